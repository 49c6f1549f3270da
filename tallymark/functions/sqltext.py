"""Pieces of SQL text.

Expressions over the columns of a table are built as text: a wide table then costs one call into Spark per
frame instead of several per column.
"""

from __future__ import annotations

from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str | None) -> str:
    """A text constant as SQL."""
    if text is None:
        return "cast(null as string)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.ArrayType):
        return f"array<{sql_type(dtype.elementType)}>"
    if isinstance(dtype, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {sql_type(f.dataType)}" for f in dtype.fields) + ">"
    return dtype.simpleString()


# Words that plain SQL does not take as names without quotes.
RESERVED = frozenset(
    """all alter and any as asc between by case cast check column constraint create cross current date default delete
    desc distinct drop else end except exists false fetch for foreign from full grant group having in index inner insert
    intersect interval into is join key left like limit natural not null offset on or order outer primary references
    right row rows select set some table then time timestamp to true union unique update user using values view when
    where window with year""".split()
)


def sql_name(name: str, quote: str = '"') -> str:
    """A name for another engine, in quotes where it is reserved or not a plain word."""
    plain = name.isidentifier() and name.isascii() and name.lower() not in RESERVED
    return name if plain else quote + name.replace(quote, quote * 2) + quote


def inline(names: list[str], rows: list[list[str]]) -> str:
    """SQL that turns one wide row into the given rows of expressions."""
    structs = [
        "named_struct(" + ", ".join(f"{literal(n)}, {v}" for n, v in zip(names, values)) + ")" for values in rows
    ]
    return f"inline(array({', '.join(structs)}))"


def chunks(items: list, size: int | None) -> list[list]:
    """The items in parts of ``size``, or as one part."""
    size = size or max(len(items), 1)
    return [items[i : i + size] for i in range(0, len(items), size)]
