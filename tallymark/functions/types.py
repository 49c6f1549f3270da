"""Type names, check families, common types and the canonical form of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymark.functions.sqltext import literal, quoted, sql_type

# Catalog type codes and the type names they stand for.
TYPE_CODES = {
    "A1": "ARRAY",
    "AN": "MULTI-DIMENSIONAL ARRAY",
    "AT": "TIME",
    "BF": "BYTE",
    "BO": "BLOB",
    "BV": "VARBYTE",
    "CF": "CHAR",
    "CO": "CLOB",
    "CV": "VARCHAR",
    "D": "DECIMAL",
    "DA": "DATE",
    "DH": "DATE INTERVAL TO HOUR",
    "DS": "INTERVAL DAY TO SECOND",
    "DY": "INTERVAL DAY",
    "F": "FLOAT",
    "HS": "INTERVAL HOUR TO SECOND",
    "I": "INT",
    "I1": "BYTEINT",
    "I2": "SMALLINT",
    "I8": "BIGINT",
    "11": "BYTEINT",
    "12": "SMALLINT",
    "18": "BIGINT",
    "JN": "JSON",
    "MI": "INTERVAL MINUTE",
    "MO": "INTERVAL MONTH",
    "N": "NUMBER",
    "PD": "DATE",
    "SZ": "TIMESTAMP WITH TIME ZONE",
    "TS": "TIMESTAMP",
    "TZ": "TIME WITH TIME ZONE",
    "UT": "UDT TYPE",
    "YR": "INTERVAL YEAR",
}
UNKNOWN_TYPE = "UNKNOWN"

# The families within which a source type may become a target type.
STRING_FAMILY = ["CHAR", "VARCHAR", "CLOB", "STRING", "DATE INTERVAL TO HOUR", "TIME", "VOID"]
NUMBER_FAMILY = ["DECIMAL", "NUMBER", "FLOAT"]
INTEGRAL_FAMILY = ["SHORT", "LONG", "BIGINT", "SMALLINT", "INTEGER", "INT", "VOID", "IDENTITY"]
TIMESTAMP_FAMILY = ["TIMESTAMP", "TIME WITH TIMEZONE"]
# What a string-family source may be in the target, besides VARCHAR.
STRING_TARGETS = ["STRING", "TIMESTAMP", "CHAR"]

# The field-metadata key under which Spark keeps the declared type of char/varchar columns.
CHAR_VARCHAR_KEY = "__CHAR_VARCHAR_TYPE_STRING"

_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_NAMES = {
    T.ByteType: "BYTEINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INT",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.TimeType: "TIME",
    T.BinaryType: "BYTE",
    T.NullType: "VOID",
}


def declared_text_type(field: T.StructField) -> tuple[str, int | None] | None:
    """``("CHAR" | "VARCHAR" | "STRING", length)`` of a text column, else ``None``."""
    dtype = field.dataType
    if isinstance(dtype, T.CharType):
        return "CHAR", dtype.length
    if isinstance(dtype, T.VarcharType):
        return "VARCHAR", dtype.length
    if not isinstance(dtype, T.StringType):
        return None
    declared = (field.metadata or {}).get(CHAR_VARCHAR_KEY, "")
    name, _, rest = declared.partition("(")
    if name in ("char", "varchar") and rest.rstrip(")").isdigit():
        return name.upper(), int(rest.rstrip(")"))
    return "STRING", None


def type_name(field: T.StructField) -> str:
    text = declared_text_type(field)
    if text:
        return text[0]
    if isinstance(field.dataType, T.DecimalType):
        return "DECIMAL"
    return _NAMES.get(type(field.dataType), field.dataType.simpleString().split("<")[0].upper())


def type_length(field: T.StructField) -> str | None:
    """Declared length (``"n"``) or precision and scale (``"p,s"``)."""
    text = declared_text_type(field)
    if text:
        return None if text[1] is None else str(text[1])
    if isinstance(field.dataType, T.DecimalType):
        return f"{field.dataType.precision},{field.dataType.scale}"
    return None


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimeType, T.TimestampType, T.TimestampNTZType))


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide are an error."""
    names = [c.lower() for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names differ only in case: {', '.join(clashes)}")
    return df if names == df.columns else df.toDF(*names)


def _needs_canonical(dtype: T.DataType) -> bool:
    if is_floating(dtype) or isinstance(dtype, (T.MapType, T.VariantType, T.NullType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _needs_canonical(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_needs_canonical(f.dataType) for f in dtype.fields)
    return False


def canonical_value(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """One value per meaning: NaN is null, -0.0 is 0.0, a map its sorted entries, a variant its JSON text."""
    if not _needs_canonical(dtype):
        return value
    if is_floating(dtype):
        kind = dtype.simpleString()
        return f"(nullif({value}, {kind}('NaN')) + {kind}(0))"
    if isinstance(dtype, T.VariantType):
        return f"to_json({value})"
    if isinstance(dtype, T.NullType):
        return f"cast({value} as string)"
    item = f"item{depth}"
    if isinstance(dtype, T.ArrayType):
        return f"transform({value}, {item} -> {canonical_value(item, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.MapType):
        entry = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        inner = canonical_value(item, entry, depth + 1)
        return f"array_sort(transform(map_entries({value}), {item} -> {inner}))"
    fields = ", ".join(
        f"{literal(f.name)}, {canonical_value(f'{value}.{quoted(f.name)}', f.dataType, depth)}" for f in dtype.fields
    )
    return f"if({value} is null, null, named_struct({fields}))"


def canonical(df: DataFrame) -> DataFrame:
    """Lower-case names and comparable values, ready to group and compare."""
    df = lower_names(df)
    if not any(_needs_canonical(f.dataType) for f in df.schema.fields):
        return df
    return df.selectExpr(
        *[f"{canonical_value(quoted(f.name), f.dataType)} as {quoted(f.name)}" for f in df.schema.fields]
    )


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type in which values of both types compare, or ``None`` if there is no lossless meeting."""
    if a == b:
        return a
    if is_text(a) and is_text(b):
        return T.StringType()
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if is_floating(a) or is_floating(b):
            return T.DoubleType()
        if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
            whole_a, scale_a = _digits(a)
            whole_b, scale_b = _digits(b)
            scale = max(scale_a, scale_b)
            return T.DecimalType(min(38, max(whole_a, whole_b) + scale), scale)
        return a if _INTEGRAL_DIGITS[type(a)] > _INTEGRAL_DIGITS[type(b)] else b
    if isinstance(a, T.TimeType) or isinstance(b, T.TimeType):
        return None
    if is_temporal(a) and is_temporal(b):
        if isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType):
            return T.TimestampType()
        return T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = common_type(a.elementType, b.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        if [n.lower() for n in a.names] != [n.lower() for n in b.names]:
            return None
        parts = [common_type(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)]
        if any(p is None for p in parts):
            return None
        return T.StructType([T.StructField(n.lower(), p) for n, p in zip(a.names, parts)])
    return None


def _digits(dtype: T.DataType) -> tuple[int, int]:
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale, dtype.scale
    return _INTEGRAL_DIGITS[type(dtype)], 0


def exact_cast(value: str, source: T.DataType, target: T.DataType) -> str:
    """Cast for comparison. A value that the target does not hold raises; it never rounds or turns null."""
    if source == target:
        return value
    kind = sql_type(target)
    if is_floating(target) and isinstance(source, (T.LongType, T.DecimalType)):
        back = f"try_cast(cast({value} as {kind}) as {sql_type(source)})"
        error = f"cast(raise_error('value does not fit {kind}') as {kind})"
        return f"if({value} is null or {back} <=> {value}, cast({value} as {kind}), {error})"
    if (
        isinstance(target, T.DecimalType)
        and isinstance(source, T.NumericType)
        and _digits(source)[0] + target.scale > 38
    ):
        narrowed = f"try_cast({value} as {kind})"
        error = f"cast(raise_error('value does not fit {kind}') as {kind})"
        return f"if({value} is null or {narrowed} is not null, {narrowed}, {error})"
    return f"cast({value} as {kind})"


def render(value: str, dtype: T.DataType) -> str:
    """Display text of a value; the text ``null`` where it is null."""
    text = f"base64({value})" if isinstance(dtype, T.BinaryType) else f"cast({value} as string)"
    return f"coalesce({text}, 'null')"
