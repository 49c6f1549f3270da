"""Sort a table into parts by splitters from a bounded sample, with one shuffle.

``repartitionByRange`` samples whole sort keys, so wide text keys fill the driver, and what follows doesn't know how the
rows lie: a window over each range costs a second shuffle. Here the sample holds a short prefix of the key, and rows are
sent to the part they belong to by its number, which later windows over the part's number know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.sqltext import quoted, sql_type
from tallymark.session import written

#: Sampled rows per part; rows of a part at least; columns and characters of a text of the first sample's prefix.
SAMPLED, LEAST, COLUMNS, LETTERS = 24, 1 << 16, 4, 16


def sort_key(columns: list[str]) -> str:
    """A struct that sorts like the columns, ascending, nulls last."""
    return "struct(" + ", ".join(f"{quoted(c)} is null as n{i}, {quoted(c)} as v{i}" for i, c in enumerate(columns)) + ")"


def _prefix(schema: T.StructType, columns: list[str], n_columns: int, letters: int) -> str:
    """The sort key, cut: texts after some letters, and what follows a cut text or so many columns to the lowest key.

    Any value is a good splitter, so a cut key need not be one of the table's.
    """
    fields, cut = [], ["false"]
    for i, c in enumerate(columns):
        kind, name = schema[c].dataType, quoted(c)
        lowest = f"cast(null as {sql_type(kind)})"
        if i >= n_columns:
            fields += [f"false as n{i}", f"{lowest} as v{i}"]
            continue
        text = isinstance(kind, (T.StringType, T.BinaryType))
        after, value = " OR ".join(cut), f"substring({name}, 1, {letters})" if text else name
        fields += [f"if({after}, false, {name} is null) as n{i}", f"if({after}, {lowest}, {value}) as v{i}"]
        if text:
            cut.append(f"coalesce(length({name}) > {letters}, false)")
    return f"struct({', '.join(fields)})"


def splitters(rows: DataFrame, columns: list[str], parts: int, n_rows: int) -> DataFrame:
    """One row with ``cuts``, a sorted array of at most ``parts - 1`` keys that deal the rows to about equal parts.

    The sample takes ``SAMPLED`` rows per part and of each a prefix of the key. Where more than one splitter falls on one
    prefix, many rows share it, and a longer one is taken, up to the whole key.
    """
    n_columns, letters = COLUMNS, LETTERS
    share = min(1.0, SAMPLED * parts / max(n_rows, 1))
    while True:
        key = _prefix(rows.schema, columns, n_columns, letters)
        sample = rows.sample(False, share, 7).selectExpr(f"{key} as k").limit(2 * SAMPLED * parts)
        found = sample.agg(F.sort_array(F.collect_list("k")).alias("k"))
        place = f"array_distinct(transform(sequence(1, {parts - 1}), i -> cast(i * size(k) div {parts} as int)))"
        cuts = written(
            found.selectExpr("k", f"filter({place}, i -> i > 0) as places").selectExpr(
                "array_distinct(transform(places, i -> k[i])) as cuts", "size(places) as wanted"
            ),
            "cuts",
        )
        got, wanted = cuts.selectExpr("size(cuts)", "wanted").first()
        if got == wanted or n_columns >= len(columns) and letters >= 1 << 16:
            return cuts.select("cuts")
        n_columns, letters = 4 * n_columns, 8 * letters


def sorted_parts(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """The rows with ``part``, and the number of parts: each lies in one task, and its keys sort before those of the next.

    ``rows`` should be a written table: it is counted, sampled and read.
    """
    n_rows = rows.count()
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, -(-n_rows // LEAST)))
    if parts == 1:
        return rows.coalesce(1).withColumn("part", F.lit(0)), 1
    cuts = splitters(rows, columns, parts, n_rows)
    steps = ", ".join(str(1 << k) for k in reversed(range(parts.bit_length())))
    key = sort_key(columns)
    search = f"aggregate(array({steps}), 0, (at, step) -> if(at + step <= size(cuts) AND cuts[at + step - 1] <= {key}, at + step, at))"
    placed = rows.withColumn("cuts", cuts.scalar()).selectExpr(*[quoted(c) for c in rows.columns], f"{search} as part")
    return placed.repartitionById(parts, F.col("part")), parts
