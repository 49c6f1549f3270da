"""Write results, whole and partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows shown in a preview.
PREVIEW_ROWS = 1000


def write_result(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(), mode: str = "error") -> None:
    """Write all of ``df`` as Parquet, ORC, CSV or JSON."""
    writer = df.write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def preview(df: DataFrame, order: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by ``order``."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(rows)
