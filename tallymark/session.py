"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "tallymark", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that would lie on one machine.
    """
    context = spark.sparkContext
    # `local-cluster[…]` has executors in processes of their own.
    local = context.master == "local" or context.master.startswith("local[")
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymark-"))
        folder = context.getCheckpointDir()
    if not local and re.match(r"(file:/+)?(tmp|var/tmp)/", folder.removeprefix("/")):
        raise RuntimeError(f"{folder} lies on each machine by itself; set spark.checkpoint.dir to a shared folder")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the work folder."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the work folder and read it back.

    Unlike an RDD checkpoint the table keeps column pruning and filter push-down for what follows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
