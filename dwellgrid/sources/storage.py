"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names; a temporary one only where Spark runs in one process."""
    folder = spark.conf.get(CONF, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CONF} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="dwellgrid-")
        spark.conf.set(CONF, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(table: DataFrame) -> None:
    """Drop the rows of a table from ``written`` that nothing reads any more.

    Overwriting removes the files through Spark's own writer, on any file system.
    """
    files = table.inputFiles()
    if files:
        path = files[0].rsplit("/", 1)[0]
        spark = table.sparkSession
        spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)
