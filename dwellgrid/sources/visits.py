"""Visit files: parquet and CSV in, parquet, CSV and JSON lines out."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dwellgrid.operators.clean import NO_CATEGORY, VISIT_COLUMNS, VisitDataError

# The header of a raw visit file.
RAW_HEADER = [
    "Country",
    "Plate Prefix",
    "Plate Number",
    "Entry Time",
    "Exit Time",
    "Risk Category",
    "Duration in Min",
    "Time Taken",
]

CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def load(spark: SparkSession, path: str) -> DataFrame:
    """Raw visits from a parquet file or folder, or from a CSV file with a header.

    CSV cells stay text, so that unreadable values become null in cleaning and are counted.
    """
    path = str(path)
    is_csv = path.rstrip("/").lower().endswith(".csv")
    try:
        return spark.read.csv(path, header=True) if is_csv else spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise VisitDataError(f"cannot read {path}: {e}") from e
    except (PySparkException, Py4JJavaError) as e:
        raise VisitDataError(
            f"cannot read {path}: expected a .csv file, a .parquet file or a folder"
        ) from e


def text_rows(spark: SparkSession, rows: Iterable[tuple], columns: list[str]) -> DataFrame:
    """A DataFrame of text cells from a few in-memory rows."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    cells = [tuple(None if v is None else str(v) for v in row) for row in rows]
    return spark.createDataFrame(cells, schema)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with typed columns; timestamps keep their microseconds."""
    return spark.read.option("timestampNTZFormat", CSV_TIME).csv(path, header=True, schema=schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampNTZFormat", CSV_TIME).csv(path, header=True)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_json(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines."""
    df.write.mode("append").json(path)


def reused(df: DataFrame) -> DataFrame:
    """Keep a result that several actions read; call ``unpersist`` after the last one."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def from_events(events: DataFrame, *keep: str) -> DataFrame:
    """Visits out of an event table with ``ts``, a stay in minutes in ``value`` and ``event_type``."""
    stay = "make_dt_interval(0, 0, 0, cast(round(value * 60, 1) AS decimal(18,6)))"
    return events.selectExpr(
        "cast(ts AS timestamp_ntz) AS entry_time",
        f"cast(ts AS timestamp_ntz) + {stay} AS exit_time",
        "CASE WHEN event_type != 'error' THEN event_type END AS risk_category",
        "value AS duration_min",
        *keep,
    )


def filled(visits: DataFrame) -> DataFrame:
    return visits.withColumn("risk_category", F.coalesce("risk_category", F.lit(NO_CATEGORY)))


def as_json_values(visits: DataFrame, *extra: str) -> DataFrame:
    """One text column ``value`` with a JSON object per visit, as on the stream."""
    fields = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if c.endswith("_time") else F.col(c)
        for c in (*extra, *VISIT_COLUMNS)
    ]
    return visits.select(F.to_json(F.struct(*fields)).alias("value"))
