"""Movements per minute, kept beside the stream's visits.

Each batch writes the arrivals and exits of its own visits per fine chunk into the folder it owns, so a replay
replaces them. Counts at an instant then need the totals, a few bytes per minute and batch, and
only the visits that end after the earliest probe, instead of all that ever landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwellgrid.operators import asof
from dwellgrid.settings import Settings


def of_batch(visits: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(series keys, fine, arrivals, exits) of one batch."""
    return asof.fine_totals(visits, s)


def load(spark: SparkSession, folder: str, s: Settings = Settings()) -> DataFrame:
    """The totals of all batches that were stored."""
    return spark.read.parquet(folder).select(*s.keys, "fine", "arrivals", "exits")
