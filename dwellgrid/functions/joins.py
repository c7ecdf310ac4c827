"""Joins in which a null series key equals a null series key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], plain: Sequence[str] = ()) -> DataFrame:
    """``left`` with the other columns of ``right``; ``keys`` match null-safe, ``plain`` by value."""
    both = [*keys, *plain]
    other = right.withColumnsRenamed({c: f"__r_{c}" for c in both})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    same += [F.col(c) == F.col(f"__r_{c}") for c in plain]
    condition = same[0]
    for x in same[1:]:
        condition = condition & x
    return left.join(other, condition, "left").drop(*[f"__r_{c}" for c in both])
