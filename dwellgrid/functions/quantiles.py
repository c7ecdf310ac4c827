"""Exact interpolated percentiles that no task has to sort a whole group for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written

SMALL = 65_536
SPLITS = 1024
MOST_PASSES = 40


def percentiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    keys: Sequence[str] = (),
    small: int = SMALL,
    splits: int = SPLITS,
) -> DataFrame:
    """One row per ``keys`` with the non-null count ``n`` and a column per entry of ``probs``.

    Linear interpolation between the closest ranks, as in ``percentile``. A cell is a range of values
    that holds a wanted rank; the first is the whole group. A pass cuts every cell of more than ``small``
    rows that has more than one value into ``splits`` parts and counts these map-side, and
    only the parts with a wanted rank go on, with the least and greatest value found in them. What
    is sorted in the end are the values of small cells, and a hot value is one counted row. The
    first pass cuts at logarithms, so that far outliers cost no further passes.
    """
    keys = list(keys)
    rows = df.filter(f"{value} IS NOT NULL").selectExpr(*keys, f"cast({value} AS double) AS __v")
    cells = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
    )
    cells = cells.selectExpr(
        *keys,
        "n",
        "0L AS __cell",
        "__lo",
        "__hi",
        "0L AS __before",
        "n AS __rows",
        f"array({', '.join(_wanted(probs))}) AS __wanted",
    )
    wide = f"__rows > {small} AND __lo < __hi"
    for turn in range(MOST_PASSES):
        if not cells.agg(F.expr(f"coalesce(bool_or({wide}), false)")).first()[0]:
            break
        parts = _split(rows, cells.filter(wide), keys, splits, logarithmic=turn == 0)
        cells = written(parts.unionByName(cells.filter(f"NOT ({wide})")), "percentile-cells")
    return _read(rows, cells, keys, list(probs))


def _wanted(probs: Mapping[str, float]) -> list[str]:
    """SQL of the two ranks of every percentile, and how far it lies between them."""
    out = []
    for i, p in enumerate(probs.values()):
        h = f"((n - 1) * {float(p)}D)"
        for side, rank in (("lo", "floor"), ("hi", "ceil")):
            out.append(
                f"named_struct('i', {i}, 'side', '{side}', 'rank', cast({rank}({h}) AS bigint), "
                f"'part', {h} - floor({h}))"
            )
    return out


def _inside(rows: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the cells, each with its cell. Without keys a few cells at most: they are broadcast."""
    side = cells.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = " AND ".join(["__v >= __lo", "__v <= __hi", *[f"{k} <=> __k_{k}" for k in keys]])
    joined = rows.join(side if keys else F.broadcast(side), F.expr(same))
    return joined.drop(*[f"__k_{k}" for k in keys])


def _split(
    rows: DataFrame, cells: DataFrame, keys: list[str], splits: int, logarithmic: bool
) -> DataFrame:
    """The parts of the cells that hold a wanted rank, as new cells."""

    def scale(x: str) -> str:
        return f"(signum({x}) * ln(1 + least(abs({x}), 1e308D)))" if logarithmic else x

    span = f"nullif({scale('__hi')} - {scale('__lo')}, 0)"
    at = f"coalesce(nanvl(({scale('__v')} - {scale('__lo')}) / {span} * {splits}, 0), 0)"
    counted = (
        _inside(rows, cells.drop("__wanted", "n", "__before", "__rows"), keys)
        .selectExpr(*keys, "__cell", f"cast(least({at}, {splits - 1}) AS int) AS __part", "__v")
        .groupBy(*keys, "__cell", "__part")
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    )
    # At most ``splits`` rows per cell.
    by = ", ".join([*keys, "__cell"])
    upto = f"sum(__rows) OVER (PARTITION BY {by} ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    parts = counted.selectExpr("*", f"{upto} AS __upto")
    old = cells.selectExpr(
        *[f"{k} AS __k_{k}" for k in keys], "__cell AS __old", "n", "__before AS __start", "__wanted AS __all"
    )
    same = " AND ".join(["__cell = __old", *[f"{k} <=> __k_{k}" for k in keys]])
    first = "(__start + __upto - __rows)"
    return (
        parts.join(old, F.expr(same))
        .selectExpr(
            *keys,
            "n",
            "0L AS __cell",
            "__lo",
            "__hi",
            f"{first} AS __before",
            "__rows",
            f"filter(__all, t -> t.rank >= {first} AND t.rank < {first} + __rows) AS __wanted",
        )
        .filter("size(__wanted) > 0")
        # A wanted rank lies in one cell only, so the first one names it.
        .withColumn("__cell", F.expr("array_min(transform(__wanted, t -> t.i * 2L + int(t.side = 'hi')))"))
    )


def _read(rows: DataFrame, cells: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The values at the wanted ranks, interpolated."""
    by = ", ".join([*keys, "__cell"])
    upto = f"sum(__n) OVER (PARTITION BY {by} ORDER BY __v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    values = (
        _inside(rows, cells.select(*keys, "__cell", "__lo", "__hi"), keys)
        .groupBy(*keys, "__cell", "__v")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    hits = cells.selectExpr(
        *[f"{k} AS __k_{k}" for k in keys], "__cell AS __hit", "n", "__before", "__wanted"
    )
    same = " AND ".join(["__cell = __hit", *[f"{k} <=> __k_{k}" for k in keys]])
    ranked = (
        values.join(hits if keys else F.broadcast(hits), F.expr(same))
        .selectExpr(*keys, "n", "__v", "__n", "__wanted", f"__before + {upto} AS __to")
        .selectExpr(
            *keys, "n", "__v", "explode(filter(__wanted, t -> t.rank >= __to - __n AND t.rank < __to)) AS __t"
        )
    )

    def pick(i: int, side: str, what: str) -> str:
        return f"max(CASE WHEN __t.i = {i} AND __t.side = '{side}' THEN {what} END)"

    out = ["max(n) AS n"]
    for i, name in enumerate(names):
        lo, hi, part = pick(i, "lo", "__v"), pick(i, "hi", "__v"), pick(i, "lo", "__t.part")
        out.append(f"{lo} + {part} * ({hi} - {lo}) AS {name}")
    return ranked.groupBy(*keys).agg(*[F.expr(e) for e in out])
