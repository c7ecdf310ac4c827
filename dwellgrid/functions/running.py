"""Ordered computations that never put a whole series into one task.

``running_total`` is a prefix sum over nested chunks: each chunk is summed on its own
and starts from the total of everything before it. ``halo`` copies the rows near a chunk
border into the neighbouring chunk, so lags and framed windows can run per chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from dwellgrid.functions.timecols import floor_index

_CARRY = "__carry"
CHUNK = "__chunk"
HOME = "__home_chunk"


def window(by: Sequence[str], order: Sequence[str], frame: tuple[int, int] | None = None) -> str:
    """The text of an OVER clause; ``frame`` counts rows from the current one."""
    parts = f"PARTITION BY {', '.join(by)} " if by else ""
    parts += f"ORDER BY {', '.join(order)}"
    if frame is not None:

        def edge(k: int) -> str:
            if k == 0:
                return "CURRENT ROW"
            return f"{abs(k)} {'PRECEDING' if k < 0 else 'FOLLOWING'}"

        parts += f" ROWS BETWEEN {edge(frame[0])} AND {edge(frame[1])}"
    return f"OVER ({parts})"


def _up_to_here(by: Sequence[str], order: Sequence[str]) -> str:
    return window(by, order)[:-1] + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def running_total(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, str],
    keys: Sequence[str] = (),
    levels: Sequence[str] = (),
) -> DataFrame:
    """Add ``{output: source}`` inclusive running sums per ``keys`` in ``order``.

    ``levels`` are chunk columns from coarse to fine, each monotone in ``order``; they are
    dropped from the result. The only window over a whole series is the one over its coarsest
    chunks. The total before a chunk enters as one extra row at its head, so the rows are
    shuffled once, no join is needed and null keys keep their own series.
    """
    if not levels:
        over = _up_to_here(keys, order)
        return df.selectExpr("*", *[f"sum({src}) {over} AS {out}" for out, src in sums.items()])

    fine = levels[-1]
    sources = list(dict.fromkeys(sums.values()))
    upto = {f"__upto_{s}": s for s in sources}
    totals = df.selectExpr(*keys, *levels, *sources).groupBy(*keys, *levels).sum(*sources)
    totals = totals.selectExpr(*keys, *levels, *[f"`sum({s})` AS {s}" for s in sources])
    carried = running_total(totals, [fine], upto, keys, levels[:-1])
    plain = [c for c in df.columns if c not in (*keys, *sources, fine)]
    heads = carried.selectExpr(
        *keys,
        *[f"__upto_{s} - {s} AS {s}" for s in sources],
        fine,
        *[f"cast(null AS {t}) AS {c}" for c, t in df.dtypes if c in plain],
        f"0 AS {_CARRY}",
    )
    rows = df.selectExpr(*keys, *sources, fine, *plain, f"1 AS {_CARRY}").union(heads)
    over = _up_to_here([*keys, fine], [_CARRY, *order])
    kept = [c for c in df.columns if c not in levels]
    return rows.selectExpr(
        *kept, _CARRY, *[f"sum({src}) {over} AS {out}" for out, src in sums.items()]
    ).filter(f"{_CARRY} = 1").drop(_CARRY)


def halo(df: DataFrame, ts: str, chunk_seconds: int, back_seconds: int, ahead_seconds: int = 0) -> DataFrame:
    """Copy each row into every chunk with a row that looks at it.

    A row may look ``back_seconds`` into the past and ``ahead_seconds`` into the future.
    """
    first = floor_index(ts, chunk_seconds, -ahead_seconds)
    last = floor_index(ts, chunk_seconds, back_seconds)
    return df.selectExpr(
        "*",
        f"{floor_index(ts, chunk_seconds)} AS {HOME}",
        f"explode(sequence({first}, {last})) AS {CHUNK}",
    )


def in_chunk(keys: Sequence[str], order: str, frame: tuple[int, int] | None = None) -> str:
    """The OVER clause of a window inside a chunk of ``halo``."""
    return window([*keys, CHUNK], [order], frame)


def drop_halo(df: DataFrame) -> DataFrame:
    """Keep each row once, in its own chunk."""
    return df.filter(f"{HOME} = {CHUNK}").drop(HOME, CHUNK)
