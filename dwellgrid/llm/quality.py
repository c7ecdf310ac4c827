"""Quality rules: fixed text statistics, then robust multivariate outliers per language and source.

**Statistics** (``with_statistics``). Words are runs of anything but ASCII white space; a null text
has none. Everything is computed inside the row: no text is shuffled. Repeated 8-word windows are
found by combining word hashes pairwise (1, 2, 4, 8 words) and looking for equal 64-bit window
hashes, so equality of windows is equality of hashes.

**Minimum covariance determinant** (``fit``). Each document becomes a vector of transformed
statistics (``FEATURES``). Per (language, source), per language, and over all rows, the estimate
is the mean and covariance of the half-or-more rows (``Mcd.support``) with the smallest
covariance determinant, reached by C-steps from two starts: distances from the median scaled by
the median absolute deviation, summed or maximal over the coordinates. A C-step is two
aggregations over the small vector table (the distance quantile, then the moments of the rows
within it), both combined map-side, so a source with a third of all rows is one partial row per
task. The better determinant wins. Means and covariances are consistency-scaled, and every
variance has a floor (``Feature.floor``), because most clean documents have exactly no symbols and
no repeats and the plain determinant would be zero. Cells with fewer than ``Mcd.least`` rows use
the language's estimate, then that of all rows.

**Verdict.** A document is rejected if a fixed rule fails, or if its squared Mahalanobis distance is
above ``Mcd.cutoff`` *and* it lies on the bad side: only deviations towards more symbols, more
capitals, more repetition or odd word lengths count (``Feature.side``); being unusually clean or
long is no reason to reject.

Null language or source is a group of its own. Empty tables give empty tables. Repeated rows count
repeatedly and are all returned. Columns of the input are kept, also ones named like an
intermediate value; an input column named like an output is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written

SPACE = r"[\\x20\\x09-\\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
CELL_FILES = 8


@dataclass(frozen=True)
class Feature:
    """A transformed statistic: SQL over the counts, least standard deviation, side that is bad."""

    name: str
    sql: str
    floor: float
    side: str  # "high" or "both"


FEATURES = (
    Feature("f_length", "ln(greatest(word_chars, 1) / greatest(n_words, 1))", 0.10, "both"),
    Feature("f_symbols", "sqrt(n_symbols / greatest(n_words, 1))", 0.12, "high"),
    Feature("f_lines", "sqrt(n_dup_lines / greatest(n_lines, 1))", 0.15, "high"),
    Feature("f_repeat", "sqrt(n_repeat_words / greatest(n_words, 1))", 0.15, "high"),
    Feature("f_upper", "sqrt(n_upper / greatest(word_chars, 1))", 0.08, "high"),
    Feature("f_variety", "ln(greatest(n_words, 1) / greatest(n_distinct, 1))", 0.25, "high"),
)


@dataclass(frozen=True)
class Mcd:
    """Parameters of the estimate and of the verdict."""

    support: float = 0.75
    steps: int = 3
    least: int = 100
    cutoff: float = 33.0
    accuracy: int = 2000


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the counts appended."""
    names = ["_q_words", "_q_text"]
    body = f"coalesce(`{text}`, '')"
    out = docs.drop(*COUNTS, "n_lines", "n_upper", "n_distinct", *names)
    out = out.selectExpr("*", f"{body} AS _q_text").selectExpr(
        "*", f"filter(split(_q_text, '{SPACE}'), w -> w != '') AS _q_words"
    )
    lines = rf"filter(split(_q_text, '\\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"
    hashes = "transform(_q_words, w -> xxhash64(w))"
    pair = "zip_with(slice(a, 1, size(a) - {k}), slice(a, {k} + 1, size(a)), (x, y) -> xxhash64(x, y))"
    window = hashes
    for k in (1, 2, 4):
        window = f"element_at(transform(array({window}), a -> {pair.format(k=k)}), 1)"
    # Positions of windows that occur twice or more: neighbours in (hash, position) order.
    again = """
        element_at(transform(array(sort_array(transform(w, (h, i) -> struct(h, i)))), s ->
            sort_array(transform(filter(transform(s, (x, k) -> struct(
                x.i AS i,
                coalesce(x.h = get(s, k - 1).h, false) OR coalesce(x.h = get(s, k + 1).h, false)
                AS twice)), x -> x.twice), x -> x.i))), 1)"""
    covered = f"""
        element_at(transform(array({again}), p -> aggregate(
            transform(p, (x, k) -> least(8, coalesce(get(p, k + 1) - x, 8))),
            0, (s, x) -> s + x)), 1)"""
    repeat = f"""
        CASE WHEN size(_q_words) < 9 THEN 0 ELSE
        element_at(transform(array({window}), w ->
            CASE WHEN size(array_distinct(w)) = size(w) THEN 0 ELSE {covered} END), 1) END"""
    out = out.selectExpr(
        "*",
        "CAST(size(_q_words) AS BIGINT) AS n_words",
        f"CAST(length(regexp_replace(_q_text, '{SPACE}', '')) AS BIGINT) AS word_chars",
        "CAST(length(_q_text) - length(translate(_q_text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols",
        f"{lines} AS _q_lines",
        f"CAST({repeat} AS BIGINT) AS n_repeat_words",
        r"CAST(length(_q_text) - length(regexp_replace(_q_text, '\\p{Lu}+', '')) AS BIGINT) AS n_upper",
        "CAST(size(array_distinct(_q_words)) AS BIGINT) AS n_distinct",
    ).selectExpr(
        "*",
        "CAST(size(_q_lines) - size(array_distinct(_q_lines)) AS BIGINT) AS n_dup_lines",
        "CAST(size(_q_lines) AS BIGINT) AS n_lines",
    )
    return out.drop(*names, "_q_lines")


BASE_FAILED = "(n_words < 20 OR 100 * n_repeat_words > 30 * n_words)"

_N = len(FEATURES)
_X = [f.name for f in FEATURES]


def _key(level: int) -> str:
    """Group of a row: 0 language and source, 1 language, 2 everything."""
    lang, source = "coalesce(concat('l', lang), '')", "coalesce(concat('s', source), '')"
    return {
        0: f"concat_ws('\\u0001', '0', {lang}, {source})",
        1: f"concat_ws('\\u0001', '1', {lang})",
        2: "'2'",
    }[level]


def vectors(stats: DataFrame) -> DataFrame:
    """Language, source, the feature vector and the outcome of the fixed rules, per document."""
    return stats.selectExpr(
        "lang",
        "source",
        *[f"CAST({f.sql} AS DOUBLE) AS {f.name}" for f in FEATURES],
        f"{BASE_FAILED} AS base_failed",
    )


def _moments(rows: DataFrame) -> DataFrame:
    """Mean, inverse Cholesky factor and log determinant of the covariance, per cell and start.

    Sums of products are plain sums: the features are of order one, so nothing cancels badly.
    """
    by = ["cell", "start"]
    pairs = [(i, j) for i in range(_N) for j in range(i + 1)]
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(x).alias(f"s_{x}") for x in _X]
    sums += [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p_{i}_{j}") for i, j in pairs]
    mean = [F.col(f"s_{x}") / F.col("n") for x in _X]
    return _factor(
        rows.groupBy(*by)
        .agg(*sums)
        .select(
            *by,
            "n",
            *[mean[i].alias(f"m_{_X[i]}") for i in range(_N)],
            *[(F.col(f"p_{i}_{j}") / F.col("n") - mean[i] * mean[j]).alias(f"c_{i}_{j}") for i, j in pairs],
        ),
        by,
    )


def _factor(m: DataFrame, by: list[str]) -> DataFrame:
    """Cholesky factor of the floored covariance and its inverse, column by column."""
    for i in range(_N):
        m = m.withColumn(f"c_{i}_{i}", F.col(f"c_{i}_{i}") + F.lit(FEATURES[i].floor ** 2))
    logdet = F.lit(0.0)
    for i in range(_N):
        low = {}
        for j in range(i + 1):
            s = F.col(f"c_{i}_{j}")
            for k in range(j):
                s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            m = m.withColumn(
                f"l_{i}_{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"l_{j}_{j}")
            )
        logdet = logdet + F.log(F.col(f"l_{i}_{i}"))
    for i in range(_N):
        m = m.withColumn(f"w_{i}_{i}", 1 / F.col(f"l_{i}_{i}"))
        for j in range(i):
            s = F.lit(0.0)
            for k in range(j, i):
                s = s + F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}")
            m = m.withColumn(f"w_{i}_{j}", -s / F.col(f"l_{i}_{i}"))
    return m.select(
        *by,
        "n",
        logdet.alias("logdet"),
        F.array(*[f"m_{x}" for x in _X]).alias("centre"),
        F.array(*[f"w_{i}_{j}" for i in range(_N) for j in range(i + 1)]).alias("inverse"),
    )


def _distance(x: list[str]) -> str:
    """SQL of the squared distance of ``x`` from ``centre`` under ``inverse``."""
    terms, at = [], 0
    for i in range(_N):
        z = " + ".join(f"inverse[{at + j}] * ({x[j]} - centre[{j}])" for j in range(i + 1))
        terms.append(f"pow({z}, 2)")
        at += i + 1
    return " + ".join(terms)


def _written_cells(table: DataFrame, label: str) -> DataFrame:
    """A written table with one row per cell, in a few files.

    A file for each shuffle partition would be mostly footers, and their bytes alone would put a
    table of some dozen cells above the threshold below which Spark broadcasts it.
    """
    return written(table.repartition(CELL_FILES), label)


def fit(stats: DataFrame, p: Mcd = Mcd()) -> DataFrame:
    """Centre and inverse Cholesky factor of every cell of every level: a table to join.

    What the rows are joined with has one row per cell and is written first, so that Spark knows
    its size: it is broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and no row is dealt
    by its cell. Beyond that the join shuffles and leaves hot cells to adaptive splitting.
    """
    vec = vectors(stats).filter("NOT base_failed").drop("base_failed")
    cells = vec.selectExpr(
        f"explode(array({_key(0)}, {_key(1)}, {_key(2)})) AS cell", *_X
    )
    middle = cells.groupBy("cell").agg(
        *[F.percentile_approx(x, 0.5, p.accuracy).alias(f"med_{x}") for x in _X]
    )
    spread = (
        cells.join(_written_cells(middle, "mcd-middle"), "cell")
        .groupBy("cell")
        .agg(
            *[F.first(f"med_{x}").alias(f"med_{x}") for x in _X],
            *[
                F.percentile_approx(F.abs(F.col(x) - F.col(f"med_{x}")), 0.5, p.accuracy).alias(
                    f"mad_{x}"
                )
                for x in _X
            ],
        )
    )
    scaled = [
        f"pow(({f.name} - med_{f.name}) / greatest(1.4826 * mad_{f.name}, {f.floor}), 2)"
        for f in FEATURES
    ]
    rows = (
        cells.join(_written_cells(spread, "mcd-spread"), "cell")
        .selectExpr(
            "cell",
            *_X,
            f"explode(array(struct(0 AS start, {' + '.join(scaled)} AS d2),"
            f" struct(1 AS start, greatest({', '.join(scaled)}) AS d2))) AS s",
        )
        .selectExpr("cell", *_X, "s.*")
    )
    estimate = None
    for _ in range(p.steps + 1):
        cut = rows.groupBy("cell", "start").agg(
            F.percentile_approx("d2", p.support, p.accuracy).alias("cut")
        )
        core = rows.join(_written_cells(cut, "mcd-cut"), ["cell", "start"]).filter("d2 <= cut")
        estimate = _written_cells(_moments(core), "mcd-step")
        rows = (
            cells.join(estimate, "cell").selectExpr("cell", "start", *_X, f"{_distance(_X)} AS d2")
        )
    best = estimate.groupBy("cell").agg(
        F.min_by(F.struct("n", "centre", "inverse"), F.struct("logdet", "start")).alias("e")
    )
    # Consistency: the median distance of a normal sample is the median of chi squared.
    middle_d2 = (
        cells.join(best, "cell")
        .selectExpr("cell", "e.*", *_X)
        .selectExpr("cell", f"{_distance(_X)} AS d2")
        .groupBy("cell")
        .agg(F.percentile_approx("d2", 0.5, p.accuracy).alias("mid"), F.count(F.lit(1)).alias("rows"))
    )
    chi_median = _N * (1 - 2 / (9 * _N)) ** 3
    return (
        best.join(middle_d2, "cell")
        .withColumn("scale", F.greatest(F.lit(1.0), F.col("mid") / F.lit(chi_median)))
        .select("cell", "rows", "scale", "e.centre", "e.inverse")
    )


def judged(stats: DataFrame, model: DataFrame, p: Mcd = Mcd()) -> DataFrame:
    """All columns of ``stats`` with ``base_failed``, ``distance`` and ``kept``."""
    enough = model.filter((F.col("rows") >= p.least) | (F.col("cell") == "2")).selectExpr(
        "cell", "struct(scale, centre, inverse) AS est"
    )
    out = stats.drop("base_failed", "kept", "distance")
    for level in (0, 1, 2):
        side = enough.selectExpr(f"cell AS _q_cell{level}", f"est AS _q_est{level}")
        out = out.withColumn(f"_q_cell{level}", F.expr(_key(level))).join(
            side, f"_q_cell{level}", "left"
        )
    out = out.withColumn("_q_est", F.coalesce("_q_est0", "_q_est1", "_q_est2"))
    # A coordinate on its good side counts as the centre's value.
    x = []
    for i, f in enumerate(FEATURES):
        v = f"CAST({f.sql} AS DOUBLE)"
        x.append(f"greatest({v}, _q_est.centre[{i}])" if f.side == "high" else v)
    d2 = _distance(x).replace("inverse[", "_q_est.inverse[").replace(" centre[", " _q_est.centre[")
    return (
        out.selectExpr(
            "*",
            f"{BASE_FAILED} AS base_failed",
            f"coalesce(({d2}) / _q_est.scale, 0.0D) AS distance",
        )
        .withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= p.cutoff))
        .drop("_q_est", *[f"_q_{n}{i}" for n in ("cell", "est") for i in (0, 1, 2)])
    )


def rules(docs: DataFrame, p: Mcd = Mcd()) -> DataFrame:
    """Statistics and verdict of every document; the text is read once for the statistics.

    The statistics are written to the shared folder without the text, because the estimate reads
    them several times.
    """
    extra = [*COUNTS, "n_lines", "n_upper", "n_distinct"]
    small = [c for c in docs.columns if c not in ("text", *extra)]
    stats = written(with_statistics(docs).select(*small, *extra), "quality")
    return judged(stats, _written_cells(fit(stats, p), "quality-model"), p)


def filtered(docs: DataFrame, p: Mcd = Mcd()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Statistics are computed once and written beside the whole row; the estimate reads the former alone and the
    verdict is read from the same file, so rows need no identifier and no join on one.
    """
    extra = [*COUNTS, "n_lines", "n_upper", "n_distinct"]
    hidden = docs.select("text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_q_row"))
    stats = written(with_statistics(hidden).select("_q_row", "lang", "source", *extra), "quality")
    model = _written_cells(fit(stats.drop("_q_row"), p), "quality-model")
    return judged(stats, model, p).filter("kept").select("_q_row.*")
