"""Toxicity: maximum-scoring segments of token log-odds, with extreme-value calibration.

**Tokens** are runs of letters and digits of the lower-cased text. **Log-odds**: a token's score is the
log ratio of its rates in toxic and other documents, both smoothed by a Dirichlet prior whose mean
is the pooled rate, moved towards zero by one standard deviation, less a constant drift. Counts
are of documents with the token, equal texts counting once, so that a repeated text proves no more
than one. Tokens that say nothing fall back on their first letters (``Model.stems``), else on the
drift alone.

**Segments**: the linear-time scan for all maximal scoring subsequences (Ruzzo and Tompa). It runs over
the positive tokens only; what lies between them is a difference of cumulative sums.

**Calibration**: with lambda and K of the background, a segment of score S in a document of n tokens
has ``lambda S - ln(K n)`` nats of evidence against chance. Segments above ``Fit.significant`` are
passages; their evidence is summed and mapped to a probability by a logistic curve fitted on
labelled rows that took no part in the token scores.

The fit uses at most ``Fit.rows`` labelled rows (those with the smallest hash of the identifier), so the
list of identifiers that is broadcast, their words and the histogram that reach the driver are bounded. Scoring covers every whole text and is a function of the row alone.

Null and empty texts have no token and get the probability of no evidence. Rows without label are
scored like others; repeated rows are repeated. Without both labels in the sample every score is 0.
Columns of the input are kept; one called like an output is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

TOKEN = re.compile(r"[^\W_]+")
MEMO_ENTRIES = 500_000


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit."""

    rows: int = 30_000
    prior: float = 2.0
    least_documents: int = 3
    stems: tuple[int, ...] = (6, 4)
    drift: float = 0.05
    significant: float = 2.0


@dataclass
class Model:
    """Token scores and calibration; small enough to travel with the task."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    lengths: tuple[int, ...] = (6, 4)
    drift: float = 0.05
    lam: float = 1.0
    log_k: float = 0.0
    significant: float = 2.0
    slope: float = 0.0
    intercept: float = -30.0

    def token(self, w: str) -> float:
        s = self.words.get(w)
        for n in self.lengths:
            if not s and len(w) > n:
                s = self.stems.get(w[:n])
        return (s or 0.0) - self.drift

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        z = self.intercept + self.slope * np.log1p(evidence)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences as (start, end, score), left to right, in linear time."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum through
    back: list[int] = []  # for each candidate, the nearest earlier one with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, low, high = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = back[j]
            if j < 0 or found[j][3] >= high:
                found.append((start, end, low, high))
                back.append(j)
                break
            start, low = found[j][0], found[j][2]
            del found[j:], back[j:]
    return [(a, b, high - low) for a, b, low, high in found]


def _evidence(model: Model, score: float, n: int) -> float:
    return model.lam * score - model.log_k - math.log(max(n, 1))


class _Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.memo = model, {}

    def scores(self, text: str) -> np.ndarray:
        memo = self.memo
        words = TOKEN.findall(text.lower())
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        for w in set(words):
            if w not in memo:
                memo[w] = self.model.token(w)
        return np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float, float]]]:
        """Number of tokens, and (first token, end token, score, evidence) of each significant segment."""
        s = self.scores(text)
        out = []
        for a, b, score in maximal_segments(s):
            e = _evidence(self.model, score, len(s))
            if e > self.model.significant:
                out.append((a, b, score, e))
        return len(s), out


PASSAGE = StructType(
    [
        StructField("first_token", IntegerType()),
        StructField("end_token", IntegerType()),
        StructField("score", DoubleType()),
        StructField("evidence", DoubleType()),
    ]
)
RESULT = StructType(
    [
        StructField("score", DoubleType()),
        StructField("predicted", IntegerType()),
        StructField("evidence", DoubleType()),
        StructField("n_tokens", LongType()),
        StructField("passages", ArrayType(PASSAGE)),
    ]
)


def toxicity(model: Model, text: Column) -> Column:
    """Struct of score, label, evidence and passages of a text column."""

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(model)
        for batch in batches:
            rows = []
            for t in batch:
                n, found = scorer.passages(t if isinstance(t, str) else "")
                rows.append((sum(x[3] for x in found), n, found))
            evidence = np.array([r[0] for r in rows], dtype=float)
            p = model.probability(evidence)
            yield pd.DataFrame(
                {
                    "score": p,
                    "predicted": (p >= 0.5).astype("int32"),
                    "evidence": evidence,
                    "n_tokens": [r[1] for r in rows],
                    "passages": [
                        [dict(zip(PASSAGE.names, x, strict=True)) for x in r[2]] for r in rows
                    ],
                }
            )

    return score(text)


def fold(doc_id: Column) -> Column:
    """The fold of a document, 0 (held out) to 4; null without identifier."""
    return F.crc32(doc_id.cast("string")) % 5


def labelled(docs: DataFrame, labels: DataFrame, p: Fit) -> DataFrame:
    """Text, label and fold of at most ``p.rows`` labelled rows outside the held-out fold."""
    chosen = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .filter(fold(F.col("doc_id")) != 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(p.rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "toxic", fold(F.col("doc_id")).alias("fold")
    )


COUNTED = "kind string, token string, toxic int, n long"


def _counts(rows: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """Documents with each word and each stem, by label; equal texts are one document."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n: Counter = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = set(TOKEN.findall(text.lower() if isinstance(text, str) else ""))
                n.update(("w", w, toxic) for w in words)
                n.update(("s", s, toxic) for s in {w[:k] for k in lengths for w in words if len(w) > k})
            yield pd.DataFrame(
                [(*key, k) for key, k in n.items()], columns=["kind", "token", "toxic", "n"]
            )

    return rows.select("text", "toxic").distinct().mapInPandas(count, COUNTED)


def _log_odds(sizes: dict[str, tuple[float, float]], prior: float) -> str:
    """SQL of the shrunken log-odds of a row with kind and counts ``c1`` and ``c0``."""
    cases = []
    for kind, (n1, n0) in sizes.items():
        share = n1 / (n1 + n0)
        x1, x0 = prior * share, prior * (1 - share)
        delta = f"ln((c1 + {x1}D) / {n1 + x1}D) - ln((c0 + {x0}D) / {n0 + x0}D)"
        sd = f"least(sqrt(1 / (c1 + {x1}D) + 1 / (c0 + {x0}D)), 2.0D)"
        cases.append(f"WHEN kind = '{kind}' THEN signum({delta}) * greatest(abs({delta}) - {sd}, 0.0D)")
    return f"CASE {' '.join(cases)} END"


def _solve_lambda(scores: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1."""
    weight = weight / weight.sum()
    low, high = 1e-3, 20.0
    if not (scores > 0).any() or weight[scores > 0].sum() == 0:
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if float((weight * np.exp(np.minimum(mid * scores, 600))).sum()) < 1:
            low = mid
        else:
            high = mid
    return low


def fit(docs: DataFrame, labels: DataFrame, p: Fit = Fit()) -> Model:
    """Token scores from folds 2 to 4 of the sample, calibration from fold 1."""
    rows = labelled(docs, labels, p)
    counts = (
        _counts(rows.filter("fold > 1"), p.stems)
        .groupBy("kind", "token")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("c1"),
            F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("c0"),
        )
    )
    sizes = {
        r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("c1").alias("n1"), F.sum("c0").alias("n0")).collect()
    }
    model = Model(lengths=p.stems, drift=p.drift, significant=p.significant)
    if "w" not in sizes or not sizes["w"]["n1"] or not sizes["w"]["n0"]:
        return model
    totals = {k: (float(r["n1"] or 1), float(r["n0"] or 1)) for k, r in sizes.items()}
    # All of them: the bound on labelled rows bounds their words.
    used = (
        counts.filter(F.col("c1") + F.col("c0") >= p.least_documents)
        .withColumn("score", F.expr(_log_odds(totals, p.prior)))
        .filter("score != 0")
        .select("kind", "token", "score", "c0")
        .toArrow()
    )
    kinds, tokens, scores, clean = (c.to_pylist() for c in used.columns)
    model.words = {t: x for k, t, x in zip(kinds, tokens, scores) if k == "w"}
    model.stems = {t: x for k, t, x in zip(kinds, tokens, scores) if k == "s"}
    told = [(x - p.drift, n) for k, x, n in zip(kinds, scores, clean) if k == "w"]
    rest = totals["w"][1] - sum(n for _, n in told)
    scores, weights = zip(*told, (-p.drift, max(rest, 1.0)))
    model.lam = _solve_lambda(np.array(scores, dtype=float), np.array(weights, dtype=float))
    return _calibrated(model, rows.filter("fold = 1"))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, free: tuple[bool, bool] = (True, True)) -> np.ndarray:
    """Intercept and slope with the highest penalised likelihood of weighted labels.

    Newton steps are halved until the likelihood rises enough. It is strictly concave, so this ends at
    its one maximum, separable labels included; anything else is an error. A coefficient that is
    not ``free`` keeps its start, a slope of 1.
    """
    design = np.column_stack([np.ones_like(x), x])
    ridge = np.array([1e-3, 1e-2])
    use = np.flatnonzero(free)

    def likelihood(beta: np.ndarray) -> float:
        z = design @ beta
        return float((w * (y * z - np.logaddexp(0, z))).sum() - (ridge * beta * beta).sum() / 2)

    beta = np.array([-2.0, 1.0])
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(design @ beta, -700, 700)))
        grad = (design.T @ (w * (y - q)) - ridge * beta)[use]
        if np.abs(grad).max() < 1e-7 * max(w.sum(), 1.0):
            return beta
        hess = (design.T @ (design * (w * q * (1 - q))[:, None]) + np.diag(ridge))[np.ix_(use, use)]
        step = np.zeros(2)
        step[use] = np.linalg.solve(hess, grad)
        now, size, rise = likelihood(beta), 1.0, float(grad @ step[use])
        while likelihood(beta + size * step) < now + 1e-4 * size * rise:
            size /= 2
            if size < 1e-12:
                return beta  # no rise left within the precision of the sums
        beta = beta + size * step
    raise ArithmeticError("the calibration did not converge")


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Intercept and a positive slope; without one in the data the slope is 1 and the intercept fitted."""
    beta = _logistic(x, y, w)
    if beta[1] <= 0:
        beta = _logistic(x, y, w, (True, False))
    return float(beta[0]), float(beta[1])


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """K from the best segments of clean rows, then the logistic curve over the evidence."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(model)
        for batch in batches:
            out = []
            for t, toxic in zip(batch["text"], batch["toxic"]):
                s = scorer.scores(t if isinstance(t, str) else "")
                if len(s) and toxic == 0:
                    top = max((x[2] for x in maximal_segments(s)), default=0.0)
                    out.append((1, model.lam * top - math.log(len(s))))
            yield pd.DataFrame(out, columns=["n", "x"])

    r = rows.mapInPandas(best, "n long, x double").agg(F.sum("n"), F.avg("x")).first()
    if r[0]:
        # The mean of an extreme-value variable lies Euler's constant above its location.
        model.log_k = r[1] - 0.5772156649
    rated = rows.select("toxic", toxicity(model, F.col("text"))["evidence"].alias("e")).groupBy(
        "toxic", F.round(F.log1p("e"), 1).alias("x")
    ).count().toPandas()
    if rated["toxic"].nunique() < 2:
        return model
    x, y, w = (rated[c].to_numpy(dtype=float) for c in ("x", "toxic", "count"))
    model.intercept, model.slope = _curve(x, y, w)
    return model


def rated(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with score, predicted, evidence, n_tokens and passages."""
    plain = docs.drop(*RESULT.names)
    found = "_".join(["tox", *plain.columns])  # a name that no column has
    return plain.withColumn(found, toxicity(model, F.col("text"))).select(
        *[F.col(f"`{c}`") for c in plain.columns], F.col(f"`{found}`.*")
    )


def filtered(docs: DataFrame, labels: DataFrame, p: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    model = fit(docs, labels, p)
    return docs.filter(toxicity(model, F.col("text"))["predicted"] == 0)
