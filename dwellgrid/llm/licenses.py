"""License scan: Dice coefficient over word bigrams against templates, candidates pruned by size.

The units of a document are its lines; its paragraphs of several lines; runs of two to ``RUN`` paragraphs; and,
if it has more than one line, its whole text. Paragraphs are parted by blank lines, those without a
word don't count, and paragraphs and runs are units only where they are not the whole text. So
a notice that wraps and a text of several paragraphs amid others are found. A unit is
normalised to lower-case ASCII words; its bigrams are a set (a single word is its own bigram).

With ``Dice = 2 |A and B| / (|A| + |B|) >= t`` the size of a unit must lie between ``t / (2 - t)`` and
``(2 - t) / t`` times that of the template, so units outside the bounds of all templates are dropped
before their bigrams are built, and pairs outside their template's bounds before they are counted.
It also follows that a unit has at least ``t / (2 - t)`` of the template's bigrams. So of any larger
rest one must be there, and units without a word of such a rest (``anchors``) go early too.
What is left meets the templates by an equi-join on bigrams. Equal units of many documents are
scored once: distinct units are counted first and joined back. Neither bound loses a match.

Each unit counts for its best template (ties: the greater name). Returns one row per document and
licence that some unit matches, with the best coefficient and the number of matching units.
Null and empty texts match nothing; repeated rows count as units of one document; empty
tables give empty tables; other columns are not read.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written

THRESHOLD = 0.9
RUN = 6
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = "\n[ \t\r]*\n"

Template = tuple[str, str]


@cache
def templates() -> tuple[Template, ...]:
    """Names and texts of public licences: notices, headers and full texts."""
    parts = Path(__file__).with_name("licences.txt").read_text(encoding="utf-8").split("== ")[1:]
    return tuple((name, text.strip()) for name, _, text in (x.partition("\n") for x in parts))


def words_of(unit):
    """Lower-case ASCII words of a unit."""
    low = F.translate(unit, UPPER, UPPER.lower())
    return F.filter(F.split(low, "[^a-z0-9]+"), lambda w: w != "")


def bigrams_of(text: str) -> set[tuple[str, ...]]:
    """The same on the driver, for a template."""
    w = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return set(zip(w, w[1:])) if len(w) > 1 else {(x,) for x in w}


def anchors(texts: tuple[Template, ...], threshold: float) -> list[str]:
    """Words of which every unit that matches has one: the longer words of the bigrams in a set of each
    template that is too large to be missed as a whole. Bigrams with the longest words are taken."""
    out = set()
    for _, text in texts:
        grams = bigrams_of(text)
        missed = int(len(grams) * (1 - threshold / (2 - threshold)) + 1e-9)
        longest = sorted((max(g, key=lambda w: (len(w), w)) for g in grams), key=lambda w: (-len(w), w))
        out |= set(longest[: missed + 1])
    return sorted(out)


BIGRAMS = (
    "array_distinct(CASE WHEN size(words) < 2 THEN words ELSE"
    " zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words)),"
    " (a, b) -> concat(a, ' ', b)) END)"
)


def template_bigrams(spark: SparkSession, texts: tuple[Template, ...]) -> DataFrame:
    """(template, license, bigram, size) of every template."""
    rows = [(i, name, text) for i, (name, text) in enumerate(texts)]
    return (
        spark.createDataFrame(rows, "template int, license string, text string")
        .withColumn("words", words_of(F.col("text")))
        .withColumn("bigrams", F.expr(BIGRAMS))
        .select("template", "license", F.explode("bigrams").alias("bigram"), F.size("bigrams").alias("size"))
    )


def _units(text):
    """The words of every unit of a text."""
    lines = F.transform(F.split(text, "\n"), words_of)
    parts = F.filter(F.split(text, BLANK), lambda x: x.rlike("[A-Za-z0-9]"))
    words = F.transform(parts, words_of)
    n = F.size(parts)
    wraps = F.transform(F.filter(parts, lambda x: F.contains(x, F.lit("\n"))), words_of)
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.least(F.lit(RUN), n - 1)),
            lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.flatten(F.slice(words, i, k))),
        )
    )
    some = F.when(n > 1, F.concat(lines, wraps)).otherwise(lines)
    some = F.when(n > 2, F.concat(some, runs)).otherwise(some)
    return F.when(F.size(lines) > 1, F.concat(some, F.array(F.flatten(lines)))).otherwise(some)


def scan(
    docs: DataFrame, texts: tuple[Template, ...] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, license, dice, n_units) of every document and licence that match."""
    spark, texts = docs.sparkSession, texts or templates()
    sizes = [len(bigrams_of(text)) for _, text in texts]
    least = min(sizes) * threshold / (2 - threshold)
    most = max(sizes) * (2 - threshold) / threshold
    some = F.array(*[F.lit(w) for w in anchors(texts, threshold)])
    # A unit has at least one bigram less than it has distinct words and at most one per word, so
    # most units go before their bigrams are built.
    units = (
        docs.select("doc_id", F.explode(_units(F.col("text"))).alias("words"))
        .filter(F.size("words") >= max(least, 1))
        .filter(F.arrays_overlap("words", some))
        .filter(F.size(F.array_distinct("words")) - 1 <= most)
        .select("doc_id", "words", F.expr(BIGRAMS).alias("bigrams"))
        .filter(F.size("bigrams").between(least, most))
        .groupBy("doc_id", F.array_join("words", " ").alias("unit"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    # Few units are left; written, so that the texts are read once.
    units = written(units, "licence-units")
    known = template_bigrams(spark, texts)
    scored = (
        units.select("unit")
        .distinct()
        .withColumn("words", F.split("unit", " "))
        .withColumn("bigrams", F.expr(BIGRAMS))
        .withColumn("unit_size", F.size("bigrams"))
        .select("unit", "unit_size", F.explode("bigrams").alias("bigram"))
        .join(known, "bigram")
        .filter(f"unit_size BETWEEN size * {threshold / (2 - threshold)} AND size * {(2 - threshold) / threshold}")
        .groupBy("unit", "unit_size", "template", "license", "size")
        .agg(F.count(F.lit(1)).alias("common"))
        .withColumn("dice", F.expr("CAST(2 * common AS DOUBLE) / (unit_size + size)"))
        .filter(F.col("dice") >= threshold)
        .groupBy("unit")
        .agg(F.max(F.struct("dice", "license")).alias("best"))
        .select("unit", "best.*")
    )
    return (
        units.join(scored, "unit")
        .groupBy("doc_id", "license")
        .agg(F.max("dice").alias("dice"), F.sum("times").alias("n_units"))
    )
