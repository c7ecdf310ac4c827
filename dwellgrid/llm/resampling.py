"""Importance resampling towards a target, over hashed word n-grams found by an Aho-Corasick dictionary.

Words are runs of digits, letters and all characters outside ASCII, with A-Z lower-cased; features are all
runs of 1 to ``Draw.longest`` words joined by a space. A feature's bucket is the CRC-32 of its bytes
modulo ``Draw.buckets``.

**Dictionary scan** (``scanned``). Texts become bytes with a space for every delimiter and are scanned in
blocks cut at a space. A block's distinct words, with a delimiter on either side, are the patterns of
an automaton; a pattern's payload is the word's CRC and length. Neighbours share a delimiter, so one scan
emits exactly one payload per word, in order. The dictionary holds one block's words, which bounds
its memory whatever the corpus; a longer text takes several blocks.

**Composition** (``features``). The CRC of ``a b`` follows from the payloads of ``a`` and ``b`` alone: the first is
moved on by the bytes of the second, which is a linear map kept as a table per length, and the two are
added. So no n-gram is ever built as a string or hashed; orders 2 and 3 are table lookups over arrays.

**Counting and scoring.** A task adds up its buckets and emits at most ``buckets`` rows; their sum is
a table of ``buckets`` rows, which reaches the driver and returns to the tasks as gains. A second scan sums
the gains of each document: reading the texts twice costs less than storing four numbers a word.

**Draw.** A Gumbel number from the identifier's hash is added to the weight; the highest scores are drawn,
which samples without replacement in proportion to the weights. Ranks come from a range partitioning
by (score, identifier), a row number inside each part and the sizes of the parts before it, so no
task holds more than a part and no row is joined.

Null and empty texts have no feature, weight 0 and no rank. A null identifier hashes as empty text and comes after
the others on ties. Repeated rows count and are ranked as often as they occur. With an empty target or
empty tables all counts are 0 and results are defined. Only the identifier and the text are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from dwellgrid.sources.storage import written

BLOCK_BYTES = 4_000_000
SLICE_BYTES = 8_000_000
ROWS_PER_PART = 200_000
_TABLED = 64


@dataclass(frozen=True)
class Draw:
    """Parameters: features, seed, and the share drawn (in per cent) of documents with enough words."""

    longest: int = 3
    buckets: int = 10_000
    seed: int = 42
    share: int = 5
    least_words: int = 20


# ---- CRC of a concatenation ------------------------------------------------------------


def _byte_table() -> np.ndarray:
    """The change of a CRC by one zero byte, per low byte. Fixed value: the polynomial of CRC-32."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


def _lookup(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The linear map ``table`` (one row of 256 per byte of the argument) at every ``c``."""
    return table[0][c & 255] ^ table[1][c >> 8 & 255] ^ table[2][c >> 16 & 255] ^ table[3][c >> 24]


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps for 0 to ``_TABLED`` zero bytes, and for 2**j of them."""
    step = _byte_table()
    now = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    short = [now]
    for _ in range(_TABLED):
        now = step[now & 255] ^ (now >> 8)
        short.append(now)
    powers = [short[1]]
    for _ in range(40):
        powers.append(_lookup(powers[-1], powers[-1]))
    return np.stack(short).reshape(-1), powers


_SHORT, _POWERS = _tables()


def moved(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each CRC after ``n`` zero bytes."""
    at = np.minimum(n, _TABLED) * 1024
    out = (
        _SHORT[at + (crc & 255)]
        ^ _SHORT[at + 256 + (crc >> 8 & 255)]
        ^ _SHORT[at + 512 + (crc >> 16 & 255)]
        ^ _SHORT[at + 768 + (crc >> 24)]
    )
    rest = np.maximum(n - _TABLED, 0)
    for j in range(int(rest.max(initial=0)).bit_length()):
        some = np.flatnonzero(rest >> j & 1)
        out[some] = _lookup(_POWERS[j], out[some])
    return out


# ---- words -----------------------------------------------------------------------------


def _plain_bytes() -> bytes:
    """A byte table: A-Z to a-z, digits, a-z and bytes of other characters kept, the rest a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for b in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[b] = b
    for b in range(65, 91):
        table[b] = b + 32
    return bytes(table)


_PLAIN = _plain_bytes()


def _blocks(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK_BYTES`` that start and end with a space; neighbours share it."""
    start, last = 0, len(data) - 1
    while start < last:
        end = data.find(b" ", min(start + BLOCK_BYTES, last))
        yield start, end + 1
        start = end


def scanned(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, CRC and length of each word of ``data``, which starts and ends with a space."""
    found = []
    for a, b in _blocks(data):
        block = data[a:b].decode("latin-1")
        words = list(set(block.split(" ")) - {""})
        if not words:
            continue
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):
            automaton.add_word(f" {w} ", i)
        automaton.make_automaton()
        hits = np.fromiter(chain.from_iterable(automaton.iter(block)), dtype=np.int64).reshape(-1, 2)
        crc = np.array([zlib.crc32(w.encode("latin-1")) for w in words], dtype=np.uint32)
        size = np.array([len(w) for w in words], dtype=np.int64)
        n = size[hits[:, 1]]
        found.append((a + hits[:, 0] - n, crc[hits[:, 1]], n))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


_SPACE = np.uint32(zlib.crc32(b" "))
_ONE = np.ones(1, dtype=np.int64)


def features(crc: np.ndarray, n: np.ndarray, text: np.ndarray, longest: int) -> Iterator[tuple]:
    """Per order: the CRC of every run of that many words of one text, and the text it is of."""
    whole = crc
    for k in range(1, longest + 1):
        if k > 1:
            # The run one shorter that ends before each word, a space, the word itself.
            whole = moved(moved(whole[:-1], _ONE) ^ _SPACE, n[k - 1 :]) ^ crc[k - 1 :]
        last = text[k - 1 :]
        inside = text[: len(last)] == last
        yield whole[inside], last[inside]
        if len(whole) < 2:
            return


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size > SLICE_BYTES:
            yield texts[start:i]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield texts[start:]


def _bucketed(texts: pa.Array, p: Draw) -> tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of texts, words of each, and (buckets, texts) of the features of each order."""
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    # A text starts after the space that joins it to the one before.
    starts = np.cumsum([1] + [len(t) + 1 for t in raw[:-1]])
    data = b"".join((b" ", b" ".join(raw), b" ")).translate(_PLAIN)
    at, crc, n = scanned(data)
    text = np.searchsorted(starts, at, side="right") - 1
    found = [
        ((c % np.uint32(p.buckets)).astype(np.int64), t) for c, t in features(crc, n, text, p.longest)
    ]
    return len(raw), np.bincount(text, minlength=len(raw)), found


# ---- counts and scores -----------------------------------------------------------------


def bucket_counts(docs: DataFrame, p: Draw = Draw()) -> DataFrame:
    """Number of features per bucket over all texts; buckets without features are absent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.buckets, dtype=np.int64)
        for batch in batches:
            for texts in _slices(batch.column(0)):
                for buckets, _ in _bucketed(texts, p)[2]:
                    total += np.bincount(buckets, minlength=p.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"]
        )

    return (
        docs.select("text")
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )


def gains(docs: DataFrame, target: DataFrame, p: Draw = Draw()) -> np.ndarray:
    """What a feature of each bucket adds to a weight: thousandths of the smoothed log ratio."""

    def counts(rows: DataFrame) -> list[int]:
        n = [0] * p.buckets
        for r in bucket_counts(rows, p).collect():
            n[r["bucket"]] = r["n"]
        return n

    source, wanted = counts(docs), counts(target)
    s_all, t_all = float(sum(source) + p.buckets), float(sum(wanted) + p.buckets)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(source, wanted)
        ],
        dtype=np.int64,
    )


WEIGHED = StructType(
    [StructField(c, LongType()) for c in ("n_words", "n_features", "weight", "score")]
)


def _gumbel(doc_id: str | None, seed: int) -> int:
    h = int.from_bytes(sha256(f"{seed}:{doc_id or ''}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, p: Draw = Draw()) -> DataFrame:
    """Identifier, n_words, n_features, weight and score of every document."""

    @F.arrow_udf(WEIGHED)
    def weigh(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            columns = [[], [], []]
            for part in _slices(texts):
                rows, words, found = _bucketed(part, p)
                n, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                for buckets, text in found:
                    # Features come in the order of their texts, so a text's are one range.
                    edges = np.searchsorted(text, np.arange(rows + 1))
                    n += np.diff(edges)
                    weight += np.diff(np.concatenate([[0], np.cumsum(gain[buckets])])[edges])
                for column, x in zip(columns, (words, n, weight)):
                    column.append(x)
            words, n, weight = (np.concatenate([np.zeros(0, np.int64), *c]) for c in columns)
            noise = np.array([_gumbel(i, p.seed) for i in ids.to_pylist()], dtype=np.int64)
            arrays = [pa.array(x, pa.int64()) for x in (words, n, weight, weight + noise)]
            yield pa.StructArray.from_arrays(arrays, names=WEIGHED.names)

    found = docs.select("doc_id", weigh(F.col("doc_id").cast("string"), "text").alias("w"))
    return found.select("doc_id", "w.*")


def resampled(docs: DataFrame, target: DataFrame, p: Draw = Draw()) -> DataFrame:
    """Every document's features, weight and score, and its rank if it is drawn."""
    scored = written(weighed(docs, gains(docs, target, p), p), "weighed")
    enough = F.col("n_words") >= p.least_words
    total = scored.filter(enough).count()
    drawn = p.share * total // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = max(8, -(-total // ROWS_PER_PART))
    dealt = written(
        scored.filter(enough).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "dealt",
    )
    sizes = dealt.groupBy("part").count()
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    place = F.col("number") + F.col("before")
    ranked = (
        dealt.withColumn("number", number)
        .join(starts, "part")
        .select(*scored.columns, F.when(place <= drawn, place).alias("rank"))
    )
    rest = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def selected(docs: DataFrame, target: DataFrame, p: Draw = Draw()) -> DataFrame:
    """The rows of ``docs`` whose identifier is drawn, with their own columns."""
    ids = resampled(docs, target, p).filter("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn"))
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")
