"""Token counts without ids: pieces once per distinct pre-token, joined to per-document frequencies.

A byte-level vocabulary merges inside pre-tokens only, so a text has the sum of its pre-tokens' pieces.

1. ``distinct``: tasks count the pre-tokens of their texts, the counts are added up, and each distinct
   pre-token of the corpus goes through the merges once. The table is written.
2. ``frequent``: the pre-tokens with the highest counts, as many as ``Counting.broadcast_bytes`` hold, by a
   histogram of the logarithm of the counts (a few hundred rows). They travel to the tasks as a dictionary.
   This is what keeps hot keys out of the join: what is left has no key of more than a bounded share.
3. Each document's pre-token frequencies are summed with the frequent ones on the spot. The rest of its
   frequencies is joined to the table by pre-token, and the parts of a document are added up by
   its row number. Only these rest pairs are shuffled. The documents are written with their rows
   numbered, so a repeated task can't number them anew.

Special strings inside texts are one token each, as the library has it by default; text between them is split
on its own. Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted on their own, null
identifiers are kept, empty tables give empty tables, texts are read whole. Bytes that are no
UTF-8 count as the replacement character. Only the identifier and the text are read.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written

SLICE_BYTES = 4_000_000
COUNTER_ENTRIES = 400_000
STEPS = 8  # histogram cells per doubling of a count

# Fixed value: how byte-level vocabularies of this family split text, with Unicode white space.
_WHITE = r"\t-\r \x85\p{Z}"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


@dataclass(frozen=True)
class Counting:
    """The limit of ``over_limit`` and the bytes of the dictionary of frequent pre-tokens."""

    limit: int = 1024
    broadcast_bytes: int = 16_000_000


def _is_latin(text: str) -> bool:
    """Only characters below 256, whose classes have not changed since the first versions of Unicode."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Splitter:
    """Pre-tokens of a text, and pieces of a pre-token, by a vocabulary file."""

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
            raise ValueError("a vocabulary with a plain byte-level split is needed")
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.parts = regex.compile(PATTERN).findall
        tokenizer = Tokenizer.from_file(file)
        self.model, self.library = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
        self.agreed, self.odd = set(), set()
        # Bytes as printable characters: printable ones stand for themselves, others come after 255.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.shown = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        self.hidden = {self.shown.get(b, b): b for b in range(256)}

    def _by_library(self, text: str) -> list[str]:
        return [x.translate(self.hidden).encode("latin-1").decode() for x, _ in self.library(text)]

    def split(self, text: str) -> list[str]:
        """Pre-tokens. The pattern and the library know different versions of Unicode; a text with
        a character that the two class differently is split by the library."""
        if not _is_latin(text):
            chars = set(text)
            for c in chars - self.agreed - self.odd:
                probe = f"a{c}b 1{c}{c} x"
                (self.agreed if self.parts(probe) == self._by_library(probe) else self.odd).add(c)
            if not self.odd.isdisjoint(chars):
                return self._by_library(text)
        return self.parts(text)

    def count(self, text: str) -> tuple[int, Counter]:
        """Special tokens of a text, and how often each pre-token occurs."""
        if self.special is None or not self.special.search(text):
            return 0, Counter(self.split(text))
        segments = self.special.split(text)
        found: Counter = Counter()
        for s in segments:
            found.update(self.split(s))
        return len(segments) - 1, found

    def pieces(self, token: str) -> int:
        shown = token.encode("utf-8", "replace").decode("latin-1").translate(self.shown)
        return len(self.model.tokenize(shown))


_SPLITTERS: dict[str, Splitter] = {}  # one per Python worker, kept across its tasks


def splitter(file: str) -> Splitter:
    if file not in _SPLITTERS:
        _SPLITTERS[file] = Splitter(file)
    return _SPLITTERS[file]


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a batch in groups of about ``SLICE_BYTES``."""

    def group(x: pa.Array) -> list[str]:
        return [(t or b"").decode("utf-8", "replace") for t in x.cast(pa.binary()).to_pylist()]

    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if size > SLICE_BYTES:
            yield group(column[start:i])
            start, size = i, 0
        size += n
    if start < len(column):
        yield group(column[start:])


def distinct(docs: DataFrame, file: str) -> DataFrame:
    """Each distinct pre-token of the texts with its occurrences and its number of pieces."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, found = splitter(file), Counter()
        names = ["token", "n"]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=names
            )

        for b in batches:
            for texts in _texts(b.column(0)):
                for t in texts:
                    found.update(s.count(t)[1])
                if len(found) > COUNTER_ENTRIES:
                    yield batch()
                    found.clear()
        yield batch()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(file)
        for b in batches:
            pieces = pa.array([s.pieces(t) for t in b.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pieces], names=["token", "n", "pieces"])

    counts = docs.select("text").mapInArrow(count, "token string, n long")
    total = counts.groupBy("token").agg(F.sum("n").alias("n"))
    return total.mapInArrow(split, "token string, n long, pieces long")


def frequent(table: DataFrame, p: Counting = Counting()) -> tuple[dict[str, int], int]:
    """Pieces of the most frequent pre-tokens within the size bound, and the least count among them."""
    cell = F.floor(F.log2("n") * STEPS)
    bytes_ = F.octet_length("token") + 64
    cells = table.groupBy(cell.alias("cell")).agg(F.sum(bytes_).alias("bytes"), F.min("n").alias("n"))
    least, size = None, 0
    for r in sorted(cells.collect(), key=lambda r: -r["cell"]):
        size += r["bytes"]
        if size > p.broadcast_bytes:
            break
        least = r["n"]
    if least is None:
        return {}, 2**62
    rows = table.filter(F.col("n") >= least).select("token", "pieces").collect()
    return {r["token"]: r["pieces"] for r in rows}, least


def counted(docs: DataFrame, file: str, p: Counting = Counting()) -> DataFrame:
    """Identifier, n_bytes, n_tokens and over_limit of every document."""
    table = written(distinct(docs, file), "pretokens")
    pieces, least = frequent(table, p)
    known = docs.sparkSession.sparkContext.broadcast(pieces)

    @F.arrow_udf("struct<tokens: bigint, token: array<string>, n: array<bigint>>")
    def summed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s, pieces = splitter(file), known.value
        for texts in batches:
            tokens, rest, counts = [], [], []
            for group in _texts(texts):
                for t in group:
                    total, found = s.count(t)
                    left, times = [], []
                    for token, n in found.items():
                        k = pieces.get(token)
                        if k is None:
                            left.append(token)
                            times.append(n)
                        else:
                            total += n * k
                    tokens.append(total)
                    rest.append(left)
                    counts.append(times)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(tokens, pa.int64()),
                    pa.array(rest, pa.list_(pa.string())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                names=["tokens", "token", "n"],
            )

    numbered = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            summed("text").alias("found"),
        ).select("row", "doc_id", "n_bytes", "found.*"),
        "frequencies",
    )
    rest = numbered.filter(F.size("token") > 0).select(
        "row", F.explode(F.arrays_zip("token", "n")).alias("x")
    )
    rare = table.filter(F.col("n") < least).select("token", "pieces")
    joined = rest.select("row", "x.token", F.col("x.n").alias("times")).join(rare, "token")
    parts = numbered.select("row", "doc_id", "n_bytes", "tokens").unionByName(
        joined.select("row", (F.col("times") * F.col("pieces")).alias("tokens")),
        allowMissingColumns=True,
    )
    return (
        parts.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum("tokens").alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > p.limit).alias("over_limit"))
    )
