"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (a mark in front, spaces become marks) and cut before each mark. The distinct marked
words of a batch are sorted, which lists the leaves of their trie in depth-first order; a word
keeps what its predecessor has for the prefix they share and goes on from there. What is kept per
character of the prefix is the best score, where its last piece starts, and the nodes of the piece
trie that are still open, one for each earlier start; a character moves the open nodes one step and
closes those without a branch. So no substring is ever cut or looked up. The best segmentation maximises
the sum of the vocabulary's piece scores; characters outside the vocabulary become byte pieces.
Ties go to the longer last piece. Words seen before are kept in a bounded memo of two
generations, so a frequent word is segmented once per worker.

Decoding concatenates pieces, turns byte pieces into characters and marks into spaces; it gives back
every text without the mark character exactly. Null texts are empty and have no pieces. Every
function depends on the row alone; columns of the input are kept.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

MARK = "▁"
MARKED = re.compile(f"{MARK}[^{MARK}]*")
MEMO_ENTRIES = 400_000


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, file: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=file)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {}
        self.score: dict[str, tuple[float, int]] = {}
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[piece] = (sp.get_score(i), i)
        # A node of the piece trie: branches by character, and score and id of the piece that ends here.
        self.trie: tuple[dict, list] = ({}, [])
        for piece, hit in self.score.items():
            node = self.trie
            for c in piece:
                node = node[0].setdefault(c, ({}, []))
            node[1].append(hit)
        # A character outside the vocabulary costs more than any piece, once per byte.
        self.byte_cost = min(s for s, _ in self.score.values()) - 10.0
        self.raw = [p.encode() for p in self.pieces]
        for b, i in self.byte_ids.items():
            self.raw[i] = bytes([b])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """The best pieces of every word; ``words`` must be sorted."""
        root = self.trie[0]
        best: list[float] = [0.0]
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())]
        # Per prefix the open nodes as (branches, best score at their start, start), earliest start first.
        open_: list[list[tuple[dict, float, int]]] = [[(root, 0.0, 0)]]
        last = ""
        for w in words:
            keep, most = 0, min(len(last), len(w))
            while keep < most and last[keep] == w[keep]:
                keep += 1
            del best[keep + 1 :], back[keep + 1 :], open_[keep + 1 :]
            for end in range(keep, len(w)):
                c = w[end]
                top, origin, still = None, None, []
                for branches, before, start in open_[end]:
                    node = branches.get(c)
                    if node is None:
                        continue
                    branches, hits = node
                    if branches:
                        still.append((branches, before, start))
                    for score, i in hits:
                        if top is None or before + score > top:
                            top, origin = before + score, (start, (i,))
                if top is None or top < best[end] + self.byte_cost:
                    bytes_ = c.encode("utf-8", "replace")
                    cost = best[end] + self.byte_cost * len(bytes_)
                    if top is None or cost > top:
                        top, origin = cost, (end, tuple(self.byte_ids[b] for b in bytes_))
                still.append((root, top, end + 1))
                best.append(top)
                back.append(origin)
                open_.append(still)
            last, at, parts = w, len(w), []
            while at:
                at, ids = back[at]
                parts.append(ids)
            yield w, tuple(i for ids in reversed(parts) for i in ids)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        marked = [MARKED.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.young) > MEMO_ENTRIES:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old, []
        for w in set().union(*marked):
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        for w, ids in self.segment(sorted(new)):
            young[w] = struct.pack(f"<{len(ids)}I", *ids)
        for words in marked:
            yield np.frombuffer(b"".join(map(young.__getitem__, words)), dtype="<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


ENCODED = StructType(
    [
        StructField("n_pieces", LongType()),
        StructField("ids_crc32", LongType()),
        StructField("round_trip", BooleanType()),
    ]
)
_VOCABULARIES: dict[str, Vocabulary] = {}  # one per Python worker, kept across its tasks


def vocabulary(file: str) -> Vocabulary:
    if file not in _VOCABULARIES:
        _VOCABULARIES[file] = Vocabulary(file)
    return _VOCABULARIES[file]


def _groups(texts: list[str], size: int = 4_000_000) -> Iterator[list[str]]:
    start, n = 0, 0
    for i, t in enumerate(texts):
        if n > size:
            yield texts[start:i]
            start, n = i, 0
        n += len(t)
    if start < len(texts):
        yield texts[start:]


def encoded(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the array ``ids``; a column called so is replaced."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(model_file)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch]
            yield pd.Series([x.astype(np.int32) for g in _groups(texts) for x in v.encode(g)], dtype=object)

    return docs.drop("ids").withColumn("ids", ids(F.col(text)))


def decoded(rows: DataFrame, model_file: str) -> DataFrame:
    """All columns of ``rows`` with the text of ``ids`` as ``decoded``."""

    @F.pandas_udf("string")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(model_file)
        for batch in batches:
            yield batch.map(lambda x: "" if x is None else v.decode(x.tolist()))

    return rows.withColumn("decoded", back("ids"))


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """Number and checksum of each text's ids, and whether decoding gives the text back.

    The other columns are kept; one called like a result is replaced.
    """

    @F.pandas_udf(ENCODED)
    def summary(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = vocabulary(model_file)
        for batch in batches:
            rows = []
            texts = [t if isinstance(t, str) else "" for t in batch]
            for g in _groups(texts):
                for t, ids in zip(g, v.encode(g), strict=True):
                    back = v.decode(ids.tolist())
                    rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), back == t))
            yield pd.DataFrame(rows, columns=ENCODED.names)

    others = [c for c in docs.columns if c not in ("text", *ENCODED.names)]
    return docs.select(*[F.col(f"`{c}`") for c in others], summary("text").alias("".join(["_p", *others]))).select(
        *[F.col(f"`{c}`") for c in others], F.col("`" + "".join(["_p", *others]) + "`.*")
    )
