"""Best-fit packing of token pieces into sequences by the linear grouping scheme.

**Pieces** (``pieces``). A document is its token ids followed by one end id; only longer ones are cut
into pieces of ``capacity`` tokens. Tokenising white-space separated chunks one by one and keeping a
bounded memo of them (``Encoder``) gives the ids of the whole text, because no token crosses white
space; it is what makes the tokeniser fast enough.

**Plan** (``plan``). Pieces of equal length are interchangeable, so the packing is decided on the
histogram of lengths: at most ``capacity`` rows reach the driver whatever the input. Large lengths
are cut into groups of equal cardinality and rounded up to the group's largest; configurations of
these few sizes are chosen by filling, for the largest size left, the sequence as far as a bounded
subset sum allows; actual lengths then replace the rounded ones in the slots, which frees room;
small pieces go best-fit into what is free, then into new sequences. Several group counts are
tried and the plan with the fewest sequences is taken.

**Placement** (``packed``). Each piece needs its rank among the pieces of its length. Ranks come from
per-shard counts and a row number inside (length, shard), so a length that holds most rows is
spread over many tasks. The plan maps ranges of ranks to sequences and offsets.

Null texts are empty documents of one token. Repeated rows are packed as often as they occur, empty
tables give empty tables, columns other than the identifier and the text are not read.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
ROWS_PER_SHARD = 100_000
MEMO_ENTRIES = 200_000
PART_BYTES = 1_000_000
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

_ENCODERS: dict[str, Encoder] = {}  # one per Python worker, kept across its tasks


@dataclass(frozen=True)
class Packing:
    """Sequence length, end id and the limit between large and small pieces."""

    capacity: int = 2048
    end_id: int = 0
    small: int = 128
    groups: tuple[int, ...] = (32, 128, 512)


# Fixed value: how the vocabulary's pre-tokeniser splits normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Memo(dict):
    """A dictionary that computes what it lacks."""

    def __init__(self, compute: Callable[[bytes], bytes]) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, key: bytes) -> bytes:
        value = self[key] = self.compute(key)
        return value


class Encoder:
    """Ids of whole texts by way of a memo of their white-space separated chunks.

    Texts are put into composed form and lower case first, as the vocabulary's normaliser does, so
    that chunks repeat; a new chunk is split and only its unseen words go through the merges. The
    memo has two generations: when the young one is full it becomes the old one, and chunks still
    in use are taken over, so memory is bounded and frequent words are never computed twice. Texts
    that contain a special token, or a vocabulary with another normaliser, take the plain way.
    """

    def __init__(self, file: str) -> None:
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        split = [x.get("pattern", {}).get("Regex") for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.known = steps == ["NFC", "Replace", "Lowercase"] and split == [SPLIT, None]
        self.special = [t["content"] for t in spec["added_tokens"]]
        # White space as the vocabulary has it; the library's own class also holds U+001C to U+001F.
        space = r"\t-\r \x85\p{Z}"
        self.parts = regex.compile(SPLIT.replace(r"\s", space)).findall
        # Bytes as printable characters: printable ones stand for themselves, others come after 255.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.printable = {b: 256 + i for i, b in enumerate(rest)}
        self.young, self.old = _Memo(self._chunk), {}

    def _word(self, w: str) -> bytes:
        if not (w.isascii() and w.isprintable()):
            w = w.encode().decode("latin-1").translate(self.printable)
        ids = [t.id for t in self.tokenizer.model.tokenize(w)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is not None:
            return ids
        c = chunk.decode()
        if c.isalpha():
            return self._word(c)
        lookup = self.young.__getitem__
        return b"".join(
            [lookup(w.encode()) if w.isalpha() else self._word(w) for w in self.parts(c)]
        )

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.young) > MEMO_ENTRIES:
            self.young, self.old = _Memo(self._chunk), self.young
        lookup = self.young.__getitem__
        for t in texts:
            if not self.known or any(x in t for x in self.special):
                ids = self.tokenizer.encode(t, add_special_tokens=False).ids
                yield struct.pack(f"<{len(ids)}I", *ids)
                continue
            if not t.isascii():
                t = unicodedata.normalize("NFC", t).replace("\u03a3", "\u03c3")
            yield b"".join(map(lookup, t.lower().encode("utf-8", "replace").split()))


def pieces(docs: DataFrame, tokenizer_file: str, p: Packing = Packing()) -> DataFrame:
    """One row per piece: document, number, ids before it, length and checksum of its ids."""
    width = 4 * p.capacity
    end = np.array([p.end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer_file)
        if encoder is None:
            encoder = _ENCODERS[tokenizer_file] = Encoder(tokenizer_file)
        for batch in batches:
            for part in _small_parts(batch):
                doc_ids, texts = (x.to_pylist() for x in part.columns)
                rows = []
                for doc_id, ids in zip(doc_ids, encoder.ids([t or "" for t in texts])):
                    ids += end
                    for i in range(0, len(ids), width):
                        x = ids[i : i + width]
                        rows.append((doc_id, i // width, i // 4, len(x) // 4, zlib.crc32(x)))
                columns = [
                    pa.array(c, t) for c, t in zip(zip(*rows), PIECE_TYPES, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=PIECE_NAMES)

    long_id = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(long_id, "text").mapInArrow(cut, PIECES)


def _small_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PART_BYTES`` of text, so that few long texts are unpacked at a time."""
    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if size > PART_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


class _Plan:
    """Ranges of ranks per length, each with its first sequence and its offset."""

    def __init__(self, hist: dict[int, int], p: Packing, groups: int) -> None:
        self.p, self.sequences = p, 0
        self.next_rank: dict[int, int] = defaultdict(int)
        self.ranges: list[tuple[int, int, int, int, int]] = []
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []
        large = {n: c for n, c in hist.items() if n > p.small}
        self._configurations(self._grouped(large, groups))
        self._best_fit({n: c for n, c in hist.items() if n <= p.small})

    def _place(self, length: int, count: int, sequence: int, offset: int) -> None:
        first = self.next_rank[length]
        self.next_rank[length] += count
        self.ranges.append((length, first, first + count, sequence, offset))

    def _release(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            if not self.free[room]:
                insort(self.rooms, room)
            self.free[room].append((sequence, count))

    @staticmethod
    def _grouped(large: dict[int, int], groups: int) -> list[list[list[int]]]:
        """Groups of equal cardinality, largest first; each a list of [length, count]."""
        total = sum(large.values())
        each = -(-total // max(groups, 1)) if total else 0
        out, room = [], 0
        for length in sorted(large, reverse=True):
            left = large[length]
            while left:
                if not room:
                    out.append([])
                    room = each
                take = min(left, room)
                out[-1].append([length, take])
                left -= take
                room -= take
        return out

    def _configurations(self, groups: list[list[list[int]]]) -> None:
        """Fill sequences with rounded sizes and put the actual lengths into the slots."""
        cap = self.p.capacity
        merged: dict[int, list[list[int]]] = {}
        for g in groups:
            merged.setdefault(g[0][0], []).extend(g)
        sizes = sorted(merged, reverse=True)
        left = {s: sum(c for _, c in merged[s]) for s in sizes}
        while sizes:
            config = self._fullest(sizes, left, cap)
            times = min(left[s] // k for s, k in config.items())
            self._substitute([s for s in config for _ in range(config[s])], merged, times)
            for s, k in config.items():
                left[s] -= k * times
            sizes = [s for s in sizes if left[s]]

    @staticmethod
    def _fullest(sizes: list[int], left: dict[int, int], cap: int) -> dict[int, int]:
        """The largest size and the subset of the others that fills its sequence best."""
        first = sizes[0]
        room = cap - first
        mask = (1 << (room + 1)) - 1
        reach, trail = 1, []
        for s in sizes:
            if s > room:
                continue
            most = min(left[s] - (s == first), room // s)
            for _ in range(most):
                grown = (reach | reach << s) & mask
                if grown == reach:
                    break
                trail.append((s, reach))
                reach = grown
            if reach >> room & 1:
                break
        at = reach.bit_length() - 1
        config = {first: 1}
        for s, before in reversed(trail):
            if not before >> at & 1:
                config[s] = config.get(s, 0) + 1
                at -= s
        return config

    def _substitute(self, slots: list[int], runs: dict[int, list[list[int]]], times: int) -> None:
        while times:
            # Slots of one size read disjoint parts of its run; the shortest part sets the pace.
            need = {s: slots.count(s) for s in slots}
            step = times
            for s, k in need.items():
                if k == 1 or runs[s][0][1] >= k:
                    step = min(step, runs[s][0][1] // k)
                else:
                    step = 1
            offset = 0
            for s in slots:
                while runs[s][0][1] == 0:
                    runs[s].pop(0)
                length, have = runs[s][0]
                runs[s][0][1] = have - step
                self._place(length, step, self.sequences, offset)
                offset += length
            for s in need:
                while runs[s] and runs[s][0][1] == 0:
                    runs[s].pop(0)
            self._release(self.p.capacity - offset, self.sequences, step)
            self.sequences += step
            times -= step

    def _best_fit(self, small: dict[int, int]) -> None:
        cap = self.p.capacity
        for length in sorted(small, reverse=True):
            count = small[length]
            while count:
                i = bisect_left(self.rooms, length)
                if i < len(self.rooms):
                    room = self.rooms[i]
                    sequence, n = self.free[room].pop()
                    if not self.free[room]:
                        self.rooms.pop(i)
                else:
                    room, sequence = cap, self.sequences
                    n = -(-count // (cap // length))
                    self.sequences += n
                per = room // length
                full = min(n, count // per)
                for j in range(per if full else 0):
                    self._place(length, full, sequence, cap - room + j * length)
                self._release(room - per * length, sequence, full)
                count -= full * per
                sequence, n = sequence + full, n - full
                if n and count:
                    for j in range(count):
                        self._place(length, 1, sequence, cap - room + j * length)
                    self._release(room - count * length, sequence, 1)
                    count, sequence, n = 0, sequence + 1, n - 1
                self._release(room, sequence, n)


def plan(hist: dict[int, int], p: Packing = Packing()) -> _Plan:
    """The best of the plans for the group counts; ``hist`` maps lengths to numbers of pieces."""
    return min((_Plan(hist, p, g) for g in p.groups), key=lambda x: x.sequences)


def _ranked(cut: DataFrame, total: int) -> DataFrame:
    """``cut`` with the rank of each piece among those of its length."""
    shards = max(8, -(-total // ROWS_PER_SHARD))
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    counts = cut.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("length", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(
        Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "start", "ids_crc32")
    )
    return (
        cut.withColumn("number", number)
        .join(starts, ["length", "shard"])
        .withColumn("rank", F.col("before") + F.col("number") - 1)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    )


def packed(docs: DataFrame, tokenizer_file: str, p: Packing = Packing()) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = written(pieces(docs, tokenizer_file, p), "pieces")
    hist = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    ranges = np.array(plan(hist, p).ranges, dtype=np.int64).reshape(-1, 5)
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    for length in np.unique(ranges[:, 0]):
        own = ranges[ranges[:, 0] == length]
        by_length[int(length)] = (own[:, 1], own[:, 3] - own[:, 1], own[:, 4])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["sequence_id"] = np.int64(0)
            batch["offset"] = np.int64(0)
            sequence, offset = batch["sequence_id"].to_numpy(copy=True), batch["offset"].to_numpy(copy=True)
            rank, lengths = batch["rank"].to_numpy(), batch["length"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
            for rows in np.split(order, edges[1:]) if len(order) else ():
                first, shift, place_at = by_length[int(lengths[rows[0]])]
                i = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = shift[i] + rank[rows]
                offset[rows] = place_at[i]
            batch["sequence_id"], batch["offset"] = sequence, offset
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch.drop(columns="rank")

    return _ranked(cut, sum(hist.values())).mapInPandas(place, PLACED)
