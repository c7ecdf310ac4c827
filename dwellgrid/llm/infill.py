"""Fill-in-middle transformation with a sparse index of multibyte characters.

A text is cut at two units into prefix, middle and suffix and written with marks as ``psm`` (prefix,
suffix, middle) or ``spm`` (suffix, prefix, middle); the rest of the texts stay ``plain``. Units
are runs of A-Z and a-z or single other characters (``units="words"``), or characters.

**Sparse exception index** (``Exceptions``). Work is done on the UTF-8 bytes of a whole slice of texts.
Only characters of more than one byte are recorded, by position and excess bytes; the running sum of
the excess at a position, found by ``searchsorted``, converts byte cuts into code points and back.
Between exceptions the two differ by a constant, and a text of ASCII alone has no entry at all.
Word units start at the first byte of a character that does not go on a run of letters, which is
one vectorised comparison per byte; the cuts of all texts are looked up together.

**Draws** are the 8-digit groups of sha256(``<seed>:<identifier>``), so they depend on the row alone: equal
rows get equal cuts on every run, after lost executors too. There is no shuffle.

Null texts are empty, and empty texts or texts that hold a mark are plain, so the marks in an
output are always the ones put there and ``restored`` is exact. A null identifier draws as empty
text. Repeated rows are repeated, an empty table gives an empty table, a text of any length is
read whole. Columns of the input are kept; one called like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SLICE_BYTES = 8_000_000


@dataclass(frozen=True)
class Infill:
    """Marks, seed and shares of the forms in per cent."""

    seed: int = 1
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 90
    spm: int = 20
    units: str = "words"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


RESULT = StructType(
    [
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ]
)
_ARROW = pa.struct(
    [
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output", pa.string()),
    ]
)


class Exceptions:
    """Multibyte characters of UTF-8 bytes: where they start and how many bytes they have beyond one."""

    def __init__(self, data: np.ndarray) -> None:
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.total = np.concatenate([[0], np.cumsum(excess)])
        # The same positions counted in characters.
        self.at_chars = self.at - self.total[:-1]

    def to_chars(self, byte_cuts: np.ndarray) -> np.ndarray:
        """Characters before each byte position that starts one."""
        return byte_cuts - self.total[np.searchsorted(self.at, byte_cuts)]

    def to_bytes(self, char_cuts: np.ndarray) -> np.ndarray:
        """Bytes before each character."""
        return char_cuts + self.total[np.searchsorted(self.at_chars, char_cuts)]


def unit_starts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Byte positions at which a unit starts; ``edges`` are the borders of the texts."""
    letter = ((data | 32) - 97).astype(np.uint8) < 26
    inside = np.zeros(len(data), dtype=bool)
    inside[1:] = letter[1:] & letter[:-1]
    inside[edges[:-1][edges[:-1] < edges[1:]]] = False
    return np.flatnonzero(~inside & ((data & 0xC0) != 0x80))


def cuts(
    data: np.ndarray, edges: np.ndarray, draws: np.ndarray, units: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and its two cuts (a row each) in bytes and in characters from its start."""
    index = Exceptions(data)
    first_char = index.to_chars(edges)
    if units == "chars":
        n = np.diff(first_char)
    else:
        starts = unit_starts(data, edges)
        first = np.searchsorted(starts, edges)
        n = np.diff(first)
    picked = np.sort(draws % (n + 1), axis=0)
    if units == "chars":
        chars = picked
        return n, index.to_bytes(first_char[:-1] + chars) - edges[:-1], chars
    # A cut after the last unit is the end of the text, where no unit of its own starts.
    starts = np.append(starts, len(data))
    at = np.where(picked < n, starts[first[:-1] + picked], edges[1:])
    return n, at - edges[:-1], index.to_chars(at) - first_char[:-1]


def _drawn(ids: list, seed: int) -> np.ndarray:
    """Four numbers per identifier, one column each."""
    digests = b"".join(sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, dtype=">u4").reshape(-1, 4).T.astype(np.int64)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE_BYTES`` of text each."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _rewritten(ids: pa.Array, texts: pa.Array, p: Infill) -> pa.Array:
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    h = _drawn(ids.to_pylist(), p.seed)
    n, at, chars = cuts(data, edges, h[:2], p.units)
    pre, suf, mid = (m.encode() for m in p.marks)
    forms, outputs = [], []
    for t, low, high, h3, h4 in zip(raw, *at.tolist(), (h[2] % 100).tolist(), (h[3] % 100).tolist()):
        if not t or h3 >= p.transformed or pre in t or suf in t or mid in t:
            forms.append("plain")
            outputs.append(t)
        elif h4 < p.spm:
            forms.append("spm")
            outputs.append(b"".join((suf, t[high:], pre, t[:low], mid, t[low:high])))
        else:
            forms.append("psm")
            outputs.append(b"".join((pre, t[:low], suf, t[high:], mid, t[low:high])))
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    columns = [
        pa.array(n, pa.int64()),
        pa.array(forms, pa.string()),
        pa.array(chars[0], pa.int64(), mask=plain),
        pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
        pa.array(outputs, pa.binary()).cast(pa.string(), safe=False),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(_ARROW))


def infilled(doc_id: Column, text: Column, p: Infill = Infill()) -> Column:
    """Struct of units, form, lengths of prefix and middle in characters, and output."""

    @F.arrow_udf(RESULT)
    def rewrite(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            parts = [_rewritten(ids[a:b], texts[a:b], p) for a, b in _slices(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _ARROW)

    return rewrite(doc_id.cast("string"), text)


def transformed(docs: DataFrame, p: Infill = Infill()) -> DataFrame:
    """All columns of ``docs`` with n, form, prefix_chars, middle_chars and output."""
    plain = docs.drop(*RESULT.names)
    return plain.select("*", infilled(F.col("doc_id"), F.col("text"), p).alias("_fim")).select(
        *[F.col(f"`{c}`") for c in plain.columns], "_fim.*"
    )


def restored(form: str = "form", output: str = "output", p: Infill = Infill()) -> Column:
    """The text from an output and its form alone, by the marks."""

    def literal(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pre, suf, mid = map(literal, p.marks)

    def opened(mark: str, until: str) -> str:
        return f"substr(substring_index({output}, {until}, 1), length({mark}) + 1)"

    def between(mark: str, until: str) -> str:
        return f"substring_index(substring_index({output}, {until}, 1), {mark}, -1)"

    middle = f"substring_index({output}, {mid}, -1)"
    return F.expr(
        f"CASE {form} WHEN 'psm' THEN concat({opened(pre, suf)}, {middle}, {between(suf, mid)}) "
        f"WHEN 'spm' THEN concat({between(pre, mid)}, {middle}, {opened(suf, pre)}) ELSE {output} END"
    )
