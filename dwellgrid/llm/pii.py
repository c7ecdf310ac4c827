"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

**Base spans** follow four fixed patterns (e-mail, IP, card, phone), leftmost and non-overlapping per
kind; a match that fails its check is dropped and not retried. So ``+1 (269) 555-3296 4524...`` is
neither a phone nor a card by pattern: one greedy match swallows both numbers and fails.

**The field** (``Field``) segments every region around digits and at-signs into spans of the four kinds
and single atoms outside. A segment is scored as a whole: number and grouping of its digits, its
affixes, its separators, the check digit, whether it cuts through a word, the word before it. A span is also
scored by the kind of the span that ends just before it, white space apart, so kinds and boundaries
of neighbours are chosen together. Segments have at most ``ATOMS`` atoms, so the dynamic programme is
linear in the text. Forward-backward gives the posterior of each segment and of each pair of
neighbouring kinds; Viterbi chooses boundaries and kinds jointly. Base spans are clamped: the
programme keeps them and may only add spans beside them. A candidate must also pass the exact
check of its kind, and a chosen segment needs a posterior of ``CONFIDENCE``.

**Training** (``train``) takes base spans and the words before them from at most ``documents`` documents (smallest
hash of the identifier), joins, reformats and surrounds them at random, adds numbers that are no
personal data, and maximises the likelihood by stochastic gradient on the driver, on half of the texts
with base spans clamped as in decoding; the sample is bounded whatever the input. Decoding covers every whole text and depends on the row alone.

Null and empty texts have no spans. Repeated rows are repeated, other columns are kept (a column
called ``spans`` is replaced). Without a base span in the sample the spans of ``SEEDS`` are used.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from dwellgrid.sources.storage import written

KINDS = ("email", "ip", "card", "phone")
ATOMS = 24
CONFIDENCE = 0.9
CONTEXT = 12
CARRY = -1

# Fixed patterns; possessive quantifiers and the look-behind only make failing matches linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# Used only if the sample holds no personal data at all.
SEEDS = {
    "email": ["ann.lee@mail.example.org", "bo7@site.example.com"],
    "ip": ["10.20.30.40", "192.168.77.5"],
    "card": ["4111111111111111", "5500000000000004"],
    "phone": ["+1 (212) 555-0147", "+44 20 7946 0958"],
}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        k = int(d) * (1 + i % 2)
        total += k - 9 if k > 9 else k
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at-sign and dotted domain, in linear time."""
    end = 0
    at = text.find("@")
    while at >= 0:
        before = text[end:at]
        start = end + len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        else:
            end = at + 1
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind."""
    found: list[tuple[int, int, int]] = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


# ---- regions, atoms and candidate segments ---------------------------------------------

CUE = re.compile(r"[0-9]|@|[\[({<](?:at|dot)[\])}>]", re.IGNORECASE)
ATOM = re.compile(r"[^\W_]+|\s|[^\s]")
WORD = re.compile(r"\S+")
LETTERS = re.compile(r"([^\W\d_]+)[^\w@]*$")
AT = re.compile(r"\s?[\[({<]at[\])}>]\s?", re.IGNORECASE)
DOT = re.compile(r"\s?[\[({<](?:dot|\.)[\])}>]\s?", re.IGNORECASE)
EMAIL_WHOLE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SEPARATED = re.compile(r"[0-9]+(?:[ .\-]{1,3}[0-9]+)*")
DIALLED = re.compile(r"(?:\+|00)?[ ]?\(?[0-9][ ().0-9/\-]*[0-9]")


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of words that hold a cue; words with cues that follow one another are one region."""
    n, pos = len(text), 0
    m = CUE.search(text)
    while m:
        start = m.start()
        while start > pos and not text[start - 1].isspace():
            start -= 1
        end = m.end()
        while True:
            while end < n and not text[end].isspace():
                end += 1
            if end >= n:
                break
            w = WORD.match(text, end + 1)
            if not w or not CUE.search(w[0]):
                break
            end = w.end()
        yield start, end
        pos = end
        m = CUE.search(text, end)


def valid(kind: str, s: str) -> bool:
    """The exact check of a candidate, looser than the fixed patterns in its separators."""
    if kind == "email":
        t = DOT.sub(".", AT.sub("@", s))
        return EMAIL_WHOLE.fullmatch(t) is not None
    if kind == "ip":
        parts = DOT.sub(".", s).split(".")
        return len(parts) == 4 and all(
            p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts
        )
    d = _digits(s)
    if kind == "card":
        return 14 <= len(d) <= 19 and SEPARATED.fullmatch(s) is not None and luhn(d)
    return 10 <= len(d) <= 15 and DIALLED.fullmatch(s) is not None


def word_before(text: str, start: int) -> str:
    """The last word among the ``CONTEXT`` characters before a position, in lower case."""
    m = LETTERS.search(text[max(0, start - CONTEXT) : start])
    return m[1].lower() if m else ""


def features(kind: str, s: str, before: str, after: str, word: str = "") -> list[str]:
    """Whole-span features of a candidate segment, from the character before it, two after it and a word before."""
    d = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    out = [
        "bias",
        f"digits{min(len(d), 20)}",
        f"groups{min(len(groups), 7)}",
        f"first{s[0] if s[0] in '+(' else 'd' if s[0].isdigit() else 'a' if s[0].isalpha() else '?'}",
        f"last{'d' if s[-1].isdigit() else 'a' if s[-1].isalpha() else '?'}",
        f"cutleft{before.isalnum() or before in '.-+@'}" if before else "edgeleft",
        f"cutright{after[0].isalnum() or after[0] in '-@'}" if after else "edgeright",
        # A dot that a letter or digit follows goes on; at the end of a sentence it doesn't.
        f"goeson{len(after) > 1 and after[0] in '.[(' and after[1].isalnum()}",
        f"luhn{14 <= len(d) <= 19 and luhn(d)}",
        f"word{word}",
    ]
    if kind == "phone":
        shape = "-".join(str(min(len(g), 5)) for g in groups[:6])
        out += [f"shape{shape}", f"plus{s[0] == '+'}", f"bracket{'(' in s}"]
        out.append(f"balanced{s.count('(') == s.count(')')}")
    if kind == "card":
        out += [f"even{len({len(g) for g in groups}) == 1}", f"lead{d[0]}"]
    if kind in ("email", "ip"):
        out.append(f"disguised{AT.search(s) is not None or DOT.search(s) is not None}")
    return [f"{kind}:{x}" for x in out]


class Region:
    """Atoms of a stretch of text and its admissible segments with their features."""

    def __init__(self, text: str, start: int, end: int, fixed: list[Span]) -> None:
        atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]
        cuts = {a: i for i, (a, _) in enumerate(atoms)} | {end: len(atoms)}
        # Base spans may begin or end inside an atom: cut there.
        inner = {x for _, a, b in fixed for x in (a, b) if start < x < end and x not in cuts}
        if inner:
            edges = sorted(set(cuts) | inner)
            atoms = list(zip(edges, edges[1:]))
        self.atoms, self.start, self.end = atoms, start, end
        self.blank = [text[a:b].isspace() for a, b in atoms]
        taken = [False] * len(atoms)
        for i, (a, b) in enumerate(atoms):
            taken[i] = any(x < b and a < y for _, x, y in fixed)
        self.segments: list[list[tuple[int, str, list[str]]]] = [[] for _ in range(len(atoms) + 1)]
        limit = max(0, end - start)
        for i, (a, _) in enumerate(atoms):
            if taken[i] or text[a].isspace():
                continue
            for j in range(i, min(len(atoms), i + ATOMS)):
                b = atoms[j][1]
                if taken[j]:
                    break
                if b - a < 6 or text[b - 1].isspace() or b - a > limit:
                    continue
                s = text[a:b]
                for kind in KINDS:
                    if valid(kind, s):
                        left = text[a - 1] if a else ""
                        right = text[b : b + 2]
                        feats = features(kind, s, left, right, word_before(text, a))
                        self.segments[j + 1].append((i, kind, feats))


class Field:
    """Weights of segment features and of the kind that precedes a span."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.w = weights or {}

    def _score(self, feats: list[str]) -> float:
        w = self.w
        return sum(w.get(f, 0.0) for f in feats)

    def _lattice(self, r: Region) -> list[list[tuple[int, int, float]]]:
        """Per end position: (begin, label, score). Spans count from 1; label 0 is an atom outside, and
        ``CARRY`` white space, after which the kind of the span before it still counts."""
        out: list[list[tuple[int, int, float]]] = [[]]
        for j in range(1, len(r.atoms) + 1):
            row = [(j - 1, CARRY if r.blank[j - 1] else 0, 0.0)]
            for i, kind, feats in r.segments[j]:
                row.append((i, 1 + KINDS.index(kind), self._score(feats)))
            out.append(row)
        return out

    def _step(self, before: int, label: int) -> float:
        return self.w.get(f"after{before}:{label}", 0.0) if label > 0 else 0.0

    def posteriors(
        self, r: Region
    ) -> tuple[dict[tuple[int, int, int], float], dict[tuple[int, int], float], float]:
        """Posterior of each span, expected number of each pair (kind before, kind), log partition."""
        lattice, n, k = self._lattice(r), len(r.atoms), len(KINDS) + 1
        low = -1e30
        fwd = [[low] * k for _ in range(n + 1)]
        fwd[0][0] = 0.0
        for j in range(1, n + 1):
            sums: list[list[float]] = [[] for _ in range(k)]
            for i, label, s in lattice[j]:
                for q in range(k):
                    if fwd[i][q] > low:
                        sums[q if label == CARRY else label].append(fwd[i][q] + s + self._step(q, label))
            fwd[j] = [_lse(x) if x else low for x in sums]
        bwd = [[low] * k for _ in range(n + 1)]
        bwd[n] = [0.0] * k
        follow: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        for j in range(1, n + 1):
            for i, label, s in lattice[j]:
                follow[i].append((j, label, s))
        for i in range(n - 1, -1, -1):
            for q in range(k):
                bwd[i][q] = _lse(
                    [
                        s + self._step(q, label) + bwd[j][q if label == CARRY else label]
                        for j, label, s in follow[i]
                    ]
                )
        z = _lse([x for x in fwd[n] if x > low])
        post: dict[tuple[int, int, int], float] = {}
        pairs: dict[tuple[int, int], float] = {}
        for j in range(1, n + 1):
            for i, label, s in lattice[j]:
                if label <= 0:
                    continue
                for q in range(k):
                    if fwd[i][q] > low:
                        v = fwd[i][q] + self._step(q, label) + s + bwd[j][label] - z
                        p = math.exp(min(0.0, v))
                        post[i, j, label] = post.get((i, j, label), 0.0) + p
                        pairs[q, label] = pairs.get((q, label), 0.0) + p
        return post, pairs, z

    def best(self, r: Region) -> list[tuple[int, int, int]]:
        """Viterbi: the spans (begin atom, end atom, label) of the best segmentation."""
        lattice, n, k = self._lattice(r), len(r.atoms), len(KINDS) + 1
        low = -1e30
        best = [[(low, -1, 0, 0)] * k for _ in range(n + 1)]
        best[0][0] = (0.0, -1, 0, 0)
        for j in range(1, n + 1):
            for i, label, s in lattice[j]:
                for q in range(k):
                    v = best[i][q][0]
                    if v > low:
                        v += s + self._step(q, label)
                        to = q if label == CARRY else label
                        if v > best[j][to][0]:
                            best[j][to] = (v, i, q, label)
        j, state = n, max(range(k), key=lambda q: best[n][q][0])
        out = []
        while j > 0:
            _, i, q, label = best[j][state]
            if label > 0:
                out.append((i, j, label))
            j, state = i, q
        return out[::-1]

    def added(self, text: str, fixed: list[Span]) -> list[Span]:
        """Spans beside the fixed ones."""
        out: list[Span] = []
        at = 0
        for start, end in regions(text):
            while at < len(fixed) and fixed[at][2] <= start:
                at += 1
            near = []
            for x in fixed[max(0, at - len(KINDS)) :]:
                if x[1] >= end:
                    break
                if x[2] > start:
                    near.append(x)
            if end - start < 6 or any(a <= start and b >= end for _, a, b in near):
                continue
            r = Region(text, start, end, near)
            if not any(r.segments):
                continue
            post, _, _ = self.posteriors(r)
            for i, j, label in self.best(r):
                if post[i, j, label] >= CONFIDENCE:
                    out.append((KINDS[label - 1], r.atoms[i][0], r.atoms[j - 1][1]))
        return out

    def learn(self, text: str, gold: list[Span], rate: float, shrink: float, fixed: Sequence[Span] = ()) -> None:
        """One gradient step on the log-likelihood of the gold segmentation of a text.

        ``fixed`` spans are clamped as in decoding, and the rest is learnt beside them.
        """
        known = {(a, b): kind for kind, a, b in gold}
        for start, end in regions(text):
            near = [x for x in fixed if x[1] < end and x[2] > start]
            if any(a <= start and b >= end for _, a, b in near):
                continue
            r = Region(text, start, end, near)
            if not any(r.segments):
                continue
            post, pairs, _ = self.posteriors(r)
            truth: dict[int, tuple[int, int]] = {}  # begin atom: end atom and label
            rise: dict[str, float] = {}
            for j in range(1, len(r.atoms) + 1):
                for i, kind, feats in r.segments[j]:
                    label = 1 + KINDS.index(kind)
                    is_gold = known.get((r.atoms[i][0], r.atoms[j - 1][1])) == kind
                    if is_gold:
                        truth[i] = (j, label)
                    for f in feats:
                        rise[f] = rise.get(f, 0.0) + is_gold - post[i, j, label]
            at, before = 0, 0
            while at < len(r.atoms):
                if at in truth:
                    at, label = truth[at]
                    f = f"after{before}:{label}"
                    rise[f] = rise.get(f, 0.0) + 1
                    before = label
                else:
                    before = before if r.blank[at] else 0
                    at += 1
            for (q, label), expected in pairs.items():
                f = f"after{q}:{label}"
                rise[f] = rise.get(f, 0.0) - expected
            for f, g in rise.items():
                if abs(g) > 1e-4:
                    w = self.w.get(f, 0.0)
                    self.w[f] = w + rate * (g - shrink * w)


def _lse(x: list[float]) -> float:
    m = max(x)
    return m + math.log(sum(math.exp(v - m) for v in x)) if m > -1e29 else m


# ---- training --------------------------------------------------------------------------


def _variant(kind: str, s: str, rng: random.Random) -> str:
    """The span as it is, or the same data in another format."""
    d = _digits(s)
    pick = rng.random()
    if pick < 0.5:
        return s
    if kind == "email":
        at, dot = rng.choice([(" [at] ", "."), ("(at)", "."), ("[at]", "[dot]"), ("@", "[.]")])
        local, _, domain = s.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return s.replace(".", rng.choice(["[.]", "(dot)", "[dot]"]))
    if kind == "card":
        sep = rng.choice([" ", "-", "."])
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    if len(d) == 11:
        a, b, c, e = d[0], d[1:4], d[4:7], d[7:]
        return rng.choice(
            [f"+{a}-{b}-{c}-{e}", f"({b}) {c}-{e}", f"+{a} {b} {c} {e}", f"+{a}.{b}.{c}.{e}", f"00{a} {b} {c} {e}"]
        )
    return "+" + " ".join(d[i : i + 3] for i in range(0, len(d), 3))


def _noise(rng: random.Random) -> str:
    """Numbers that are no personal data."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice(
        [
            n(rng.randint(1, 13)),
            f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}",
            f"20{n(2)}-{n(2)}-{n(2)}",
            f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}",
            f"978{n(10)}",
            f"{n(2)}:{n(2)}",
            " ".join(n(rng.randint(1, 5)) for _ in range(rng.randint(2, 8))),
            f"20{n(2)}-{n(2)}-{n(2)} 20{n(2)}-{n(2)}-{n(2)}",
            f"{n(3)}-{n(2)}-{n(4)}",
            n(rng.randint(20, 40)),
        ]
    )


def examples(found: dict[str, list[str]], count: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Texts with gold spans: sampled spans (after a word and a tab, if any), reformatted, set side by side
    and amid noise."""
    rng = random.Random(seed)
    words = ["the", "ou", "call", "see,", "in", "de", "und", "x", "no."]
    out = []
    for _ in range(count):
        text, gold = rng.choice(words), []
        for _ in range(rng.randint(1, 4)):
            text += rng.choice([" ", " ", " ", " " + rng.choice(words) + " ", ": ", ", "])
            if rng.random() < 0.3:
                text += _noise(rng)
                continue
            kind = rng.choice(KINDS)
            word, _, s = rng.choice(found[kind]).rpartition("\t")
            s = _variant(kind, s, rng)
            if not valid(kind, s):
                continue
            if word and rng.random() < 0.7:
                text += word + rng.choice([" ", ": "])
            gold.append((kind, len(text), len(text) + len(s)))
            text += s
        out.append((text + rng.choice(["", ".", ",", " " + rng.choice(words)]), gold))
    return out


def train(docs: DataFrame, documents: int = 4000, spans: int = 2000, steps: int = 3000) -> Field:
    """Fit the field on base spans of at most ``documents`` documents, ``spans`` of each kind."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(documents)
    udf = F.pandas_udf(
        lambda text: text.map(
            lambda t: [f"{k}:{word_before(t, a)}\t{t[a:b]}" for k, a, b in base_spans(t)] if t else []
        ),
        ArrayType(StringType()),
    )
    rows = written(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id", "left_semi")
        .select(F.explode(udf("text")).alias("s"))
        .distinct()
        .withColumn("kind", F.substring_index("s", ":", 1)),
        "pii-spans",
    )
    found: dict[str, list[str]] = {}
    for kind in KINDS:
        some = rows.filter(F.col("kind") == kind).orderBy(F.xxhash64("s"), "s").limit(spans)
        found[kind] = [r["s"].partition(":")[2] for r in some.collect()] or SEEDS[kind]
    field = Field()
    texts = examples(found, steps)
    for i, (text, gold) in enumerate(texts):
        clamped = base_spans(text) if i % 2 else ()
        field.learn(text, gold, 0.3 / (1 + 3 * i / len(texts)), 1e-3, clamped)
    return field


# ---- on tables -------------------------------------------------------------------------

SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("base", BooleanType()),
    ]
)


def all_spans(field: Field, text: str) -> list[tuple[str, int, int, bool]]:
    fixed = base_spans(text)
    merged = [(*x, True) for x in fixed] + [(*x, False) for x in field.added(text, fixed)]
    return sorted(merged, key=lambda x: (x[1], KINDS.index(x[0])))


def spans(field: Field, text: Column) -> Column:
    """Array of (kind, start, end, base) of a text column, in code points."""

    @F.pandas_udf(ArrayType(SPAN))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [
                    [dict(zip(SPAN.names, x, strict=True)) for x in all_spans(field, t)]
                    if isinstance(t, str)
                    else []
                    for t in batch
                ],
                dtype=object,
            )

    return find(text)


def found(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All columns of ``docs`` with the array ``spans``."""
    field = field or train(docs)
    return docs.drop("spans").withColumn("spans", spans(field, F.col("text")))


def redact(text: str, marks: list[tuple[str, int, int, bool]]) -> str:
    """Each stretch of overlapping spans becomes the kind of its first span in brackets."""
    out, end = [], 0
    for kind, a, b, _ in marks:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The rows and columns of ``docs`` with personal data replaced in ``text`` (and ``n_chars``)."""
    field = field or train(docs)

    @F.pandas_udf(StringType())
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: redact(t, all_spans(field, t)) if isinstance(t, str) else None)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
