"""Resampling, token counts, fill-in-middle and the toxicity curve against plain versions of themselves."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dwellgrid.llm import infill, pieces, resampling, tokencounts, toxicity
from dwellgrid.llm.queries import tokenizer_file

DOCS = "doc_id long, text string"
LONG = " ".join(f"Word{i % 977}x{i % 31}é" for i in range(60_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three"),
    (5, "one two three"),
    (5, "one two three"),
    (None, "no identifier here " * 12),
    (6, LONG),
    (7, "mixed <P> mark and <|endoftext|> mark, İ ß 中文 🙂 x́ \x1c\x85"),
    (8, "<S"),
    (9, "a" * 5000 + " " + "-" * 3000),
    (10, "�Ᲊ\U0001f9d1‍­ don't we'll 1234½ "),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def clash(docs, *names):
    return docs.withColumns({n: F.lit("theirs") for n in names})


# ---- resampling -------------------------------------------------------------------------

LOWER = {i: i + 32 for i in range(65, 91)}


def features_by_hand(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in runs]


def resampled_by_hand(docs, target, share=5):
    found = [(i, *features_by_hand(t)) for i, t in docs]
    s, t = [0] * 10_000, [0] * 10_000
    for _, _, f in found:
        for b in f:
            s[b] += 1
    for text in target:
        for b in features_by_hand(text)[1]:
            t[b] += 1
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000))))
        for b in range(10_000)
    ]
    rows = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        score = w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), w, score, None, n])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: share * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=repr)


def test_resampling_equals_brute_force(spark, odd):
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "délta", "1st", "x", "中文"]
    made = [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(80)]
    docs = odd.union(spark.createDataFrame(made, DOCS))
    target = spark.createDataFrame([("alpha beta gamma",), (None,), ("1st-x délta",)], "text string")
    p = resampling.Draw(share=40)
    rows = resampling.resampled(clash(docs, "weight", "rank", "part"), target, p).collect()
    want = resampled_by_hand(ODD + made, [r["text"] for r in target.collect()], 40)
    assert sorted(map(tuple, rows), key=repr) == want
    drawn = {r["doc_id"] for r in rows if r["rank"]}
    chosen = resampling.selected(clash(docs, "weight"), target, p).collect()
    assert {r["doc_id"] for r in chosen} == drawn and all(r["weight"] == "theirs" for r in chosen)


def test_resampling_of_empty_tables(odd, none):
    assert resampling.resampled(none, none.select("text")).count() == 0
    assert resampling.resampled(odd, none.select("text")).count() == len(ODD)


def test_moved_checksums_compose(monkeypatch):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 63, 64, 65, 1000, 70_001):
        a, b = rng.bytes(11), rng.bytes(n)
        moved = resampling.moved(np.array([zlib.crc32(a)], np.uint32), np.array([n]))
        assert int(moved[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)
    # Words that lie across many small blocks are found once each.
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 16)
    text = "the quick brown fox jumps over a-very/long" + "word" * 30 + " the end  "
    n, _, found = resampling._bucketed(pa.array([text, None, "the end"]), resampling.Draw())[0:3]
    buckets = sorted(b for x, t in found for b, i in zip(x.tolist(), t.tolist()) if i == 0)
    assert n == 3 and buckets == sorted(features_by_hand(text)[1])


# ---- token counts -----------------------------------------------------------------------


def counts_by_library(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        out.append((i, len((text or "").encode()), n, n > 1024))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [16_000_000, 2_000, 0])
def test_token_counts_equal_the_library(odd, size):
    p = tokencounts.Counting(broadcast_bytes=size)
    rows = tokencounts.counted(clash(odd, "row", "tokens", "n_bytes"), tokenizer_file("byte_bpe_50k.json"), p)
    assert sorted(map(tuple, rows.collect()), key=repr) == counts_by_library(ODD)


def test_token_counts_of_an_empty_table(none):
    assert tokencounts.counted(none, tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_pre_tokens_equal_the_library():
    s = tokencounts.Splitter(tokenizer_file("byte_bpe_50k.json"))
    bits = ["'s", "'S", " it's", "Σ", "é", "é", "\x1c", "\x85", "1", "½", "中文", "🙂", "ß", "\t", " ", "  \n", "a", " ", "Ᲊ", "\U00010d4a", " "]
    for seed in range(1500):
        r = random.Random(seed)
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 14)))
        assert s.split(t) == s._by_library(t)


def test_frequent_pre_tokens_stay_within_their_bytes(spark):
    table = spark.range(2000).selectExpr("concat('t', id) AS token", "id + 1 AS n", "1L AS pieces")
    found, least = tokencounts.frequent(table, tokencounts.Counting(broadcast_bytes=20_000))
    assert 0 < sum(len(t) + 64 for t in found) <= 20_000
    assert set(found) == {f"t{i}" for i in range(2000) if i + 1 >= least}


# ---- fill in the middle -----------------------------------------------------------------


def infilled_by_hand(doc_id, text, units=r"[A-Za-z]+|[^A-Za-z]"):
    text = text or ""
    parts = re.findall(units, text, re.DOTALL)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(parts) + 1), h[1] % (len(parts) + 1)))
    p, m, s = ("".join(parts[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(parts), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(parts), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(parts), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_brute_force_and_is_undone(spark, odd):
    rng = random.Random(9)
    bits = ["abc", "Z", " ", "é", "🙂", "<", "P>", "<S", ">", "\n", "中", "́", "1"]
    made = [(100 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(400)]
    docs = odd.union(spark.createDataFrame(made, DOCS))
    for units, pattern in (("words", r"[A-Za-z]+|[^A-Za-z]"), ("chars", ".")):
        out = infill.transformed(clash(docs, "form", "n", "extra"), infill.Infill(units=units))
        rows = out.withColumn("back", infill.restored()).collect()
        got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows]
        assert sorted(got, key=repr) == sorted((infilled_by_hand(i, t, pattern) for i, t in ODD + made), key=repr)
        assert all(r["back"] == (r["text"] or "") and r["extra"] == "theirs" for r in rows)
        assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_infill_of_an_empty_table(none):
    assert infill.transformed(none).count() == 0


def test_exceptions_convert_both_ways():
    for text in ("", "plain", "éa中🙂b", "🙂🙂", "aé" * 50):
        x = infill.Exceptions(np.frombuffer(text.encode(), np.uint8))
        at = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
        assert x.to_chars(at).tolist() == list(range(len(text) + 1))
        assert x.to_bytes(np.arange(len(text) + 1)).tolist() == at.tolist()


# ---- pieces -----------------------------------------------------------------------------


def test_pieces_of_clashing_columns_and_empty_tables(odd, none):
    file = tokenizer_file("piece_bpe_32k.model")
    rows = pieces.digest(clash(odd, "n_pieces", "ids_crc32", "_p"), file)
    assert rows.columns == ["doc_id", "_p", "n_pieces", "ids_crc32", "round_trip"]
    assert rows.filter("round_trip AND _p = 'theirs' AND n_pieces IS NOT NULL").count() == len(ODD)
    assert pieces.encoded(clash(odd, "ids"), file).schema["ids"].dataType.simpleString() == "array<int>"
    assert pieces.digest(none, file).count() == 0
    assert pieces.decoded(pieces.encoded(none, file), file).count() == 0


# ---- toxicity ---------------------------------------------------------------------------


def test_curves_of_a_thousand_histograms():
    """Counts of evidence by label, many of them separable: the slope is positive and toxic rows are found."""
    for seed in range(1000):
        rng = np.random.default_rng(seed)
        gap, n1, n0 = rng.uniform(0.8, 6), rng.integers(3, 2000), rng.integers(50, 20_000)
        clean = np.where(rng.random(n0) < rng.uniform(0, 0.3), rng.exponential(0.5, n0), 0.0)
        toxic = clean.max() * (seed % 2) + gap + rng.normal(0, rng.uniform(0.01, 0.5), n1)
        x = np.round(np.concatenate([clean, np.maximum(toxic, 0)]), 1)
        y = np.concatenate([np.zeros(n0), np.ones(n1)])
        cells, w = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
        intercept, slope = toxicity._curve(cells[:, 0], cells[:, 1], w.astype(float))
        assert slope > 0
        if seed % 2:
            caught = (intercept + slope * x[y == 1] >= 0).mean()
            wrong = (intercept + slope * x[y == 0] >= 0).mean()
            assert caught >= 0.9 and wrong <= 0.05, (seed, caught, wrong)


def test_curve_is_the_maximum_and_has_a_slope_at_any_rate():
    rng = np.random.default_rng(0)
    x, y, w = rng.exponential(1, 40), rng.integers(0, 2, 40).astype(float), rng.integers(1, 9, 40).astype(float)
    beta = toxicity._logistic(x, y, w)

    def loss(b):
        z = b[0] + b[1] * x
        return (w * (np.logaddexp(0, z) - y * z)).sum() + (1e-3 * b[0] ** 2 + 1e-2 * b[1] ** 2) / 2

    assert all(loss(beta) <= loss(beta + d) for d in rng.normal(0, 0.01, (200, 2)))
    # Evidence that points the wrong way, or says nothing.
    assert toxicity._curve(np.array([0.0, 2.0]), np.array([1.0, 0.0]), np.array([5.0, 5.0]))[1] == 1.0
    assert toxicity._curve(np.zeros(2), np.array([1.0, 0.0]), np.array([5.0, 50.0]))[1] > 0


def test_fit_equals_plain_counts(spark):
    """Token scores, lambda and K of a small table, recomputed from its texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = [rng.choice(words) for _ in range(20)]
        if bad:
            text[3] = text[11] = "vile"
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs, table = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    p = toxicity.Fit()
    model = toxicity.fit(docs, table, p)
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in rows}
    seen = {(t, i % 5 == 0) for i, t in rows if fold[i] > 1}
    n = {1: {}, 0: {}}
    for t, bad in seen:
        for w in set(toxicity.TOKEN.findall(t.lower())):
            n[int(bad)][w] = n[int(bad)].get(w, 0) + 1
    all1, all0 = sum(n[1].values()), sum(n[0].values())
    share = all1 / (all1 + all0)
    want = {}
    for w in {*n[1], *n[0]}:
        c1, c0 = n[1].get(w, 0) + p.prior * share, n[0].get(w, 0) + p.prior * (1 - share)
        if n[1].get(w, 0) + n[0].get(w, 0) < p.least_documents:
            continue
        delta = math.log(c1 / (all1 + p.prior * share)) - math.log(c0 / (all0 + p.prior * (1 - share)))
        score = math.copysign(max(abs(delta) - min(math.sqrt(1 / c1 + 1 / c0), 2.0), 0.0), delta)
        if score:
            want[w] = score
    assert set(model.words) == set(want) and all(abs(model.words[w] - want[w]) < 1e-9 for w in want)
    # Lambda: the background's expected exp(lambda s) is one.
    weight = {w: n[0].get(w, 0) for w in want}
    rest = max(all0 - sum(weight.values()), 1)
    total = rest + sum(weight.values())
    mean = rest / total * math.exp(-model.lam * p.drift)
    mean += sum(c / total * math.exp(model.lam * (want[w] - p.drift)) for w, c in weight.items())
    assert abs(mean - 1) < 1e-4 or model.lam > 19.9
    best = []
    for i, t in rows:
        if fold[i] == 1 and i % 5:
            s = np.array([model.token(w) for w in toxicity.TOKEN.findall(t.lower())])
            top = max((x[2] for x in toxicity.maximal_segments(s)), default=0.0)
            best.append(model.lam * top - math.log(len(s)))
    assert abs(model.log_k - (np.mean(best) - 0.5772156649)) < 1e-9
    rated = toxicity.rated(docs, model).collect()
    assert all(r["n_tokens"] == 20 for r in rated)
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in rated if fold[r["doc_id"]] == 0)
