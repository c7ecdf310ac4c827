"""Near-duplicate documents: MinHash with tensored banding, verified on full shingle sets.

**Sets.** A-Z are lower-cased, words are runs of anything but ASCII white space, a document's set holds its
distinct 5-word shingles (the whole sequence if it has fewer words; nothing without words) as
64-bit hashes. Documents with equal sets are one class from here on, so a group of exact copies
costs one row whatever its size.

**Tensored banding.** Two collections of ``m`` bands of ``r`` minhashes are computed, ``2 m r`` minhashes in all.
A table key combines a band of the first with a band of the second collection: ``m * m`` tables of
``2 r`` rows each, for which plain banding needs ``2 m m r`` minhashes. Two sets with
similarity ``s`` share a bucket with probability ``(1 - (1 - s^r)^m)^2``: 0.9996 at 0.85 for the
defaults, more above.

**Verification.** All candidate links between different components are checked on full sets, without
emitting all pairs of a bucket. In each of ``star_rounds`` rounds every bucket picks one member as
hub, its members are verified against the hub, components are recomputed, and the hub leaves the
bucket, all of whose pairs are then known. Buckets within one component need nothing more. The
rest, where members of several components remain, is compared in blocks of bounded size inside
tasks, and only links come out. So every pair that shares a bucket is either verified or
already known to be connected, and components are exact for the candidates.

Buckets with equal members are kept once. A document without identifier, text or words is linked
with nothing and kept. Repeated rows are rows of one document. Empty tables give empty tables. Only
the identifier and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.llm.graph import components
from dwellgrid.sources.storage import written

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)
HOT = 1000


@dataclass(frozen=True)
class Near:
    """Parameters; a link needs ``100 * common >= percent * union``."""

    width: int = 5
    percent: int = 85
    bands: int = 9
    band_rows: int = 3
    star_rounds: int = 2
    block_members: int = 2048
    block_shingles: int = 2_000_000


def shingles(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    k = min(width, n)
    s = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        s = (s ^ h[i : n - k + 1 + i]) * MIX
        s ^= s >> np.uint64(29)
    s *= MIX2
    s ^= s >> np.uint64(32)
    return np.unique(s)


def _multipliers(p: Near) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    n = 2 * p.bands * p.band_rows
    draw = lambda: rng.integers(0, 2**63, n, dtype=np.uint64)
    return draw() * np.uint64(2) + np.uint64(1), draw()


def _bands(s: np.ndarray, p: Near, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """One hash per band of both collections."""
    low = np.full(len(mul), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 2048):
        v = (s[at : at + 2048, None] ^ add) * mul
        low = np.minimum(low, (v ^ (v >> np.uint64(31))).min(axis=0))
    rows = low.reshape(2 * p.bands, p.band_rows)
    out = np.zeros(2 * p.bands, dtype=np.uint64)
    for j in range(p.band_rows):
        out = (out ^ rows[:, j]) * MIX
        out ^= out >> np.uint64(30)
    return out.view(np.int64)


SIGNED = "doc_id long, n_shingles long, fp1 long, fp2 long, half_a array<long>, half_b array<long>"


def signatures(docs: DataFrame, p: Near = Near()) -> DataFrame:
    """Set size, 128-bit fingerprint of the set and band hashes of every document."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        mul, add = _multipliers(p)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part, rows = batch.iloc[at : at + 1000], []
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    s = shingles(text if isinstance(text, str) else "", p.width)
                    f = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype="<i8")
                    b = _bands(s, p, mul, add) if len(s) else np.empty(0, dtype=np.int64)
                    rows.append((doc_id, len(s), f[0], f[1], b[: p.bands], b[p.bands :]))
                names = ["doc_id", "n_shingles", "fp1", "fp2", "half_a", "half_b"]
                out = pd.DataFrame(rows, columns=names)
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return docs.select("doc_id", "text").mapInPandas(sign, SIGNED)


def sets(docs: DataFrame, chosen: DataFrame, p: Near = Near()) -> DataFrame:
    """(rep, shingles) of the documents whose identifiers are in ``chosen`` (rep)."""

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                yield pd.DataFrame(
                    {
                        "rep": part["doc_id"],
                        "shingles": [
                            shingles(t if isinstance(t, str) else "", p.width).view(np.int64)
                            for t in part["text"]
                        ],
                    }
                )

    # The list grows with the documents, so it is never broadcast: one plan at every size.
    ids = chosen.select(F.col("rep").alias("doc_id")).hint("merge")
    wanted = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    # A repeated identifier would give a set twice; the aggregate keeps one of equal rows.
    return wanted.dropDuplicates(["doc_id"]).mapInPandas(collect, "rep long, shingles array<long>")


def buckets(classes: DataFrame) -> DataFrame:
    """(key, rep, n_shingles) of every bucket with two members or more, equal buckets once."""
    keys = classes.select(
        "rep",
        "n_shingles",
        F.explode(
            F.expr(
                "flatten(transform(half_a, (a, i) -> transform(half_b,"
                " (b, j) -> xxhash64(a, b, i, j))))"
            )
        ).alias("key"),
    )
    several = (
        keys.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("rep").alias("least"),
            F.expr("bit_xor(xxhash64(rep))").alias("members"),
        )
        .filter("n > 1")
        .groupBy("n", "least", "members")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    return keys.join(several, "key").select("key", "rep", "n_shingles")


def verified(pairs: DataFrame, full: DataFrame, p: Near) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = full.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = full.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    common = pairs.join(left, "a").join(right, "b").select(
        "a",
        "b",
        F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"),
        (F.size("sa") + F.size("sb")).cast("long").alias("total"),
    )
    return common.filter(f"100 * common >= {p.percent} * (total - common)").select("a", "b")


def _labelled(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """Members with their present component, in buckets that still hold several."""
    if label is None:
        rows = members.withColumn("component", F.col("rep"))
    else:
        rows = members.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep")
        )
    open_keys = (
        rows.groupBy("key")
        .agg(
            F.min("component").alias("first"),
            F.max("component").alias("last"),
            F.count(F.lit(1)).alias("n"),
            F.sum("n_shingles").alias("total"),
            F.min(F.struct(F.xxhash64("key", "rep").alias("h"), "rep", "component")).alias("hub"),
        )
        .filter("first != last")
        .selectExpr("key", "n", "total", "hub.rep AS hub", "hub.component AS hub_component")
    )
    return rows.join(open_keys, "key")


LINK = "a long, b long"


def _block_links(percent: int):
    """Links between components inside one block, or between two."""

    def find(group: pd.DataFrame) -> pd.DataFrame:
        reps, comps = group["rep"].to_numpy(), group["component"].to_numpy()
        side = group["side"].to_numpy()
        rows = [np.asarray(x, dtype=np.int64) for x in group["shingles"]]
        size = np.array([len(x) for x in rows])
        owner = np.repeat(np.arange(len(rows)), size)
        _, element = np.unique(np.concatenate(rows), return_inverse=True)
        order = np.argsort(element, kind="stable")
        edge = np.searchsorted(element[order], np.arange(element.max() + 2))
        posting = owner[order]
        begin = np.concatenate([[0], np.cumsum(size)])
        two = len(np.unique(side)) > 1
        local = {c: c for c in np.unique(comps).tolist()}

        def root(c: int) -> int:
            while local[c] != c:
                local[c] = local[local[c]]
                c = local[c]
            return c

        largest = pd.Series(comps).mode().iloc[0]
        found = []
        for i in np.flatnonzero(comps != largest):
            own = element[begin[i] : begin[i + 1]]
            hits = np.concatenate([posting[edge[e] : edge[e + 1]] for e in own])
            common = np.bincount(hits, minlength=len(rows))
            good = 100 * common >= percent * (size + size[i] - common)
            good &= comps != comps[i]
            if two:
                good &= side != side[i]
            for j in np.flatnonzero(good):
                x, y = root(int(comps[i])), root(int(comps[j]))
                if x != y:
                    local[x] = y
                    found.append((int(reps[i]), int(reps[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return find


def _rest(open_rows: DataFrame, full: DataFrame, p: Near) -> DataFrame:
    """Links between components that share a bucket, found in blocks of bounded size."""
    dealt = open_rows.withColumn(
        "blocks",
        F.greatest(
            F.ceil(F.col("n") / F.lit(p.block_members)),
            F.ceil(F.col("total") / F.lit(p.block_shingles)),
        ),
    ).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    pairs = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.col("block").alias("side"),
        "rep",
        "component",
    )
    return (
        pairs.join(full, "rep")
        .groupBy("key", "low", "high")
        .applyInPandas(_block_links(p.percent), LINK)
    )


def links(docs: DataFrame, classes: DataFrame, p: Near = Near()) -> DataFrame | None:
    """Component labels (node, component) of the classes that are linked with another."""
    members = written(buckets(classes), "buckets")
    full = written(sets(docs, members.select("rep").distinct(), p), "sets")
    found, label = None, None
    for _ in range(p.star_rounds):
        rows = written(_labelled(members, label), "open")
        if rows.isEmpty():
            return label
        pairs = (
            rows.filter("component != hub_component")
            .selectExpr("least(rep, hub) AS a", "greatest(rep, hub) AS b")
            .distinct()
        )
        new = written(verified(pairs, full, p), "verified")
        found = new if found is None else found.union(new)
        if not found.isEmpty():
            label = written(components(found), "components")
        members = rows.filter("rep != hub").select("key", "rep", "n_shingles")
    rows = written(_labelled(members, label), "open")
    if not rows.isEmpty():
        new = written(_rest(rows, full, p), "rest")
        found = new if found is None else found.union(new)
        if not found.isEmpty():
            label = written(components(found), "components")
    return label


def near_duplicates(docs: DataFrame, p: Near = Near()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    signed = written(signatures(docs, p), "signatures")
    classes = written(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("fp1", "fp2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("members"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("half_a").alias("half_a"),
            F.first("half_b").alias("half_b"),
        ),
        "classes",
    )
    label = links(docs, classes, p)
    reps = classes.select("fp1", "fp2", "rep", "members")
    if label is not None:
        reps = reps.join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
            "fp1", "fp2", "members", F.coalesce("component", "rep").alias("component")
        )
    else:
        reps = reps.withColumnRenamed("rep", "component")
    reps = written(reps, "representatives")
    # Fewer than HOT classes hold more than one in HOT of the rows: these are broadcast, so that no task gets
    # a large group of copies. The rest is joined by key, and empty sets are alone.
    hot = F.col("members") * HOT > signed.count()
    plain = signed.select("doc_id", "n_shingles", "fp1", "fp2")
    many = F.broadcast(reps.filter(hot).select("fp1", "fp2", F.col("component").alias("large")))
    dealt = plain.filter("n_shingles > 0").join(many, ["fp1", "fp2"], "left")
    small = dealt.filter("large IS NULL").join(
        reps.filter(~hot).select("fp1", "fp2", "component"), ["fp1", "fp2"], "left"
    )
    names = ["doc_id", "n_shingles"]
    found = (
        small.select(*names, "component")
        .union(dealt.filter("large IS NOT NULL").select(*names, "large"))
        .union(plain.filter("n_shingles = 0").select(*names, F.lit(None).cast("long")))
    )
    return found.select(
        *names,
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, p: Near = Near()) -> DataFrame:
    """One document, that with the smallest identifier, of each group; rows without identifier stay."""
    kept = near_duplicates(docs, p).filter("kept AND doc_id IS NOT NULL").select("doc_id")
    named = docs.join(kept.distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).union(docs.filter("doc_id IS NULL"))
