"""Boosted regression trees from histograms that tasks add up and cut.

``binned`` turns a training and a validation set into blocks once: every feature becomes a code of one byte,
cut at sketched quantiles of the training rows. ``fit`` grows any number of configurations over these
blocks in step: a pass sums gradients and rows per (tree node, feature, code) inside each task, the sums of a
node meet in one task, and that task picks the node's best split. The driver gets a few numbers per node, never
sums. A node that cannot be split (too deep, too few rows, no leaf left) is not summed: what its leaf value
needs comes with its parent's split. Up to ``ROWS_ALONE`` rows a task takes all blocks for its share of the
configurations, which needs no shuffle; with more rows the blocks are dealt out too, and where there are fewer
partitions than cores, the configurations go to copies of them.

* **Growth**: level by level, or best leaf first (``leaves``). The latter asks for several leaves in a
  pass and keeps exactly the splits that a one-by-one search takes.
* **Regularisation**: L1 and L2 in gain and leaf values, least gain, least rows, shares of rows and columns.
* **Losses**: squared, or pinball at ``alpha``. Pinball trees get as leaf values the residual quantile of
  the rows in the leaf, from two counting passes (to a millionth of the range of residuals).
* **Ties**: of splits with equal gain up to rounding the first feature and code wins, whatever the order of sums.
* **Patience**: a model ends when its validation loss has not improved for ``patience`` rounds, and is cut at its
  best round. The loss comes with the first pass of the next round.

Margins of the rows are written to the shared folder every ``STORED_ROUNDS`` rounds; what is lost with an
executor is computed again from there and the trees since. A null feature goes to the right.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellgrid.sources.storage import emptied, written

BLOCK_ROWS = 4096
MOST_ROWS_PER_PART = 262_144
STORED_ROUNDS = 25
CELLS = 1024
CHUNK_BLOCKS = 64
KEYS_PER_TASK = 32
ROWS_ALONE = 32_768
MODELS_PER_COPY = 8
MEMO_BYTES = 256_000_000
NULL_CODE = 255


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters. The defaults, tuned in the study.

    ``alpha`` 0 stands for squared loss, ``leaves`` 0 for growth by level and ``max_depth`` 0 for no
    limit.
    """

    rounds: int = 1500
    learning_rate: float = 0.051612
    max_depth: int = 6
    min_rows: int = 8
    row_share: float = 0.988352
    column_share: float = 0.952685
    min_gain: float = 0.089951
    l1: float = 0.285222
    l2: float = 2.843754
    patience: int = 50
    leaves: int = 0
    alpha: float = 0.0
    max_bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays; a leaf has feature -1. ``cut`` is a code while growing, a value afterwards."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every column of ``x`` (features by rows)."""
        at = np.zeros(x.shape[1], dtype=np.int64)
        going = np.flatnonzero(self.feature[at] >= 0)
        while len(going):
            node = at[going]
            below = x[self.feature[node], going] <= self.cut[node]
            node = np.where(below, self.left[node], self.right[node])
            at[going] = node
            going = going[self.feature[node] >= 0]
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(x)]

    def small(self) -> Tree:
        """A tree over codes in short types, to travel with tasks."""
        f, c, left, right = (
            a.astype(k) for a, k in zip((self.feature, self.cut, self.left, self.right), ("i2", "f4", "i4", "i4"))
        )
        return Tree(f, c, left, right, self.value)


@dataclass
class Model:
    """A fitted ensemble: plain values, small enough to travel with a task."""

    features: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)
    gain: dict[str, tuple[float, int]] = field(default_factory=dict)
    losses: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(x.shape[1], self.base)
        for t in self.trees:
            out += t.predict(x)
        return out

    def importance(self) -> dict[str, float]:
        """Mean gain of a feature's splits as a share of the sum over features."""
        mean = {f: g / n for f, (g, n) in self.gain.items() if n}
        total = sum(mean.values()) or 1.0
        return {f: mean.get(f, 0.0) / total for f in self.features}


# ---- the binned table ------------------------------------------------------------------


@dataclass
class Binned:
    """Blocks of coded rows in the shared folder, and the cuts behind the codes."""

    blocks: DataFrame
    features: list[str]
    cuts: list[np.ndarray]
    rows: int
    train: DataFrame


def binned(train: DataFrame, validation: DataFrame, features: Sequence[str], max_bins: int = 64) -> Binned:
    """Code both sets once; all fits on them read the stored blocks."""
    if not 2 <= max_bins <= NULL_CODE:
        raise ValueError(f"max_bins has to lie between 2 and {NULL_CODE}")
    if train.isEmpty():
        raise ValueError("no training rows")
    features = list(features)
    probs = [i / max_bins for i in range(1, max_bins)]
    found = train.approxQuantile(features, probs, 1 / (8 * max_bins))
    cuts = [np.unique(np.array(q, dtype=float)) for q in found]
    both = train.withColumn("__held", F.lit(0)).unionByName(validation.withColumn("__held", F.lit(1)))
    rows = both.select(
        *[F.col(f).cast("double") for f in features], F.col("target").cast("double"), "__held"
    )
    n = both.count()
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-n // BLOCK_ROWS), max(cores, -(-n // MOST_ROWS_PER_PART))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, b in enumerate(batches):
            codes = np.empty((len(features), b.num_rows), dtype=np.uint8)
            for k, c in enumerate(cuts):
                x = b.column(k).to_numpy(zero_copy_only=False).astype(float)
                codes[k] = np.where(np.isnan(x), NULL_CODE, np.searchsorted(c, x))
            target = b.column(len(features)).to_numpy(zero_copy_only=False).astype(float)
            held = b.column(len(features) + 1).to_numpy(zero_copy_only=False).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 24 | i], pa.int64()),
                    pa.array([codes.tobytes()], pa.binary()),
                    pa.array([target.tobytes()], pa.binary()),
                    pa.array([held.tobytes()], pa.binary()),
                    pa.array([b""], pa.binary()),
                ],
                names=["block", "codes", "target", "held", "margins"],
            )

    blocks = rows.repartition(parts).mapInArrow(
        code, "block long, codes binary, target binary, held binary, margins binary"
    )
    return Binned(written(blocks, "binned"), features, cuts, n, train)


@dataclass
class _Block:
    number: int
    codes: np.ndarray
    target: np.ndarray
    held: np.ndarray
    margins: np.ndarray | None

    @staticmethod
    def of(row, n_features: int) -> _Block:
        target = np.frombuffer(row["target"], dtype=float)
        margins = row["margins"]
        return _Block(
            row["block"],
            np.frombuffer(row["codes"], dtype=np.uint8).reshape(n_features, len(target)),
            target,
            np.frombuffer(row["held"], dtype=np.uint8).astype(bool),
            np.frombuffer(margins, dtype=float).reshape(-1, len(target)) if margins else None,
        )


# ---- work inside tasks -----------------------------------------------------------------


@dataclass
class _Ask:
    """What a pass has to sum for one model."""

    model: int
    base: float
    params: TreeParams
    round: int
    stored: int  # trees in the stored margins
    trees: list[bytes]  # trees since then, unpacked where they are needed
    growing: Tree | None = None
    slot: np.ndarray | None = None  # per node the place of its sums, or -1
    slots: int = 0
    columns: np.ndarray | None = None  # features that may split
    loss: bool = False
    span: tuple[float, float] | None = None  # range of residuals to count
    inside: np.ndarray | None = None  # per slot the cell to count more finely
    rank: np.ndarray | None = None  # per slot the rank wanted inside that cell


_MEMO: dict[tuple[str, int, int], tuple[int, np.ndarray]] = {}


def _margin(fit: str, block: _Block, ask: _Ask) -> np.ndarray:
    """The model's prediction of each row so far; worked on from the last pass if this worker made it."""
    key = (fit, block.number, ask.model)
    done, margin = _MEMO.get(key, (-1, None))
    if margin is None or not ask.stored <= done <= ask.round:
        done = ask.stored
        if block.margins is None or done == 0:
            margin = np.full(len(block.target), ask.base)
        else:
            margin = block.margins[ask.model].copy()
    for t in ask.trees[done - ask.stored :]:
        margin = margin + pickle.loads(t).predict(block.codes)
    if sum(m.nbytes for _, m in list(_MEMO.values())[:1]) * len(_MEMO) > MEMO_BYTES:
        _MEMO.clear()
    _MEMO[key] = (ask.round, margin)
    return margin


def _used(block: _Block, ask: _Ask) -> np.ndarray:
    """Training rows in this round's share; a function of seed, round and block alone."""
    p = ask.params
    if p.row_share >= 1:
        return ~block.held
    draw = np.random.default_rng([p.seed, ask.round, block.number]).random(len(block.target))
    return ~block.held & (draw < p.row_share)


def _loss(block: _Block, ask: _Ask, rest: np.ndarray) -> np.ndarray:
    """Validation loss, its rows, and the range of the training residuals."""
    p, e, train = ask.params, rest[block.held], rest[~block.held]
    loss = e * e if not p.alpha else np.maximum(p.alpha * e, (p.alpha - 1) * e)
    return np.array([loss.sum(), len(e), train.min(initial=np.inf), train.max(initial=-np.inf)])


def _sums(block: _Block, ask: _Ask, rest: np.ndarray, codes: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and rows per (slot, feature, code); a feature at a time, so that its columns stay in the cache."""
    p, size = ask.params, ask.slots * bins
    slot = ask.slot[ask.growing.leaf_of(block.codes)]
    rows = np.flatnonzero(_used(block, ask) & (slot >= 0))
    e, first = rest[rows], slot[rows] * bins
    grad = -e if not p.alpha else np.where(e < 0, 1 - p.alpha, -p.alpha)
    g, n = np.empty((ask.slots, len(codes), bins)), np.empty((ask.slots, len(codes), bins), dtype=np.int64)
    for f, own in enumerate(codes):
        at = first + own[rows]
        g[:, f] = np.bincount(at, grad, size).reshape(-1, bins)
        n[:, f] = np.bincount(at, minlength=size).reshape(-1, bins)
    return g, n


def _cells(block: _Block, ask: _Ask, rest: np.ndarray) -> np.ndarray:
    """Rows per (slot, cell of residuals), or per cell inside the slot's cell."""
    used = _used(block, ask)
    slot = ask.slot[ask.growing.leaf_of(block.codes)][used]
    e, (low, high) = rest[used], ask.span
    width = (high - low) / CELLS or 1.0
    cell = np.clip(((e - low) / width).astype(np.int64), 0, CELLS - 1)
    if ask.inside is not None:
        fine = cell == ask.inside[slot]
        slot, e, cell = slot[fine], e[fine], cell[fine]
        part = (e - low - cell * width) / (width / CELLS)
        cell = np.clip(part.astype(np.int64), 0, CELLS - 1)
    return np.bincount(slot * CELLS + cell, minlength=ask.slots * CELLS).reshape(ask.slots, CELLS)


def _partial(fit: str, blocks: Iterator[_Block], asks: list[tuple[int, _Ask]], bins: int) -> Iterator[tuple]:
    """((number of the ask, slot), sums) of a task's blocks; slot -1 has the loss, slots without rows are left out."""
    while chunk := list(islice(blocks, CHUNK_BLOCKS)):
        capped = [np.minimum(b.codes, bins - 1) for b in chunk]
        for k, a in asks:
            loss, g, n = [], 0, 0
            for b, codes in zip(chunk, capped):
                rest = b.target - _margin(fit, b, a)
                if a.loss:
                    loss.append(_loss(b, a, rest))
                if a.span is not None:
                    n = n + _cells(b, a, rest)
                elif a.slots:
                    more = _sums(b, a, rest, codes, bins)
                    g, n = g + more[0], n + more[1]
            if loss:
                x = np.array(loss)
                yield (k, -1), (np.array([*x[:, :2].sum(axis=0), x[:, 2].min(), x[:, 3].max()]),)
            for i in range(a.slots):
                if a.span is not None and n[i].any():
                    yield (k, i), (n[i].astype(np.int32),)
                elif a.span is None and n[i, 0].any():
                    yield (k, i), (g[i], n[i].astype(np.int32))


def _added(at: int, a: tuple, b: tuple) -> tuple:
    if at < 0:
        (x,), (y,) = a, b
        return (np.array([x[0] + y[0], x[1] + y[1], min(x[2], y[2]), max(x[3], y[3])]),)
    return tuple(np.add(x, y, dtype=float) for x, y in zip(a, b))


def _answer(ask: _Ask, at: int, sums: tuple) -> tuple[float, ...]:
    """What the driver needs of the sums of one key."""
    if at < 0:
        return tuple(map(float, sums[0]))
    if ask.span is None:
        return _best(ask.params, ask.columns, *sums)
    upto = np.cumsum(sums[0])
    rank = np.ceil(ask.params.alpha * upto[-1]) if ask.rank is None else ask.rank[at]
    cell = int(np.argmax(upto >= max(rank, 1)))
    return cell, float(rank - (upto[cell] - sums[0][cell]))


def _shrunk(p: TreeParams, g):
    return np.sign(g) * np.maximum(np.abs(g) - p.l1, 0.0)


def _score(p: TreeParams, g, n):
    return _shrunk(p, g) ** 2 / (n + p.l2 + 1e-12)


def _best(p: TreeParams, columns: np.ndarray, g: np.ndarray, n: np.ndarray) -> tuple[float, ...]:
    """Gradient and rows of a node and, if it has a split, its gain, feature, code and the left child's two sums."""
    total = float(g[0].sum()), float(n[0].sum())
    gl, nl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(n, axis=1, dtype=float)[:, :-1]
    gr, nr = total[0] - gl, total[1] - nl
    whole = _score(p, *total)
    gain = _score(p, gl, nl) + _score(p, gr, nr) - whole
    allowed = (nl >= max(p.min_rows, 1)) & (nr >= max(p.min_rows, 1)) & columns[:, None]
    gain = np.where(allowed, gain, -np.inf)
    top = gain.max()
    if not top > p.min_gain + 1e-9:
        return total
    f, code = divmod(int(np.argmax(gain >= top - 1e-12 * (top + whole))), gain.shape[1])
    return *total, float(gain[f, code]), f, code, float(gl[f, code]), float(nl[f, code])


# ---- growing one tree on the driver ----------------------------------------------------


@dataclass
class _Node:
    depth: int
    total: tuple[float, float] = (0.0, 0.0)  # gradient, rows
    split: tuple[float, int, int, float, float] | None = None  # gain, feature, code, left gradient and rows
    children: tuple[int, int] | None = None


class _Grower:
    """The nodes of a tree and what is known of them."""

    def __init__(self, p: TreeParams, columns: np.ndarray, bins: int) -> None:
        self.p, self.columns, self.bins = p, columns, bins
        self.nodes = [_Node(0)]
        self.asked = [0]

    def receive(self, found: dict[int, tuple[float, ...]]) -> None:
        """Totals and best splits of the asked nodes; one that is missing has no rows."""
        for i, at in enumerate(self.asked):
            g, n, *split = found.get(i, (0.0, 0.0))
            self.nodes[at].total, self.nodes[at].split = (g, n), tuple(split) or None
        self.asked = []

    def _open(self, node: _Node) -> bool:
        """Whether the node could be split at all."""
        p = self.p
        return not (p.max_depth and node.depth >= p.max_depth) and node.total[1] >= 2 * max(p.min_rows, 1)

    def _chosen(self) -> tuple[list[int], list[int]]:
        """Nodes split in the tree as far as it is known, and those whose children are to be asked for."""
        if not self.p.leaves:
            inner = [i for i, x in enumerate(self.nodes) if x.split]
            return inner, [i for i in inner if self.nodes[i].children is None]
        open_, inner, unknown = [0], [], []
        while open_ and len(inner) + 1 < self.p.leaves:
            best = max(open_, key=lambda i: (self.nodes[i].split or (-1.0,))[0])
            if self.nodes[best].split is None:
                break
            open_.remove(best)
            inner.append(best)
            if self.nodes[best].children is None:
                unknown.append(best)
            else:
                open_.extend(self.nodes[best].children)
        return inner, unknown

    def advance(self) -> bool:
        """Split what is to be split and ask for the children; False when the tree is complete."""
        while True:
            inner, unknown = self._chosen()
            if not unknown:
                return False
            # With all leaves given away, the children of the last split stay as they are.
            last = self.p.leaves and len(inner) + 1 >= self.p.leaves and unknown == inner[-1:]
            for i in unknown:
                node = self.nodes[i]
                _, _, _, g, n = node.split
                left = len(self.nodes)
                totals = (g, n), (node.total[0] - g, node.total[1] - n)
                self.nodes += [_Node(node.depth + 1, t) for t in totals]
                node.children = (left, left + 1)
                self.asked += [c for c in node.children if not last and self._open(self.nodes[c])]
            if self.asked:
                return True

    def tree(self, final: bool = False) -> Tree:
        """All nodes so far, or the chosen ones with their values."""
        inner = set(self._chosen()[0]) if final else {i for i, x in enumerate(self.nodes) if x.children}
        order, place = [0], {0: 0}
        for i in order:
            if i in inner:
                for c in self.nodes[i].children:
                    place[c] = len(order)
                    order.append(c)
        size = len(self.nodes) if not final else len(order)
        where = (lambda i: place[i]) if final else (lambda i: i)
        t = Tree(
            np.full(size, -1), np.zeros(size), np.zeros(size, int), np.zeros(size, int), np.zeros(size)
        )
        for i in order:
            k, node = where(i), self.nodes[i]
            if i in inner:
                t.feature[k], t.cut[k] = node.split[1], node.split[2]
                t.left[k], t.right[k] = (where(c) for c in node.children)
            elif final:
                g, n = node.total
                t.value[k] = -self.p.learning_rate * float(_shrunk(self.p, g)) / (n + self.p.l2 + 1e-12)
        return t

    def gains(self) -> list[tuple[int, float]]:
        return [(self.nodes[i].split[1], self.nodes[i].split[0]) for i in self._chosen()[0]]


# ---- fitting ---------------------------------------------------------------------------


class _Run:
    """One configuration on its way."""

    def __init__(self, i: int, p: TreeParams, base: float, features: list[str]) -> None:
        self.i, self.p, self.base = i, p, base
        self.trees: list[Tree] = []
        self.packed: list[bytes] = []
        self.gains: list[list[tuple[int, float]]] = []
        self.losses: list[float] = []
        self.features, self.open = features, True
        self.span = (0.0, 0.0)

    def ask(self, stored: int, **more) -> _Ask:
        return _Ask(self.i, self.base, self.p, len(self.trees), stored, self.packed[stored:], **more)

    def add(self, tree: Tree, gains: list[tuple[int, float]]) -> None:
        self.trees.append(tree)
        self.packed.append(pickle.dumps(tree.small()))
        self.gains.append(gains)

    def judged(self, loss: Sequence[float]) -> None:
        """Take in the loss of the trees so far and decide whether to go on."""
        value = loss[0] / loss[1] if loss[1] else 0.0
        self.losses.append(float(value))
        best = int(np.argmin(self.losses))
        waited = len(self.losses) - 1 - best
        if (loss[1] and waited >= self.p.patience) or len(self.trees) >= self.p.rounds:
            self.open = False

    def model(self, cuts: list[np.ndarray]) -> Model:
        best = int(np.argmin(self.losses)) if any(self.losses) else len(self.trees)
        gain: dict[str, tuple[float, int]] = {}
        for per_tree in self.gains[:best]:
            for f, g in per_tree:
                total, n = gain.get(self.features[f], (0.0, 0))
                gain[self.features[f]] = (total + g, n + 1)
        trees = []
        for t in self.trees[:best]:
            inner = t.feature >= 0
            cut = np.zeros(len(t.cut))
            # A code past the last cut parts nulls from all values.
            cut[inner] = [
                cuts[f][int(c)] if c < len(cuts[f]) else np.inf
                for f, c in zip(t.feature[inner], t.cut[inner])
            ]
            trees.append(Tree(t.feature, cut, t.left, t.right, t.value))
        return Model(self.features, self.base, trees, gain, self.losses)


class _Data:
    """The blocks with their margins, in tasks' memory as far as it goes."""

    def __init__(self, table: Binned, models: int) -> None:
        self.table, self.frame, self.stored, self.models = table, table.blocks, 0, models
        self.cores = table.blocks.sparkSession.sparkContext.defaultParallelism
        self.fit = uuid.uuid4().hex
        self.bins = max(max((len(c) for c in table.cuts), default=0) + 1, 2) + 1
        self.rows = self._loaded()

    def _loaded(self) -> RDD:
        """The blocks; copies for the idle cores, each with a share of the models."""
        n = len(self.table.features)
        rows = self.frame.rdd.map(lambda r: _Block.of(r, n))
        if self.table.rows <= ROWS_ALONE:
            rows = rows.coalesce(1)
        self.parts = max(1, rows.getNumPartitions())
        share = 1 if self.parts == 1 else MODELS_PER_COPY
        self.copies = max(1, min(self.models // share, self.cores // self.parts))
        if self.copies > 1:
            rows = rows.context.union([rows] * self.copies)
        return rows.persist(StorageLevel.MEMORY_AND_DISK)

    def sums(self, asks: list[_Ask]) -> list[dict[int, tuple[float, ...]]]:
        """What the sums of each ask come to, by slot."""
        fit, bins, parts, copies = self.fit, self.bins, self.parts, self.copies

        def partial(part: int, blocks: Iterator[_Block]) -> Iterator[tuple]:
            return _partial(fit, blocks, [*enumerate(asks)][part // parts :: copies], bins)

        def picked(sums: Iterator[tuple]) -> Iterator[tuple]:
            found: dict[tuple[int, int], tuple] = {}
            for key, x in sums:
                found[key] = _added(key[1], found[key], x) if key in found else x
            for (k, i), x in found.items():
                yield k, i, _answer(asks[k], i, x)

        if parts == 1:
            answers = self.rows.mapPartitionsWithIndex(lambda part, blocks: picked(partial(part, blocks)))
        else:
            stride = max(a.slots for a in asks) + 1
            tasks = min(self.cores, -(-sum(a.slots + a.loss for a in asks) // KEYS_PER_TASK))
            sums = self.rows.mapPartitionsWithIndex(partial)
            met = sums.partitionBy(tasks, lambda key: key[0] * stride + key[1] + 1)
            answers = met.mapPartitions(picked)
        out: list[dict[int, tuple[float, ...]]] = [{} for _ in asks]
        for k, i, x in answers.collect():
            out[k][i] = x
        return out

    def store(self, runs: list[_Run], upto: int) -> None:
        """Write the margins after ``upto`` trees and go on from there."""
        asks, n, fit = [r.ask(self.stored) for r in runs], len(self.table.features), self.fit

        def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in b.to_pylist():
                    block = _Block.of(row, n)
                    row["margins"] = np.stack([_margin(fit, block, a) for a in asks]).tobytes()
                    yield pa.RecordBatch.from_pylist([row], b.schema)

        before, rows = self.frame, self.rows
        self.frame = written(before.mapInArrow(margins, before.schema), "margins")
        self.stored, self.rows = upto, self._loaded()
        rows.unpersist()
        if before is not self.table.blocks:
            emptied(before)

    def close(self) -> None:
        self.rows.unpersist()
        if self.frame is not self.table.blocks:
            emptied(self.frame)


def _bases(table: Binned, configs: Sequence[TreeParams]) -> list[float]:
    """What each model starts from: the mean, or the quantile, of the training targets."""
    alphas = sorted({c.alpha for c in configs if c.alpha})
    mean = table.train.agg(F.avg("target")).first()[0]
    found = table.train.approxQuantile("target", alphas, 1e-4) if alphas else []
    at = dict(zip(alphas, found or [0.0] * len(alphas)))
    return [float(at[c.alpha] if c.alpha else mean or 0.0) for c in configs]


def fit(table: Binned, configs: Sequence[TreeParams]) -> list[Model]:
    """One model per configuration, grown in step over the same passes."""
    runs = [_Run(i, c, b, table.features) for i, (c, b) in enumerate(zip(configs, _bases(table, configs)))]
    data = _Data(table, len(runs))
    try:
        for turn in range(max(c.rounds for c in configs) + 1):
            open_ = [r for r in runs if r.open]
            if turn and turn % STORED_ROUNDS == 0:
                data.store(runs, turn)
            growers = [_grower(r, turn, data.bins, table.cuts) for r in open_]
            _first_pass(data, open_, growers)
            keep = [k for k, r in enumerate(open_) if r.open]
            if not keep:
                break
            _grow(data, [open_[k] for k in keep], [growers[k] for k in keep])
    finally:
        data.close()
    return [r.model(table.cuts) for r in runs]


def _grower(r: _Run, turn: int, bins: int, cuts: list[np.ndarray]) -> _Grower:
    rng = np.random.default_rng([r.p.seed, turn])
    columns = np.zeros(len(cuts), dtype=bool)
    take = max(1, round(r.p.column_share * len(cuts)))
    columns[rng.permutation(len(cuts))[:take]] = True
    return _Grower(r.p, columns, bins)


def _asks(data: _Data, runs: list[_Run], growers: list[_Grower], loss: bool = False) -> list[_Ask]:
    out = []
    for r, g in zip(runs, growers):
        slot = np.full(len(g.nodes), -1)
        slot[g.asked] = np.arange(len(g.asked))
        more = {"growing": g.tree().small(), "slot": slot, "slots": len(g.asked), "columns": g.columns}
        out.append(r.ask(data.stored, loss=loss, **more))
    return out


def _first_pass(data: _Data, runs: list[_Run], growers: list[_Grower]) -> None:
    """Sums of the roots, with the loss of the rounds before."""
    for r, g, x in zip(runs, growers, data.sums(_asks(data, runs, growers, loss=True))):
        *loss, low, high = x.pop(-1)
        g.receive(x)
        r.judged(loss)
        r.span = (low, high)


def _grow(data: _Data, runs: list[_Run], growers: list[_Grower]) -> None:
    busy = [(r, g) for r, g in zip(runs, growers) if g.advance()]
    while busy:
        some, grow = map(list, zip(*busy))
        for g, x in zip(grow, data.sums(_asks(data, some, grow))):
            g.receive(x)
        busy = [(r, g) for r, g in busy if g.advance()]
    trees = [g.tree(final=True) for g in growers]
    quantile = [k for k, r in enumerate(runs) if r.p.alpha]
    if quantile:
        values = _leaf_quantiles(data, [runs[k] for k in quantile], [trees[k] for k in quantile])
        for k, v in zip(quantile, values):
            trees[k].value[:] = v
    for r, g, t in zip(runs, growers, trees):
        r.add(t, g.gains())


def _leaf_quantiles(data: _Data, runs: list[_Run], trees: list[Tree]) -> list[np.ndarray]:
    """The shrunk residual quantile of each leaf: the cell with the rank, then the cell inside it."""

    leaves = [np.flatnonzero(t.feature < 0) for t in trees]

    def count(more: list[dict]) -> list[np.ndarray]:
        """Per leaf the cell with the rank and the rank inside it; -1 for a leaf without rows."""
        asks = []
        for r, t, own, x in zip(runs, trees, leaves, more):
            slot = np.full(len(t.feature), -1)
            slot[own] = np.arange(len(own))
            asks.append(r.ask(data.stored, growing=t.small(), slot=slot, slots=len(own), span=r.span, **x))
        found = data.sums(asks)
        return [np.array([x.get(i, (-1, 0.0)) for i in range(len(own))]) for x, own in zip(found, leaves)]

    coarse = count([{} for _ in runs])
    fine = count([{"inside": c[:, 0].astype(int), "rank": c[:, 1]} for c in coarse])
    out = []
    for r, t, own, c, f in zip(runs, trees, leaves, coarse, fine):
        low, high = r.span
        width = (high - low) / CELLS or 1.0
        value = np.zeros(len(t.feature))
        inside = low + c[:, 0] * width + (f[:, 0] + 1) * (width / CELLS)
        value[own] = np.where(f[:, 0] >= 0, r.p.learning_rate * inside, 0.0)
        out.append(value)
    return out


# ---- use and storage -------------------------------------------------------------------


def predicted(models: dict[str, Model]) -> Column:
    """Struct with the prediction of each named model; all read the same features."""
    features = next(iter(models.values())).features

    @F.pandas_udf(", ".join(f"{name} double" for name in models))
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b.to_numpy(dtype=float).T
            yield pd.DataFrame({name: m.predict(x) for name, m in models.items()})

    return predict(F.struct(*[F.col(f).cast("double").alias(f) for f in features]))


NODES = (
    "model string, tree int, node int, feature string, cut double, left int, right int, value double, "
    "splits_gain double"
)


def to_nodes(spark: SparkSession, models: dict[str, Model]) -> DataFrame:
    """One row per node; row -1 of a model holds what it starts from."""
    rows = []
    for name, m in models.items():
        rows.append((name, -1, -1, None, None, None, None, float(m.base), None))
        for f, (g, n) in m.gain.items():
            rows.append((name, -2, n, f, None, None, None, None, float(g)))
        for k, t in enumerate(m.trees):
            for i in range(len(t.feature)):
                f = m.features[t.feature[i]] if t.feature[i] >= 0 else None
                rows.append(
                    (name, k, i, f, float(t.cut[i]), int(t.left[i]), int(t.right[i]), float(t.value[i]), None)
                )
    return spark.createDataFrame(rows, NODES)


def from_nodes(nodes: DataFrame, features: Sequence[str]) -> dict[str, Model]:
    """The models of a table of nodes (at most rounds x leaves rows each)."""
    place = {f: i for i, f in enumerate(features)}
    found: dict[str, Model] = {}
    for name, part in nodes.toPandas().groupby("model"):
        m = found[name] = Model(list(features), float(part.loc[part["tree"] == -1, "value"].iloc[0]))
        for r in part[part["tree"] == -2].itertuples():
            m.gain[r.feature] = (r.splits_gain, r.node)
        for _, t in part[part["tree"] >= 0].sort_values(["tree", "node"]).groupby("tree"):
            feature = np.array([place[f] if isinstance(f, str) else -1 for f in t["feature"]])
            ints = [t[c].to_numpy(dtype=np.int64) for c in ("left", "right")]
            m.trees.append(Tree(feature, t["cut"].to_numpy(float), *ints, t["value"].to_numpy(float)))
    return found
