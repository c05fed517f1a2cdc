"""Gradient boosting that grows its trees leaf by leaf.

Features are binned once to bytes. Rows with the same bytes always share a leaf, so they are one cell: its bytes and its numbers of rows of
either class. Where few values repeat, a cell is a row. A round needs the sums of gradients and of second derivatives per open leaf, feature and bin:
every task adds up its own rows, and the sums meet either on the driver, where they are small, or feature group by feature
group on the executors, where only the best split of each leaf leaves them. Of two children only the one with fewer
rows is counted; the other is the parent less that one.

A leaf's best split depends on its own rows alone. So one pass over the rows counts many leaves: those that the queue would
split next if nothing better came up. The queue is then run again over what is known, until it asks for nothing new. The
tree is exactly that of one split at a time, after about as many passes as it is deep. Children that cannot be split again are not counted:
their sums are those of the split.

Where the cells and the sums of a training fit one task (TASK_BYTES), trainings that run side by side are a task each and need no passes.

Gradients are whole multiples of 2^-28 and their sums whole numbers, hence the model does not depend on how the rows lie in
partitions or on the order in which tasks end.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import col
from ..ordering import SKETCH_COLUMNS
from ..session import pin

# Parameters of the booster that are not set otherwise.
DEFAULTS = {
    "n_estimators": 100, "num_leaves": 31, "max_depth": -1, "learning_rate": 0.1, "subsample": 1.0, "subsample_freq": 0,
    "colsample_bytree": 1.0, "min_child_samples": 20, "min_child_weight": 1e-3, "min_split_gain": 0.0, "reg_alpha": 0.0,
    "reg_lambda": 0.0, "max_bin": 255,
}
BLOCK_CELLS = 1 << 16
CELLS_A_TASK = 1 << 20
# Sums of one training that may meet on the driver, all partitions together; beyond it they meet on the executors. Some trainings run side
# by side.
DRIVER_BYTES = 8 << 20
# What a training may take in one task: its cells, three bytes a feature and CELL_BYTES for what is worked out for each, and its sums.
TASK_BYTES = 192 << 20
CELL_BYTES = 100
# Sums whose splits are sought at once: their intermediate results are several times as large.
SEARCH_BYTES = 4 << 20
# After so many trees the rows' margins are written to reliable storage, so that a lost executor repeats no more than these.
TREES_A_CHECKPOINT = 16
_SCALE = float(1 << 28)


def settings(params: dict | None) -> dict:
    """All parameters, those given over the defaults."""
    params = dict(params or {})
    params.pop("subsample_for_bin", None)  # bins are made from all rows
    unknown = sorted(set(params) - set(DEFAULTS))
    if unknown:
        raise ValueError(f"unknown booster parameters: {unknown}")
    return DEFAULTS | params


# ---- bins -----------------------------------------------------------------------------


def fit_bins(df: DataFrame, names: Sequence[str], max_bin: int = 255) -> list[np.ndarray]:
    """Upper ends of the bins of every column, from sketched quantiles of all rows: one aggregate per 32 columns."""
    if not 2 <= max_bin <= 255:
        raise ValueError("max_bin must be between 2 and 255")
    edges = []
    # One constant, not hundreds of literals per column.
    shares = F.lit(",".join(repr(i / max_bin) for i in range(1, max_bin)))
    shares = F.split(shares, ",").cast("array<double>")
    for lo in range(0, len(names), SKETCH_COLUMNS):
        chunk = names[lo:lo + SKETCH_COLUMNS]
        clean = [F.nanvl(col(n).cast("double"), F.lit(None).cast("double")) for n in chunk]
        row = df.agg(*[F.percentile_approx(c, shares, 10_000) for c in clean]).first()
        edges += [np.unique(np.array(row[i] if row[i] is not None else [], dtype=float)) for i in range(len(chunk))]
    return edges


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin 0 for a missing value, 1 up to the first end, and so on; one more beyond the last."""
    return np.where(np.isnan(x), 0, np.searchsorted(edges, x, side="left") + 1).astype(np.uint8)


def bin_count(edges: Sequence[np.ndarray]) -> int:
    """Bins of the widest column, those for missing values and beyond the last end included."""
    return max((len(e) + 2 for e in edges), default=2)


def draws_rows(p: dict) -> bool:
    """Do the trees learn from drawn rows?"""
    return p["subsample_freq"] > 0 and p["subsample"] < 1.0


def cell_rows(df: DataFrame, names: Sequence[str], edges: Sequence[np.ndarray], label: str, fold: str | None = None, ids: bool = False) -> DataFrame:
    """(x, fold, id, n0, n1): the distinct rows of bins in each fold with their numbers of rows of either class. Rows without a label are left
    out. With `ids` rows are also told apart by a pseudo-random number, for the draws of rows."""
    import pyarrow as pa

    edges, width = list(edges), len(names)

    def pack(batches):
        for batch in batches:
            x = np.stack([binned(_floats(batch.column(i)), e) for i, e in enumerate(edges)], axis=1)
            ends = pa.py_buffer(np.arange(0, x.size + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.Array.from_buffers(pa.binary(), len(x), [None, ends, pa.py_buffer(x.tobytes())]), *batch.columns[width:]], ["x", "y", "fold", "id"])

    rows = df.filter(col(label).isNotNull()).select(
        *[col(n).cast("double").alias(f"c{i}") for i, n in enumerate(names)], col(label).cast("int").alias("y"),
        (col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
        (F.xxhash64(*[col(c) for c in names], col(label)) if ids else F.lit(0).cast("long")).alias("id"))
    made = rows.mapInArrow(pack, "x binary, y int, fold int, id long")
    return made.groupBy("x", "fold", "id").agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n")).select(
        "x", "fold", "id", (F.col("n") - F.col("n1")).alias("n0"), "n1")


def block_rows(cells: DataFrame, width: int) -> DataFrame:
    """Cells in blocks: x (bins, feature by feature), fold, id and the counts n0 and n1 as packed numbers."""
    import pyarrow as pa

    def small(a: np.ndarray) -> np.ndarray:
        """The same numbers in as few bytes as they need."""
        kind = np.min_scalar_type(-1 - int(a.max())) if a.min() < 0 else np.min_scalar_type(int(a.max()))
        return a.astype(kind)

    def pack(batches):
        held, n = [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            x = np.frombuffer(b"".join(table["x"].to_pylist()), np.uint8).reshape(-1, width)
            rest = [table[c].to_numpy() for c in ("fold", "id", "n0", "n1")]
            ids = rest[1].astype(np.int64) if rest[1].any() else np.zeros(0, np.int64)
            parts = [x.T.tobytes(), *(a.dtype.char.encode() + a.tobytes() for a in (rest[0].astype(np.int32), ids, small(rest[2]), small(rest[3])))]
            return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), *[pa.array([v], pa.binary()) for v in parts]],
                                              ["rows", "x", "fold", "id", "n0", "n1"])

        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, BLOCK_CELLS - n), batch.slice(BLOCK_CELLS - n)
                held.append(part)
                n += part.num_rows
                if n == BLOCK_CELLS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return cells.mapInArrow(pack, "rows long, x binary, fold binary, id binary, n0 binary, n1 binary")


def _floats(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(float)


# ---- trees ----------------------------------------------------------------------------


@dataclass
class Node:
    """A node by its number in a full binary tree (root 1, children 2i and 2i + 1), with its rows' sums and its best split."""

    number: int
    g: int
    h: int
    n: int
    split: tuple | None = None  # (gain, feature, bin, g, h, n of the left child)

    @property
    def depth(self) -> int:
        return self.number.bit_length() - 1


@dataclass
class Tree:
    """Nodes as arrays; feature -1 marks a leaf. A row goes left where its bin is at most `bin`."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def parts(self, x: np.ndarray, wanted: Callable[[int], bool] | None = None):
        """(leaf, its rows of bins) for the leaves that are wanted and have rows, each row once."""
        columns = np.asfortranarray(x)
        waiting = [(0, np.arange(len(x)))] if len(x) else []
        while waiting:
            node, rows = waiting.pop()
            if self.feature[node] < 0:
                if wanted is None or wanted(node):
                    yield node, rows
                continue
            goes_left = columns[:, self.feature[node]].take(rows) <= self.bin[node]
            for child, own in ((self.left[node], rows[goes_left]), (self.right[node], rows[~goes_left])):
                if len(own):
                    waiting.append((int(child), own))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Index of the leaf of every row of bins."""
        at = np.zeros(len(x), dtype=np.int32)
        if len(x) < 32 * len(self.feature):
            # Few rows a node: all of them step down together.
            open_rows = np.arange(len(x)) if self.feature[0] >= 0 else np.zeros(0, dtype=np.int64)
            while len(open_rows):
                node = at[open_rows]
                node = np.where(x[open_rows, self.feature[node]] <= self.bin[node], self.left[node], self.right[node])
                at[open_rows] = node
                open_rows = open_rows[self.feature[node] >= 0]
            return at
        for leaf, rows in self.parts(x):
            at[rows] = leaf
        return at


def _shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0) if alpha else g


def _quality(g, h, p: dict):
    """What a leaf gains: shrunk gradient squared over the (regularised) second derivative."""
    return _shrunk(g, p["reg_alpha"]) ** 2 / np.maximum(h + p["reg_lambda"], 1e-300)


def best_splits(sums: np.ndarray, features: np.ndarray, p: dict) -> list[tuple | None]:
    """Best split of every node from sums[node, feature, bin, (g, h, n)], all whole numbers. Equal gains go to the first feature
    and the lowest bin."""
    at_once = max(1, SEARCH_BYTES // max(1, sums[:1].nbytes))
    if len(sums) > at_once:
        return [s for lo in range(0, len(sums), at_once) for s in best_splits(sums[lo:lo + at_once], features, p)]
    left = [np.cumsum(sums[..., j], axis=2) for j in range(3)]
    total = [c[:, 0, -1] for c in left]
    need, size = max(1, p["min_child_samples"]), sums.shape[1] * sums.shape[2]
    # A bin without rows parts the node as the bin before it does.
    fits = (sums[..., 2] > 0) & (left[2] >= need) & (left[2] <= (total[2] - need)[:, None, None])
    at = np.flatnonzero(fits)
    node = at // size
    g, h = (left[j].ravel()[at] for j in range(2))
    gl, hl, gr, hr = g / _SCALE, h / _SCALE, (total[0][node] - g) / _SCALE, (total[1][node] - h) / _SCALE
    whole = _quality(total[0] / _SCALE, total[1] / _SCALE, p)
    gain = _quality(gl, hl, p) + _quality(gr, hr, p) - whole[node]
    good = np.flatnonzero((np.minimum(hl, hr) >= p["min_child_weight"]) & (gain > max(p["min_split_gain"], 1e-12)))
    at, gain, out = at[good], gain[good], []
    ends = np.searchsorted(node[good], np.arange(len(sums) + 1)).tolist()
    for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
        if lo == hi:
            out.append(None)
        else:
            best = lo + int(gain[lo:hi].argmax())
            f, b = divmod(int(at[best]) - i * size, sums.shape[2])
            out.append((float(gain[best]), int(features[f]), b, *(int(c[i, f, b]) for c in left)))
    return out


def grow(evaluate: Callable, p: dict) -> list[Node]:
    """Grow one tree and return its nodes.

    evaluate(splits) counts the children of the given nodes and returns {number: Node} with their best splits; with no
    splits it counts the root.
    """
    known: dict[int, Node] = evaluate([])
    while True:
        queue, kept, asked, leaves = [], [known[1]], [], 1
        heapq.heapify(queue)

        def offer(node: Node) -> None:
            if node.split and (p["max_depth"] <= 0 or node.depth < p["max_depth"]):
                heapq.heappush(queue, (-node.split[0], node.number))

        offer(known[1])
        while queue and leaves < p["num_leaves"]:
            number = heapq.heappop(queue)[1]
            leaves += 1
            if 2 * number not in known:
                known |= _last_children(known[number], p)
            if 2 * number in known:
                for child in (known[2 * number], known[2 * number + 1]):
                    kept.append(child)
                    offer(child)
            else:
                asked.append(known[number])
        if not asked:
            return kept
        known |= evaluate(asked)


def _last_children(node: Node, p: dict) -> dict[int, Node]:
    """Both children of a split node if neither can be split again; else nothing."""
    sums = (node.split[3:], (node.g - node.split[3], node.h - node.split[4], node.n - node.split[5]))
    if node.depth + 1 != p["max_depth"] and max(n for _, _, n in sums) >= 2 * max(1, p["min_child_samples"]):
        return {}
    return {c: Node(c, *s) for c, s in zip((2 * node.number, 2 * node.number + 1), sums)}


def as_tree(nodes: Sequence[Node], p: dict) -> Tree:
    """Arrays of a set of nodes that holds both children of every node that it splits."""
    order = sorted(nodes, key=lambda n: n.number)
    at = {n.number: i for i, n in enumerate(order)}
    size = len(order)
    tree = Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32),
                np.zeros(size), np.zeros(size), np.zeros(size, np.int64))
    g, h = (np.array([getattr(n, c) for n in order], dtype=np.int64) / _SCALE for c in "gh")
    tree.value[:] = -p["learning_rate"] * _shrunk(g, p["reg_alpha"]) / np.maximum(h + p["reg_lambda"], 1e-300)
    for i, n in enumerate(order):
        tree.rows[i] = n.n
        if 2 * n.number in at:
            tree.gain[i], tree.feature[i], tree.bin[i] = n.split[:3]
            tree.left[i], tree.right[i] = at[2 * n.number], at[2 * n.number + 1]
    return tree


def gradients(y: np.ndarray, margin: np.ndarray, weight: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the logistic loss, as whole multiples of 2^-28."""
    share = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((share - y) * _SCALE) * weight, np.rint(share * (1.0 - share) * _SCALE) * weight


def first_margin(positives: float, rows: float) -> float:
    """Log odds of the label among the training rows, as far as there are both classes."""
    share = min(max(positives / rows, 1e-15), 1 - 1e-15) if rows else 0.5
    return float(np.log(share / (1.0 - share)))


def drawn_features(width: int, p: dict, seed: int, number: int) -> np.ndarray:
    """Columns that the tree of this number may split by."""
    take = max(1, round(p["colsample_bytree"] * width))
    return np.sort(np.random.default_rng([seed, number, 1]).choice(width, take, replace=False))


def most_leaves(p: dict, rows: int) -> int:
    """No tree of so many rows has more leaves."""
    leaves = min(p["num_leaves"], 1 + rows // max(1, p["min_child_samples"]))
    return min(leaves, 1 << p["max_depth"]) if 0 < p["max_depth"] < 20 else leaves


# ---- passes over the rows --------------------------------------------------------------


@dataclass
class Block:
    """Some cells of a partition with their margins: x[cell, feature] lies feature by feature, n0 and n1 are the rows of either class."""

    x: np.ndarray
    fold: np.ndarray
    id: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    margin: np.ndarray

    def of(self, rule: Callable | None) -> Block:
        """The cells whose fold the rule accepts."""
        if rule is None:
            return self
        at = np.flatnonzero(rule(self.fold))
        return Block(np.asfortranarray(self.x[at]), self.fold[at], self.id[at] if len(self.id) else self.id, self.n0[at], self.n1[at], self.margin[at[:len(self.margin)]])

    def drawn(self, p: dict, seed: int, number: int) -> np.ndarray | None:
        """Which cells the tree of this number learns from; None: all."""
        if not draws_rows(p):
            return None
        if len(self.id) < len(self.fold):
            raise ValueError("rows are drawn by their ids, which these blocks lack")
        salt = (0x9E3779B97F4A7C15 * (1 + seed + (1 << 20) * (number // p["subsample_freq"]))) % (1 << 64)
        mixed = (self.id.view(np.uint64) ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return (mixed * np.uint64(0xD6E8FEB86659FD93)) < np.uint64(p["subsample"] * 2.0**64)

    def sums(self, rows: np.ndarray) -> list[np.ndarray]:
        """Sums of the first and second derivatives of some cells' rows, and their numbers of rows; whole numbers."""
        share = 1.0 / (1.0 + np.exp(-self.margin[rows]))
        n0, n1 = self.n0[rows].astype(np.int64), self.n1[rows].astype(np.int64)
        g = np.rint(share * _SCALE).astype(np.int64) * n0 + np.rint((share - 1.0) * _SCALE).astype(np.int64) * n1
        return [g, np.rint(share * (1.0 - share) * _SCALE).astype(np.int64) * (n0 + n1), n0 + n1]


def _exact(values: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Whole numbers as doubles whose sums are exact, each with its power of two: one column, or a high and a low part."""
    if float(np.abs(values).sum(dtype=float)) < 2.0**52:
        return [(values.astype(float), 0)]
    return [((values >> 26).astype(float), 26), ((values & ((1 << 26) - 1)).astype(float), 0)]


def add_sums(total: np.ndarray, block: Block, places: Sequence[tuple[int, np.ndarray]], features: np.ndarray, bins: int) -> None:
    """Add to total[(g, h, n), feature, node * bins + bin] the sums of the cells (place of the node, cells)."""
    rows = np.concatenate([r for _, r in places]) if len(places) > 1 else places[0][1]
    base = np.repeat(np.array([i * bins for i, _ in places], dtype=np.int64), [len(r) for _, r in places])
    columns = [_exact(v) for v in block.sums(rows)]
    for i, f in enumerate(features):
        at = base + block.x[:, f].take(rows)
        for j, parts in enumerate(columns):
            for values, power in parts:
                total[j, i] += np.bincount(at, weights=values, minlength=total.shape[2]).astype(np.int64) << power


def node_sums(x: np.ndarray, place: np.ndarray, nodes: int, features: np.ndarray, bins: int, g: np.ndarray, h: np.ndarray,
              weight: np.ndarray) -> np.ndarray:
    """sums[node, feature, bin, (g, h, n)] of the rows whose place is a node (-1: none)."""
    out = np.empty((nodes, len(features), bins, 3), dtype=np.int64)
    rows = np.flatnonzero((place >= 0) & (weight > 0))
    base, columns = place[rows].astype(np.int64) * bins, (g[rows], h[rows], weight[rows])
    for i, f in enumerate(features):
        at = base + x[rows, f]
        for j, values in enumerate(columns):
            out[:, i, :, j] = np.rint(np.bincount(at, weights=values, minlength=nodes * bins)).reshape(nodes, bins)
    return out


class LocalRows:
    """Passes over weighted rows that are arrays at hand, such as the counted bins of one feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, bins: int, p: dict):
        self.x, self.y, self.weight, self.bins, self.p = x, y, weight, bins, p
        self.margin = np.full(len(y), first_margin(float((y * weight).sum()), float(weight.sum())))

    def tree(self, features: np.ndarray) -> Tree:
        g, h = gradients(self.y, self.margin, self.weight)
        numbers, known = np.ones(len(self.y), dtype=object), {}

        def evaluate(splits):
            for s in splits:
                mine = numbers == s.number
                numbers[mine] = np.where(self.x[mine, s.split[1]] <= s.split[2], 2 * s.number, 2 * s.number + 1)
            fresh = [1] if not splits else [c for s in splits for c in (2 * s.number, 2 * s.number + 1)]
            place = np.full(len(self.y), -1, dtype=np.int64)
            for i, c in enumerate(fresh):
                place[numbers == c] = i
            sums = node_sums(self.x, place, len(fresh), features, self.bins, g, h, self.weight)
            return _nodes(fresh, sums[:, 0].sum(axis=1), best_splits(sums, features, self.p))

        tree = as_tree(grow(evaluate, self.p), self.p)
        self.margin = self.margin + tree.value[tree.leaves(self.x)]
        return tree


def local_margins(x: np.ndarray, y: np.ndarray, weight: np.ndarray, bins: int, p: dict, seed: int = 0) -> Callable:
    """Fit a booster on weighted rows of bins that are at hand; returns a function from rows of bins to their margins."""
    rows = LocalRows(x, y, weight, bins, p)
    first = float(rows.margin[0]) if len(y) else 0.0
    trees = [rows.tree(drawn_features(x.shape[1], p, seed, i)) for i in range(int(p["n_estimators"]))] if len(y) else []
    return lambda asked: sum((t.value[t.leaves(asked)] for t in trees), np.full(len(asked), first))


@dataclass
class Cells:
    """All cells of a table: x[row, feature], feature by feature, has every row of bins once unless ids tell them apart; `at` is a cell's row."""

    x: np.ndarray
    at: np.ndarray
    fold: np.ndarray
    id: np.ndarray
    n0: np.ndarray
    n1: np.ndarray

    @staticmethod
    def joined(blocks: Sequence[Block], width: int) -> Cells:
        x = np.concatenate([b.x for b in blocks]) if blocks else np.zeros((0, width), np.uint8)
        fold, ids, n0, n1 = (np.concatenate([getattr(b, c) for b in blocks]) if blocks else np.zeros(0, np.int64) for c in ("fold", "id", "n0", "n1"))
        at = np.arange(len(x), dtype=np.int32)
        if len(x) and not len(ids):
            _, first, at = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1]))).ravel(), return_index=True, return_inverse=True)
            x, at = x[first], at.astype(np.int32)
        return Cells(np.asfortranarray(x), at, fold, ids, n0, n1)

    def of(self, rule: Callable) -> Block:
        """The cells whose fold the rule accepts."""
        own = np.flatnonzero(rule(self.fold))
        return Block(np.asfortranarray(self.x[self.at[own]]), self.fold[own], self.id[own] if len(self.id) else self.id, self.n0[own], self.n1[own], np.zeros(0))

    def counted(self, rule: Callable) -> Block:
        """All rows of bins with their numbers of rows of either class in the folds that the rule accepts."""
        own = rule(self.fold)
        n0, n1 = (np.bincount(self.at[own], weights=n[own], minlength=len(self.x)).astype(np.int64) for n in (self.n0, self.n1))
        return Block(self.x, np.zeros(len(self.x), np.int32), self.id, n0, n1, np.zeros(len(self.x)))


class TaskRows:
    """One training over cells that are at hand. Every open node keeps its cells, so that only those are read that are counted."""

    def __init__(self, block: Block, bins: int, p: dict, seed: int):
        self.block, self.bins, self.p, self.seed, self.number = block, bins, p, seed, 0
        n = block.n0 + block.n1
        self.rows, self.single = np.flatnonzero(n), bool((n <= 1).all())
        self.first = first_margin(int(block.n1.sum()), int(n.sum()))
        block.margin[:] = self.first

    def tree(self, features: np.ndarray) -> Tree:
        b, p, bins = self.block, self.p, self.bins
        drawn = b.drawn(p, self.seed, self.number)
        columns = [_exact(v) for v in b.sums(slice(None))]
        cells, held = {1: self.rows}, {}

        def part(s: Node) -> None:
            rows = cells.pop(s.number)
            goes_left = b.x[:, s.split[1]].take(rows) <= s.split[2]
            cells[2 * s.number], cells[2 * s.number + 1] = rows[goes_left], rows[~goes_left]

        def sums(counted: Sequence[int]) -> np.ndarray:
            """[node, (g, h, n), feature, bin]"""
            each = [cells[c] if drawn is None else cells[c][drawn[cells[c]]] for c in counted]
            rows, size = np.concatenate(each), len(counted) * bins
            base = np.repeat(np.arange(0, size, bins), [len(r) for r in each])
            taken = [[(v.take(rows), power) for v, power in parts] for parts in columns]
            out = np.empty((len(counted), 3, len(features), bins), dtype=np.int64)
            for i, f in enumerate(features):
                at = base + b.x[:, f].take(rows)
                for j, parts in enumerate(taken):
                    if j == 2 and self.single:
                        found = np.bincount(at, minlength=size)
                    else:
                        found = sum(np.bincount(at, weights=v, minlength=size).astype(np.int64) << power for v, power in parts)
                    out[:, j, i] = found.reshape(len(counted), bins)
            return out

        def evaluate(splits):
            if not splits:
                fresh = {1: sums([1])[0]}
            else:
                fresh, counted = {}, [2 * s.number + (0 if 2 * s.split[5] <= s.n else 1) for s in splits]
                for s in splits:
                    part(s)
                for s, c, small in zip(splits, counted, sums(counted)):
                    large = held.pop(s.number)
                    large -= small
                    fresh[c], fresh[c ^ 1] = small, large
            found, some = {}, max(1, SEARCH_BYTES // max(1, 24 * bins * len(features)))
            numbers = list(fresh)
            for lo in range(0, len(numbers), some):
                few = numbers[lo:lo + some]
                stacked = np.moveaxis(np.stack([fresh[c] for c in few]), 1, 3)
                found |= _nodes(few, stacked[:, 0].sum(axis=1), best_splits(stacked, features, p))
            # A node that cannot be split needs no sums.
            held.update((c, fresh[c].copy() if fresh[c].base is not None else fresh[c]) for c in numbers if found[c].split)
            return found

        nodes = grow(evaluate, p)
        tree, split = as_tree(nodes, p), {n.number >> 1 for n in nodes}
        for n in sorted(nodes, key=lambda n: n.number):
            if n.number in split and n.number in cells:
                part(n)
        for number, value in zip(sorted(n.number for n in nodes), tree.value.tolist()):
            if number not in split:
                waiting = [number]
                while waiting:
                    c = waiting.pop()
                    if c in cells:
                        b.margin[cells[c]] += value
                    else:
                        waiting += [2 * c, 2 * c + 1]
        self.number += 1
        return tree


def _nodes(numbers: Sequence[int], totals: np.ndarray, splits: Sequence[tuple | None]) -> dict[int, Node]:
    return {c: Node(c, *(int(v) for v in t), split=s) for c, t, s in zip(numbers, totals, splits)}


class SparkRows:
    """Passes over the blocks of a table."""

    def __init__(self, blocks: RDD, bins: int, p: dict, seed: int, learns: Callable | None):
        self.bins, self.p, self.seed, self.stale = bins, p, seed, None

        def count(b):
            own = b.of(learns)
            return int(own.n1.sum(dtype=np.int64)), int(own.n0.sum(dtype=np.int64)) + int(own.n1.sum(dtype=np.int64))

        positives, self.rows = blocks.map(count).fold((0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]))
        self.first = start = first_margin(positives, self.rows)
        self.context = blocks.context

        def opened(b):
            own = b.of(learns)
            return Block(own.x, own.fold, own.id, own.n0, own.n1, np.full(len(own.fold), start))

        self.state = blocks.map(opened).filter(lambda b: len(b.fold)).persist(StorageLevel.MEMORY_AND_DISK)
        self.partitions = self.state.getNumPartitions()
        self.number = 0

    def tree(self, features: np.ndarray) -> Tree:
        p, bins, number, seed, state = self.p, self.bins, self.number, self.seed, self.state
        leaves = most_leaves(p, self.rows)
        meets = _DriverSums(p, features) if self.partitions * leaves * len(features) * bins * 24 <= DRIVER_BYTES else _ExecutorSums(
            p, features, max(1, min(len(features), self.context.defaultParallelism)))
        seen: dict[int, Node] = {}

        def evaluate(splits):
            if not splits:
                counted, partial = [1], None
            else:
                # Of two children the one with fewer rows is counted.
                counted = [2 * s.number + (0 if 2 * s.split[5] <= s.n else 1) for s in splits]
                partial = as_tree(_ancestry(seen, splits), p)
            spots = _spots(partial, seen, splits, counted)

            def sums(part):
                total = None
                for b in part:
                    places = [(0, np.arange(len(b.fold)))] if partial is None else [
                        (int(spots[leaf]), rows) for leaf, rows in partial.parts(b.x, lambda leaf: spots[leaf] >= 0)]
                    drawn = b.drawn(p, seed, number)
                    if drawn is not None:
                        places = [(i, rows[drawn[rows]]) for i, rows in places]
                    total = np.zeros((3, len(features), len(counted) * bins), dtype=np.int64) if total is None else total
                    if places:
                        add_sums(total, b, places, features, bins)
                if total is not None:
                    yield np.ascontiguousarray(total.reshape(3, len(features), len(counted), bins).transpose(2, 1, 3, 0))

            found = meets.splits(state.mapPartitions(sums), splits, counted) or {1: Node(1, 0, 0, 0)}
            seen.update(found)
            self._forget_stale()
            return found

        tree = as_tree(grow(evaluate, p), p)
        meets.close()
        self.number += 1
        after = state.map(lambda b: Block(b.x, b.fold, b.id, b.n0, b.n1, b.margin + tree.value[tree.leaves(b.x)]))
        after.persist(StorageLevel.MEMORY_AND_DISK)
        if self.number % TREES_A_CHECKPOINT == 0:
            after.checkpoint()
        # The next pass computes the new margins from the old ones, which can go after it.
        self.state, self.stale = after, state
        return tree

    def _forget_stale(self) -> None:
        if self.stale is not None:
            self.stale.unpersist()
            self.stale = None

    def close(self) -> None:
        self._forget_stale()
        self.state.unpersist()


def _ancestry(seen: dict[int, Node], splits: Sequence[Node]) -> list[Node]:
    """The nodes on the ways to the children of the nodes to split, both children of each."""
    numbers = {1}
    for s in splits:
        up = s.number
        while up:
            numbers |= {2 * up, 2 * up + 1}
            up >>= 1
    return [seen.get(n) or Node(n, 0, 0, 0) for n in numbers]


def _spots(partial: Tree | None, seen: dict[int, Node], splits: Sequence[Node], counted: Sequence[int]) -> np.ndarray | None:
    """Index among the counted nodes of every leaf of the partial tree; -1 for the others."""
    if partial is None:
        return None
    order = sorted({n.number for n in _ancestry(seen, splits)})
    place = {c: i for i, c in enumerate(counted)}
    return np.array([place.get(n, -1) for n in order], dtype=np.int64)


def _children(parent: np.ndarray, small: np.ndarray, left_counted: bool) -> tuple[np.ndarray, np.ndarray]:
    return (small, parent - small) if left_counted else (parent - small, small)


class _DriverSums:
    """Sums that meet on the driver: partitions x leaves x features x bins of them are within DRIVER_BYTES."""

    def __init__(self, p: dict, features: np.ndarray):
        self.p, self.features, self.held = p, features, {}

    def splits(self, partial: RDD, splits, counted) -> dict[int, Node]:
        parts = partial.collect()
        if not parts:
            return {}
        sums = parts[0]
        for part in parts[1:]:
            sums += part
        del parts
        if not splits:
            fresh = {1: sums[0]}
        else:
            fresh = {}
            for s, c, small in zip(splits, counted, sums):
                fresh[2 * s.number], fresh[2 * s.number + 1] = _children(self.held.pop(s.number), small, c % 2 == 0)
        self.held |= fresh
        stacked = np.stack(list(fresh.values()))
        return _nodes(list(fresh), stacked[:, 0].sum(axis=1), best_splits(stacked, self.features, self.p))

    def close(self) -> None:
        self.held = {}


class _ExecutorSums:
    """Sums that meet per group of features. The open leaves' sums stay on the executors; the best split of each group leaves."""

    def __init__(self, p: dict, features: np.ndarray, groups: int):
        self.p, self.features, self.groups, self.held = p, features, np.array_split(np.arange(len(features)), groups), None

    def splits(self, partial: RDD, splits, counted) -> dict[int, Node]:
        p, features, groups = self.p, self.features, self.groups
        plan = [(s.number, c % 2 == 0) for s, c in zip(splits, counted)]
        met = partial.flatMap(lambda t: [(i, t[:, g]) for i, g in enumerate(groups)]).reduceByKey(lambda a, b: a + b, len(groups))

        def open_leaves(pair):
            old, small = pair
            if not plan:
                return {1: small[0]}, [1]
            held, fresh = dict(old), []
            for (number, left_counted), one in zip(plan, small):
                held[2 * number], held[2 * number + 1] = _children(held.pop(number), one, left_counted)
                fresh += [2 * number, 2 * number + 1]
            return held, fresh

        before = self.held.mapValues(lambda v: v[0]) if self.held is not None else None
        joined = met.mapValues(lambda v: (None, v)) if before is None else before.join(met, len(groups))
        held = joined.mapValues(open_leaves).persist(StorageLevel.MEMORY_AND_DISK)

        def best(item):
            i, (leaves, fresh) = item
            stacked = np.stack([leaves[c] for c in fresh])
            return [(c, [int(v) for v in t], s) for c, t, s in zip(
                fresh, stacked[:, 0].sum(axis=1), best_splits(stacked, features[groups[i]], p))]

        out: dict[int, Node] = {}
        for c, total, split in sorted(held.flatMap(best).collect(), key=lambda r: (r[0], r[2][1] if r[2] else 1 << 30)):
            node = out.setdefault(c, Node(c, *total))
            if split and (node.split is None or split[0] > node.split[0]):
                node.split = split
        # The new sums are counted and kept; those before them are no longer read.
        self.close()
        self.held = held
        return out

    def close(self) -> None:
        if self.held is not None:
            self.held.unpersist()


# ---- models ---------------------------------------------------------------------------


@dataclass
class LeafwiseModel:
    """A fitted booster."""

    names: list[str]
    edges: list[np.ndarray]
    first: float
    trees: list[Tree] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.first)
        for tree in self.trees:
            out += tree.value[tree.leaves(x)]
        return out

    def gains(self) -> dict[str, float]:
        """Sum of the gains of all splits by each feature."""
        total = np.zeros(len(self.names))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return dict(zip(self.names, total.tolist()))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, left_node, right_node, value, gain, n_rows); feature is NULL in a leaf. A row goes left where
        the feature is at most the threshold or missing; a NULL threshold sends only the missing left."""
        import pandas as pd
        import pyarrow as pa

        parts = []
        for i, t in enumerate(self.trees):
            inner = t.feature >= 0
            ends = [self.edges[f][b - 1] if 0 < b <= len(self.edges[f]) else None for f, b in zip(t.feature[inner], t.bin[inner])]
            part = pd.DataFrame({"tree": i, "node": np.arange(len(inner)), "at": t.feature, "bin": t.bin, "left_node": t.left,
                                 "right_node": t.right, "value": t.value, "gain": t.gain, "n_rows": t.rows})
            part["feature"] = [self.names[f] if f >= 0 else None for f in t.feature]
            part["threshold"] = pd.Series(ends, index=part.index[inner], dtype=float)
            parts.append(part)
        kinds = {"tree": "int", "node": "int", "at": "int", "bin": "int", "feature": "string", "threshold": "double", "left_node": "int",
                 "right_node": "int", "value": "double", "gain": "double", "n_rows": "long"}
        schema = ", ".join(f"{n} {k}" for n, k in kinds.items())
        if not parts:
            return spark.createDataFrame([], schema)
        rows = pd.concat(parts)[list(kinds)]
        return spark.createDataFrame(pa.Table.from_pandas(rows, preserve_index=False), schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the node table and the bins below path."""
        head = json.dumps({"names": self.names, "edges": [e.tolist() for e in self.edges], "first": self.first, "trees": len(self.trees)})
        self.nodes(spark).write.mode("overwrite").parquet(f"{path.rstrip('/')}/nodes")
        spark.createDataFrame([(head,)], "head string").write.mode("overwrite").parquet(f"{path.rstrip('/')}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LeafwiseModel:
        head = json.loads(spark.read.parquet(f"{path.rstrip('/')}/head").first()["head"])
        rows = spark.read.parquet(f"{path.rstrip('/')}/nodes").toPandas().sort_values(["tree", "node"])
        kinds = {"at": np.int32, "bin": np.int32, "left_node": np.int32, "right_node": np.int32, "value": float, "gain": float, "n_rows": np.int64}
        trees = [Tree(*(part[n].to_numpy(k) for n, k in kinds.items())) for _, part in rows.groupby("tree")]
        return LeafwiseModel(head["names"], [np.array(e, dtype=float) for e in head["edges"]], head["first"], trees)


def packed_blocks(df: DataFrame, names: Sequence[str], edges: Sequence[np.ndarray], label: str, fold: str | None = None, ids: bool = False) -> RDD:
    """The blocks of a table, pinned: every pass and every repeated task sees the same ones. `ids`: also for trees that draw rows."""
    width = len(names)

    def numbers(packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, chr(packed[0]), offset=1) if len(packed) > 1 else np.zeros(0, chr(packed[0]))

    def unpack(row):
        x = np.frombuffer(row["x"], np.uint8).reshape(width, row["rows"]).T
        return Block(x, *[numbers(row[c]) for c in ("fold", "id", "n0", "n1")], np.zeros(0))

    blocks = pin(block_rows(cell_rows(df, names, edges, label, fold, ids), width))
    n, cells = blocks.agg(F.count(F.lit(1)), F.sum("rows")).first()
    # A task that has few cells costs more than it does.
    context = df.sparkSession.sparkContext
    tasks = max(1, min(n, -(-(cells or 0) // BLOCK_CELLS), max(2 * context.defaultParallelism, -(-(cells or 0) // CELLS_A_TASK))))
    dealt = blocks.rdd.zipWithIndex().map(lambda r: (r[1], r[0])).partitionBy(tasks, lambda i: i)
    return dealt.values().map(unpack)


def fit_blocks(blocks: RDD, names: Sequence[str], edges: Sequence[np.ndarray], params: dict | None = None, seed: int = 0,
               learns: Callable[[np.ndarray], np.ndarray] | None = None) -> LeafwiseModel:
    """A booster that learns from the rows whose folds the rule accepts."""
    p = settings(params)
    model = LeafwiseModel(list(names), list(edges), 0.0)
    rows = SparkRows(blocks, bin_count(edges), p, seed, learns)
    try:
        model.first = rows.first
        for number in range(int(p["n_estimators"])):
            model.trees.append(rows.tree(drawn_features(len(names), p, seed, number)))
        return model
    finally:
        rows.close()


class Trainings:
    """Boosters that learn from the same blocks, side by side: a task each where the cells and a training's sums fit one, else in passes over
    the blocks, some at a time."""

    def __init__(self, blocks: RDD, names: Sequence[str], edges: Sequence[np.ndarray], seed: int = 0, parallelism: int = 3):
        self.blocks, self.names, self.edges, self.seed, self.parallelism = blocks, list(names), list(edges), seed, parallelism
        self.shared, self.rows = None, 0
        cells, self.rows = blocks.map(lambda b: (len(b.fold), int(b.n0.sum(dtype=np.int64)) + int(b.n1.sum(dtype=np.int64)))).fold(
            (0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]))
        self.cell_bytes = cells * (3 * len(self.names) + CELL_BYTES)
        if self.cell_bytes <= TASK_BYTES:
            self.shared = blocks.context.broadcast(Cells.joined(blocks.collect(), len(self.names)))

    def _fits_a_task(self, p: dict) -> bool:
        width = max(1, round(p["colsample_bytree"] * len(self.names)))
        # Sums of the open nodes and of those that are counted.
        return self.shared is not None and self.cell_bytes + 2 * most_leaves(p, self.rows) * width * bin_count(self.edges) * 24 <= TASK_BYTES

    def run(self, asked: Sequence[tuple[dict | None, Callable, Callable]], then: Callable | None = None) -> list:
        """The models of trainings (parameters, rule of the folds to learn from, rule of those to test). With `then(model, block)`, a tuple of
        numbers for the test cells of a block, their sums over all blocks instead."""
        plans = [(settings(params), learns, tests) for params, learns, tests in asked]
        small = [i for i, (p, _, _) in enumerate(plans) if self._fits_a_task(p)]
        out = dict(zip(small, self._in_tasks([plans[i] for i in small], then)))
        large = [i for i in range(len(plans)) if i not in out]
        with ThreadPoolExecutor(self.parallelism) as pool:
            out |= zip(large, pool.map(lambda i: self._in_passes(*plans[i], then), large))
        return [out[i] for i in range(len(plans))]

    def _in_tasks(self, plans: list, then: Callable | None) -> list:
        if not plans:
            return []
        names, edges, seed, shared = self.names, self.edges, self.seed, self.shared

        def train(plan):
            p, learns, tests = plan
            rows = TaskRows(shared.value.counted(learns), bin_count(edges), p, seed)
            model = LeafwiseModel(names, edges, rows.first)
            for number in range(int(p["n_estimators"])):
                model.trees.append(rows.tree(drawn_features(len(names), p, seed, number)))
            return then(model, shared.value.of(tests)) if then else model

        return self.blocks.context.parallelize(plans, len(plans)).map(train).collect()

    def _in_passes(self, p: dict, learns: Callable, tests: Callable, then: Callable | None):
        model = fit_blocks(self.blocks, self.names, self.edges, p, self.seed, learns)
        if not then:
            return model
        return self.blocks.map(lambda b: then(model, b.of(tests))).reduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))

    def close(self) -> None:
        if self.shared is not None:
            self.shared.destroy()


def fit_leafwise(df: DataFrame, names: Sequence[str], label: str, params: dict | None = None, seed: int = 0,
                 edges: Sequence[np.ndarray] | None = None) -> LeafwiseModel:
    """Booster for a 0/1 label. Missing values are allowed in the features and lie below all others; rows without a label are
    left out. Without rows every score is one half."""
    p = settings(params)
    edges = fit_bins(df, names, p["max_bin"]) if edges is None else edges
    blocks = packed_blocks(df, names, edges, label, ids=draws_rows(p)).persist()
    try:
        return fit_blocks(blocks, names, edges, params, seed)
    finally:
        blocks.unpersist()


def score_leafwise(model: LeafwiseModel, df: DataFrame, *keep: str) -> DataFrame:
    """Probability of class 1 next to the columns to keep."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = df.sparkSession.sparkContext.broadcast(model)
    width = len(model.names)
    rows = df.select(*[col(n).cast("double").alias(f"c{i}") for i, n in enumerate(model.names)], *[col(k).alias(f"k{i}") for i, k in enumerate(keep)])
    kept = rows.select(*[f"k{i}" for i in range(len(keep))])
    kinds = to_arrow_schema(kept.schema)

    def score(batches):
        m = shared.value
        for batch in batches:
            x = np.stack([binned(_floats(batch.column(i)), e) for i, e in enumerate(m.edges)]).T
            share = 1.0 / (1.0 + np.exp(-m.margins(x)))
            columns = [batch.column(width + i).cast(kinds.field(i).type) for i in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(share)], [*kinds.names, "score"])

    made = rows.mapInArrow(score, kept.withColumn("score", F.lit(0.0)).schema)
    return made.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], "score")


def score_cells(models: dict[int, LeafwiseModel], blocks: RDD, spark: SparkSession) -> DataFrame:
    """(fold, label, score, n): every cell's score by the model of its fold, and its rows of either label. Cells of other folds are left out."""
    shared = spark.sparkContext.broadcast(models)

    def score(b):
        for fold, model in shared.value.items():
            own = b.of(lambda f: f == fold)
            share = 1.0 / (1.0 + np.exp(-model.margins(own.x)))
            # Cells of one score are one row.
            scores, at = np.unique(share, return_inverse=True)
            for label, counts in ((0, own.n0), (1, own.n1)):
                n = np.zeros(len(scores), np.int64)
                np.add.at(n, at, counts.astype(np.int64))
                for lo in range(0, len(scores), 10_000):
                    yield fold, label, scores[lo:lo + 10_000].tolist(), n[lo:lo + 10_000].tolist()

    packed = spark.createDataFrame(blocks.flatMap(score), "fold int, label int, scores array<double>, counts array<long>")
    pairs = packed.select("fold", "label", F.explode(F.arrays_zip("scores", "counts")).alias("pair"))
    return pairs.select("fold", "label", F.col("pair.scores").alias("score"), F.col("pair.counts").alias("n")).filter("n > 0")
