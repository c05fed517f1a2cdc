"""Embedding near-duplicates by NN-descent: a neighbour graph refined through neighbours of neighbours.

1. Equal vectors are one node.
2. Every node starts with neighbours from random-hyperplane cells: cells split until they are small.
3. Rounds of NN-descent: a node offers its neighbours, and those that have it as a neighbour, to each other;
   each keeps its nearest. Rounds go on while the lists improve.
4. A node whose whole list is within the threshold is saturated: it may have more links than its list has places, so its
   list is enlarged and the rounds go on.
5. Links of the lists connect groups. Within a group all pairs are compared in blocks, so that the links of a vector
   are all links of its group, and the group's size and not its square is what is sent.
6. The audit compares the stated queries, ids divisible by 50, with all other rows; links that the graph has missed are
   counted, and while the recall is below the bound, twice as many further cells and rounds are added. Where
   IDLE attempts in a row find no more, the query fails with the recall measured.

Everything is done on vectors of length one in double precision.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, components, stored

_log = logging.getLogger(__name__)
NEIGHBOURS, CELL, TREES = 12, 128, 3
MOST_TREES = 192
"""Sets of cells of the first attempt at most; the audit asks for further ones."""
BLOCK = 2048
QUERY_EVERY = 50
RECALL = 0.99
IDLE = 2


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(-1, width)


def unit_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, unit, node) of all rows: unit is the vector in double precision at length one, node its hash; both are null
    for a vector that is null, empty or zero or holds null or non-finite components."""
    import pyarrow as pa

    def normalise(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = lists.flatten().to_numpy(zero_copy_only=False)  # a null component is NaN
            filled = np.flatnonzero(sizes)
            starts, lengths = (np.cumsum(sizes) - sizes)[filled], sizes[filled]
            whole = np.zeros(len(sizes), dtype=bool)
            if len(filled):
                with np.errstate(divide="ignore", invalid="ignore"):
                    largest = np.maximum.reduceat(np.abs(x), starts)
                    x = x / np.repeat(largest, lengths)
                    x /= np.repeat(np.sqrt(np.add.reduceat(x * x, starts)), lengths)
                whole[filled] = np.isfinite(largest) & (largest > 0)
                x = x[np.repeat(whole[filled], lengths)]
            ends = np.cumsum(np.where(whole, sizes, 0))
            unit = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(x, pa.float64()), mask=pa.array(~whole))
            yield pa.RecordBatch.from_arrays([batch.column(0), unit], ["key", "unit"])

    cast = rows.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("unit"))
    return cast.mapInArrow(normalise, "key long, unit array<double>").withColumn("node", F.when(F.col("unit").isNotNull(), F.xxhash64("unit")))


def _packed(rows: DataFrame) -> DataFrame:
    """(node, vec): one row per distinct vector, as bytes."""
    import pyarrow as pa

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array(v, dtype="<f8").tobytes() for v in batch.column(1).to_pylist()], pa.binary())],
                                             ["node", "vec"])

    distinct = rows.filter("node IS NOT NULL").groupBy("node").agg(F.first("unit").alias("unit"))
    return distinct.select("node", "unit").mapInArrow(pack, "node long, vec binary")


def _cells(nodes: DataFrame, width: int, bits: int, seed: int) -> DataFrame:
    """nodes with the side of each vector on `bits` random planes through the middle of the unit sphere, as a number."""
    import pyarrow as pa

    planes = np.random.default_rng(seed).normal(size=(width, bits))

    def side(batches):
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist(), width)
            code = (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.astype(np.int64))], ["node", "vec", "cell"])

    return nodes.mapInArrow(side, "node long, vec binary, cell long")


def _trees(bits: int, threshold: float) -> int:
    """How many sets of cells a pair at the threshold needs to share one of them with probability RECALL: a random plane
    leaves it on one side with probability 1 - angle / pi, and a cell has `bits` planes."""
    together = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits
    if together >= RECALL:
        return TREES
    return max(TREES, int(np.ceil(min(MOST_TREES, np.log(1 - RECALL) / np.log1p(-max(together, 1e-9))))))


def _nearest(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, neighbour, similarity) of the k nearest of each within a small set."""
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    k = min(k, len(ids) - 1)
    if k <= 0:
        return ids[:0], ids[:0], np.zeros(0)
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.repeat(ids, k), ids[at].ravel(), np.take_along_axis(sims, at, axis=1).ravel()


def _by_group(rows: DataFrame, group: list[str], width: int, k: int, salted: int) -> DataFrame:
    """Nearest neighbours within groups of (group..., node, vec); groups of more than `salted` rows are met in parts that
    memory can hold: a group is only where a search starts, and its parts are refined through each other later."""
    import pyarrow as pa

    def near(batches):
        here, ids, vecs = None, [], []

        def out():
            if len(ids) < 2:
                return [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
            return _nearest(np.array(ids, dtype=np.int64), _matrix(vecs, width), k)

        for batch in batches:
            made = []
            for *key, node, vec in zip(*(c.to_pylist() for c in batch.columns)):
                if key != here or len(ids) >= salted:
                    made.append(out())
                    here, ids, vecs = key, [], []
                ids.append(node)
                vecs.append(vec)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([m[i] for m in made])) for i in range(3)], ["node", "other", "sim"])
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in out()], ["node", "other", "sim"])

    return (rows.select(*group, "node", "vec").repartition(*group).sortWithinPartitions(*group, "node")
            .mapInArrow(near, "node long, other long, sim double"))


def _best(edges: DataFrame, size: str = "12") -> DataFrame:
    """(node, size, list): the nearest `size` neighbours of each node, ties by the smaller hash. Candidates of a node are
    cut to their best in every task before they are shuffled."""
    return (edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.max(F.expr(size)).alias("size"))
            .groupBy("node").agg(F.max("size").alias("size"), F.collect_list(F.struct((-F.col("sim")).alias("far"), "other")).alias("all"))
            .select("node", "size", F.slice(F.sort_array("all"), F.lit(1), F.col("size").cast("int")).alias("list")))


def near_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, neighbours: int = NEIGHBOURS,
               rounds: int = 3, seed: int = 11) -> DataFrame:
    """(key, n_links, component_id, kept) of all rows; see the module for the method.

    Rows link when their cosine is at least threshold. n_links counts the rows linked directly, copies included;
    component_id is the smallest key reachable by links, itself included. Vectors that are null, empty or zero or hold
    null or non-finite components link with nothing. Vectors of another length than most are not compared: a
    table with vectors of different lengths is an error. The metadata of n_links hold the audit's count of links found and
    missed, and its recall.
    """
    spark = vectors.sparkSession
    bounded_batches(vectors, 4096)
    rows = stored(unit_vectors(vectors, key, vector), "units")
    nodes = stored(_packed(rows), "nodes")
    shape = nodes.agg(F.count(F.lit(1)), F.min(F.octet_length("vec")), F.max(F.octet_length("vec"))).first()
    if shape[0] and shape[1] != shape[2]:
        raise ValueError("vectors of different lengths")
    width = (shape[1] or 8) // 8
    bits = max(0, int(np.ceil(np.log2(max(1, shape[0]) / CELL))))
    graph, done, trees, least, idle = None, 0, _trees(bits, threshold), None, 0
    while True:
        for first in range(done, trees, TREES):
            starts = [_by_group(_cells(nodes, width, bits, seed + t), ["cell"], width, neighbours, 4 * CELL)
                      for t in range(first, min(trees, first + TREES))]
            for more in starts[1:]:
                starts[0] = starts[0].union(more)
            edges = starts[0].withColumn("size", F.lit(neighbours))
            if graph is not None:
                edges = edges.union(_edges(graph))
            graph = stored(_best(edges, "size"), "graph")
        graph = _descend(graph, nodes, width, neighbours, rounds, threshold)
        links = stored(_edges(graph).filter(F.col("sim") >= threshold - 1e-9).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "links")
        groups = stored(components(links), "groups")
        counted = stored(_links_in_groups(rows, nodes, groups, width, threshold), "counts")
        found, missed, recall = _audit(rows, nodes, groups, width, threshold)
        _log.info("near_links: recall %.4f with %d sets of cells, %d links found, %d missed", recall, trees, found, missed)
        if recall >= RECALL:
            break
        idle = idle + 1 if least is not None and missed >= least else 0
        if idle == IDLE:
            raise RuntimeError(f"near_links: recall {recall:.4f} is below {RECALL} with {trees} sets of cells: {found} links found, {missed} missed")
        least = missed if least is None else min(least, missed)
        done, trees = trees, 3 * trees
    copies = rows.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"))
    parts = stored(components(counted.filter("a IS NOT NULL").select("a", "b")), "parts")
    by_node = (copies.join(counted.filter("a IS NULL").groupBy("node").agg(F.sum("linked").alias("linked")), "node", "left")
               .join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = by_node.groupBy("component").agg(F.min("least").alias("first"))
    by_node = by_node.join(least, "component").select("node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), "first")
    out = rows.select("key", "node").join(by_node, "node", "left")
    component = F.coalesce("first", "key")
    audit = {"audit_found": int(found), "audit_missed": int(missed), "audit_recall": float(recall)}
    return out.select(F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links", metadata=audit), component.alias("component_id"),
                      F.col("key").eqNullSafe(component).alias("kept"))


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode("list").alias("e"), "size").select("node", F.col("e.other").alias("other"), (-F.col("e.far")).alias("sim"), "size")


def _descend(graph: DataFrame, nodes: DataFrame, width: int, neighbours: int, rounds: int, threshold: float) -> DataFrame:
    """Rounds of neighbours-of-neighbours; lists that are saturated grow by half each round."""
    before = None
    for _ in range(rounds):
        edges = _edges(graph)
        # Who meets whom: the neighbours of a node and those that have it as theirs, around that node. The nearest are few,
        # and a node that many have as a neighbour is met by its own nearest and a hash share of the others.
        back = edges.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim")
        many = back.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        back = (back.join(many, "node").withColumn("part", F.pmod(F.xxhash64("node", "other"), F.ceil(F.col("n") / (2 * neighbours))))
                .select("node", "part", "other"))
        parts = many.select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / (2 * neighbours)) - 1)).alias("part"))
        own = edges.select("node", F.col("other")).join(parts, "node", "left").select("node", F.coalesce("part", F.lit(0).cast("long")).alias("part"), "other")
        hub = own.select("node", "part").distinct().withColumn("other", F.col("node"))
        met = own.union(back).union(hub).distinct()
        met = met.withColumnRenamed("node", "around").withColumnRenamed("other", "node").join(nodes, "node")
        found = _by_group(met, ["around", "part"], width, neighbours, 4096)
        sizes = graph.select("node", F.when(F.col("list")[F.size("list") - 1]["far"] <= -threshold, F.ceil(F.col("size") * 1.5)).otherwise(F.col("size")).cast("int").alias("size"))
        offered = edges.drop("size").union(found).join(sizes, "node", "left").withColumn("size", F.coalesce("size", F.lit(neighbours)))
        graph = stored(_best(offered, "size"), "graph")
        state = graph.agg(F.sum(F.aggregate("list", F.lit(0.0), lambda a, e: a + e["far"]))).first()[0]
        if before is not None and state is not None and abs(state - before) <= 1e-3 * abs(before):
            break
        before = state
    return graph


def _links_in_groups(rows: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, threshold: float) -> DataFrame:
    """(node, linked, null, null) with the rows linked to the copies of a node, and links (null, null, a, b) that connect what is connected.

    A group of more than BLOCK nodes is cut into blocks; two blocks meet in one task, which returns sums only."""
    import pyarrow as pa

    copies = rows.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = (groups.join(sizes, "component").join(copies, "node").join(nodes, "node")
               .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    met = (members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("component", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "node", "copies", "vec"))
    met = met.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "own", "node")

    def compare(batches):
        here, held = None, []

        def out():
            ids, linked, a, b = [], [], [], []
            if len(held) >= 2:
                own, node, copies, vec = zip(*held)
                own, copies, x = np.array(own), np.array(copies), _matrix(vec, width)
                left = np.flatnonzero(own == here[1])
                right = np.flatnonzero(own == here[2])
                for lo in range(0, len(left), 512):
                    at = left[lo:lo + 512]
                    near = x[at] @ x[right].T >= threshold
                    near &= at[:, None] != right
                    ids += [node[i] for i in at]
                    linked += (near @ copies[right]).tolist()
                    if here[1] != here[2]:
                        ids += [node[i] for i in right]
                        linked += (copies[at] @ near).tolist()
                    r, c = np.nonzero(near)
                    r, c = _spanning(at[r], right[c], np.arange(len(x)))
                    a += [node[i] for i in r]
                    b += [node[i] for i in c]
            n, m = len(ids), len(a)
            return pa.RecordBatch.from_arrays([pa.array(ids + [None] * m, pa.int64()), pa.array([int(v) for v in linked] + [None] * m, pa.int64()),
                                               pa.array([None] * n + a, pa.int64()), pa.array([None] * n + b, pa.int64())], ["node", "linked", "a", "b"])

        for batch in batches:
            for component, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (component, i, j) != here:
                    yield out()
                    here, held = (component, i, j), []
                held.append(row)
        yield out()

    return met.mapInArrow(compare, "node long, linked long, a long, b long")


def _spanning(a: np.ndarray, b: np.ndarray, part: np.ndarray) -> tuple[list[int], list[int]]:
    """Links of (a, b) that connect all that they connect: every node takes the smallest label around it until none changes."""
    label = part.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    nodes = np.unique(np.concatenate((a, b)))
    nodes = nodes[label[nodes] != nodes]
    return nodes.tolist(), label[nodes].tolist()


def _audit(rows: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, threshold: float) -> tuple[int, int, float]:
    """Links of the query nodes to other nodes within and across groups: the former are found, the latter missed; and the
    recall, over all links or as the mean over the query nodes that have links, whichever is less. Queries, the
    nodes with a key divisible by QUERY_EVERY, are sent in blocks, and each block meets all rows."""
    import pyarrow as pa

    spark = rows.sparkSession
    asked = (rows.filter((F.col("key") % QUERY_EVERY == 0) & F.col("node").isNotNull()).select("node").distinct()
             .join(groups, "node", "left").join(nodes, "node").select("node", F.coalesce("component", "node").alias("component"), "vec"))
    named = nodes.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "vec")
    blocks = max(1, -(-asked.count() // BLOCK))
    slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left = asked.withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(blocks))).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")))
    right = named.withColumn("slice", F.pmod(F.xxhash64("vec", F.lit(1)), F.lit(slices))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    met = left.select("block", "slice", F.lit(0).alias("role"), "node", "component", "vec").union(right.select("block", "slice", F.lit(1).alias("role"), "node", "component", "vec"))
    met = met.repartition("block", "slice").sortWithinPartitions("block", "slice", "role")

    def compare(batches):
        here, asked, others = None, [], []

        def tally():
            node, component, vec = zip(*asked) if asked and others else ((), (), ())
            hits = np.zeros((2, len(node)), dtype=np.int64)
            if node:
                other, other_component, other_vec = zip(*others)
                near = _matrix(vec, width) @ _matrix(other_vec, width).T >= threshold
                near &= np.array(node)[:, None] != np.array(other)
                same = np.array(component)[:, None] == np.array(other_component)
                hits = np.stack(((near & same).sum(axis=1), (near & ~same).sum(axis=1)))
            some = np.flatnonzero(hits.any(axis=0))
            return pa.RecordBatch.from_arrays([pa.array([node[i] for i in some], pa.int64()), pa.array(hits[0][some], pa.int64()),
                                               pa.array(hits[1][some], pa.int64())], ["node", "found", "missed"])

        for batch in batches:
            for block, slice_, role, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (block, slice_) != here:
                    yield tally()
                    here, asked, others = (block, slice_), [], []
                if role and len(others) == BLOCK:
                    yield tally()
                    others = []
                (others if role else asked).append(row)
        yield tally()

    per_query = met.mapInArrow(compare, "node long, found long, missed long").groupBy("node").agg(F.sum("found").alias("found"), F.sum("missed").alias("missed"))
    row = per_query.agg(F.sum("found"), F.sum("missed"), F.avg(F.col("found") / (F.col("found") + F.col("missed")))).first()
    found, missed = row[0] or 0, row[1] or 0
    return found, missed, min(found / (found + missed), row[2]) if found + missed else 1.0
