"""Exact Jaccard self-join of documents on word n-grams, by a prefix tree over globally ordered n-gram sets.

1. Equal sets are one class; everything after works on classes.
2. All n-grams of all classes are counted in an inverted index, dealt out by n-gram in packed arrays. N-grams of a
   single class can be in no intersection, so a class keeps the others only, and a class of which fewer than the
   threshold's share is left cannot link with anything.
3. Sets are ordered by (number of classes, hash), rarest first. Two sets that link share an n-gram in their prefixes.
4. Sets that touch through such n-grams, directly or by way of others, are a cluster. The sets of a cluster are put
   into a prefix tree, and each is a probe for it: an overlap is found once for all sets that share a path, and a
   subtree is left when what is still to come in it cannot make up the overlap needed. A probe looks only at sets
   that are not connected with it yet, so near copies are looked at once and no pairs are ever written out.

An n-gram is its 48-bit hash and a class its 64-bit set hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, components, stored, whole_text
from .shingles import WordHashes, shingle_set, words_of

BUCKET_TOKENS = 1 << 20
BLOCK_TOKENS = 1 << 20
TREE_TOKENS = 1 << 21
EDGE = 16
TOKEN_BITS = 48


def _class_of(tokens: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def _pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def set_sizes(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, class) of docs (doc_id, text); class is null for an empty set."""
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def sizes(batches):
        import pyarrow as pa

        hasher = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                ns, classes = [], []
                for text in part.column(1).to_pylist():
                    tokens = shingle_set(hasher.of(words_of(text)), k)
                    ns.append(len(tokens))
                    classes.append(_class_of(tokens) if len(tokens) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ns, pa.int64()), pa.array(classes, pa.int64())],
                                                 ["doc_id", "n_shingles", "class"])

    return rows.mapInArrow(sizes, "doc_id long, n_shingles long, class long")


def shared_ngrams(docs: DataFrame, sizes: DataFrame, k: int, buckets: int, threshold: tuple[int, int]) -> DataFrame:
    """(class, n, tokens) of the classes that share enough n-grams with others: tokens are those n-grams as big-endian
    keys (frequency, hash), so that sets compare as bytes in the global order."""
    import pyarrow as pa

    num, den = threshold
    rows = docs.select(whole_text().alias("text"))

    def deal(batches):
        hasher, seen = WordHashes(), set()
        sets: list[np.ndarray] = []
        ids: list[int] = []
        held = 0

        def flush():
            tokens = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            bucket = (tokens >> np.uint64(TOKEN_BITS)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            tokens, owner, bucket = tokens[order], owner[order], bucket[order]
            cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]))
            classes = np.array(ids, dtype=np.int64)
            out = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own = owner[lo:hi]
                first = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
                runs = np.diff(np.append(first, len(own))).astype("<u4")
                out.append((int(bucket[lo]), _pack48(tokens[lo:hi]), classes[own[first]].astype("<i8").tobytes(), runs.tobytes()))
            for lo in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[lo:lo + 64]), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                                 ["bucket", "tokens", "classes", "runs"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                for text in batch.slice(lo, 1000).column(0).to_pylist():
                    tokens = shingle_set(hasher.of(words_of(text)), k)
                    if not len(tokens):
                        continue
                    key = _class_of(tokens)
                    if key in seen:
                        continue
                    if len(seen) < 1 << 18:
                        seen.add(key)
                    sets.append(tokens)
                    ids.append(key)
                    held += len(tokens)
                    if held >= BLOCK_TOKENS:
                        yield from flush()
                        sets, ids, held = [], [], 0
        if sets:
            yield from flush()

    def count_bucket(table: pa.Table) -> pa.Table:
        """N-grams of one bucket that two or more classes have, dealt out by class."""
        tokens = np.concatenate([_unpack48(b) for b in table["tokens"].to_pylist()])
        owners = np.concatenate([np.frombuffer(b, "<i8") for b in table["classes"].to_pylist()])
        runs = np.concatenate([np.frombuffer(b, "<u4") for b in table["runs"].to_pylist()])
        classes, owners = np.unique(owners, return_inverse=True)
        owner = np.repeat(owners.astype(np.uint32), runs)
        order = np.lexsort((owner, tokens))
        tokens, owner = tokens[order], owner[order]
        keep = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])))
        tokens, owner = tokens[keep], owner[keep]
        first = np.concatenate(([0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1))
        times = np.diff(np.append(first, len(tokens)))
        grade = np.minimum(4 * np.log2(times), 255).astype(np.uint64)
        shared = np.repeat(times > 1, times)
        keys = ((np.repeat(grade, times) << np.uint64(TOKEN_BITS)) | tokens)[shared]
        owner = classes[owner[shared]]
        home = owner.astype(np.uint64) % np.uint64(buckets)
        order = np.lexsort((owner, home))
        keys, owner, home = keys[order], owner[order], home[order]
        cuts = np.concatenate(([0], np.flatnonzero(home[1:] != home[:-1]) + 1, [len(home)])) if len(home) else np.zeros(1, np.int64)
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            first = np.concatenate(([0], np.flatnonzero(owner[a + 1:b] != owner[a:b - 1]) + 1))
            runs = np.diff(np.append(first, b - a))
            out.append((int(home[a]), keys[a:b].astype("<u8").tobytes(), owner[a:b][first].astype("<i8").tobytes(), runs.astype("<u4").tobytes()))
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(
            [("home", pa.int64()), ("keys", pa.binary()), ("classes", pa.binary()), ("runs", pa.binary())])})

    def gather(known: pa.Table, found: pa.Table) -> pa.Table:
        """Classes whose shared n-grams are enough, with these in order."""
        size = dict(zip(known["class"].to_pylist(), known["n"].to_pylist()))
        out = []
        if found.num_rows:
            keys = np.concatenate([np.frombuffer(b, "<u8") for b in found["keys"].to_pylist()])
            owner = np.concatenate([np.repeat(np.frombuffer(b, "<i8"), np.frombuffer(r, "<u4"))
                                    for b, r in zip(found["classes"].to_pylist(), found["runs"].to_pylist())])
            order = np.lexsort((keys, owner))
            keys, owner = keys[order], owner[order]
            cuts = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]))
            out = [(int(owner[a]), size[int(owner[a])], keys[a:b].astype(">u8").tobytes()) for a, b in zip(cuts[:-1], cuts[1:])
                   if den * (b - a) >= num * size[int(owner[a])]]
        return pa.table({"class": pa.array([r[0] for r in out], pa.int64()), "n": pa.array([r[1] for r in out], pa.int64()),
                         "tokens": pa.array([r[2] for r in out], pa.binary())})

    dealt = rows.mapInArrow(deal, "bucket long, tokens binary, classes binary, runs binary")
    found = dealt.groupBy("bucket").applyInArrow(count_bucket, "home long, keys binary, classes binary, runs binary")
    known = sizes.filter("class IS NOT NULL").groupBy("class").agg(F.first("n_shingles").alias("n"))
    known = known.withColumn("home", _unsigned_mod("class", buckets))
    return (known.groupBy("home").cogroup(found.groupBy("home"))
            .applyInArrow(gather, "class long, n long, tokens binary"))


def _unsigned_mod(name: str, modulus: int):
    """A 64-bit column read as unsigned, modulo a small number."""
    high = F.shiftrightunsigned(F.col(name), 32)
    low = F.col(name).bitwiseAND(F.lit(0xFFFFFFFF))
    return ((high % modulus) * ((1 << 32) % modulus) + low) % modulus


def prefix_entries(sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(token, class): the n-grams in the prefix of each set. N-grams of one class only fill the prefix first."""
    num, den = threshold

    def prefixes(batches):
        import pyarrow as pa

        for batch in batches:
            tokens, classes = [np.zeros(0, np.int64)], []
            for cls, n, keys in zip(*(c.to_pylist() for c in batch.columns)):
                keys = np.frombuffer(keys, ">i8")
                length = max(0, n + (-num * n // den) + 1 - (n - len(keys)))
                tokens.append(keys[:length].astype(np.int64))
                classes += [cls] * len(tokens[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(classes, pa.int64())], ["token", "class"])

    return sets.select("class", "n", "tokens").mapInArrow(prefixes, "token long, class long")


class PrefixTree:
    """N-gram sets in one tree, EDGE n-grams to an edge; sets must come in the order of their n-grams.

    A level holds the distinct prefixes of (level + 1) * EDGE n-grams: their last n-grams, the sets below them, and the
    fewest n-grams and the most that are still to come in those.
    """

    def __init__(self, sizes: np.ndarray, sets: list[np.ndarray]):
        self.sizes, self.lengths = sizes, np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        self.names, local = np.unique(flat, return_inverse=True)
        starts = np.cumsum(self.lengths) - self.lengths
        self.sets = np.split(local, starts[1:])
        common = np.zeros(len(sets), dtype=np.int64)
        for i in range(1, len(sets)):
            width = min(self.lengths[i - 1], self.lengths[i])
            differ = np.flatnonzero(self.sets[i - 1][:width] != self.sets[i][:width])
            common[i] = differ[0] if len(differ) else width
        padded = np.append(local, np.full(EDGE, len(self.names)))
        self.levels = []
        node_of = np.zeros(len(sets), dtype=np.int64)
        for depth in range(0, int(self.lengths.max()), EDGE):
            rows = np.flatnonzero(self.lengths > depth)
            end = np.minimum(self.lengths[rows], depth + EDGE)
            joined = np.concatenate(([False], (rows[1:] == rows[:-1] + 1) & (common[rows[1:]] >= end[1:]) & (end[1:] == end[:-1])))
            first = np.flatnonzero(~joined)
            node = np.cumsum(~joined) - 1
            at = starts[rows[first]][:, None] + depth + np.arange(EDGE)
            grams = np.where(np.arange(EDGE) < (end[first] - depth)[:, None], padded[at], len(self.names))
            ended = self.lengths[rows] <= depth + EDGE
            self.levels.append({
                "grams": grams, "last": local[starts[rows[first]] + end[first] - 1], "parent": node_of[rows[first]], "low": rows[first],
                "high": np.append(rows[first][1:], rows[-1] + 1), "size": np.minimum.reduceat(sizes[rows], first),
                "left": np.maximum.reduceat(self.lengths[rows], first) - end[first], "ended": rows[ended], "ended_at": node[ended]})
            node_of = np.zeros(len(sets), dtype=np.int64)
            node_of[rows] = node

    def similar(self, probe: int, active: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
        """The active sets that link with set `probe`."""
        num, den = threshold
        own, size = self.sets[probe], self.sizes[probe]
        within = np.zeros(len(self.names) + 1, dtype=bool)
        within[own] = True
        before = np.concatenate(([0], np.cumsum(active)))
        found, kept, overlap = [], np.ones(1, dtype=bool), np.zeros(1, dtype=np.int64)
        for depth, level in enumerate(self.levels):
            parent = level["parent"] if depth else np.zeros(len(level["low"]), dtype=np.int64)
            nodes = np.flatnonzero(kept[parent])
            nodes = nodes[before[level["high"][nodes]] > before[level["low"][nodes]]]
            if not len(nodes):
                break
            both = overlap[parent[nodes]] + within[level["grams"][nodes]].sum(axis=1)
            to_come = np.minimum(level["left"][nodes], len(own) - np.searchsorted(own, level["last"][nodes], side="right"))
            stay = (den + num) * (both + to_come) >= num * (size + level["size"][nodes])
            nodes, both = nodes[stay], both[stay]
            kept, overlap = np.zeros(len(level["low"]), dtype=bool), np.zeros(len(level["low"]), dtype=np.int64)
            kept[nodes], overlap[nodes] = True, both
            done = kept[level["ended_at"]]
            rows, shared = level["ended"][done], overlap[level["ended_at"][done]]
            found.append(rows[active[rows] & (den * shared >= num * (size + self.sizes[rows] - shared))])
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def tree_links(sizes: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that connect all sets that are connected: each set is a probe for the later ones that are not connected
    with it yet; with `side`, only for those of the other side."""
    tree = PrefixTree(sizes, sets)
    part, links = np.arange(len(sets)), []
    later = np.zeros(len(sets), dtype=bool)
    for probe in range(len(sets) - 1):
        later[:] = part != part[probe]
        later[:probe + 1] = False
        if side is not None:
            later &= side != side[probe]
        if not later.any():
            continue
        for other in tree.similar(probe, later, threshold):
            if part[other] != part[probe]:
                links.append((probe, int(other)))
                part[part == part[other]] = part[probe]
    return links


def cluster_links(sets: DataFrame, clusters: DataFrame, threshold: tuple[int, int], tree_tokens: int = TREE_TOKENS) -> DataFrame:
    """Links (a, b) that connect what is connected within clusters (node, component) of candidates.

    A cluster of up to tree_tokens n-grams is one tree. A larger one is cut into blocks; every two blocks meet in a tree
    of their own, so memory is bounded whatever the cluster's size.
    """
    narrow = clusters.select(F.col("node").alias("class"), F.col("component").alias("cluster"))
    sizes = sets.select("class", (F.octet_length("tokens") / 8).alias("size")).join(narrow, "class")
    blocks = sizes.groupBy("cluster").agg(F.ceil(F.sum("size") / tree_tokens).cast("int").alias("blocks"))
    members = sets.join(narrow.join(blocks, "cluster"), "class").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = (members.withColumn("other", F.explode(other))
            .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "n", "tokens"))
    rows = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "tokens")

    def link(batches):
        import pyarrow as pa

        here, held = None, []

        def links():
            if len(held) < 2:
                return [], []
            owns, classes, ns, tokens = zip(*held)
            side = np.array(owns) if here[1] != here[2] else None
            sets = [np.frombuffer(t, ">u8").astype(np.uint64) for t in tokens]
            pairs = tree_links(np.array(ns), sets, side, threshold)
            return [classes[a] for a, _ in pairs], [classes[b] for _, b in pairs]

        for batch in batches:
            a, b = [], []
            for cluster, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (cluster, i, j) != here:
                    more = links()
                    a += more[0]
                    b += more[1]
                    here, held = (cluster, i, j), []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        more = links()
        yield pa.RecordBatch.from_arrays([pa.array(more[0], pa.int64()), pa.array(more[1], pa.int64())], ["a", "b"])

    return rows.mapInArrow(link, "a long, b long")


def ngram_components(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (3, 4)) -> DataFrame:
    """(doc_id, n_shingles, component_id) of all docs (doc_id, text).

    Two documents link when the Jaccard similarity of their sets of k-word shingles (the whole sequence, if shorter)
    is at least threshold = (numerator, denominator). component_id is the smallest doc_id reachable by links, itself
    included. Missing and empty texts, and texts of white space, have an empty set and link with nothing. Rows that
    repeat a doc_id count as documents. A missing doc_id gets the component of its copies, or none.
    """
    sizes = stored(set_sizes(docs, k), "set-sizes")
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_TOKENS))
    sets = stored(shared_ngrams(docs, sizes, k, buckets, threshold), "shared-ngrams")
    entries = stored(prefix_entries(sets, threshold), "prefixes")
    least = entries.groupBy("token").agg(F.min("class").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    touching = entries.join(least, "token").select("a", F.col("class").alias("b")).filter("a <> b").distinct()
    clusters = stored(components(touching), "clusters")
    parts = stored(components(stored(cluster_links(sets, clusters, threshold), "links")), "classes")
    named = (sizes.join(parts.withColumnRenamed("node", "class"), "class", "left")
             .select("doc_id", "n_shingles", F.coalesce("component", "class").alias("component")))
    least = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
