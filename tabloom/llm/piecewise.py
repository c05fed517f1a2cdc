"""Document fingerprints by context-triggered piecewise hashing, and their likeness by edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stored, whole_text

WINDOW = 7
MIN_BLOCK = 3
SIGNATURE = 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Mixed hash of the WINDOW bytes that end at each position; bytes before the text count as zero."""
    padded = np.concatenate((np.zeros(WINDOW - 1, dtype=np.uint32), data.astype(np.uint32)))
    rolled = np.zeros(len(data), dtype=np.uint32)
    for i in range(WINDOW):
        rolled *= np.uint32(0x01000193)
        rolled += padded[i:i + len(data)]
    rolled ^= rolled >> np.uint32(16)
    rolled *= np.uint32(0x7FEB352D)
    rolled ^= rolled >> np.uint32(15)
    return rolled


def fingerprint(text: str) -> str:
    """`block:signature:signature at twice the block` of the UTF-8 bytes of a text.

    A piece ends where the rolling hash of the last seven bytes is a multiple of the block size, so an edit changes
    only the pieces around it. Each piece gives one of 64 symbols, the rest after the last boundary gives the last
    one. The block is the smallest 3 * 2**k with at most 64 pieces; a hash of zero, a multiple of every block, ends no
    piece, as no block would thin it out. Equal texts have equal fingerprints; the
    empty text has two empty signatures.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return f"{MIN_BLOCK}::"
    rolled = _rolling(data)
    ends = np.flatnonzero((rolled % np.uint32(MIN_BLOCK) == 0) & (rolled != 0))
    times = rolled[ends] // np.uint32(MIN_BLOCK)
    level = 0
    while len(ends) > SIGNATURE - 1:
        keep = (times & np.uint32(1)) == 0
        ends, times, level = ends[keep], times[keep] >> np.uint32(1), level + 1
    finer = _signature(rolled, ends)
    coarser = _signature(rolled, ends[(times & np.uint32(1)) == 0])
    return f"{MIN_BLOCK << level}:{finer}:{coarser}"


def _signature(rolled: np.ndarray, ends: np.ndarray) -> str:
    starts = np.concatenate(([0], ends + 1))
    starts = starts[starts < len(rolled)]
    sums = np.add.reduceat(rolled, starts, dtype=np.uint32)
    sums = (sums ^ (sums >> np.uint32(13))) * np.uint32(0x9E3779B1)
    return ALPHABET[sums >> np.uint32(26)].tobytes().decode()


def common_symbols(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair of signatures of up to 64 symbols, all pairs at once:
    one machine word per pair holds a row of the edit table."""
    n = len(left)
    width = max([1, *map(len, right)])
    masks = np.zeros((n, 128), dtype=np.uint64)
    for i, s in enumerate(left):
        codes = np.frombuffer(s.encode(), dtype=np.uint8)
        np.bitwise_or.at(masks[i], codes, np.uint64(1) << np.arange(len(codes), dtype=np.uint64))
    symbols = np.zeros((width, n), dtype=np.uint8)
    for i, s in enumerate(right):
        symbols[:len(s), i] = np.frombuffer(s.encode(), dtype=np.uint8)
    row, at = np.full(n, ~np.uint64(0)), np.arange(n)
    for k in range(width):
        hit = row & masks[at, symbols[k]]
        row = (row + hit) | (row - hit)
    return np.bitwise_count(~row).astype(np.int64)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 - (insertions + deletions) / symbols of each pair of fingerprints, over the signatures with the same block
    size, the better of two; 0 if the block sizes are further apart than a factor of two or a signature is empty, 1
    for equal fingerprints."""
    jobs, out = [], np.zeros(len(left))
    for i, (a, b) in enumerate(zip(left, right)):
        if a == b:
            out[i] = 1.0
            continue
        (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
        if p == q:
            jobs += [(i, a1, b1), (i, a2, b2)]
        elif int(p) == 2 * int(q):
            jobs.append((i, a1, b2))
        elif int(q) == 2 * int(p):
            jobs.append((i, a2, b1))
    jobs = [j for j in jobs if j[1] and j[2]]
    if jobs:
        at, a, b = zip(*jobs)
        shared = common_symbols(list(a), list(b))
        np.maximum.at(out, np.array(at), 2 * shared / np.array([len(x) + len(y) for x, y in zip(a, b)]))
    return out


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


_OUT = [("doc_id", "long"), ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
        ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")]


def _results(rows: list[tuple[int | None, str, str, str, str]]) -> Iterator[tuple]:
    """From (doc_id, text, its fingerprint, following text, its fingerprint)."""
    changed = [edited(text, following) for _, text, _, following, _ in rows]
    prints = [fingerprint(t) for t in changed]
    own, following = [r[2] for r in rows], [r[4] for r in rows]
    yield from zip([r[0] for r in rows], [len(r[1]) for r in rows],
                   [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], own, prints,
                   likeness(own, prints).tolist(), likeness(own, following).tolist())


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all docs (doc_id, text), of their edited texts, and of how near these and the next documents are.

    The next document is the one with the next smaller doc_id, after the last the first. Documents are range-partitioned
    by doc_id once and read in order; where a partition ends, its last document waits for the first of the next, of
    which there is one per partition. A missing text is empty, a missing doc_id comes last, rows that repeat a
    doc_id stand in descending order of their texts. A single document is its own next one.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
    schema = ", ".join(f"{n} {k}" for n, k in _OUT)

    def batch_of(rows):
        import pyarrow as pa

        kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
        names = [*_OUT, ("part", "int"), ("role", "int"), ("text", "string")]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names)], [n for n, _ in names[:len(columns)]])

    def scan(batches):
        from pyspark import TaskContext

        part, waiting = TaskContext.get().partitionId(), None
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                pairs, out = [], []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(lo, 200).columns)):
                    own = fingerprint(text)
                    if waiting is None:
                        out.append((doc_id, None, None, own, None, None, None, part, 1, text))
                    else:
                        pairs.append((*waiting, text, own))
                    waiting = (doc_id, text, own)
                out += [(*r, part, 0, None) for r in _results(pairs)]
                if out:
                    yield batch_of(out)
        if waiting is not None:
            yield batch_of([(waiting[0], None, None, waiting[2], None, None, None, part, 2, waiting[1])])

    def finish(batches):
        for batch in batches:
            pairs = list(zip(*(c.to_pylist() for c in batch.columns)))
            yield batch_of([(*r, 0, 0, None) for r in _results(pairs)])

    wide = schema + ", part int, role int, text string"
    done = stored(rows.mapInArrow(scan, wide), "fingerprints")
    parts = sorted(r["part"] for r in done.filter("role = 1").select("part").collect())
    steps = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part int, after int")
    heads = done.filter("role = 1").select(F.col("part").alias("after"), F.col("text").alias("head"), F.col("fingerprint").alias("head_print"))
    last = (done.filter("role = 2").select("part", "doc_id", "text", "fingerprint").join(steps, "part").join(heads, "after")
            .select("doc_id", "text", "fingerprint", "head", "head_print").mapInArrow(finish, wide))
    names = [n for n, _ in _OUT]
    return done.filter("role = 0").select(*names).union(last.select(*names))
