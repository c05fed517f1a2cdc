"""Packing documents into as few fixed-length sequences as possible: bin completion over the histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import col
from .common import bounded_batches, stored, whole_text
from .tokens import shared_encoder, text_blocks

SEARCH_WORK = 400_000
"""Bound on the search for a better packing: the sum of the lengths looked at in all its nodes."""
FILLINGS_PER_NODE = 24
WORDS_HELD, BLOCK_CHARS = 1 << 15, 1 << 18
"""Words that a task looks up, and characters of texts that it encodes at a time; ids do not depend on either."""

Plan = list[tuple[tuple[int, ...], int]]
"""Fillings (lengths in one sequence) and how many sequences are filled that way."""


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: all tokens, and the lengths that cannot share a sequence (Martello-Toth)."""
    number = np.zeros(capacity + 2, dtype=object)
    for n, c in counts.items():
        number[n] = c
    upto = np.concatenate(([0], np.cumsum(number)))  # upto[i]: documents of fewer than i tokens
    mass = np.concatenate(([0], np.cumsum(number * np.arange(capacity + 2))))
    half = capacity // 2
    k = np.arange(half + 1)
    large = upto[capacity + 1] - upto[capacity - k + 1]
    alone = upto[capacity - k + 1] - upto[half + 1]
    room = alone * capacity - (mass[capacity - k + 1] - mass[half + 1])
    over = np.maximum(0, mass[half + 1] - mass[k] - room)
    return max(-(-mass[capacity + 1] // capacity), int(np.max(large + alone + -(-over // capacity))))


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a histogram: equal lengths go into equal sequences together, so the work depends on
    the number of lengths and not on the number of documents."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def leave(room: int, filling: tuple[int, ...], copies: int) -> None:
        if room not in open_:
            insort(rooms, room)
        open_.setdefault(room, []).append((filling, copies))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, left)
                leave(capacity - each * length, (length,) * each, left // each)
                left -= left // each * each
                continue
            room = rooms[at]
            filling, copies = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            each = min(room // length, left)
            used = min(copies, left // each)
            if copies > used:
                leave(room, filling, copies - used)
            leave(room - each * length, filling + (length,) * each, used)
            left -= each * used
    merged = Counter()
    for group in open_.values():
        for filling, copies in group:
            merged[filling] += copies
    return list(merged.items())


def fillings(counts: dict[int, int], room: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill `room` from the histogram, least waste first.

    Only fillings that nothing more fits into are made, largest lengths first. One filling dominates another if it
    comes from it by exchanging one length, or two, for a single one not smaller than their sum that still fits: what
    remains is then no harder to pack.
    """
    lengths = sorted((n for n in counts if counts[n] and n <= room), reverse=True)
    found: set[tuple[int, ...]] = set()

    def extend(chosen: tuple[int, ...], at: int, left: int) -> Iterator[tuple[int, ...]]:
        grew = False
        for i in range(at, len(lengths)):
            n = lengths[i]
            if n <= left and chosen.count(n) < counts[n]:
                grew = True
                yield from extend(chosen + (n,), i, left - n)
        if not grew and not any(n <= left and chosen.count(n) < counts[n] for n in lengths[:at]):
            yield chosen

    for filling in extend((), 0, room):
        found.add(filling)
        if sum(filling) == room and len(filling) <= 2:
            break
        if len(found) >= 8 * FILLINGS_PER_NODE:
            break

    def dominated(f: tuple[int, ...]) -> bool:
        spare = room - sum(f)
        held = Counter(f)
        parts = {(a,) for a in f} | {(a, b) for i, a in enumerate(f) for b in f[i + 1:]}
        return any(sum(p) <= n <= sum(p) + spare and (n,) != p and held[n] < counts[n] for p in parts for n in lengths)

    kept = [f for f in found if not dominated(f)] or list(found)
    return sorted(kept, key=lambda f: (room - sum(f), len(f), [-n for n in f]))[:FILLINGS_PER_NODE]


def bin_completion(counts: dict[int, int], capacity: int, work: int = SEARCH_WORK) -> Plan:
    """Fewest sequences for a histogram of lengths, by branch and bound.

    The best-fit packing is the first incumbent. Each node of the search takes the largest length left and branches
    over its undominated fillings, each used as often as the counts allow, then less often. A branch is left when the
    room it has wasted exceeds what any better packing may waste, or when its lower bound is no better than the
    incumbent. The search ends with a proof, or with the best packing found after `work`; either is a packing
    of all documents.
    """
    counts = {n: c for n, c in counts.items() if c}
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError("a length does not fit into a sequence")
    best = best_fit(counts, capacity)
    best_size, bound = sum(c for _, c in best), lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    stack: list[tuple[dict[int, int], Plan, int, int]] = [(counts, [], 0, 0)]
    while stack and work > 0 and best_size > bound:
        left, made, size, waste = stack.pop()
        work -= len(left) + 10
        if waste > (best_size - 1) * capacity - total or size + lower_bound(left, capacity) >= best_size:
            continue
        rest = best_fit(left, capacity)
        if size + sum(c for _, c in rest) < best_size:
            best, best_size = made + rest, size + sum(c for _, c in rest)
        if not left:
            continue
        largest = max(left)
        others = {**left, largest: left[largest] - 1}
        branches = []
        for completion in fillings(others, capacity - largest):
            filling = (largest, *completion)
            need = Counter(filling)
            times = min(left[n] // k for n, k in need.items())
            while times:
                after = {n: left[n] - times * need.get(n, 0) for n in left}
                branches.append(({n: c for n, c in after.items() if c}, [*made, (filling, times)], size + times,
                                 waste + times * (capacity - sum(filling))))
                times //= 2
        stack.extend(reversed(branches))
    return best


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, word_ends: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of docs (doc_id, text): whole texts encoded, end_id added, and cut into
    pieces of capacity ids of which the first may be shorter. A missing text is empty: one piece with the end id.
    ids are little-endian unsigned 32-bit integers."""
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def encode(batches):
        import pyarrow as pa

        encoder = shared_encoder(tokenizer, word_ends, WORDS_HELD)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            pairs = ((d, t) for lo in range(0, batch.num_rows, 500)
                     for d, t in zip(*(c.to_pylist() for c in batch.slice(lo, 500).columns)))
            for block in text_blocks(pairs, 1, BLOCK_CHARS):
                ids, lengths = encoder.encode([t for _, t in block])
                data = memoryview(np.insert(ids, np.cumsum(lengths), end_id).astype("<u4").tobytes())
                rows_out, at = [], 0
                for (doc_id, _), n in zip(block, (lengths + 1).tolist()):
                    first = n % capacity or capacity
                    for piece, start in enumerate([0, *range(first, n, capacity)]):
                        length = first if piece == 0 else capacity
                        rows_out.append((doc_id, piece, start, length, data[4 * (at + start):4 * (at + start + length)]))
                    at += n
                for lo in range(0, len(rows_out), 256):
                    columns = zip(*rows_out[lo:lo + 256])
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                     ["doc_id", "piece", "start", "length", "ids"])
        encoder.release()

    return rows.mapInArrow(encode, "doc_id long, piece long, start long, length long, ids binary")


def assign_sequences(pieces: DataFrame, capacity: int = 2048, work: int = SEARCH_WORK) -> DataFrame:
    """pieces (length, ...) with sequence_id and offset; pieces must be a stored table, it is read more than once.

    Only the histogram of lengths, at most `capacity` rows, reaches the driver, and the plan made from it is a list of
    fillings no longer than a few per length. A piece finds its place in the plan by its rank among the pieces of its
    length. Ranks are made in salted groups plus an offset per group, so a length that most pieces share is ranked by
    many tasks. Repeated rows are packed each for itself.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, first, taken = [], 0, Counter()
    for filling, copies in bin_completion(counts, capacity, work):
        offset = 0
        for length, each in sorted(Counter(filling).items(), reverse=True):
            start = taken[length]
            taken[length] += each * copies
            places.append((length, start, taken[length], each, first, offset))
            offset += each * length
        first += copies
    schema = "_length long, _from long, _to long, _each long, _first long, _offset long"
    plan = spark.createDataFrame(places, schema)
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in ("doc_id", "piece") if c in names] or ["length"]), F.lit(salts)))
    groups = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy(*[col(c) for c in ("doc_id", "piece") if c in names] or [F.lit(1)])
    ranked = (salted.withColumn("_rank", F.row_number().over(inside).cast("long") - 1)
              .join(groups, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before")))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from"))
                         & (F.col("_rank") < F.col("_to")))
    step = F.col("_rank") - F.col("_from")
    copy = F.floor(step / F.col("_each"))
    return placed.select(*[col(c) for c in names], (F.col("_first") + copy).cast("long").alias("sequence_id"),
                         (F.col("_offset") + (step - copy * F.col("_each")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, word_ends: bool = False,
                   work: int = SEARCH_WORK) -> DataFrame:
    """Pack all docs (doc_id, text): a row per piece with its ids, sequence_id and offset. The pieces are stored once;
    which of their columns the placement carries is up to what is selected from it."""
    return assign_sequences(stored(document_pieces(docs, tokenizer, capacity, end_id, word_ends), "pieces"), capacity, work)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
