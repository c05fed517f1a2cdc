"""Token ids in wavelet matrices: one compressed file per shard that is also its own index."""

from __future__ import annotations

import json
import struct

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bounded_batches, filesystem, new_file, spread, stored, whole_text, write_file
from .tokens import shared_encoder, text_blocks

MAGIC = b"TBWM"
SHARD_TOKENS = 1 << 21
RANK_BLOCK = 512
STEP = 1 << 17


class WaveletMatrix:
    """A sequence of unsigned integers as bit planes, highest bit first.

    Each plane is stably parted by its bit before the next is written: zeros, then ones. Counts of ones per block of
    512 bits give rank; access, counting and occurrence lookup take one rank or select per plane.
    """

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._blocks: list[np.ndarray] | None = None

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        values = np.asarray(values, dtype=np.uint32)
        bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        values = values.astype(np.uint16) if bits <= 16 else values
        planes, zeros = [], []
        for level in range(bits - 1, -1, -1):
            ones = (values & values.dtype.type(1 << level)).astype(bool)
            planes.append(np.packbits(ones, bitorder="little"))
            # np.compress finds the places first, which costs half of a boolean index; in steps these places stay few.
            blocks = [(ones[lo:lo + STEP], values[lo:lo + STEP]) for lo in range(0, len(values), STEP)]
            low = [np.compress(~bits_of, block) for bits_of, block in blocks]
            zeros.append(sum(map(len, low)))
            values = np.concatenate((*low, *(np.compress(bits_of, block) for bits_of, block in blocks), values[:0]))
        return cls(n=len(values), planes=planes, zeros=zeros)

    def values(self) -> np.ndarray:
        """The whole sequence: the planes are put together from the last to the first."""
        low = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (plane, zero) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            low[zero:] |= low.dtype.type(1 << level)
            whole, before = np.empty_like(low), 0
            for lo in range(0, self.n, STEP):
                to, ones_at = whole[lo:lo + STEP], np.flatnonzero(ones[lo:lo + STEP])
                zeros_at = np.flatnonzero(~ones[lo:lo + STEP])
                to[ones_at] = low[zero + lo - before:zero + lo - before + len(ones_at)]
                to[zeros_at] = low[before:before + len(zeros_at)]
                before += len(zeros_at)
            low = whole
        return low.astype(np.uint32)

    def _rank_tables(self) -> list[np.ndarray]:
        if self._blocks is None:
            self._blocks = []
            for plane in self.planes:
                padded = np.zeros(-(-max(1, len(plane)) // (RANK_BLOCK // 8)) * (RANK_BLOCK // 8), dtype=np.uint8)
                padded[:len(plane)] = plane
                ones = np.bitwise_count(padded.reshape(-1, RANK_BLOCK // 8)).sum(axis=1)
                self._blocks.append(np.concatenate(([0], np.cumsum(ones))).astype(np.int64))
        return self._blocks

    def _rank1(self, level: int, position: int) -> int:
        """Ones of a plane before position."""
        block = position // RANK_BLOCK
        inside = np.unpackbits(self.planes[level][block * RANK_BLOCK // 8:(position + 7) // 8], bitorder="little")
        return int(self._rank_tables()[level][block]) + int(inside[:position - block * RANK_BLOCK].sum())

    def _select(self, level: int, bit: int, nth: int) -> int:
        """Position of the nth (from 0) zero or one of a plane."""
        ones = self._rank_tables()[level]
        before = ones if bit else np.arange(len(ones)) * RANK_BLOCK - ones
        block = int(np.searchsorted(before, nth, side="right")) - 1
        inside = np.unpackbits(self.planes[level][block * RANK_BLOCK // 8:(block + 1) * RANK_BLOCK // 8], bitorder="little")
        return block * RANK_BLOCK + int(np.flatnonzero(inside == bit)[nth - int(before[block])])

    def access(self, position: int) -> int:
        """The value at position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        value = 0
        for level, zero in enumerate(self.zeros):
            ones = self._rank1(level, position)
            bit = self._rank1(level, position + 1) - ones
            value = value << 1 | bit
            position = zero + ones if bit else position - ones
        return value

    def _range_of(self, value: int, end: int) -> tuple[int, int]:
        lo, hi = 0, end
        for level, zero in enumerate(self.zeros):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (zero + a, zero + b) if value >> (len(self.zeros) - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of value before position end (default: in the whole sequence)."""
        if value >> len(self.zeros):
            return 0
        lo, hi = self._range_of(value, self.n if end is None else end)
        return hi - lo

    def find(self, value: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence of value."""
        if nth < 0 or nth >= self.count(value):
            raise IndexError(nth)
        position = self._range_of(value, self.n)[0] + nth
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = value >> (len(self.zeros) - 1 - level) & 1
            position = self._select(level, bit, position - (self.zeros[level] if bit else 0))
        return position

    def to_bytes(self) -> bytes:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        parts = [packer.compress(p.tobytes()) for p in self.planes]
        return struct.pack("<QB", self.n, len(parts)) + struct.pack(f"<{2 * len(parts)}Q", *self.zeros, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        import zstandard

        n, bits = struct.unpack_from("<QB", data)
        head = struct.unpack_from(f"<{2 * bits}Q", data, 9)
        at, planes = 9 + 16 * bits, []
        for length in head[bits:]:
            planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at:at + length], max_output_size=(n + 7) // 8 + 8), dtype=np.uint8))
            at += length
        return cls(n, planes, list(head[:bits]))


def pack_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard file: documents with their lengths, then the wavelet matrix of all their ids."""
    import zstandard

    documents = zstandard.ZstdCompressor(level=3).compress(json.dumps([doc_ids, [int(n) for n in lengths]]).encode())
    return MAGIC + struct.pack("<Q", len(documents)) + documents + WaveletMatrix.build(ids).to_bytes()


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    import zstandard

    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    length = struct.unpack_from("<Q", data, 4)[0]
    doc_ids, lengths = json.loads(zstandard.ZstdDecompressor().decompress(data[12:12 + length]))
    return doc_ids, np.array(lengths, dtype=np.int64), WaveletMatrix.from_bytes(data[12 + length:])


def read_shard(uri: str) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    system, path = filesystem(uri)
    with system.open_input_stream(path, compression=None) as source:
        return open_shard(source.read())


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, word_ends: bool = True, end_id: int | None = 1,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode the whole texts of docs (doc_id, text) into shards below folder, in ascending doc_id order.

    Returns the shards in that order: shard (its file), part and number (its place), start (ids in all shards
    before it), n_docs, n_tokens. Documents are range-partitioned by doc_id once; a task writes a shard whenever
    it holds shard_tokens ids, so memory does not depend on the partition. A document is never split. A missing text is
    empty, a missing doc_id comes first, rows that repeat a doc_id stand in the order of their texts.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), []
        encoder = shared_encoder(tokenizer, word_ends)
        held_ids: list[np.ndarray] = []
        held_docs: list[int | None] = []
        held_lengths: list[np.ndarray] = []
        held = 0

        def close():
            name = new_file(folder, "wavelet")
            write_file(name, pack_shard(held_docs, np.concatenate(held_lengths), np.concatenate(held_ids)))
            made.append((name, part, len(made), len(held_docs), held))
            held_ids.clear()
            held_docs.clear()
            held_lengths.clear()

        for batch in batches:
            pairs = ((d, t) for lo in range(0, batch.num_rows, 500)
                     for d, t in zip(*(c.to_pylist() for c in batch.slice(lo, 500).columns)))
            for block in text_blocks(pairs, 1, min(shard_tokens, 1 << 20)):
                ids, lengths = encoder.encode([t for _, t in block])
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(lengths), end_id)
                    lengths = lengths + 1
                held_ids.append(ids)
                held_lengths.append(lengths)
                held_docs.extend(d for d, _ in block)
                held += len(ids)
                if held >= shard_tokens:
                    close()
                    held = 0
        if held_docs:
            close()
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)],
                                         ["shard", "part", "number", "n_docs", "n_tokens"])

    made = stored(rows.mapInArrow(write, "shard string, part int, number int, n_docs long, n_tokens long"), "token-shards")
    parts = made.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return made.join(parts, "part").select(
        "shard", "part", "number", (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_docs", "n_tokens")


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the shards; ids are little-endian unsigned 32-bit integers."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids, lengths, matrix = read_shard(name)
                data, ends = memoryview(matrix.values().astype("<u4").tobytes()), np.cumsum(lengths)
                for lo in range(0, len(doc_ids), 500):
                    hi = min(lo + 500, len(doc_ids))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[lo:hi], pa.int64()), pa.array(start + ends[lo:hi] - lengths[lo:hi]), pa.array(lengths[lo:hi]),
                         pa.array([data[4 * (e - n):4 * e] for e, n in zip(ends[lo:hi], lengths[lo:hi])], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    return (spread(shards.select("shard", "start"), "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))


def token_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the shards to the shared folder and return what they hold."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer))
