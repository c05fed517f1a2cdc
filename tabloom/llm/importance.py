"""Importance resampling towards a target: documents whose word n-grams look like those of the target are drawn.

Every text is scanned once. Its separators collapse to single spaces, and one overlapped regex scan per order, fenced by
lookarounds at word boundaries, yields the n-grams as spans of that text; the crc32 of a span is its bucket. The
buckets of a document are kept as packed numbers, so that the second pass, which needs the counts of the whole corpus,
reads numbers and no text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..ordering import ordered_index
from .common import bounded_batches, stored, whole_text

BUCKETS = 10_000
MOST_BUCKETS = 1 << 20
"""Bound on the buckets: their counts are summed on the driver and their gains go to every task."""
_SPACED = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
_WHOLE = itemgetter(0)


def collapsed(text: str) -> bytes:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text with A-Z in lower case, as UTF-8, one space between two."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().translate(_SPACED).split())


def span_pattern(order: int):
    """Runs of `order` words in a collapsed text. Scanned with overlaps, a match starts at every word that has enough
    words after it; the lookarounds keep a match from starting or ending inside a word."""
    import regex

    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (order - 1))


def feature_buckets(line: bytes, patterns: Sequence, buckets: int) -> np.ndarray:
    """Bucket of every n-gram of a collapsed text, repeats included."""
    found = [np.fromiter(map(zlib.crc32, map(_WHOLE, p.finditer(line, overlapped=True))), np.uint32) for p in patterns]
    return np.concatenate(found) % np.uint32(buckets)


def scan_features(docs: DataFrame, orders: Sequence[int] = (1, 2), buckets: int = BUCKETS, id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, features) for every row; features holds little-endian bucket numbers."""
    import pyarrow as pa

    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")
    kind = _number(buckets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [span_pattern(n) for n in orders]
        for batch in batches:
            words, packed = [], []
            for text in batch.column(1):
                line = collapsed(text.as_py())
                words.append(line.count(b" ") + 1 if line else 0)
                packed.append(feature_buckets(line, patterns, buckets).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "n_words", "features"])

    rows = bounded_batches(docs).select(F.col(f"`{id}`").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_words long, features binary")


def _number(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows. A task returns the buckets it met; these partial counts are summed."""
    import pyarrow as pa

    kind = _number(buckets)

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), kind)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for row in scanned.select("features").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def _numbers(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers packed in a binary column, and how many each row has."""
    rows = column.to_pylist()
    sizes = np.array([len(r) for r in rows], dtype=np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), dtype=kind), sizes


def bucket_gains(ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share of the target / share of the corpus)) of every bucket, each count raised by one."""
    ours, theirs = [int(n) for n in ours], [int(n) for n in theirs]
    s, t = sum(ours) + len(ours), sum(theirs) + len(theirs)
    return np.array([math.floor(1000 * math.log((b + 1) * s / ((a + 1) * t))) for a, b in zip(ours, theirs)], dtype=np.int64)


def weigh(scanned: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of a row's features, 0 without any."""
    import pyarrow as pa

    kind = _number(len(gains))

    def weights(batches):
        for batch in batches:
            numbers, sizes = _numbers(batch.column(2), kind)
            ends = np.concatenate(([0], np.cumsum(gains[numbers])))
            places = np.concatenate(([0], np.cumsum(sizes)))
            sums = ends[places[1:]] - ends[places[:-1]]
            mean = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), pa.array(mean)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return scanned.mapInArrow(weights, "doc_id long, n_words long, n_features long, weight long")


def resample_to_target(docs: DataFrame, target: DataFrame, orders: Sequence[int] = (1, 2), buckets: int = BUCKETS,
                       share: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of docs.

    score is the weight plus Gumbel noise that depends on seed and doc_id alone; of the N rows with at least
    `least_words` words the floor(share * N / 100) best are drawn, ranked from 1; equal scores by doc_id. The others
    have no rank. Neither the result nor the draw depends on partitions.

    A missing text is empty: no features, weight 0. A missing doc_id enters the noise as the empty text and comes last
    among equal scores. Rows that repeat an id are rows of their own; where they also tie in score, the order among
    them is any. Without documents the result is empty, without a target all its counts are 0. Other columns of docs
    are not read.
    """
    scanned = stored(scan_features(docs, orders, buckets), "ngrams")
    gains = bucket_gains(bucket_counts(scanned, buckets), bucket_counts(scan_features(target, orders, buckets, target.columns[0]), buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weigh(scanned, gains).withColumn("score", F.col("weight") + noise).withColumn("_row", F.monotonically_increasing_id())
    scored = stored(scored, "scores")

    # Scores are whole numbers: their counts are far fewer than the rows, and find the score at which the draw ends.
    fit = F.col("n_words") >= least_words
    counts = scored.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    drawn, cut = _score_cut(counts, share)
    best = fit & (F.col("score") >= F.lit(cut)) if drawn else F.lit(False)
    placed = ordered_index(scored.filter(best), [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("_row")], name="place")
    ranked = placed.withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1)).drop("place", "_row")
    rest = scored.filter(~best).drop("_row").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def _score_cut(counts: DataFrame, share: int) -> tuple[int, int]:
    """(rows drawn, score of the last of them) from the rows per score."""
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    counts = stored(counts, "score_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    drawn = share * total // 100
    if not drawn:
        return 0, 0
    row = counts.withColumn("upto", F.sum("n").over(above)).filter(F.col("upto") >= drawn).agg(F.max("score")).first()
    return drawn, row[0]
