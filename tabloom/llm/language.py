"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, whole_text

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MODEL_CELLS = 1 << 26
"""Bound on languages x buckets of a model, which is broadcast; more is an error and not a cut."""
_SPACE = np.uint32(32)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> itself if it is a letter, else space; code points beyond the first plane are kept."""
    if not _LETTERS:
        _LETTERS.append(np.array([i if chr(i).isalpha() else 32 for i in range(1 << 16)], dtype=np.uint32))
    return _LETTERS[0]


def ngram_buckets(text: str, buckets: int = BUCKETS, orders=ORDERS) -> np.ndarray:
    """Hashed character n-grams of the lower-cased letters of a text; runs of anything else are one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(points < (1 << 16), _letters()[np.minimum(points, 0xFFFF)], points)
    solid = points != _SPACE
    if not solid.any():
        return np.zeros(0, dtype=np.int64)
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    points = np.concatenate(([_SPACE], points[keep]))
    parts, shift = [], np.uint32(32 - (buckets.bit_length() - 1))
    for order in orders:
        n = len(points) - order + 1
        if n <= 0:
            continue
        mixed = np.full(n, order, dtype=np.uint32)
        for i in range(order):
            mixed = (mixed ^ points[i:i + n]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        parts.append(((mixed * np.uint32(0x85EBCA77)) >> shift).astype(np.int64))
    return np.concatenate(parts)


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities: weights[bucket, language] and one prior per language."""

    languages: tuple[str, ...]
    weights: np.ndarray
    priors: np.ndarray

    def posterior(self, texts: list[str]) -> np.ndarray:
        """Probability of each language for each text, all texts in one sparse product."""
        rows = [ngram_buckets(t, len(self.weights)) for t in texts]
        out = np.tile(self.priors, (len(texts), 1))
        sizes = np.array([len(r) for r in rows])
        full = np.flatnonzero(sizes)
        if len(full):
            starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            out[full] += np.add.reduceat(self.weights[np.concatenate([rows[i] for i in full])], starts, axis=0, dtype=np.float64)
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def fit_languages(docs: DataFrame, learn: Column | None = None, lang: str = "lang", buckets: int = BUCKETS,
                  smoothing: float = 0.5) -> LanguageModel:
    """Count the n-grams of all rows that have a text and a language (and for which `learn` holds).

    Every task counts in numpy and returns the buckets it met, which are summed per (language, bucket): no row of
    text is shuffled, and a language with most of the rows is a sum of few partial counts like any other.
    """
    rows = bounded_batches(docs).filter(F.col("text").isNotNull() & F.col(lang).isNotNull())
    rows = rows.filter(learn) if learn is not None else rows
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))

    def count(batches):
        import pyarrow as pa

        held: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}

        def flush():
            for name, counts in held.items():
                met = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(met) + 1), pa.string()), pa.array(np.append(met, -1).astype(np.int32)),
                     pa.array(np.append(counts[met], docs_of[name]).astype(np.int64))], ["lang", "bucket", "n"])
            held.clear()
            docs_of.clear()

        for batch in batches:
            groups: dict[str, list[np.ndarray]] = {}
            for text, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                groups.setdefault(name, []).append(ngram_buckets(text, buckets))
            for name, parts in groups.items():
                if name not in held and len(held) == 64:
                    yield from flush()
                counts = np.bincount(np.concatenate(parts), minlength=buckets)
                held[name] = held[name] + counts if name in held else counts
                docs_of[name] = docs_of.get(name, 0) + len(parts)
        yield from flush()

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = counts.cache()
    sizes = counts.filter("bucket = -1").orderBy("lang").limit(MODEL_CELLS // buckets + 1).collect()
    if len(sizes) > MODEL_CELLS // buckets:
        raise ValueError("more languages than a broadcast model can hold; use fewer buckets")
    names = tuple(r["lang"] for r in sizes)
    table = np.full((buckets, len(names)), smoothing)
    found = counts.filter("bucket >= 0").toPandas()
    counts.unpersist()
    at = {n: i for i, n in enumerate(names)}
    np.add.at(table, (found["bucket"].to_numpy(), found["lang"].map(at).to_numpy(dtype=np.int64)), found["n"].to_numpy())
    priors = np.log(np.array([r["n"] for r in sizes], dtype=float) / max(1, sum(r["n"] for r in sizes))) if names else np.zeros(0)
    return LanguageModel(names, np.log(table / table.sum(axis=0, keepdims=True)).astype(np.float32), priors)


def predict_language(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of docs (default: all) with lang_pred and score, the posterior of that language.

    `und` with score 0 for a text that is missing or has no letter, and for all texts if nothing was learned. Equal
    posteriors go to the first language in text order.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = bounded_batches(docs).select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], whole_text().alias("_text"))
    kept = rows.drop("_text")
    out_schema = kept.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    kinds = to_arrow_schema(kept.schema)

    def predict(batches):
        import regex

        letter = regex.compile(r"\p{L}")
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = part.column(part.num_columns - 1).to_pylist()
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                known = [i for i, t in enumerate(texts) if letter.search(t)] if shared.value.languages else []
                if known:
                    sure = shared.value.posterior([texts[i] for i in known])
                    best = sure.argmax(axis=1)
                    for i, k, s in zip(known, best, sure[np.arange(len(known)), best]):
                        names[i], scores[i] = shared.value.languages[k], s
                columns = [part.column(i).cast(kinds.field(i).type) for i in range(len(kinds))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 [*kinds.names, "lang_pred", "score"])

    made = rows.mapInArrow(predict, out_schema)
    return made.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")
