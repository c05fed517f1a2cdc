"""Toxicity: a bidirectional gated recurrent network with attention pooling, over words and their characters."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, whole_text
from .shingles import Numbers

WINDOW, STRIDE = 32, 24
BUCKETS, WIDTH, HIDDEN = 1 << 14, 16, 12
ORDERS = (3, 4, 5)
SAMPLE_ROWS, SAMPLE_CHARS = 1200, 20_000
"""Bounds on the labelled rows that the network is fitted on: so many texts labelled 1, three times as many labelled
0, none longer than SAMPLE_CHARS. Scoring has no bound."""
WORDS_HELD = 1 << 16
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def split_words(text: str) -> list[str]:
    return text.lower().split()


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all words in a row, number of features of each): the word itself and its character n-grams
    with both ends marked, each hashed; marks around a word are left out unless nothing else is there."""
    bare = [f"\x02{w.strip(_EDGE) or w}\x03" for w in words]
    points = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, bare), np.int64, len(bare))
    ends = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(bare)), lengths)
    rolled = np.zeros(len(points), dtype=np.uint64)
    powers = np.cumprod(np.full(int(lengths.max()), 0x100000001B3, dtype=np.uint64))
    place = np.arange(len(points)) - (ends - lengths)[word_of]
    rolled = np.add.reduceat((points.astype(np.uint64) + np.uint64(7)) * powers[place], ends - lengths)
    owners, values = [np.arange(len(bare))], [rolled]
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            continue
        inside = word_of[:n] == word_of[order - 1:]
        mixed = np.full(n, order, dtype=np.uint64)
        for i in range(order):
            mixed = (mixed ^ points[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        owners.append(word_of[:n][inside])
        values.append(mixed[inside])
    owner, value = np.concatenate(owners), np.concatenate(values)
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(owner, kind="stable")
    return (value[order] >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64), np.bincount(owner, minlength=len(bare))


def windows_of(n: int) -> list[int]:
    """Starts of the overlapping windows that cover n words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class ToxicityNet:
    """Parameters by name; the forward pass takes the gate inputs of windows of words."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 7) -> ToxicityNet:
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        p = {"embed": draw(BUCKETS, WIDTH, scale=0.3), "attend": draw(2 * HIDDEN, scale=0.1), "out": draw(2 * HIDDEN, scale=0.3),
             "bias": np.full(1, -2, dtype=np.float32)}
        for way in "fb":
            p[f"in_{way}"] = draw(WIDTH, 3 * HIDDEN, scale=0.4)
            p[f"rec_{way}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.25)
            p[f"gate_{way}"] = np.concatenate((np.ones(HIDDEN), np.zeros(2 * HIDDEN))).astype(np.float32)
        return cls(p)

    def vectors(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Word vectors: the mean of the vectors of their features, scaled to keep rare ones visible."""
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        return np.add.reduceat(self.p["embed"][features], starts, axis=0) / np.sqrt(lengths)[:, None].astype(np.float32)

    def inputs(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        return {way: vectors @ self.p[f"in_{way}"] + self.p[f"gate_{way}"] for way in "fb"}

    def _run(self, way: str, gates: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States [time, window, unit] of one direction; gates are [time, window, 3 units]: update, reset, new."""
        steps, n, _ = gates.shape
        rec, h = self.p[f"rec_{way}"], np.zeros((n, HIDDEN), dtype=np.float32)
        out = np.empty((steps, n, HIDDEN), dtype=np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            r = h @ rec
            both = _sigmoid(gates[t, :, :2 * HIDDEN] + r[:, :2 * HIDDEN])
            z, s = both[:, :HIDDEN], both[:, HIDDEN:]
            new = np.tanh(gates[t, :, 2 * HIDDEN:] + s * r[:, 2 * HIDDEN:])
            if keep is not None:
                keep.append((t, h, z, s, new, r[:, 2 * HIDDEN:]))
            step = z * (h - new) + new
            h = np.where(mask[t][:, None], step, h) if not mask[t].all() else step
            out[t] = h
        return out

    def logits(self, gates: dict[str, np.ndarray], mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """One logit per window: attention over the states of both directions. mask is [time, window]."""
        keep = {way: [] if kept is not None else None for way in "fb"}
        states = np.concatenate([self._run(way, gates[way], mask, keep[way]) for way in "fb"], axis=2)
        weight = np.where(mask, states @ self.p["attend"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        if kept is not None:
            kept |= {"keep": keep, "states": states, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(self, vectors: np.ndarray, words: np.ndarray, mask: np.ndarray, target: np.ndarray, cost: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted log loss for windows words[time, window] of word vectors; and those of the vectors."""
        kept: dict = {}
        table = self.inputs(vectors)
        logit = self.logits({way: table[way][words] for way in "fb"}, mask, kept)
        d = ((_sigmoid(logit) - target) * cost / len(target)).astype(np.float32)
        states, weight, pooled = kept["states"], kept["weight"], kept["pooled"]
        g = {"bias": d.sum(keepdims=True), "out": pooled.T @ d}
        d_pooled = d[:, None] * self.p["out"]
        d_weight = np.einsum("nh,tnh->tn", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.p["attend"]
        d_vectors = np.zeros_like(vectors)
        for k, way in enumerate("fb"):
            rec, d_rec = self.p[f"rec_{way}"], np.zeros_like(self.p[f"rec_{way}"])
            d_gates = np.zeros((*words.shape, 3 * HIDDEN), dtype=np.float32)
            carry = np.zeros((words.shape[1], HIDDEN), dtype=np.float32)
            for t, h, z, s, new, r_new in reversed(kept["keep"][way]):
                on = mask[t][:, None]
                total = carry + d_states[t, :, k * HIDDEN:(k + 1) * HIDDEN]
                d_h = np.where(on, total, 0)
                d_new = d_h * (1 - z) * (1 - new * new)
                d_z = d_h * (h - new) * z * (1 - z)
                d_s = d_new * r_new * s * (1 - s)
                d_pre = np.concatenate((d_z, d_s, d_new), axis=1)
                d_r = np.concatenate((d_z, d_s, d_new * s), axis=1)
                d_gates[t] = d_pre
                d_rec += h.T @ d_r
                carry = np.where(on, d_h * z + d_r @ rec.T, total)
            g[f"rec_{way}"] = d_rec
            flat = d_gates.reshape(-1, 3 * HIDDEN)
            g[f"gate_{way}"] = flat.sum(axis=0)
            d_table = _sum_rows(words.ravel(), flat, len(vectors))
            g[f"in_{way}"] = vectors.T @ d_table
            d_vectors += d_table @ self.p[f"in_{way}"].T
        return g, d_vectors


def _sum_rows(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """values summed by owner, as n rows."""
    out = np.zeros((n, values.shape[1]), dtype=np.float32)
    order = np.argsort(owner, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(owner[order]) > 0)))
    out[owner[order][first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, d in g.items():
            at = rows.get(k, slice(None))
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * d
            self.v[k][at] = 0.999 * self.v[k][at] + 0.001 * d * d
            p[k][at] -= scale * self.m[k][at] / (np.sqrt(self.v[k][at]) + 1e-7)


class _Sample:
    """Labelled texts as word numbers, with the features of the distinct words."""

    def __init__(self, texts: list[str]):
        numbers = Numbers()
        numbers[""]
        self.docs = [numbers.of(split_words(t)) for t in texts]
        words = list(numbers)
        made = [word_features(words[lo:lo + 8192]) for lo in range(0, len(words), 8192)]
        self.features = np.concatenate([f.astype(np.uint16) for f, _ in made])
        self.lengths = np.concatenate([n for _, n in made])
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of some words in a row, and how many each has."""
        return (np.concatenate([self.features[self.starts[w]:self.starts[w] + n] for w, n in zip(words, self.lengths[words])]).astype(np.int64),
                self.lengths[words])

    def window(self, doc: int, start: int) -> np.ndarray:
        part = self.docs[doc][start:start + WINDOW]
        return np.concatenate((part, np.full(WINDOW - len(part), -1)))


def fit_toxicity(texts: list[str], labels: list[int], epochs: int = 12, steps: int = 1200, batch: int = 64, rate: float = 0.004,
                 seed: int = 7) -> ToxicityNet:
    """Fit on whole texts with a label each, for `epochs` or as many more as make `steps`. A text is labelled, not its
    windows: the first third of the epochs takes windows at random, the others the window of each text that the
    network finds most toxic, found anew in every second one."""
    net, rng = ToxicityNet.new(seed), np.random.default_rng(seed)
    if not texts:
        return net
    sample, target = _Sample(texts), np.array(labels, dtype=np.float32)
    starts = [windows_of(len(d)) for d in sample.docs]
    net.p["bias"][0] = np.log((target.sum() + 1) / (len(target) - target.sum() + 1))
    adam = _Adam(net.p, rate)
    epochs, worst = max(epochs, -(-steps * batch // (2 * len(starts)))), []

    def most_toxic() -> list[tuple[int, int]]:
        """The highest window of each text, a few texts at a time."""
        out = []
        for lo in range(0, len(starts), 100):
            some = [(d, s) for d in range(lo, min(lo + 100, len(starts))) for s in starts[d]]
            words = np.stack([sample.window(*w) for w in some], axis=1)
            met, local = np.unique(words, return_inverse=True)
            table = net.inputs(net.vectors(*sample.of(np.maximum(met, 0))))
            scores = _scored(net, table, np.where(words >= 0, local.reshape(words.shape), -1))
            owner = np.array([d for d, _ in some])
            order = np.lexsort((-scores, owner))
            out += [some[i] for i in order[np.concatenate(([True], np.diff(owner[order]) > 0))]]
        return out

    for epoch in range(epochs):
        noisy = epoch < epochs // 3
        if noisy:
            chosen = [(d, ss[rng.integers(len(ss))]) for d, ss in enumerate(starts) for _ in range(2)]
        else:
            if not worst or epoch % 2 == 0:
                worst = most_toxic()
            chosen = worst + [(d, ss[rng.integers(len(ss))]) for d, ss in enumerate(starts) if not target[d]]
        adam.rate = rate * (0.3 if epoch >= epochs - 3 else 1)
        for at in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)):
            words = np.stack([sample.window(*chosen[i]) for i in at], axis=1)
            mask = words >= 0
            mask[0] = True
            met, local = np.unique(np.maximum(words, 0), return_inverse=True)
            features, lengths = sample.of(met)
            y = target[[chosen[i][0] for i in at]]
            g, d_vectors = net.gradients(net.vectors(features, lengths), local.reshape(words.shape), mask, y, np.ones(len(y), np.float32))
            rows, back = np.unique(features, return_inverse=True)
            d_embed = _sum_rows(back, np.repeat(d_vectors / np.sqrt(lengths)[:, None].astype(np.float32), lengths, axis=0), len(rows))
            adam.step(net.p, g | {"embed": d_embed}, {"embed": rows})
    return net


def _scored(net: ToxicityNet, table: dict[str, np.ndarray], words: np.ndarray) -> np.ndarray:
    """Probabilities of windows words[time, window] of word numbers, -1 beyond a text."""
    mask = words >= 0
    mask[0] = True
    at = np.maximum(words, 0)
    return _sigmoid(net.logits({way: table[way][at] for way in "fb"}, mask))


class ToxicityScorer:
    """Scores texts; gate inputs are made once per distinct word, in a table of bounded size."""

    def __init__(self, net: ToxicityNet, held: int = WORDS_HELD):
        self.net, self.held = net, held
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.table = {way: np.zeros((0, 3 * HIDDEN), dtype=np.float32) for way in "fb"}

    def scores(self, texts: list[str]) -> np.ndarray:
        """The score of a text is that of its most toxic window; all windows of all texts are scored."""
        if len(self.numbers) > self.held:
            self._forget()
        self.numbers[""]
        docs = [self.numbers.of(split_words(t)) for t in texts]
        if fresh := self.numbers.fresh:
            made = self.net.inputs(self.net.vectors(*word_features(fresh)))
            self.table = {way: np.concatenate((self.table[way], made[way])) for way in "fb"}
            fresh.clear()
        starts = [windows_of(len(d)) for d in docs]
        owner = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
        base = np.concatenate(([0], np.cumsum([len(d) for d in docs])[:-1])) if docs else np.zeros(0, np.int64)
        flat = np.concatenate([*docs, np.full(WINDOW, -1)])
        first = np.concatenate([b + np.array(s) for b, s in zip(base, starts)]).astype(np.int64)
        end = np.repeat(base + [len(d) for d in docs], [len(s) for s in starts])
        out = np.zeros(len(docs))
        for lo in range(0, len(first), 2048):
            at = first[lo:lo + 2048] + np.arange(WINDOW)[:, None]
            words = np.where(at < end[lo:lo + 2048], flat[np.minimum(at, len(flat) - 1)], -1)
            np.maximum.at(out, owner[lo:lo + 2048], _scored(self.net, self.table, words))
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic",
                    rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int]]:
    """Texts and labels to fit on, chosen by the hash of their doc_id among the rows for which `learn` holds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1)").filter(learn)
    chosen = []
    for value, most in ((1, rows), (0, 3 * rows)):
        order = known.filter(F.col("y") == value).groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen += [(r["doc_id"], value) for r in order.limit(most).collect() if r["doc_id"] is not None]
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, y int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.length("text") <= chars).join(F.broadcast(ids), "doc_id")
    found = sorted((r["doc_id"], r["y"], r["text"]) for r in texts.collect())
    return [t for _, _, t in found], [y for _, y, _ in found]


def score_toxicity(docs: DataFrame, net: ToxicityNet, keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """Columns `keep` of docs (default: all) with score and predicted (1 from the threshold on). A missing text is empty,
    and an empty text has the score of no words at all; a text of any length is scored in all its windows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = bounded_batches(docs).select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], whole_text().alias("_text"))
    kept = rows.drop("_text")
    out_schema = kept.withColumns({"_score": F.lit(0.0)}).schema
    kinds = to_arrow_schema(kept.schema)

    def score(batches):
        scorer = ToxicityScorer(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 250):
                part = batch.slice(lo, 250)
                texts = part.column(part.num_columns - 1).to_pylist()
                columns = [part.column(i).cast(kinds.field(i).type) for i in range(len(kinds))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scorer.scores(texts), pa.float64())], [*kinds.names, "_score"])

    made = rows.mapInArrow(score, out_schema)
    return made.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias("score"),
                       (F.col("_score") >= threshold).cast("int").alias("predicted"))
