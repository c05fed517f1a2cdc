"""Language-model scoring: causal self-attention over subword ids, together with word counts of the whole corpus.

The network predicts the next subword: one head of masked attention over a window, and an output that mixes a fixed
number of distributions over the vocabulary, so that a token costs the same whatever the vocabulary's size. Frequent words are
vocabulary entries of their own, with their counts in all training texts; other words are subwords of a public tokenizer.

A sample only gives the network's first weights. All of its weights are then fitted on all training texts: every task takes
gradient steps over its texts from the same first weights, and the weights of all tasks are averaged, each by the ids it saw.
The distributions that the network mixes are learned in the same pass, which sums, for each id, how much of it each
distribution explains in its context.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, id_bucket, stored, whole_text
from .tokens import TextEncoder

WINDOW, STRIDE = 64, 48
WIDTH, EXPERTS = 24, 64
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_TOKENS = 3000, 20_000, 1_000_000
"""Bounds on the training rows that the network's first weights come from. Word counts, the weights that score and the
experts' distributions are learned from all training rows."""
SHARE_BUCKETS = 64
FREQUENT, UNITS, UNIT_COUNT = 1 << 18, 1 << 16, 5
"""Bounds on what is broadcast: words whose counts every task knows, and how many of them (met UNIT_COUNT times or
more) are vocabulary entries. The counts of other words are looked up by a join."""
AFFINITY_PRIOR = 0.3
WORDS_HELD = 3 << 15
BATCH, RATE = 64, 0.005
"""Windows of a step over all training texts, and its largest length."""
START, END = 49406, 49407
"""Ids of the tokenizer's start and end; START also stands for a word that the tokenizer drops."""
BLOCK_WORDS = 1 << 20
_AGO = np.arange(WINDOW)[:, None] - np.arange(WINDOW)


@dataclass
class AttentionLM:
    """Weights by name; `experts` is [vocabulary, expert]: the distributions that the output mixes; `counts`, what each
    expert explained of each id while the weights were fitted."""

    p: dict[str, np.ndarray]
    experts: np.ndarray
    counts: np.ndarray | None = None

    @classmethod
    def new(cls, vocabulary: int, seed: int = 5) -> AttentionLM:
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
        p = {"embed": draw(vocabulary, WIDTH, scale=0.5), "near": np.zeros(WINDOW, dtype=np.float32), "bias": np.zeros(WIDTH, dtype=np.float32),
             "gates": draw(WIDTH, EXPERTS, scale=0.5), "gate_bias": np.zeros(EXPERTS, dtype=np.float32)}
        p |= {k: draw(WIDTH, WIDTH, scale=0.3) for k in ("query", "key", "value", "own", "seen")}
        experts = rng.gamma(1.0, 1.0, (vocabulary, EXPERTS)).astype(np.float32)
        return cls(p, experts / experts.sum(axis=0))

    def _forward(self, table: np.ndarray, at: np.ndarray, first: int) -> tuple[np.ndarray, ...]:
        """Projections [window, position, query key value own], attention (not normalised) and its norm, what is seen, hidden
        layer and a one, and gates (not normalised), a row per window and position; queries from position `first` on. table: projections of
        ids, at[window, position]: rows of it."""
        p, (b, t) = self.p, at.shape
        near = np.where(_AGO >= 0, p["near"][np.maximum(_AGO, 0)], np.float32(-1e4)).astype(np.float32)[first:t, :t]
        z = table.take(at.ravel(), axis=0).reshape(b, t, 4 * WIDTH)
        q, k, v, own = (z[:, :, i * WIDTH:(i + 1) * WIDTH] for i in range(4))
        a = q[:, first:] @ k.transpose(0, 2, 1)
        a += near
        if a.max() > 30:
            np.minimum(a, 30, out=a)
        np.exp(a, out=a)
        norm = 1 / (a.reshape(-1, t) @ np.ones((t, 1), np.float32)).reshape(b, t - first, 1)
        o = a @ v
        o *= norm
        h = np.ones((b * (t - first), WIDTH + 1), o.dtype)
        seen = o + own[:, first:]
        seen += p["bias"]
        np.tanh(seen.reshape(-1, WIDTH), out=h[:, :WIDTH])
        g = h @ np.concatenate((p["gates"], p["gate_bias"][None]))
        if (np.abs(p["gates"]).sum(axis=0) + p["gate_bias"]).max() > 30:
            np.minimum(g, 30, out=g)
        return z, a, norm, o, h, np.exp(g, out=g)

    def projected(self, ids: np.ndarray) -> np.ndarray:
        """Projections of ids, a row each."""
        return self.p["embed"].take(ids, axis=0) @ self._projections()

    def _projections(self) -> np.ndarray:
        p = self.p
        return np.concatenate((p["query"] / np.float32(np.sqrt(WIDTH)), p["key"], p["value"] @ p["seen"], p["own"]), axis=1)

    def gates(self, ids: np.ndarray, first: int = 0) -> np.ndarray:
        """Weights of the experts after each position, from `first` on, of windows ids[window, position]; a position sees itself
        and what is before it."""
        g = self._forward(self.projected(ids.ravel()), np.arange(ids.size).reshape(ids.shape), first)[-1]
        g /= g.sum(axis=1, keepdims=True)
        return g.reshape(len(ids), -1, EXPERTS)

    def log_probability(self, ids: np.ndarray, target: np.ndarray, first: int = 0, table: np.ndarray | None = None) -> np.ndarray:
        """Natural log probability of target[window, position] after the ids up to that position, from position `first` on. With a
        table of projections, ids are rows of it."""
        if table is None:
            table, ids = self.projected(ids.ravel()), np.arange(ids.size).reshape(ids.shape)
        g = self._forward(table, ids, first)[-1]
        part = np.einsum("nm,nm->n", g, self.experts.take(target[:, first:].ravel(), axis=0))
        return np.log(part / (g @ np.ones(EXPERTS, np.float32)) + np.float32(1e-30)).reshape(len(ids), -1)

    def gradients(self, ids: np.ndarray, target: np.ndarray, on: np.ndarray, first: int = 0) -> tuple[dict, np.ndarray, float]:
        """Gradients of the mean loss over positions, from `first` on, weighted by `on`, the share of each expert in each of
        their targets, so weighted, and the loss. An id is projected once, its gradients are summed before they go back through the projections."""
        p, on = self.p, on[:, first:].reshape(-1, 1)
        same = Same(ids.ravel())
        x, projections = p["embed"].take(same.ids, axis=0), self._projections()
        z, a, norm, o, h, g = self._forward(x @ projections, same.of.reshape(ids.shape), first)
        q, k, v = (z[:, :, i * WIDTH:(i + 1) * WIDTH] for i in range(3))
        ones, n = np.ones((EXPERTS, 1), np.float32), max(1, on.sum())
        share = self.experts.take(target[:, first:].ravel(), axis=0)
        share *= g
        total, gate_sum = share @ ones + np.float32(1e-30), g @ ones
        share *= on / total
        g *= on / gate_sum
        g -= share
        part = 1 / np.asarray(n, g.dtype)
        gates = h.T @ g * part
        out = {"gates": gates[:WIDTH], "gate_bias": gates[WIDTH]}
        d_h = g @ (p["gates"].T * part)
        h = h[:, :WIDTH]
        d_h *= 1 - h * h
        out["bias"] = d_h.sum(axis=0)
        d_o = d_h.reshape(o.shape)
        d_a = d_o * norm
        d_s = d_a @ v.transpose(0, 2, 1)
        d_s -= np.einsum("btd,btd->bt", d_a, o)[:, :, None]
        d_s *= a
        d_z = np.empty_like(z)
        d_z[:, :first] = 0
        np.matmul(d_s, k, out=d_z[:, first:, :WIDTH])
        np.matmul(d_s.transpose(0, 2, 1), q[:, first:], out=d_z[:, :, WIDTH:2 * WIDTH])
        np.matmul(a.transpose(0, 2, 1), d_a, out=d_z[:, :, 2 * WIDTH:3 * WIDTH])
        d_z[:, first:, 3 * WIDTH:] = d_o
        ago = _AGO[first:ids.shape[1], :ids.shape[1]]
        out["near"] = np.bincount(ago[ago >= 0], weights=(np.ones(len(d_s), d_s.dtype) @ d_s.reshape(len(d_s), -1)).reshape(ago.shape)[ago >= 0], minlength=WINDOW).astype(np.float32)
        d_table = same.sums(d_z.reshape(-1, 4 * WIDTH))
        d_query, d_key, d_seen, d_own = np.split(x.T @ d_table, 4, axis=1)
        out |= {"query": d_query / np.float32(np.sqrt(WIDTH)), "key": d_key, "value": d_seen @ p["seen"].T, "seen": p["value"].T @ d_seen, "own": d_own}
        out["embed"] = (same.ids, d_table @ projections.T)
        return out, share, float(-(np.log(total / gate_sum) * on).sum() / n)


class Same:
    """Places of equal ids: ids are the different ones in order, ids[of] all. A sum goes by halves: of the rows of an id, every second
    one is added to the one before it, until one is left."""

    def __init__(self, ids: np.ndarray):
        many = len(ids)
        packed = np.sort(ids.astype(np.int64) << 32 | np.arange(many))
        self.order, found = packed & 0xFFFFFFFF, packed >> 32
        begins = np.ones(many, bool)
        np.not_equal(found[1:], found[:-1], out=begins[1:])
        self.first = np.flatnonzero(begins)
        self.ids, of = found[self.first], np.cumsum(begins) - 1
        self.of = np.empty(many, np.int64)
        self.of[self.order] = of
        self.rank = np.arange(many) - self.first[of]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Rows of values summed by id; values are overwritten."""
        left, gap = np.flatnonzero(self.rank), 1
        while len(left):
            odd = (self.rank[left] & gap) > 0
            at = left[odd]
            values[self.order[at - gap]] += values[self.order[at]]
            left, gap = left[~odd], 2 * gap
        return values.take(self.order[self.first], axis=0)


class Steps:
    """Adam steps of a network's weights; a row of `embed` moves when its id is met. The other weights are parts of one array."""

    def __init__(self, net: AttentionLM):
        self.net, self.taken = net, 0
        self.names = [k for k in net.p if k != "embed"]
        self.flat, at = np.concatenate([net.p[k].ravel() for k in self.names]), 0
        for k in self.names:
            shape, n = net.p[k].shape, net.p[k].size
            net.p[k], at = self.flat[at:at + n].reshape(shape), at + n
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in (("embed", net.p["embed"]), ("flat", self.flat))}

    def take(self, gradients: dict, pace: float) -> None:
        self.taken += 1
        fix = np.sqrt(1 - 0.999 ** self.taken) / (1 - 0.9 ** self.taken)
        rows, d = gradients["embed"]
        first, second = (m.take(rows, axis=0) for m in self.moments["embed"])
        move = self._move(first, second, d, pace * fix)
        for held, moment in zip(self.moments["embed"], (first, second)):
            held[rows] = moment
        self.net.p["embed"][rows] -= move
        self.flat -= self._move(*self.moments["flat"], np.concatenate([gradients[k].ravel() for k in self.names]), pace * fix)

    @staticmethod
    def _move(first: np.ndarray, second: np.ndarray, d: np.ndarray, pace: float) -> np.ndarray:
        first *= np.float32(0.9)
        move = np.float32(0.1) * d
        first += move
        second *= np.float32(0.999)
        np.multiply(d, d, out=move)
        move *= np.float32(0.001)
        second += move
        np.sqrt(second, out=move)
        move += np.float32(1e-8)
        np.divide(first, move, out=move)
        move *= np.float32(pace)
        return move


def windows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, scored, places in the sequence) [window, position] of one sequence of ids: overlapping windows in which each target is
    scored once, from the second window on with at least WINDOW - STRIDE ids before it."""
    return windows_of_all(ids, np.array([len(ids)]))


def windows_of_all(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of sequences that stand in a row, none of them empty; places are those in the row."""
    many = np.maximum(1, -(-(lengths - (WINDOW - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(len(lengths)), many)
    begin = np.cumsum(lengths) - lengths
    starts = STRIDE * (np.arange(len(owner)) - (np.cumsum(many) - many)[owner])
    given = np.concatenate(([START], ids[:-1]))
    given[begin] = START
    at = starts[:, None] + np.arange(WINDOW)
    n = lengths[owner][:, None]
    scored = (at < n) & ((np.arange(WINDOW) >= WINDOW - STRIDE) | (starts == 0)[:, None])
    at = np.minimum(at, n - 1) + begin[owner][:, None]
    return given[at], ids[at], scored, at


def batches_of(scored: np.ndarray, at_once: int, order: np.ndarray | None = None):
    """(windows, first position to look at): a sequence's first window is scored from its start, others from WINDOW - STRIDE on."""
    order = np.arange(len(scored)) if order is None else order
    for first in (WINDOW - STRIDE, 0):
        chosen = order[scored[order, 0] == (first == 0)]
        for lo in range(0, len(chosen), at_once):
            yield chosen[lo:lo + at_once], first


def share_out(counts: np.ndarray, overall: np.ndarray) -> np.ndarray:
    """Distributions of the experts from the counts [id, expert] that they explain and the share of each id."""
    usual = counts.sum(axis=0) / counts.sum()
    part = (counts + np.float32(AFFINITY_PRIOR) * usual) / (counts.sum(axis=1, keepdims=True) + np.float32(AFFINITY_PRIOR))
    part *= overall[:, None]
    return part / part.sum(axis=0)


def fit_attention(sequences: list[np.ndarray], overall: np.ndarray, epochs: int = 4, batch: int = 48, rate: float = 0.01,
                  seed: int = 5) -> AttentionLM:
    """Fit on sequences of ids that end with END. overall: share of each id in the whole corpus.

    The network is fitted by gradient steps. An expert's distribution is the overall one, each id weighted by the
    expert's share in the sample's targets with that id, so an id that the sample has seldom is still as likely as
    the corpus says."""
    net, rng = AttentionLM.new(len(overall), seed), np.random.default_rng(seed)
    overall = overall.astype(np.float32)
    net.experts = net.experts * overall[:, None]
    net.experts /= net.experts.sum(axis=0)
    if not sequences:
        return net
    seen = np.bincount(np.concatenate([[START], *sequences]), minlength=len(overall)) > 0
    net.p["embed"][~seen] = 0
    ids, target, on = windows_of_all(np.concatenate(sequences), np.array([len(s) for s in sequences]))[:3]
    on = on.astype(np.float32)
    counts = net.experts * np.float32(2000)
    fit = Steps(net)
    steps = max(1, epochs * len(ids) // batch)

    while fit.taken < steps:
        for at in np.array_split(rng.permutation(len(ids)), max(1, len(ids) // batch)):
            g, share, _ = net.gradients(ids[at], target[at], on[at])
            step = fit.taken + 1
            fit.take(g, rate * min(1.0, step / 50) * (1 - 0.9 * step / steps))
            same = Same(target[at].ravel())
            counts[same.ids] += same.sums(share)
            if step % 20 == 0:
                counts *= np.float32(0.9) if step < steps * 0.4 else np.float32(0.98)
                net.experts = share_out(counts, overall)
            if step >= steps:
                break
    net.experts, net.counts = share_out(counts, overall), counts
    return net


class TextIds:
    """Words, ids and counts of blocks of texts. hashes, counts and units are those of the frequent words, units -1 for the
    ones that are no vocabulary entries."""

    def __init__(self, tokenizer: str, hashes: np.ndarray, counts: np.ndarray, units: np.ndarray, held: int = WORDS_HELD):
        self.encoder = TextEncoder(tokenizer, True, held)
        self.hashes, self.counts, self.units = hashes, counts, units

    def of(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of an Arrow array of texts, each with the end as its last word: (ids of all, ids per text, hashes of all words,
        their counts, words per text)."""
        words, lengths, spelled = split_words(texts)
        hashes = word_hashes(spelled)
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        found = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        counts, units = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1)
        counts[found], units[found] = self.counts[at[found]], self.units[at[found]]
        units[0] = -1
        rare = 1 + np.flatnonzero(units[1:] < 0)
        ids, sizes = self.encoder.encode([spelled[i].decode("utf-8", "surrogatepass") for i in rare.tolist()])
        dropped = sizes == 0
        ids = np.insert(ids.astype(np.int64), (np.cumsum(sizes) - sizes)[dropped], START)
        sizes = sizes + dropped
        table = np.concatenate(([END], END + 1 + units[units >= 0], ids)).astype(np.int64)
        starts, many = np.zeros(len(hashes), np.int64), np.ones(len(hashes), np.int64)
        starts[units >= 0] = 1 + np.arange((units >= 0).sum())
        starts[rare], many[rare] = 1 + (units >= 0).sum() + np.cumsum(sizes) - sizes, sizes
        per_word = many[words]
        ends = np.cumsum(per_word)
        steps = np.ones(ends[-1], dtype=np.int64)
        begin = starts[words]
        steps[0] = begin[0]
        steps[ends[:-1]] = begin[1:] - (begin[:-1] + per_word[:-1] - 1)
        return table[np.cumsum(steps)], np.diff(ends[np.cumsum(lengths) - 1], prepend=0), hashes[words], counts[words], lengths


def split_words(texts) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(numbers of the words of all texts in a row, words per text, distinct words by number) of an Arrow array of texts, with A-Z in
    lower case, cut at [\\x20\\x09-\\x0D]+. The end of a text is its last word, b"", number 0."""
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    flat = split.flatten().dictionary_encode()
    spelled = flat.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    number = np.arange(1, 1 + len(spelled))
    blank = spelled.index(b"") if b"" in spelled else -1
    if blank >= 0:
        number[blank] = 0
        number[blank + 1:] -= 1
        del spelled[blank]
    words = number[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    kept = words > 0
    sizes = np.diff(np.concatenate(([0], np.cumsum(kept)))[np.cumsum(sizes)], prepend=0)
    return np.insert(words[kept], np.cumsum(sizes), 0), sizes + 1, [b"", *spelled]


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def log_probabilities(net: AttentionLM, ids: np.ndarray, lengths: np.ndarray, at_once: int = BATCH) -> np.ndarray:
    """Log probability of each id of sequences that stand in a row; each different id is projected once."""
    given, target, scored, at = windows_of_all(ids, lengths)
    met = np.zeros(len(net.experts), bool)
    met[given] = True
    given = (np.cumsum(met) - 1)[given]
    table = net.projected(np.flatnonzero(met))
    out = np.zeros(len(ids), np.float32)
    for chosen, first in batches_of(scored, at_once):
        on = scored[chosen, first:]
        out[at[chosen, first:][on]] = net.log_probability(given[chosen], target[chosen], first, table)[on]
    return out


def sequences_in(batch, most: int = 1 << 18):
    """(ids in a row, lengths, rows) of Arrow batches whose first column holds packed ids; about `most` ids at a time."""
    packed, lo = batch.column(0).to_pylist(), 0
    sizes = np.array([len(b) // 4 for b in packed], dtype=np.int64)
    while lo < len(packed):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), most, side="right")))
        yield np.frombuffer(b"".join(packed[lo:hi]), "<u4").astype(np.int64), sizes[lo:hi], slice(lo, hi)
        lo = hi


class TaskFit:
    """Gradient steps of one task over its texts from the first weights, and what each expert explains of each id in them."""

    def __init__(self, p: dict[str, np.ndarray], counts: np.ndarray, overall: np.ndarray):
        self.before, self.overall = counts, overall.astype(np.float32)
        self.net = AttentionLM({k: v.copy() for k, v in p.items()}, share_out(counts, self.overall))
        self.fit, self.rng = Steps(self.net), np.random.default_rng(5)
        self.explained = np.zeros((len(overall), EXPERTS), np.float32)
        self.met = np.zeros(len(overall), np.int64)
        self.seen, self.renew = 0, 1 << 18

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        given, target, scored, _ = windows_of_all(ids, lengths)
        for chosen, first in batches_of(scored, BATCH, self.rng.permutation(len(scored))):
            g, share, _ = self.net.gradients(given[chosen], target[chosen], scored[chosen].astype(np.float32), first)
            step = self.fit.taken + 1
            self.fit.take(g, RATE * min(1.0, step / 50) / np.sqrt(1 + step / 500))
            same = Same(target[chosen, first:].ravel())
            self.explained[same.ids] += same.sums(share)
        self.met += np.bincount(given[scored], minlength=len(self.met))
        self.seen += len(ids)
        if self.seen >= self.renew:
            self.renew = 2 * self.seen
            self.net.experts = share_out(self.before + self.explained, self.overall)


def fit_all(sequences: DataFrame, shared, vocabulary: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights fitted on all sequences (ids, packed), and [id, expert]: the counts of each id in all of them, dealt to the
    experts by what each explains. shared: the first weights, what the experts explained then, and the share of each id. A task sends its weights, and a row per bucket
    of ids; the rows of a bucket are added one by one, so memory is bounded by the vocabulary. A row of `embed` is averaged over the tasks that met
    its id, by how often they did."""
    import pyarrow as pa

    names = ["bucket", "ids", "met", "shares", "weights"]

    def of_task(batches):
        task = TaskFit(*shared.value)
        for batch in batches:
            for ids, lengths, _ in sequences_in(batch):
                task.add(ids, lengths)
        if not task.seen:
            return
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        row = lambda *c: pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(c, kinds)], names)
        weights = np.concatenate([v.ravel() for k, v in sorted(task.net.p.items()) if k != "embed"]).astype("<f8")
        yield row(SHARE_BUCKETS, b"", np.array([task.seen], "<i8").tobytes(), b"", (task.seen * weights).tobytes())
        used = np.flatnonzero((task.met > 0) | task.explained.any(axis=1))
        for bucket in range(SHARE_BUCKETS):
            own = used[used % SHARE_BUCKETS == bucket]
            if len(own):
                yield row(bucket, own.astype("<i8").tobytes(), task.met[own].astype("<i8").tobytes(), task.explained[own].astype("<f4").tobytes(),
                          (task.met[own][:, None] * task.net.p["embed"][own]).astype("<f4").tobytes())

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, ids, met, shares, weights in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket == SHARE_BUCKETS:
                    met, weights = np.frombuffer(met, "<i8"), np.frombuffer(weights, "<f8")
                    had = held.setdefault(bucket, [np.zeros(1, np.int64), np.zeros((1, 0)), np.zeros((1, len(weights)))])
                    had[0] += met
                    had[2] += weights
                    continue
                if bucket not in held:
                    n = len(range(bucket, vocabulary, SHARE_BUCKETS))
                    held[bucket] = [np.zeros(n, np.int64), np.zeros((n, EXPERTS)), np.zeros((n, WIDTH))]
                at = np.frombuffer(ids, "<i8") // SHARE_BUCKETS
                for total, part, kind in zip(held[bucket], (met, shares, weights), ("<i8", "<f4", "<f4")):
                    total[at] += np.frombuffer(part, kind).reshape(len(at), *total.shape[1:])
        for bucket, (met, shares, weights) in held.items():
            weights /= np.maximum(met, 1)[:, None]
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in (
                met.astype("<i8"), shares.astype("<f4"), weights.astype("<f4")))], ["bucket", "met", "shares", "weights"])

    found = (sequences.mapInArrow(of_task, "bucket long, ids binary, met binary, shares binary, weights binary").repartition("bucket")
             .mapInArrow(add, "bucket long, met binary, shares binary, weights binary"))
    p, explained = {k: v.copy() for k, v in shared.value[0].items()}, np.zeros((vocabulary, EXPERTS), np.float32)
    for r in found.collect():
        weights = np.frombuffer(r["weights"], "<f4")
        if r["bucket"] == SHARE_BUCKETS:
            names = [k for k in sorted(p) if k != "embed"]
            for k, part in zip(names, np.split(weights, np.cumsum([p[k].size for k in names])[:-1])):
                p[k] = part.reshape(p[k].shape).copy()
            continue
        explained[r["bucket"]::SHARE_BUCKETS] = np.frombuffer(r["shares"], "<f4").reshape(-1, EXPERTS)
        met = np.frombuffer(r["met"], "<i8") > 0
        p["embed"][r["bucket"]::SHARE_BUCKETS][met] = weights.reshape(-1, WIDTH)[met]
    return p, explained


def count_words(docs: DataFrame, learn: Column, buckets: int) -> DataFrame:
    """(bucket, hashes, counts, n_words, n_tokens, top_hashes, top_counts), a row per bucket of words, of the whole
    texts of all rows for which `learn` holds. A task sends a word once per half a million different words."""
    import pyarrow as pa

    rows = docs.filter(learn).select(whole_text().alias("text"))

    def count_task(batches):
        hashes, times, held = [], [], 0

        def merged():
            order = np.argsort(h := np.concatenate(hashes), kind="stable")
            h, t = h[order], np.concatenate(times)[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            return h[first], np.add.reduceat(t, first)

        def flush(hashes, times):
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            hashes, times, bucket = hashes[order], times[order], bucket[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
            return pa.RecordBatch.from_arrays([
                pa.array(bucket[cuts[:-1]]), pa.array([hashes[a:b].astype("<u8").tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                pa.array([times[a:b].astype("<i8").tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], ["bucket", "hashes", "counts"])

        for batch in batches:
            if not batch.num_rows:
                continue
            words, _, spelled = split_words(batch.column(0))
            hashes.append(word_hashes(spelled))
            times.append(np.bincount(words, minlength=len(spelled)))
            held += len(spelled)
            if held >= BLOCK_WORDS:
                hashes[:], times[:] = ([a] for a in merged())
                held = len(hashes[0])
                if held >= BLOCK_WORDS // 2:
                    yield flush(hashes.pop(), times.pop())
                    held = 0
        if hashes:
            yield flush(*merged())

    most = max(1, FREQUENT // buckets)

    def merge(found: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(b, "<u8") for b in found["hashes"].to_pylist()])
        times = np.concatenate([np.frombuffer(b, "<i8") for b in found["counts"].to_pylist()])
        order = np.argsort(hashes, kind="stable")
        hashes, times = hashes[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        hashes, times = hashes[first], np.add.reduceat(times, first)
        top = np.sort(np.lexsort((hashes, -times))[:most])
        column = lambda a, kind: pa.array([a.astype(kind).tobytes()], pa.binary())
        return pa.table({"bucket": found["bucket"].slice(0, 1).combine_chunks(), "hashes": column(hashes, "<u8"), "counts": column(times, "<i8"),
                         "n_words": pa.array([len(hashes)], pa.int64()), "n_tokens": pa.array([int(times.sum())], pa.int64()),
                         "top_hashes": column(hashes[top], "<u8"), "top_counts": column(times[top], "<i8")})

    return (rows.mapInArrow(count_task, "bucket long, hashes binary, counts binary").groupBy("bucket")
            .applyInArrow(merge, "bucket long, hashes binary, counts binary, n_words long, n_tokens long, top_hashes binary, top_counts binary"))


def training_sample(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[str]:
    """Texts to fit the network on, chosen by the hash of their doc_id and in its order, so that any first part of them is a
    sample of the corpus too; of a longer text, `chars` characters from a place that
    the hash chooses."""
    ids = (docs.filter(learn).select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    room = F.greatest(F.length("text") - chars + 1, F.lit(1))
    texts = texts.withColumn("text", F.substring("text", F.pmod(F.xxhash64("doc_id"), room).cast("int") + 1, F.lit(chars)))
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], i) for i, r in enumerate(ids.collect())], "doc_id long, place long")
    return [r["text"] for r in sorted(texts.join(F.broadcast(chosen), "doc_id").collect(), key=lambda r: (r["place"], r["text"]))]


def overall_shares(sequences: list[np.ndarray], unit_counts: np.ndarray) -> np.ndarray:
    """Share of each id in the corpus: counts of the vocabulary's words in all training texts, and the subwords of the
    sample scaled to the tokens that are no such words."""
    sample = np.bincount(np.concatenate([[END], *sequences]), minlength=END + 1 + len(unit_counts)).astype(np.float64)
    pieces, words = sample[:END + 1].sum(), sample[END + 1:].sum()
    sample[:END + 1] += 0.05
    overall = sample.copy()
    if words:
        overall[:END + 1] *= pieces / words * unit_counts.sum() / overall[:END + 1].sum()
        overall[END + 1:] = unit_counts
    else:
        overall[END + 1:] = np.maximum(unit_counts, 1)
    return overall / overall.sum()


def encode_documents(docs: DataFrame, learn: Column, tokenizer: str, words, buckets: int) -> DataFrame:
    """Rows (key, doc_id, held_out, n_tokens, n_known, known_log, ids): ids of all whole texts, packed, with the counts of their
    frequent words; and rows (bucket, hashes, keys) with the other words, packed. words: what TextIds takes."""
    import pyarrow as pa

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~learn).alias("held_out"), whole_text().alias("text"))
    schema = ("key long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, ids binary, "
              "bucket long, hashes binary, keys binary")

    def encode(batches):
        from pyspark import TaskContext

        maker = TextIds(tokenizer, *words.value)
        key = TaskContext.get().partitionId() << 33
        rare_hash: list[np.ndarray] = []
        rare_key: list[np.ndarray] = []
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in schema.split(", ")]

        def batch_of(n, columns):
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

        def flush():
            h, k = np.concatenate(rare_hash), np.concatenate(rare_key)
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            h, k, bucket = h[order], k[order], bucket[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
            rare_hash.clear()
            rare_key.clear()
            if len(h):
                packed = lambda a, kind: pa.array([a[lo:hi].astype(kind).tobytes() for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield batch_of(len(cuts) - 1, {"bucket": pa.array(bucket[cuts[:-1]]), "hashes": packed(h, "<u8"), "keys": packed(k, "<i8")})

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes, hashes, counts, lengths = maker.of(batch.column(2))
            keys = key + np.arange(batch.num_rows)
            key += batch.num_rows
            begin, known = np.cumsum(lengths) - lengths, counts > 0
            logs = np.where(known, np.log10(counts + 0.5), 0.0)
            data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes)
            yield batch_of(batch.num_rows, {
                "key": pa.array(keys), "doc_id": batch.column(0), "held_out": batch.column(1), "n_tokens": pa.array(lengths),
                "n_known": pa.array(np.add.reduceat(known.astype(np.int64), begin)), "known_log": pa.array(np.add.reduceat(logs, begin)),
                "ids": pa.array([data[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), sizes.tolist())], pa.binary())})
            rare_hash.append(hashes[~known])
            rare_key.append(np.repeat(keys, lengths)[~known])
            if sum(map(len, rare_hash)) >= BLOCK_WORDS:
                yield from flush()
        if rare_hash:
            yield from flush()

    return rows.mapInArrow(encode, schema)


def score_documents(docs: DataFrame, tokenizer: str, modulus: int = 5, held: int = 1) -> DataFrame:
    """Log10 probabilities of all whole texts of docs (doc_id, text), learned from the rows whose id_bucket is not `held`.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-half unigram), score (the model). A missing
    text is empty: its only token is the end. The counts of frequent words, a bounded table, are broadcast; the
    other words of a document meet their counts in the bucket of their hash, in packed arrays. Texts become ids once; the network
    is fitted on those of all training texts and then scores all.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    docs = bounded_batches(docs)
    learn = id_bucket("doc_id", modulus) != held
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(count_words(docs, learn, buckets), "word-counts")
    n_words, n_tokens = counts.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    n_words, n_tokens = n_words or 0, n_tokens or 0
    tops = counts.select("top_hashes", "top_counts").collect()
    hashes = np.concatenate([np.frombuffer(r["top_hashes"], "<u8") for r in tops]) if tops else np.zeros(0, np.uint64)
    times = np.concatenate([np.frombuffer(r["top_counts"], "<i8") for r in tops]) if tops else np.zeros(0, np.int64)
    order = np.argsort(hashes)
    hashes, times = hashes[order], times[order]
    units = np.full(len(times), -1)
    chosen = np.lexsort((hashes, -times))[:UNITS]
    chosen = np.sort(chosen[times[chosen] >= UNIT_COUNT])
    units[chosen] = np.arange(len(chosen))
    words = spark.sparkContext.broadcast((hashes, times, units))
    made = stored(encode_documents(docs, learn, tokenizer, words, buckets), "ids")
    texts = made.filter("bucket IS NULL")

    maker, sequences, used = TextIds(tokenizer, hashes, times, units, 1 << 10), [], 0
    for text in training_sample(docs, learn):
        sequences.append(maker.of(pa.array([text], pa.large_string()))[0])
        used += len(sequences[-1])
        if used > SAMPLE_TOKENS:
            break
    overall = overall_shares(sequences, times[chosen])
    net = fit_attention(sequences, overall)
    if sequences:
        begun = spark.sparkContext.broadcast((net.p, net.counts, overall))
        del maker, sequences, net
        p, explained = fit_all(texts.filter("NOT held_out").select("ids"), begun, len(overall))
        begun.destroy()
        overall = explained.sum(axis=1, dtype=np.float64) + 0.05
        net = AttentionLM(p, share_out(explained, overall / overall.sum()).astype(np.float32))
    shared = spark.sparkContext.broadcast(AttentionLM(net.p, net.experts))

    def score(batches):
        for batch in batches:
            logs = [np.add.reduceat(log_probabilities(shared.value, ids, lengths).astype(np.float64), np.cumsum(lengths) - lengths)
                    for ids, lengths, _ in sequences_in(batch)]
            if logs:
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(logs) / np.log(10))], [*batch.schema.names[1:], "score"])

    def look_up(found: pa.Table, known: pa.Table) -> pa.Table:
        """Per document and bucket: words with a count, and the sum of log10(count + 0.5) over all."""
        if not found.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "rare_known": pa.array([], pa.int64()), "rare_log": pa.array([], pa.float64())})
        h = np.concatenate([np.frombuffer(b, "<u8") for b in found["hashes"].to_pylist()])
        k = np.concatenate([np.frombuffer(b, "<i8") for b in found["keys"].to_pylist()])
        times = np.zeros(len(h), np.int64)
        if known.num_rows:
            words, c = np.frombuffer(known["hashes"][0].as_py(), "<u8"), np.frombuffer(known["counts"][0].as_py(), "<i8")
            at = np.minimum(np.searchsorted(words, h), len(words) - 1)
            times = np.where(words[at] == h, c[at], 0)
        order = np.argsort(k, kind="stable")
        k, times = k[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        return pa.table({"key": k[first], "rare_known": np.add.reduceat((times > 0).astype(np.int64), first),
                         "rare_log": np.add.reduceat(np.log10(times + 0.5), first)})

    scored = stored(texts.select("ids", "key", "doc_id", "held_out", "n_tokens", "n_known", "known_log")
                    .mapInArrow(score, "key long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, score double"), "scores")
    rare = made.filter("bucket IS NOT NULL").select("bucket", "hashes", "keys")
    sums = (rare.groupBy("bucket").cogroup(counts.select("bucket", "hashes", "counts").groupBy("bucket"))
            .applyInArrow(look_up, "key long, rare_known long, rare_log double")
            .groupBy("key").agg(F.sum("rare_known").alias("rare_known"), F.sum("rare_log").alias("rare_log")))
    floor = float(np.log10(n_tokens + 0.5 * (n_words + 1)))
    joined = scored.join(sums, "key", "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score")
