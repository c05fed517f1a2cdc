"""Adaptive search of parameters: the next trials are drawn where good trials are denser than bad ones."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np

CANDIDATES = 24
START = 10


class _Density:
    """Mixture on [0, 1]: a uniform part and a normal around every point, as wide as the gap to its farther neighbour."""

    def __init__(self, points: Sequence[float]):
        order = np.sort(np.asarray(points, dtype=float))
        around = np.concatenate(([0.0], order, [1.0]))
        gaps = np.diff(around)
        self.centres = order
        self.widths = np.clip(np.maximum(gaps[:-1], gaps[1:]), 1.0 / min(100, 1 + len(order)), 1.0) if len(order) else order
        erf = np.vectorize(math.erf, otypes=[float])
        # What of each normal lies inside [0, 1].
        root = self.widths * math.sqrt(2.0)
        self.inside = 0.5 * (erf((1.0 - order) / root) - erf(-order / root)) if len(order) else order

    def draw(self, n: int, rng: np.random.Generator) -> np.ndarray:
        part = rng.integers(0, len(self.centres) + 1, n)
        out = rng.uniform(size=n)
        for i in np.flatnonzero(part < len(self.centres)):
            while True:
                x = rng.normal(self.centres[part[i]], self.widths[part[i]])
                if 0.0 <= x <= 1.0:
                    out[i] = x
                    break
        return out

    def log(self, x: np.ndarray) -> np.ndarray:
        bells = np.exp(-0.5 * ((x[:, None] - self.centres) / self.widths) ** 2) / (self.widths * math.sqrt(2 * math.pi) * self.inside)
        return np.log((1.0 + bells.sum(axis=1)) / (1 + len(self.centres)))


def _value(rule: tuple, u: float):
    """Parameter value at a place between 0 and 1 of its range: ('step', lo, hi, step) or ('float', lo, hi)."""
    kind, lo, hi = rule[:3]
    if kind == "float":
        return lo + (hi - lo) * float(u)
    steps = int((hi - lo) // rule[3])
    return lo + rule[3] * min(int(u * (steps + 1)), steps)


def _place(rule: tuple, value) -> float:
    kind, lo, hi = rule[:3]
    if kind == "float":
        return (value - lo) / (hi - lo) if hi > lo else 0.5
    steps = int((hi - lo) // rule[3])
    return ((value - lo) / rule[3] + 0.5) / (steps + 1)


def propose(space: Mapping[str, tuple], history: Sequence[tuple[dict, float]], rng: np.random.Generator) -> dict:
    """Next trial. Every parameter takes that of CANDIDATES draws from the good trials' density which is likeliest under it
    compared with the density of the others. Equal scores count the earlier trial as better."""
    ranked = sorted(range(len(history)), key=lambda i: (-history[i][1], i))
    cut = max(2, math.ceil(len(history) / 10))
    out = {}
    for name, rule in space.items():
        good, bad = ([_place(rule, history[i][0][name]) for i in part] for part in (ranked[:cut], ranked[cut:]))
        likely, unlikely = _Density(good), _Density(bad)
        drawn = likely.draw(CANDIDATES, rng)
        out[name] = _value(rule, drawn[int(np.argmax(likely.log(drawn) - unlikely.log(drawn)))])
    return out


def adaptive_search(space: Mapping[str, tuple], judge: Callable[[Sequence[dict]], Sequence[float]], trials: int, batch: int = 5,
                    seed: int = 0) -> list[tuple[dict, float]]:
    """(parameters, score) of all trials in the order of their numbers; larger scores are better.

    The first START trials are uniform, every later batch is proposed from all finished trials. A trial's draws depend on the seed, its number
    and the finished scores, so that a search can be repeated.
    """
    history: list[tuple[dict, float]] = []
    while len(history) < trials:
        numbers = range(len(history), min(trials, len(history) + batch))
        rngs = [np.random.default_rng([seed, n]) for n in numbers]
        if len(history) >= START:
            drawn = [propose(space, history, r) for r in rngs]
        else:
            drawn = [{name: _value(rule, r.uniform()) for name, rule in space.items()} for r in rngs]
        history += list(zip(drawn, judge(drawn)))
    return history
