"""Chained regression imputation on sufficient statistics.

In every round each incomplete column is regressed on all others, and its missing values become predictions. Within the rows
that miss the same columns, such a prediction is an affine function of what these rows hold, and stays one however often
it is replaced. The sums of products of each pattern of missing values are therefore all that is needed: they are collected in one
scan, all rounds run on them, and a last pass writes the values. Beyond PATTERN_CELLS numbers the rounds read the rows again,
once per regression, by the same rules.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import col, require
from ..session import pin

# Numbers that the sums of all patterns may have on the driver (128 MB).
PATTERN_CELLS = 1 << 24
# Sums that a task holds before it hands them on.
TASK_CELLS = 1 << 22
# Evidence maximisation of the Bayesian ridge.
RIDGE_STEPS, RIDGE_TOL, RIDGE_PRIOR = 300, 1e-3, 1e-6
MOST_PATTERNS = 100_000


def bayesian_ridge(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Weights of the ridge whose penalty and noise maximise the evidence, from centred sums of products."""
    eig, vectors = np.linalg.eigh(xx)
    eig = np.maximum(eig, 0.0)
    turned = vectors.T @ xy
    noise, penalty = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    before = None
    for _ in range(RIDGE_STEPS):
        weights = vectors @ (turned / (eig + penalty / noise))
        left = max(yy - 2.0 * weights @ xy + weights @ xx @ weights, 0.0)
        gamma = float((noise * eig / (penalty + noise * eig)).sum())
        penalty = (gamma + 2 * RIDGE_PRIOR) / (float(weights @ weights) + 2 * RIDGE_PRIOR)
        noise = (n - gamma + 2 * RIDGE_PRIOR) / (left + 2 * RIDGE_PRIOR)
        if before is not None and np.abs(before - weights).sum() < RIDGE_TOL:
            break
        before = weights
    return vectors @ (turned / (eig + penalty / noise))


def least_squares(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Plain least squares; the shortest solution where columns depend on each other."""
    return np.linalg.lstsq(xx, xy, rcond=1e-12)[0]


REGRESSIONS = {"ridge": bayesian_ridge, "least_squares": least_squares}


def _regress(moments: np.ndarray, at: int, solve) -> np.ndarray:
    """Weights (constant first, 0 for the column itself) of column `at` on the others, from sums of products of (1, columns)."""
    n = moments[0, 0]
    out = np.zeros(len(moments))
    if n <= 0:
        return out
    mean = moments[0] / n
    centred = moments - n * np.outer(mean, mean)
    others = [i for i in range(1, len(moments)) if i != at]
    out[others] = solve(centred[np.ix_(others, others)], centred[others, at], centred[at, at], n)
    out[0] = mean[at] - out[others] @ mean[others]
    return out


def _patterns(df: DataFrame, names: Sequence[str]) -> tuple[dict[str, int], dict[str, float]]:
    """(rows per pattern of missing values, mean per column). A pattern has a 1 per missing column."""
    pattern = F.concat(*[F.when(col(n).isNull(), "1").otherwise("0") for n in names])
    sums = df.groupBy(pattern.alias("pattern")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(col(n)).alias(f"s{i}") for i, n in enumerate(names)])
    sums = pin(sums)
    total = sums.agg(*[(F.sum(f"s{i}") / F.sum(F.when(F.substring("pattern", i + 1, 1) == "0", F.col("rows")))).alias(f"m{i}")
                       for i in range(len(names))]).first()
    counts = {r["pattern"]: r["rows"] for r in sums.select("pattern", "rows").limit(MOST_PATTERNS + 1).collect()}
    return counts, {n: total[f"m{i}"] for i, n in enumerate(names)}


def _moments(df: DataFrame, names: Sequence[str], means: Sequence[float], by_pattern: bool = True) -> dict[str, np.ndarray]:
    """Sums of products of (1, columns less their means) per pattern of missing values, which count as 0."""
    import pyarrow as pa

    width, means = len(names) + 1, np.array(means)

    def add_up(batches):
        held: dict[str, np.ndarray] = {}

        def flush():
            for pattern, m in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pattern] * width), pa.array(np.arange(width, dtype=np.int32)), pa.array(list(m), pa.list_(pa.float64()))],
                    ["pattern", "line", "sums"])
            held.clear()

        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - means
            missing = np.isnan(x)
            x = np.concatenate((np.ones((len(x), 1)), np.where(missing, 0.0, x)), axis=1)
            if not by_pattern:
                missing = np.zeros_like(missing)
            kinds, at = np.unique(np.packbits(missing, axis=1), axis=0, return_inverse=True)
            at = at.reshape(-1)
            for i in range(len(kinds)):
                rows = x[at == i]
                name = "".join(map(str, np.unpackbits(kinds[i])[:width - 1]))
                held[name] = held[name] + rows.T @ rows if name in held else rows.T @ rows
            if len(held) * width * width > TASK_CELLS:
                yield from flush()
        yield from flush()

    parts = df.select(*[col(n) for n in names]).mapInArrow(add_up, "pattern string, line int, sums array<double>")

    # A line of a matrix is short, however many tasks had a part of it.
    def total(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pattern": part["pattern"].iloc[:1], "line": part["line"].iloc[:1], "sums": [np.sum(np.stack(part["sums"].to_numpy()), axis=0)]})

    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("pattern", "line").applyInPandas(total, parts.schema).collect():
        out.setdefault(r["pattern"], np.zeros((width, width)))[r["line"]] = r["sums"]
    return out


def _settle(moments: dict[str, np.ndarray], order: Sequence[int], rounds: int, tol: float, solve) -> dict[str, np.ndarray]:
    """All rounds on the patterns' sums. Returns per pattern a matrix that turns (1, centred columns, 0 where missing) into the
    filled row."""
    patterns = list(moments)
    width = len(next(iter(moments.values()))) if patterns else 1
    missing = {m: np.array([False, *[c == "1" for c in m]]) for m in patterns}
    maps = {m: np.eye(width) for m in patterns}
    filled = {m: s.copy() for m, s in moments.items()}
    reach = np.sqrt(max((sum(np.diag(s)[i] for s in moments.values()) / max(1.0, sum(s[0, 0] for m, s in moments.items() if not missing[m][i])))
                        for i in range(1, width))) if patterns and width > 1 else 0.0
    for _ in range(rounds):
        moved = 0.0
        for c in order:
            known = sum((filled[m] for m in patterns if not missing[m][c]), np.zeros((width, width)))
            weights = _regress(known, c, solve)
            change, rows = 0.0, 0.0
            for m in patterns:
                if missing[m][c]:
                    new = weights @ maps[m]
                    step = new - maps[m][c]
                    change += step @ moments[m] @ step
                    rows += moments[m][0, 0]
                    maps[m][c] = new
                    line = maps[m] @ moments[m] @ new
                    filled[m][c], filled[m][:, c] = line, line
            moved = max(moved, np.sqrt(max(change, 0.0) / rows) if rows else 0.0)
        if moved <= tol * reach:
            break
    return maps


def impute_chained(df: DataFrame, names: Sequence[str], rounds: int = 10, tol: float = 1e-3, regression: str = "ridge") -> DataFrame:
    """Fill the columns by chained regression, those with the fewest missing values first, starting from means.

    regression is 'ridge' (penalty and noise that maximise the evidence) or 'least_squares'. Ends after `rounds` or when no column's
    filled values move by more than tol times the largest spread of a column, both as root mean squares. Values that are there stay,
    a column without any becomes missing throughout.
    """
    require(df, names)
    solve = REGRESSIONS[regression]
    table = df.withColumns({n: F.nanvl(col(n).cast("double"), F.lit(None).cast("double")) for n in names})
    counts, means = _patterns(table, names)
    usable = [n for n in names if means[n] is not None]
    at = {n: 1 + i for i, n in enumerate(usable)}
    nulls = {n: sum(c for p, c in counts.items() if p[names.index(n)] == "1") for n in usable}
    order = [at[n] for n in sorted((n for n in usable if nulls[n]), key=lambda n: nulls[n])]
    if not order:
        return table
    centre = [means[n] for n in usable]
    if len(counts) <= MOST_PATTERNS and len(counts) * (len(usable) + 1) ** 2 <= PATTERN_CELLS:
        maps = _settle(_moments(table, usable, centre), order, rounds if len(usable) > 1 else 0, tol, solve)
        return _write_back(table, usable, centre, maps)
    return _impute_by_scans(table, usable, centre, order, rounds if len(usable) > 1 else 0, tol, solve)


def _write_back(table: DataFrame, names: Sequence[str], centre: Sequence[float], maps: dict[str, np.ndarray]) -> DataFrame:
    """The filled rows: one pass, every row by the matrix of its pattern."""
    shared = table.sparkSession.sparkContext.broadcast(maps)
    means = np.array(centre)

    @F.pandas_udf("array<double>")
    def fill(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype=object)
        x = np.stack(values.to_numpy()).astype(float) - means
        missing = np.isnan(x)
        z = np.concatenate((np.ones((len(x), 1)), np.where(missing, 0.0, x)), axis=1)
        kinds, at = np.unique(np.packbits(missing, axis=1), axis=0, return_inverse=True)
        out = np.empty_like(x)
        for i in range(len(kinds)):
            rows = at.reshape(-1) == i
            name = "".join(map(str, np.unpackbits(kinds[i])[:x.shape[1]]))
            out[rows] = (z[rows] @ shared.value[name].T)[:, 1:]
        return pd.Series(list(out + means))

    kept = [c for c in table.columns]
    filled = table.withColumn("_filled", fill(F.array(*[col(n) for n in names])))
    place = {n: i for i, n in enumerate(names)}
    return filled.select(*[F.coalesce(col(c), F.col("_filled")[place[c]]).alias(c) if c in place else col(c) for c in kept])


def _impute_by_scans(table: DataFrame, names: Sequence[str], centre: Sequence[float], order: Sequence[int], rounds: int, tol: float,
                     solve) -> DataFrame:
    """The same rounds over the rows themselves, for more patterns than fit: a scan per regression, a written table per round."""
    flags = {i: f"_missing_{i}" for i in order}
    rows = table.withColumns({flags[i]: col(names[i - 1]).isNull() for i in order})
    reach = max(r or 0.0 for r in rows.agg(*[F.stddev_pop(col(n)) for n in names]).first())
    current = pin(rows.withColumns({n: F.coalesce(col(n), F.lit(m)) for n, m in zip(names, centre)}))
    for _ in range(rounds):
        before = {i: f"_before_{i}" for i in order}
        current = current.withColumns({before[i]: col(names[i - 1]) for i in order})
        for i in order:
            known = current.filter(~F.col(flags[i]))
            sums = _moments(known, names, centre, by_pattern=False)
            weights = _regress(next(iter(sums.values())), i, solve)
            value = F.lit(float(weights[0] + centre[i - 1]))
            for j, n in enumerate(names):
                if weights[j + 1]:
                    value = value + F.lit(float(weights[j + 1])) * (col(n) - F.lit(float(centre[j])))
            current = current.withColumn(names[i - 1], F.when(F.col(flags[i]), value).otherwise(col(names[i - 1])))
        current = pin(current)
        steps = [F.sqrt(F.avg(F.when(F.col(flags[i]), F.pow(col(names[i - 1]) - F.col(before[i]), 2)))) for i in order]
        moved = max(m or 0.0 for m in current.agg(*steps).first())
        current = current.drop(*before.values())
        if moved <= tol * reach:
            break
    return current.drop(*flags.values())
