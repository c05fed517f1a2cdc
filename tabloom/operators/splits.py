"""Train/test splits and cross-validation folds.

Every splitter adds one small column to the rows: `role` for a single split, `fold` for the
fold in which a row is tested. A row trains in the other folds (`k_folds`) or, for an
expanding window, in the later ones (`expanding`); rows are never copied once per fold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col, listed
from ..ordering import at_or_after, attach, hash_block, kth_rows, ordered_index, row_hash
from ..session import driver_table, pin

# ---- single splits --------------------------------------------------------------------


def split_random(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 0) -> DataFrame:
    """role 'test' for exactly ceil(fraction * n) rows, chosen by the hash of the key."""
    out = hash_block(df, key, seed, lambda n: [F.ceil(n * F.lit(fraction))], name="_b")
    return out.withColumn("role", F.when(F.col("_b") == 0, "test").otherwise("train")).drop("_b")


def split_stratified(df: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 0) -> DataFrame:
    """The same within every class: ceil(fraction * class size) test rows each."""
    out = hash_block(df, key, seed, lambda n: [F.ceil(n * F.lit(fraction))], by=label, name="_b")
    return out.withColumn("role", F.when(F.col("_b") == 0, "test").otherwise("train")).drop("_b")


def shuffle_rows(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """A seeded permutation of the rows."""
    return df.withColumn("_h", row_hash(key, seed)).orderBy("_h").drop("_h")


# ---- folds ----------------------------------------------------------------------------


def split_time_series(df: DataFrame, order: str | Sequence[str], k: int = 5) -> DataFrame:
    """Expanding window: fold i (1..k) tests n // (k + 1) rows after everything before them;
    fold 0 holds the rows that only ever train. The order must be unique and complete."""
    order = listed(order)
    n = df.count()
    size = n // (k + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {k} folds")
    starts = kth_rows(df, order, [n - (k - i) * size for i in range(k)])
    passed = [at_or_after(df, order, s).cast("int") for s in starts]
    return df.withColumn("fold", sum(passed, F.lit(0)))


def split_stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0) -> DataFrame:
    """fold 0..k-1 per class in hash order; class sizes per fold differ by at most one."""
    def ends(n: Column) -> list[Column]:
        return [F.floor(n / k) * (i + 1) + F.least(n % k, F.lit(i + 1)) for i in range(k - 1)]

    return hash_block(df, key, seed, ends, by=label, name="fold")


def _fill_lightest(sizes: Sequence[tuple[int, int]], k: int) -> list[tuple[int, list[int], list[list[int]]]]:
    """Give groups, largest first, to the lightest fold (the lower number on ties).

    Groups of one size are placed together: while the folds on the receiving side stay below
    the next heavier one they take turns, so that a size needs at most k periodic patterns
    however many groups have it. Returns (size, first position of each pattern, patterns).
    """
    load = [0] * k
    plan = []
    for size, groups in sizes:
        starts, patterns, placed = [], [], 0
        while placed < groups:
            waiting = sorted((load[f], f) for f in range(k))
            taking = [f for level, f in waiting if level < waiting[0][0] + size]
            others = [w for w in waiting if w[1] not in taking]
            if others:
                limit, rival = others[0]
                turns = [max(0, math.ceil((limit - load[f]) / size) if (limit - load[f]) % size or f > rival
                             else (limit - load[f]) // size + 1) for f in taking]
                total = sum(turns)
            else:
                turns, total = None, groups - placed
            starts.append(placed)
            patterns.append(taking)
            total = min(total, groups - placed)
            full, extra = divmod(total, len(taking))
            if turns is not None and total == sum(turns):
                given = turns
            else:
                given = [full + (1 if i < extra else 0) for i in range(len(taking))]
            for f, t in zip(taking, given):
                load[f] += t * size
            placed += total
        plan.append((size, starts, patterns))
    return plan


def group_folds(df: DataFrame, group: str, k: int) -> DataFrame:
    """(group, fold): groups by size, largest first (the larger label first on ties), each to
    the lightest fold. Only the distinct sizes reach the driver: at most sqrt(2 * rows)."""
    counts = pin(df.groupBy(col(group)).agg(F.count(F.lit(1)).alias("_size")))
    sizes = [(r["_size"], r["c"]) for r in counts.groupBy("_size").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("_size")).collect()]
    groups = sum(c for _, c in sizes)
    if k > groups:
        raise ValueError(f"Cannot have number of splits n_splits={k} greater than the number of groups: {groups}.")
    plan = driver_table(
        df.sparkSession, _fill_lightest(sizes, k), "_size bigint, _starts array<bigint>, _patterns array<array<int>>")
    turn = attach(ordered_index(counts, [col(group).desc()], "_size", "_turn"), plan, "_size")
    phase = F.size(F.filter("_starts", lambda s: s <= F.col("_turn")))
    pattern = F.element_at("_patterns", phase)
    place = ((F.col("_turn") - F.element_at("_starts", phase)) % F.size(pattern)).cast("int")
    return turn.select(col(group), F.element_at(pattern, place + 1).alias("fold"))


def split_group_kfold(df: DataFrame, group: str, k: int) -> DataFrame:
    """fold 0..k-1 such that no group is in two folds."""
    return attach(df, pin(group_folds(df, group, k)), group)


def split_leave_one_group_out(df: DataFrame, group: str) -> DataFrame:
    """One fold per group, in the groups' order."""
    groups = ordered_index(df.select(col(group)).distinct(), [group], name="fold")
    return attach(df, pin(groups.withColumn("fold", F.col("fold").cast("int"))), group)


def split_leave_p_groups_out(df: DataFrame, group: str, p: int) -> DataFrame:
    """(fold, test_groups): every combination of p groups, in lexicographic order.

    A combination grows by the later groups only, so that the intermediate rows are no more
    than the combinations asked for.
    """
    groups = pin(ordered_index(df.select(col(group)).distinct(), [group], name="_at"))
    n = groups.count()
    if p >= n:
        raise ValueError(f"leaving {p} groups out needs more than {n} groups")
    # The place of the i-th chosen group leaves room for the p - i that follow.
    combos = groups.filter(F.col("_at") <= n - p).select(
        F.array("_at").alias("_places"), F.array(col(group)).alias("test_groups"))
    for i in range(1, p):
        places = F.sequence(F.element_at("_places", -1) + 1, F.lit(n - p + i).cast("long"))
        combos = combos.withColumn("_at", F.explode(places))
        combos = attach(combos, groups, "_at").select(
            F.concat("_places", F.array("_at")).alias("_places"),
            F.concat("test_groups", F.array(col(group))).alias("test_groups"))
    return ordered_index(combos, ["_places"], name="fold").select("fold", "test_groups")


def with_leave_p_groups_out(df: DataFrame, group: str, p: int) -> DataFrame:
    """Rows joined to the folds that test them: C(groups - 1, p - 1) per row by definition."""
    folds = split_leave_p_groups_out(df, group, p)
    tests = pin(folds.select("fold", F.explode("test_groups").alias(group)))
    return attach(df, tests, group, "inner")


def fold_sizes(split: DataFrame, fold: str = "fold", group: str | None = None, expanding: bool = False) -> DataFrame:
    """(fold, role, rows[, groups]) of a split; everything is derived from the counts per fold."""
    per = split.groupBy(F.col(fold).cast("int").alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), *([F.count_distinct(col(group)).alias("groups")] if group else []))
    stats = ["rows"] + (["groups"] if group else [])
    per = pin(per)
    row = per.agg(F.max("fold").alias("top"), *[F.sum(s).alias(s) for s in stats]).first()
    test = per.select("fold", F.lit("test").alias("role"), *stats)
    if not expanding:
        train = per.select("fold", F.lit("train").alias("role"), *[(F.lit(row[s]) - F.col(s)).alias(s) for s in stats])
        return test.unionByName(train)
    # A row of fold f trains in every later fold.
    later = per.filter(F.col("fold") < row["top"]).select(
        F.explode(F.sequence(F.col("fold") + 1, F.lit(row["top"]))).alias("fold"), *stats)
    train = later.groupBy("fold").agg(*[F.sum(s).alias(s) for s in stats]).select(
        "fold", F.lit("train").alias("role"), *stats)
    return test.filter(F.col("fold") > 0).unionByName(train)
