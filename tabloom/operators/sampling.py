"""Class balancing: under-, over- and synthetic sampling of a binary label."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col
from ..ordering import hash_block, ordered_index
from ..session import pin


def class_sizes(df: DataFrame, label: str) -> list[tuple[object, int]]:
    """[(minority label, rows), (majority label, rows)] of a two-class table."""
    rows = df.filter(col(label).isNotNull()).groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).orderBy("n", label).take(3)
    if len(rows) != 2:
        raise ValueError("balancing needs exactly two classes")
    return [(r[0], r["n"]) for r in rows]


def _number(text: Column) -> Column:
    """Uniform integer below 2^32 from a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def sample_under(df: DataFrame, key: str, label: str, seed: int = 0) -> DataFrame:
    """All minority rows and as many majority rows, without replacement."""
    (_, n_min), _ = class_sizes(df, label)
    cut = hash_block(df.filter(col(label).isNotNull()), key, seed, lambda n: [F.least(n, F.lit(n_min))], by=label, name="_b")
    return cut.filter(F.col("_b") == 0).drop("_b")


def sample_over(df: DataFrame, key: str, label: str, seed: int = 0) -> DataFrame:
    """All majority rows, and minority rows drawn with replacement up to their number.

    Draws are counted per drawn position before they meet the rows, so that each minority row
    is joined once and then repeated. `copy` numbers the repetitions.
    """
    (minority, n_min), (majority, n_maj) = class_sizes(df, label)
    rows = ordered_index(df.filter(col(label) == F.lit(minority)), [key], name="_i")
    draws = df.sparkSession.range(n_maj).select(
        (_number(F.concat(F.col("id").cast("string"), F.lit(f":{seed}"))) % n_min).alias("_i"))
    drawn = draws.groupBy("_i").agg(F.count(F.lit(1)).alias("_times"))
    repeated = rows.join(drawn, "_i").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    kept = df.filter(col(label) == F.lit(majority)).withColumn("copy", F.lit(1))
    return kept.unionByName(repeated.drop("_i", "_times"))


# A tile of feature vectors, and a slab of distances, that one task holds at a time.
TILE_BYTES = 32 * 1024 * 1024


def _tile_neighbours(k: int):
    """For each query row of one tile, its k nearest rows of one other tile."""

    def find(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"i": pd.Series(dtype="int64"), "j": pd.Series(dtype="int64"), "d": pd.Series(dtype="float64")})
        a, b = np.stack(queries["qx"].to_numpy()), np.stack(rows["x"].to_numpy())
        qi, rj = queries["q"].to_numpy(), rows["i"].to_numpy()
        squares = (b * b).sum(axis=1)
        out = []
        step = max(1, TILE_BYTES // (8 * len(b)))
        for s in range(0, len(a), step):
            part, own = a[s:s + step], qi[s:s + step]
            d = (part * part).sum(axis=1)[:, None] - 2.0 * part @ b.T + squares[None, :]
            d[own[:, None] == rj[None, :]] = np.inf
            take = min(k, d.shape[1])
            near = np.argpartition(d, take - 1, axis=1)[:, :take]
            limit = np.take_along_axis(d, near, axis=1).max(axis=1, keepdims=True)
            if ((d <= limit).sum(axis=1) > take).any():  # equal distances at the last place: the smaller index is nearer
                near = np.lexsort((np.broadcast_to(rj, d.shape), d), axis=1)[:, :take]
            out.append(pd.DataFrame({
                "i": np.repeat(own, take), "j": rj[near].ravel(),
                "d": np.maximum(np.take_along_axis(d, near, axis=1), 0.0).ravel()}))
        found = pd.concat(out)
        return found[np.isfinite(found["d"])]

    return find


# Points of a cell of the metric index, and cells of an index (their pivots are broadcast).
CELL_ROWS = 2048
MOST_CELLS = 1024
# Cells that a query visits in the first round, the second, ...; the last number holds from there on.
ROUNDS = (1, 4, 16, 64)


class _Cells:
    """Pivots; a point belongs to its nearest one, and a cell reaches as far as its farthest point."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, self.reach, self.sizes = pivots, np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)

    def distances(self, x: np.ndarray) -> np.ndarray:
        squares = (x * x).sum(axis=1)[:, None] - 2.0 * x @ self.pivots.T + (self.pivots * self.pivots).sum(axis=1)
        return np.sqrt(np.maximum(squares, 0.0))

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot) of every point."""
        d = self.distances(x)
        at = d.argmin(axis=1)
        return at, d[np.arange(len(x)), at]

    def next(self, x: np.ndarray, kth: np.ndarray, seen: np.ndarray, step: int) -> list[np.ndarray]:
        """Up to `step` further cells per query, those that may hold the nearest points first. No point of a cell is nearer than the
        pivot less the cell's reach, so that cells whose bound exceeds the k-th distance (squared: kth) hold nothing."""
        bound = np.maximum(self.distances(x) - self.reach, 0.0)
        bound[:, self.sizes == 0] = np.inf
        order = np.argsort(bound, axis=1, kind="stable")
        slack = 1e-7 * (1.0 + np.sqrt((x * x).sum(axis=1)))
        out = []
        for i, cells in enumerate(order):
            ahead = cells[seen[i]:seen[i] + step]
            near = bound[i, ahead]
            out.append(ahead[np.isfinite(near) & (near <= np.sqrt(kth[i]) + slack[i])])
        return out


def _pivots(points: DataFrame, cells: int) -> np.ndarray:
    """Points far from each other, out of eight times as many that their hashes choose."""
    sample = points.select("x", F.xxhash64("i").alias("h"), "i").orderBy("h", "i").limit(8 * cells).collect()
    x = np.array([r["x"] for r in sample], dtype=float)
    chosen, far = [0], np.square(x - x[0]).sum(axis=1)
    while len(chosen) < min(cells, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.square(x - x[chosen[-1]]).sum(axis=1))
    return x[chosen]


def nearest_neighbours(points: DataFrame, queries: DataFrame, n: int, width: int, k: int, visits: list | None = None) -> DataFrame:
    """(i, neighbours array): the k nearest points of each query by Euclidean distance, exact; equal distances go to the smaller i.

    Points are (i, x array<double>) with i in 0..n-1, queries (q, qx) some of them; both should be pinned. Points lie in the cells of
    some hundred pivots. Round by round a query visits the cells that may hold its nearest points, and stops when the triangle
    inequality rules out all others. A task compares a bounded part of a cell with the queries of a bounded part of another
    and emits k rows per query. visits receives the number of such pairs of every round.
    """
    spark = points.sparkSession
    rows = max(256, TILE_BYTES // (8 * width))
    index = _Cells(_pivots(points, max(1, min(MOST_CELLS, math.ceil(n / CELL_ROWS)))))

    @F.pandas_udf("struct<cell int, far double>")
    def home(x: pd.Series) -> pd.DataFrame:
        if x.empty:
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "far": pd.Series(dtype="float64")})
        cell, far = index.home(np.stack(x.to_numpy()))
        return pd.DataFrame({"cell": cell.astype(np.int32), "far": far})

    placed = pin(points.withColumn("_home", home("x")).select("i", "x", F.col("_home.cell").alias("cell"), F.col("_home.far").alias("far")))
    for r in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        index.reach[r["cell"]], index.sizes[r["cell"]] = r["far"], r["n"]
    shared = spark.sparkContext.broadcast(index)
    parts = F.array(*[F.lit(max(1, math.ceil(c / rows))) for c in index.sizes.tolist()])

    def part_of(number: Column, cell: Column) -> Column:
        return F.pmod(F.xxhash64(number), F.element_at(parts, cell + 1)).cast("int")

    placed = placed.select("i", "x", "cell", part_of(F.col("i"), F.col("cell")).alias("part"))
    state = pin(queries.withColumn("_cell", home("qx")["cell"]).select(
        "q", "qx", F.struct(F.col("_cell").alias("cell"), part_of(F.col("q"), F.col("_cell")).alias("part")).alias("tile"),
        F.lit(float("inf")).alias("kth"), F.lit(0).alias("seen"), F.array().cast("array<struct<d:double,j:bigint>>").alias("best")))

    for number in range(MOST_CELLS):
        step = ROUNDS[min(number, len(ROUNDS) - 1)]

        @F.pandas_udf("array<int>")
        def ahead(x: pd.Series, kth: pd.Series, seen: pd.Series) -> pd.Series:
            if x.empty:
                return pd.Series([], dtype=object)
            return pd.Series(shared.value.next(np.stack(x.to_numpy()), kth.to_numpy(), seen.to_numpy(), step))

        asked = pin(state.withColumn("cells", ahead("qx", "kth", "seen")))
        if not asked.filter(F.size("cells") > 0).head(1):
            break
        left = asked.select("q", "qx", "tile", F.explode("cells").alias("cell")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col("cell") + 1) - 1)))
        pairs = pin(left.select("cell", "part", "tile").distinct())
        if visits is not None:
            visits.append(pairs.count())
        wanted = pairs.select(F.col("cell").alias("c"), F.col("part").alias("p"), F.col("tile").alias("t"))
        right = placed.join(wanted, (F.col("cell") == F.col("c")) & (F.col("part") == F.col("p"))).select("i", "x", "c", "p", "t")
        near = left.groupBy("cell", "part", "tile").cogroup(right.groupBy("c", "p", "t")).applyInPandas(
            _tile_neighbours(k), "i long, j long, d double")
        found = near.groupBy(F.col("i").alias("q")).agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "j"))), 1, k).alias("new"))
        best = F.slice(F.array_sort(F.concat("best", F.coalesce("new", F.array().cast("array<struct<d:double,j:bigint>>")))), 1, k)
        merged = asked.join(found, "q", "left").withColumn("best", best)
        state = pin(merged.select(
            "q", "qx", "tile", F.when(F.size("best") >= k, F.element_at("best", -1)["d"]).otherwise(F.lit(float("inf"))).alias("kth"),
            (F.col("seen") + F.size("cells")).alias("seen"), "best"))
    return state.filter(F.size("best") > 0).select(F.col("q").alias("i"), F.col("best.j").alias("neighbours"))


def sample_smote(df: DataFrame, names: Sequence[str], key: str, label: str, k: int = 5, seed: int = 0) -> DataFrame:
    """The rows and, up to balance, synthetic minority rows: each lies at a random place between
    a minority row and one of its k nearest minority rows. `synthetic` marks them."""
    (minority, n_min), (_, n_maj) = class_sizes(df, label)
    if n_min < 2:
        raise ValueError("a synthetic row lies between two rows of the minority class, which has fewer")
    missing = df.filter(col(label) == F.lit(minority)).filter(reduce(lambda a, b: a | b, [col(n).isNull() for n in names]))
    if missing.head(1):
        raise ValueError("rows of the minority class have missing features: fill them first")
    vector = F.array(*[col(n).cast("double") for n in names])
    rows = df.filter(col(label) == F.lit(minority)).select(col(key).alias("_key"), vector.alias("x"))
    points = pin(ordered_index(rows, ["_key"], name="i").select("i", "x"))

    def draw(what: str) -> Column:
        return _number(F.concat(F.col("id").cast("string"), F.lit(f":{seed}:{what}")))

    draws = pin(df.sparkSession.range(n_maj - n_min).select(
        "id", (draw("row") % n_min).alias("i"), draw("neighbour").alias("turn"), (draw("place") / F.lit(2.0**32)).alias("u")))
    # The minority may be far larger than the number of draws: only drawn rows look for neighbours.
    queries = points.join(draws.select("i").distinct(), "i", "left_semi").select(F.col("i").alias("q"), F.col("x").alias("qx"))
    near = nearest_neighbours(points, queries, n_min, len(names), k)
    chosen = draws.join(near, "i").filter(F.size("neighbours") > 0).select(
        "id", "i", "u", F.element_at("neighbours", (F.col("turn") % F.size("neighbours")).cast("int") + 1).alias("j"))
    ends = points.select(F.col("i").alias("j"), F.col("x").alias("y"))
    between = (
        chosen.join(points, "i").join(ends, "j")
        .select(F.zip_with("x", "y", lambda a, b: a + F.col("u") * (b - a)).alias("x")))
    synthetic = between.select(
        *[F.col("x")[i].alias(n) for i, n in enumerate(names)], F.lit(minority).cast(df.schema[label].dataType).alias(label),
        F.lit(True).alias("synthetic"))
    real = df.filter(col(label).isNotNull()).select(
        *[col(n).cast("double").alias(n) for n in names], col(label), F.lit(False).alias("synthetic"))
    return real.unionByName(synthetic)
