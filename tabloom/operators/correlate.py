"""Pearson correlation of many columns in tiles of column blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import col

BLOCK = 128
# Tiles of one scan: a task holds their sums (six numbers per pair of columns, 100 MB in all).
TILES_A_SCAN = 128
_RESULT = "column_a string, column_b string, r double"


def pairwise_correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_a, column_b, r) of every pair with column_a < column_b, over the rows that have both. r is NULL where either column
    has no spread in them. NaN counts as missing.

    One aggregate finds the centres. A task then adds up products per tile, a pair of column blocks above the diagonal, and hands
    on a line of sums per column and tile; these meet on the executors, which turn them into the long result.
    """
    ordered = sorted(names)
    spark = df.sparkSession
    if len(ordered) < 2:
        return spark.createDataFrame([], _RESULT)
    clean = [F.nanvl(col(n).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, n in enumerate(ordered)]
    facts = df.select(*clean)
    row = facts.agg(*[F.struct(F.avg(f"c{i}"), F.min(f"c{i}"), F.max(f"c{i}")).alias(f"c{i}") for i in range(len(ordered))]).first()
    # A constant column is centred on its value, not on a rounded mean of it.
    centres = np.array([0.0 if r[0] is None else r[1] if r[1] == r[2] else r[0] for r in row])
    blocks = [list(range(lo, min(lo + BLOCK, len(ordered)))) for lo in range(0, len(ordered), BLOCK)]
    tiles = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))]
    parts = None
    for lo in range(0, len(tiles), TILES_A_SCAN):
        made = _tile_sums(facts, centres, blocks, tiles[lo:lo + TILES_A_SCAN])
        parts = made if parts is None else parts.unionByName(made)

    def finish(lines):
        import pyarrow as pa

        i, j, line = (lines.column(k)[0].as_py() for k in ("i", "j", "line"))
        a = blocks[i][line]
        n, xy, sx, sy, sxx, syy = np.sum(lines.column("sums").to_pylist(), axis=0).reshape(6, -1)
        some = np.maximum(n, 1.0)
        vx, vy = sxx - sx * sx / some, syy - sy * sy / some
        spread = (n > 0) & (vx > 1e-12 * sxx) & (vy > 1e-12 * syy)
        r = (xy - sx * sy / some) / np.sqrt(np.where(spread, vx * vy, 1.0))
        keep = [k for k, b in enumerate(blocks[j]) if b > a]
        return pa.table({"column_a": pa.array([ordered[a]] * len(keep), pa.string()),
                         "column_b": pa.array([ordered[blocks[j][k]] for k in keep], pa.string()),
                         "r": pa.array([float(r[k]) if spread[k] else None for k in keep], pa.float64())})

    return parts.groupBy("i", "j", "line").applyInArrow(finish, _RESULT)


def _tile_sums(facts: DataFrame, centres: np.ndarray, blocks: list[list[int]], tiles: list[tuple[int, int]]) -> DataFrame:
    """(i, j, line, sums): for column `line` of block i and all columns of block j their joint rows, products, sums and squares."""
    import pyarrow as pa

    def scan(batches):
        total = {t: np.zeros((6, len(blocks[t[0]]), len(blocks[t[1]]))) for t in tiles}
        seen = False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - centres
            missing = np.isnan(x)
            whole = not missing.any()
            x = np.where(missing, 0.0, x)
            there, squares = (~missing).astype(float), x * x
            sums, sums2 = x.sum(axis=0), squares.sum(axis=0)
            for (i, j), t in total.items():
                a, b = blocks[i], blocks[j]
                t[1] += x[:, a].T @ x[:, b]
                if whole:
                    # Every row has both: the other sums are those of single columns.
                    t[0] += len(x)
                    t[2] += sums[a][:, None]
                    t[3] += sums[b]
                    t[4] += sums2[a][:, None]
                    t[5] += sums2[b]
                else:
                    t[0] += there[:, a].T @ there[:, b]
                    t[2] += x[:, a].T @ there[:, b]
                    t[3] += there[:, a].T @ x[:, b]
                    t[4] += squares[:, a].T @ there[:, b]
                    t[5] += there[:, a].T @ squares[:, b]
        for (i, j), t in total.items() if seen or not tiles else []:
            n = t.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * n, pa.int32()), pa.array([j] * n, pa.int32()), pa.array(range(n), pa.int32()),
                 pa.array([t[:, k].reshape(-1) for k in range(n)], pa.list_(pa.float64()))], ["i", "j", "line", "sums"])

    made = facts.mapInArrow(scan, "i int, j int, line int, sums array<double>")
    # A line of zeros per column, so that a table without rows has its pairs too.
    none = [(i, j, k) for i, j in tiles for k in range(len(blocks[i]))]
    zeros = facts.sparkSession.createDataFrame(none, "i int, j int, line int")
    width = F.element_at(F.array(*[F.lit(len(b)) for b in blocks]), F.col("j") + 1)
    return made.unionByName(zeros.withColumn("sums", F.array_repeat(F.lit(0.0), F.lit(6) * width)))
