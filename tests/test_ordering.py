"""Exact ranks under ties, skew and small sketches, against brute force."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom import ordering
from tabloom.ordering import (
    at_or_after, attach, hash_block, kth_rows, ordered_index, quantile_table, row_hash, running_totals)

N = 20_000


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the rows share one group, and a third one value; the rest is skewed."""
    df = spark.range(N).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 3 == 1, 5.0).otherwise(F.exp(((F.col("id") * 7919) % 1009) / 100.0)).alias("v"))
    return df.persist()


@pytest.mark.parametrize("accuracy", [100, 1000, 10_000_000])
@pytest.mark.parametrize("window_rows", [0, 1_000_000])
def test_quantiles_are_exact_whatever_the_sketch(numbers, monkeypatch, accuracy, window_rows):
    monkeypatch.setattr(ordering, "WINDOW_ROWS", window_rows)
    qs = [0.0, 0.003, 0.25, 0.5, 0.9, 0.997, 1.0]
    got = quantile_table(numbers, ["v"], qs, by="g", accuracy=accuracy).toPandas().set_index("g")
    local = numbers.toPandas()
    for g, part in local.groupby("g"):
        want = np.quantile(part["v"], qs)
        assert np.allclose(got.loc[g, [f"q{i}" for i in range(len(qs))]].astype(float), want, rtol=1e-12), g


def test_quantiles_skip_missing_values_and_keep_missing_groups(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), (None, 7.0), (None, 9.0)]
    got = quantile_table(spark.createDataFrame(rows, "g string, v double"), ["v"], [0.5], by="g").collect()
    assert {r["g"]: r["q0"] for r in got} == {"a": 2.0, None: 8.0}


def test_row_index_counts_without_gaps_per_hot_group(numbers):
    got = ordered_index(numbers.repartition(13), ["v", "id"], "g").toPandas()
    for _, part in got.groupby("g"):
        ordered = part.sort_values(["v", "id"])
        assert (ordered["row_index"].to_numpy() == np.arange(len(part))).all()


def test_running_totals_are_exclusive_prefix_sums(numbers):
    counts = numbers.groupBy("g", "v").agg(F.count("*").alias("c"))
    got = running_totals(counts, ["v"], {"before": "c"}, "g").toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("v")
        assert (part["before"].to_numpy() == np.concatenate([[0], part["c"].cumsum().to_numpy()[:-1]])).all()


@pytest.mark.parametrize("window_rows", [0, 1_000_000])
@pytest.mark.parametrize("accuracy", [200, 10_000_000])
def test_kth_rows_break_ties_by_the_next_column(numbers, monkeypatch, window_rows, accuracy):
    monkeypatch.setattr(ordering, "WINDOW_ROWS", window_rows)
    local = numbers.toPandas().sort_values(["v", "id"])
    positions = [0, 1, N // 2, N // 2 + 1, N - 1]
    got = kth_rows(numbers, ["v", "id"], positions, accuracy)
    assert got == [tuple(local[["v", "id"]].iloc[p]) for p in positions]
    after = numbers.filter(at_or_after(numbers, ["v", "id"], got[2])).count()
    assert after == N - N // 2


def test_kth_rows_of_wall_clock_times(spark):
    start = datetime.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = [(start + datetime.timedelta(minutes=i // 2), i) for i in range(50)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id bigint")
    assert kth_rows(df, ["ts", "id"], [0, 7, 8, 49]) == [rows[i] for i in (0, 7, 8, 49)]


def test_hash_blocks_have_exact_sizes_per_hot_group(numbers):
    got = hash_block(numbers, "id", 3, lambda n: [F.lit(0), F.floor(n / 4), F.floor(n / 2)], by="g").toPandas()
    for _, part in got.groupby("g"):
        n = len(part)
        assert part["block"].value_counts().to_dict() == {1: n // 4, 2: n // 2 - n // 4, 3: n - n // 2}


def test_hash_blocks_follow_the_hash_order(numbers):
    got = hash_block(numbers, "id", 3, lambda n: [F.floor(n / 4)]).withColumn("h", row_hash("id", 3)).toPandas()
    assert got.loc[got["block"] == 0, "h"].max() < got.loc[got["block"] == 1, "h"].min()
    assert (got["block"] == 0).sum() == N // 4


@pytest.mark.parametrize("rows", [0, 500_000])
def test_attach_is_null_safe_and_keeps_all_facts(spark, monkeypatch, rows):
    monkeypatch.setattr(ordering, "BROADCAST_ROWS", rows)
    facts = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, i int")
    lookup = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    assert {(r["i"], r["v"]) for r in attach(facts, lookup, "k").collect()} == {(1, 10), (2, 20), (3, None)}
    assert {(r["i"], r["v"]) for r in attach(facts, lookup, "k", null_safe=False).collect()} == {(1, 10), (2, None), (3, None)}
    plan = attach(facts, lookup, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (rows > 0)
