"""Stored stages: what counts is what was finished, and of the input that is asked for."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tabloom.sources import stage_snapshot


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "input")
    spark.range(100).selectExpr("id", "id * 2.0 AS v").write.parquet(path)
    return path


def total(df):
    return df.agg(F.sum("v")).first()[0]


def test_a_failed_write_leaves_the_stage_before(spark, table, tmp_path):
    path = str(tmp_path / "stage")
    stage_snapshot(spark.read.parquet(table), path, "function")
    broken = spark.read.parquet(table).withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit(1.0)))
    with pytest.raises(Exception, match="lost"):
        stage_snapshot(broken, path, "function")
    assert total(stage_snapshot(None, path, "stored", spark)) == 9900.0
    nowhere = str(tmp_path / "nowhere")
    with pytest.raises(Exception, match="lost"):
        stage_snapshot(broken, nowhere, "function")
    with pytest.raises(ValueError, match="no finished stage"):
        stage_snapshot(None, nowhere, "stored", spark)


def test_rows_without_a_manifest_are_no_stage(spark, table, tmp_path):
    path = str(tmp_path / "stage")
    stage_snapshot(spark.read.parquet(table), path, "function")
    os.rename(f"{path}/manifest.json", f"{path}/manifest.draft")
    with pytest.raises(ValueError, match="no finished stage"):
        stage_snapshot(None, path, "stored", spark)


def test_a_stage_of_other_input_plan_or_schema_is_refused(spark, table, tmp_path):
    path = str(tmp_path / "stage")
    first = spark.read.parquet(table)
    stage_snapshot(first, path, "function")
    assert total(stage_snapshot(spark.read.parquet(table), path, "stored")) == 9900.0
    for other, what in ((first.filter("id < 50"), "plan"), (first.withColumn("v", F.col("v").cast("float")), "schema")):
        with pytest.raises(ValueError, match=what):
            stage_snapshot(other, path, "stored")
    spark.range(100, 110).selectExpr("id", "id * 2.0 AS v").write.mode("append").parquet(table)
    with pytest.raises(ValueError, match="input"):
        stage_snapshot(spark.read.parquet(table), path, "stored")
    assert total(stage_snapshot(None, path, "stored", spark)) == 9900.0


def test_fresh_computes_only_what_is_stale(spark, table, tmp_path):
    path = str(tmp_path / "stage")

    def rows():
        return json.load(open(f"{path}/manifest.json"))["rows"]

    stage_snapshot(spark.read.parquet(table), path, "fresh")
    kept = rows()
    stage_snapshot(spark.read.parquet(table), path, "fresh")
    assert rows() == kept
    old = stage_snapshot(None, path, "stored", spark)
    spark.range(100, 110).selectExpr("id", "id * 2.0 AS v").write.mode("append").parquet(table)
    assert total(stage_snapshot(spark.read.parquet(table), path, "fresh")) == 9900.0 + sum(2.0 * i for i in range(100, 110))
    assert rows() != kept and total(old) == 9900.0
    stage_snapshot(spark.read.parquet(table), path, "function")
    assert len([n for n in os.listdir(path) if n.startswith("rows-")]) == 2
