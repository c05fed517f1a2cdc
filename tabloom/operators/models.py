"""Training and scoring: leaf-wise boosters, and MLlib's kernel machine and network, whose features must be free of missing values."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import col
from ..ordering import attach
from ..session import pin, scratch_path
from .leafwise import (
    LeafwiseModel,
    Trainings,
    bin_count,
    binned,
    draws_rows,
    fit_bins,
    fit_leafwise,
    local_margins,
    packed_blocks,
    score_cells,
    score_leafwise,
    settings,
)
from .metrics import accuracy, auc_roc, fold_report, threshold_labels
from .relational import join_submission
from .profile import _wide
from .search import adaptive_search
from .splits import group_folds, split_group_kfold, split_stratified_kfold, split_time_series
from ..sources import csv_sink

# The default booster, the one of the feature check, and the searched ranges.
DEFAULT_BOOSTER = {
    "num_leaves": 512, "n_estimators": 512, "max_depth": 9, "learning_rate": 0.064, "subsample": 0.85, "colsample_bytree": 0.85,
    "reg_alpha": 0.3,
}
CONSISTENCY_BOOSTER = {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "max_depth": -1}
SEARCH_SPACE = {
    "n_estimators": ("step", 1000, 5000, 50),
    "subsample_for_bin": ("float", 10, 300000),
    "learning_rate": ("float", 0.00001, 0.03),
    "max_depth": ("step", 3, 8, 1),
    "num_leaves": ("step", 7, 256, 1),
    "subsample": ("float", 0.60, 0.95),
    "colsample_bytree": ("float", 0.60, 0.95),
    "min_child_samples": ("step", 1, 500, 1),
    "min_child_weight": ("float", 0.60, 0.95),
    "min_split_gain": ("float", 0.60, 0.95),
    "reg_lambda": ("float", 1, 25),
}


def booster(params: dict | None) -> dict:
    """Parameters of a booster, by default those of DEFAULT_BOOSTER."""
    return DEFAULT_BOOSTER if params is None else params


def assemble(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(df)


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows over more partitions where a table has too few splits to keep the cores busy."""
    return df.repartition(partitions) if partitions and df.rdd.getNumPartitions() < partitions else df


def score_rows(model, df: DataFrame, *keep: str) -> DataFrame:
    """Probability of class 1 next to the columns to keep."""
    if isinstance(model, LeafwiseModel):
        return score_leafwise(model, df, *keep)
    return model.transform(df).select(*[col(k) for k in keep], vector_to_array("probability")[1].alias("score"))


def _folds_trained(folded: DataFrame, names: Sequence[str], label: str, tests: Sequence[int], learns, params: dict | None, seed: int,
                   parallelism: int) -> tuple[DataFrame, list[LeafwiseModel]]:
    """One booster per fold over the same binned rows, several at a time; ((fold, label, score, n) of the test folds, models)."""
    p = booster(params)
    rows = folded.select(*[col(n) for n in names], col(label), "fold")
    edges = fit_bins(rows, names, settings(p)["max_bin"])
    blocks = packed_blocks(rows, names, edges, label, "fold", draws_rows(settings(p))).persist()
    trainings = Trainings(blocks, names, edges, seed, parallelism)
    try:
        models = trainings.run([(p, learns(i), lambda fold, i=i: fold == i) for i in tests])
        return pin(score_cells(dict(zip(tests, models)), blocks, folded.sparkSession)), models
    finally:
        trainings.close()
        blocks.unpersist()


def gbt_train_cv(df: DataFrame, names: Sequence[str], label: str, group: str, k: int = 3, params: dict | None = None,
                 model_path: str | None = None, seed: int = 0, partitions: int | None = None,
                 parallelism: int = 3) -> tuple[DataFrame, LeafwiseModel]:
    """Booster per group fold: (metrics per fold, model of the last fold, which is also saved)."""
    folded = split_group_kfold(_spread(df, partitions), group, k)
    scored, models = _folds_trained(folded, names, label, range(k), lambda i: lambda fold: fold != i, params, seed, parallelism)
    if model_path:
        models[-1].save(df.sparkSession, model_path)
    return fold_report(scored, "label", "score", "fold", "n"), models[-1]


def gbt_train_time_cv(df: DataFrame, names: Sequence[str], label: str, order: str | Sequence[str], k: int = 5,
                      params: dict | None = None, seed: int = 0, partitions: int | None = None,
                      parallelism: int = 3) -> DataFrame:
    """(fold, auc) of boosters that train on everything before their test window."""
    folded = split_time_series(_spread(df, partitions), order, k)
    scored, _ = _folds_trained(folded, names, label, range(1, k + 1), lambda i: lambda fold: fold < i, params, seed, parallelism)
    return auc_roc(scored, "label", "score", "fold", "n")


def gbt_train_full(df: DataFrame, names: Sequence[str], label: str, params: dict | None = None, model_path: str | None = None,
                   seed: int = 0) -> LeafwiseModel:
    """Booster trained on all rows; saved when a path is given."""
    model = fit_leafwise(df, names, label, booster(params), seed)
    if model_path:
        model.save(df.sparkSession, model_path)
    return model


def gbt_predict(model_path: str, df: DataFrame, key: str) -> DataFrame:
    """(key, score) from a saved model."""
    return score_rows(LeafwiseModel.load(df.sparkSession, model_path), df, key)


def feature_importance(model: LeafwiseModel, names: Sequence[str] | None = None) -> DataFrame:
    """(feature, importance): total gain of the splits by each feature (0 if there is none), the largest first."""
    gains = model.gains()
    values = [(n, float(gains[n])) for n in (model.names if names is None else names)]
    session = SparkSession.getActiveSession()
    return session.createDataFrame(values, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _hits(model: LeafwiseModel, block) -> tuple[int, int]:
    """Right decisions on the rows of a block, and all of them."""
    right = np.where(model.margins(block.x) > 0, block.n1, block.n0)
    return int(right.sum(dtype=np.int64)), int(block.n0.sum(dtype=np.int64)) + int(block.n1.sum(dtype=np.int64))


def hyperparam_search(df: DataFrame, names: Sequence[str], key: str, label: str, space: dict | None = None, trials: int = 20,
                      k: int = 5, seed: int = 0, parallelism: int = 4, batch: int = 5, fixed: dict | None = None) -> DataFrame:
    """(trial, parameters as JSON, score), the best first: trials scored by mean accuracy over stratified folds.

    The first batch is drawn at random, later ones where good trials are dense and bad ones are not (`search.adaptive_search`). The
    trainings of a batch run side by side. `fixed` holds parameters that are not searched.
    """
    space = SEARCH_SPACE if space is None else space
    folded = split_stratified_kfold(df, key, label, k, seed).select(*[col(n) for n in names], col(label), "fold")
    edges = fit_bins(folded, names)
    blocks = packed_blocks(folded, names, edges, label, "fold", "subsample_freq" in {**space, **(fixed or {})}).persist()
    trainings = Trainings(blocks, names, edges, seed, parallelism)
    try:
        def judge(drawn: Sequence[dict]) -> list[float]:
            asked = [({**(fixed or {}), **d}, lambda fold, i=i: fold != i, lambda fold, i=i: fold == i) for d in drawn for i in range(k)]
            found = [right / rows if rows else None for right, rows in trainings.run(asked, _hits)]
            parts = [[s for s in found[j:j + k] if s is not None] for j in range(0, len(found), k)]
            return [sum(s) / len(s) if s else 0.0 for s in parts]

        history = adaptive_search(space, judge, trials, batch, seed)
    finally:
        trainings.close()
        blocks.unpersist()
    rows = [(i, json.dumps(d, sort_keys=True), float(s)) for i, (d, s) in enumerate(history)]
    return df.sparkSession.createDataFrame(rows, "trial int, parameters string, score double").orderBy(F.desc("score"), "trial")


def best_parameters(found: DataFrame) -> dict:
    """Booster parameters of the best trial of a search."""
    return json.loads(found.first()["parameters"])


def _bin_counts(rows: DataFrame, names: Sequence[str], edges: Sequence[np.ndarray], label: str, folds: int) -> DataFrame:
    """(feature, fold, bin, n0, n1): rows of either class. A task adds up all its rows before anything is shuffled."""
    import pyarrow as pa

    width, bins, edges = len(names), bin_count(edges), list(edges)

    def count(batches):
        total = np.zeros((width, folds * bins * 2), dtype=np.int64)
        for batch in batches:
            y, fold = (batch.column(width + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            for i, e in enumerate(edges):
                x = binned(batch.column(i).to_numpy(zero_copy_only=False).astype(float), e)
                total[i] += np.bincount((fold * bins + x) * 2 + y, minlength=folds * bins * 2)
        total = total.reshape(width, folds, bins, 2)
        at = np.nonzero(total.sum(axis=3))
        yield pa.RecordBatch.from_arrays([*[pa.array(a.astype(np.int32)) for a in at], *[pa.array(total[(*at, c)]) for c in (0, 1)]],
                                         ["feature", "fold", "bin", "n0", "n1"])

    flat = rows.filter(col(label).isNotNull()).select(
        *[col(n).cast("double").alias(f"c{i}") for i, n in enumerate(names)], (col(label) == 1).cast("int").alias("y"), F.col("fold").cast("int"))
    made = flat.mapInArrow(count, "feature int, fold int, bin int, n0 long, n1 long")
    return made.groupBy("feature", "fold", "bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _auc_of_counts(score: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> float | None:
    """Area under the ROC curve of counted scores; equal scores count half."""
    if not n0.sum() or not n1.sum():
        return None
    _, at = np.unique(score, return_inverse=True)
    neg, pos = np.bincount(at, weights=n0), np.bincount(at, weights=n1)
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (neg.sum() * pos.sum()))


def feature_time_consistency(df: DataFrame, names: Sequence[str], label: str, group: str, k: int = 4, params: dict | None = None,
                             seed: int = 0) -> DataFrame:
    """(feature, auc, flagged): does one feature alone, trained on some periods, still separate the classes in others? Mean AUC
    over group folds; below one half it is flagged.

    The rows are read for the bins and once more to count them per feature, fold, bin and class. Boosters learn from these counts, a
    few hundred per feature, which says the same as learning from the rows.
    """
    p = settings(CONSISTENCY_BOOSTER if params is None else params)
    folds = pin(group_folds(df.select(col(group)), group, k))
    edges = fit_bins(df, names, p["max_bin"])
    bins = bin_count(edges)
    rows = attach(df.select(*[col(n) for n in names], col(label), col(group)), folds, group)
    listed_names = list(names)

    def judge(counts: pd.DataFrame) -> pd.DataFrame:
        aucs = []
        for i in range(k):
            learn, test = counts[counts["fold"] != i], counts[counts["fold"] == i]
            cells = learn.groupby("bin", as_index=False)[["n0", "n1"]].sum()
            x = np.repeat(cells["bin"].to_numpy(np.uint8), 2)[:, None]
            weight = cells[["n0", "n1"]].to_numpy(float).reshape(-1)
            margin = local_margins(x, np.tile([0.0, 1.0], len(cells)), weight, bins, p, seed)
            # A bin that only the test fold has is scored like any other value: by where the trees send it.
            auc = _auc_of_counts(margin(test["bin"].to_numpy(np.uint8)[:, None]), test["n0"].to_numpy(float), test["n1"].to_numpy(float))
            if auc is not None:
                aucs.append(auc)
        return pd.DataFrame({"feature": [listed_names[int(counts["feature"].iloc[0])]], "auc": [float(np.mean(aucs)) if aucs else None]})

    found = _bin_counts(rows, names, edges, label, k).groupBy("feature").applyInPandas(judge, "feature string, auc double")
    return found.withColumn("flagged", F.col("auc") < 0.5)


# ---- kernel machine and neural network --------------------------------------------------


def rbf_gamma(df: DataFrame, names: Sequence[str]) -> float:
    """1 / (columns * variance of all entries)."""
    row = _wide(df, names, {"n": F.count, "m": F.avg, "v": F.var_pop}).first()
    n = sum(row[f"{c}|n"] for c in names)
    mean = sum(row[f"{c}|n"] * row[f"{c}|m"] for c in names) / n
    var = sum(row[f"{c}|n"] * (row[f"{c}|v"] + (row[f"{c}|m"] - mean) ** 2) for c in names) / n
    return 1.0 / (len(names) * var) if var else 1.0


def fourier_features(df: DataFrame, names: Sequence[str], gamma: float, size: int = 256, seed: int = 0) -> DataFrame:
    """Random Fourier features: their inner products approximate the RBF kernel."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2.0 * gamma), size=(len(names), size))
    phase = rng.uniform(0.0, 2.0 * np.pi, size)

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        if x.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.sqrt(2.0 / size) * np.cos(np.stack(x.to_numpy()) @ weights + phase)))

    return df.withColumn("features", array_to_vector(project(F.array(*[col(n).cast("double") for n in names]))))


def _by_role(model, vectors: DataFrame, label: str) -> DataFrame:
    return accuracy(model.transform(vectors), label, "prediction", "role")


def svm_train_score(split: DataFrame, names: Sequence[str], label: str, gamma: float | str = "scale", c: float = 1.0,
                    size: int = 256, max_iter: int = 50, seed: int = 0) -> DataFrame:
    """(role, accuracy) of an RBF support vector machine; `role` is 'train' or 'test'. The cost c
    of a margin violation weighs the sum over the rows, MLlib's penalty their mean."""
    train = split.filter(F.col("role") == "train")
    g = rbf_gamma(train, names) if gamma == "scale" else float(gamma)
    vectors = fourier_features(split, names, g, size, seed).select(col(label), "role", "features").persist()
    try:
        rows = vectors.filter(F.col("role") == "train")
        model = LinearSVC(labelCol=label, featuresCol="features", maxIter=max_iter, regParam=1.0 / (c * max(rows.count(), 1))).fit(rows)
        return pin(_by_role(model, vectors, label))
    finally:
        vectors.unpersist()


def mlp_train_score(split: DataFrame, names: Sequence[str], label: str, layers: Sequence[int] = (100, 100, 100, 100, 100),
                    max_iter: int = 100, model_path: str | None = None, seed: int = 0) -> DataFrame:
    """(role, accuracy, auc) of a network that was trained, saved and read back."""
    vectors = assemble(split, names).select(col(label), "role", "features").persist()
    path = model_path or scratch_path(split.sparkSession, "network")
    try:
        MultilayerPerceptronClassifier(
            labelCol=label, featuresCol="features", layers=[len(names), *layers, 2], maxIter=max_iter, seed=seed,
        ).fit(vectors.filter(F.col("role") == "train")).write().overwrite().save(path)
        scored = pin(score_rows(MultilayerPerceptronClassificationModel.load(path), vectors, label, "role"))
    finally:
        vectors.unpersist()
    decided = accuracy(threshold_labels(scored, "score"), label, "predicted", "role")
    return attach(decided, pin(auc_roc(scored, label, "score", "role")), "role")


def submission(template: DataFrame, predictions: DataFrame, key: str, placeholder: str, score: str, path: str) -> str:
    """Write the template with the predicted scores as CSV, in key order."""
    return csv_sink(join_submission(template, predictions, key, placeholder, score), path)
