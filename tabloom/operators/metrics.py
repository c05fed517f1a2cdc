"""Classification metrics. Rows are reduced to counts first; everything after is tiny."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import col, listed
from ..ordering import attach, running_totals
from ..session import pin


def _count_if(condition: Column, weight: str | None) -> Column:
    """Rows for which a condition holds, or the sum of their weights."""
    return F.count_if(condition) if weight is None else F.sum(F.when(condition, col(weight)).otherwise(0))


def auc_roc(df: DataFrame, y: str, score: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """Area under the ROC curve; equal scores count half. One row (per class of `by`). A row stands for `weight` rows."""
    keys = listed(by)
    known = df.filter(col(y).isNotNull() & col(score).isNotNull())
    counts = known.groupBy(*[col(k) for k in keys], col(score).alias("_score")).agg(
        _count_if(col(y) == 1, weight).alias("pos"), _count_if(col(y) == 0, weight).alias("neg"))
    ranked = running_totals(counts, ["_score"], {"neg_before": "neg"}, keys)
    area = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    both = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(*keys).agg(F.when(both > 0, area / both).alias("auc"))


def threshold_labels(df: DataFrame, score: str, name: str = "predicted") -> DataFrame:
    """0/1 decision of a probability; exactly one half rounds to the even 0."""
    return df.withColumn(name, F.bround(col(score).cast("double"), 0).cast("int"))


def confusion_counts(df: DataFrame, y: str, yhat: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    def cell(truth: int, guess: int) -> Column:
        return _count_if((col(y) == truth) & (col(yhat) == guess), weight)

    return df.groupBy(*listed(by)).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn"))


def _cells(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    """(by, truth, predicted, count): at most classes squared rows (per class of by)."""
    return df.groupBy(*[col(k) for k in listed(by)], col(y).alias("truth"), col(yhat).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    """(by, truth, predicted, count) over all combinations of the classes that occur (in that class of `by`)."""
    keys = listed(by)
    cells = pin(_cells(df, y, yhat, by))
    classes = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("truth", "predicted")))))
    grid = cells.groupBy(*keys).agg(classes.alias("classes")).select(*keys, F.explode("classes").alias("truth"), "classes").select(
        *keys, "truth", F.explode("classes").alias("predicted"))
    return grid.join(cells, [*keys, "truth", "predicted"], "left").fillna(0, ["count"])


def confusion_matrix_norm(df: DataFrame, y: str, yhat: str, numpy_broadcast: bool = False) -> DataFrame:
    """Shares of each true class. numpy_broadcast divides column j by the size of class j
    instead, which is what dividing a matrix by its row sums literally does in numpy."""
    cells = confusion_matrix(df, y, yhat)
    if not numpy_broadcast:
        total = F.sum("count").over(Window.partitionBy("truth"))
        return cells.select("truth", "predicted", F.when(total > 0, F.col("count") / total).alias("share"))
    cells = pin(cells)
    totals = cells.groupBy(F.col("truth").alias("predicted")).agg(F.sum("count").alias("total"))
    return cells.join(totals, "predicted", "left").select(
        "truth", "predicted", F.when(F.col("total") > 0, F.col("count") / F.col("total")).alias("share"))


def accuracy(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    return df.groupBy(*listed(by)).agg(F.avg((col(y) == col(yhat)).cast("double")).alias("accuracy"))


def _per_class(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    """(by, class, tp, fp, fn, support)."""
    sides = F.array(
        F.struct(F.col("truth").alias("class"), F.lit(True).alias("real")),
        F.struct(F.col("predicted").alias("class"), F.lit(False).alias("real")))
    keys = listed(by)
    long = _cells(df, y, yhat, by).select(*keys, "truth", "predicted", "count", F.inline(sides))
    hit = F.col("truth") == F.col("predicted")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("count")).otherwise(0))

    return long.groupBy(*keys, "class").agg(
        total(hit & F.col("real")).alias("tp"), total(~hit & ~F.col("real")).alias("fp"),
        total(~hit & F.col("real")).alias("fn"), total(F.col("real")).alias("support"))


def _scores(df: DataFrame, y: str, yhat: str, ratio, by: str | None = None) -> DataFrame:
    """(by, average, value): macro, micro, weighted, one row per class, and the positive class
    with an undefined ratio counted as 1 ('binary'); elsewhere undefined ratios count as 0."""
    keys = listed(by)
    classes = _per_class(df, y, yhat, by)
    top, bottom = ratio(F.col("tp"), F.col("fp"), F.col("fn"))
    value = F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
    all_top, all_bottom = ratio(F.sum("tp"), F.sum("fp"), F.sum("fn"))
    one = F.when(bottom > 0, top / bottom).otherwise(F.lit(1.0))
    each = F.array_sort(F.collect_list(F.struct(F.concat(F.lit("class_"), F.col("class").cast("string")).alias("average"), value.alias("value"))))
    row = classes.groupBy(*keys).agg(
        F.avg(value).alias("macro"),
        F.when(all_bottom > 0, all_top / all_bottom).otherwise(F.lit(0.0)).alias("micro"),
        (F.sum(value * F.col("support")) / F.sum("support")).alias("weighted"),
        F.max(F.when(F.col("class") == 1, one)).alias("binary"), each.alias("each"))
    named = F.array(*[F.struct(F.lit(n).alias("average"), F.col(n).alias("value")) for n in ("macro", "micro", "weighted", "binary")])
    return row.select(*keys, F.inline(F.concat(named, F.col("each"))))


def precision_scores(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    return _scores(df, y, yhat, lambda tp, fp, fn: (tp, tp + fp), by)


def recall_scores(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    return _scores(df, y, yhat, lambda tp, fp, fn: (tp, tp + fn), by)


def f1_scores(df: DataFrame, y: str, yhat: str, by: str | None = None) -> DataFrame:
    return _scores(df, y, yhat, lambda tp, fp, fn: (2 * tp, 2 * tp + fp + fn), by)


def fold_scores(predictions: DataFrame, y: str, score: str, by: str) -> DataFrame:
    """(by, metric, average, value): precision, recall and F1 of the rounded scores, per fold and in all averages."""
    decided = threshold_labels(predictions, score, "_yhat").select(col(by), col(y).alias("_y"), "_yhat")
    ways = {"precision": precision_scores, "recall": recall_scores, "f1": f1_scores}
    parts = [f(decided, "_y", "_yhat", by).withColumn("metric", F.lit(n)) for n, f in ways.items()]
    return reduce(DataFrame.unionByName, parts).select(col(by), "metric", "average", "value")


def fold_report(predictions: DataFrame, y: str, score: str, by: str, weight: str | None = None) -> DataFrame:
    """(by, auc, accuracy, tp, fp, tn, fn) per fold of scored rows; a row stands for `weight` rows."""
    decided = threshold_labels(predictions, score, "_yhat")
    counts = confusion_counts(decided, y, "_yhat", by, weight).withColumn(
        "accuracy", (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")))
    return attach(auc_roc(predictions, y, score, by, weight), pin(counts), by).select(
        col(by), "auc", "accuracy", "tp", "fp", "tn", "fn")
