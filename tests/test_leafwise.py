"""The leaf-wise booster against a plain one that looks at every row and every threshold, one split at a time."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import leafwise, models, search
from tabloom.operators.leafwise import DEFAULTS, fit_bins, fit_leafwise, score_leafwise

NAMES = ["a", "b", "c"]


def plain_booster(x, y, p, drawn=lambda number: None):
    """(scores, gains per feature, leaves per tree) of boosting on bins x."""
    quality = lambda g, h: max(abs(g) - p["reg_alpha"], 0) ** 2 / (h + p["reg_lambda"])
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    gains, leaf_counts = np.zeros(x.shape[1]), []

    def best(rows, g, h, features):
        found = None
        for f in features:
            for t in range(int(x[:, f].max())):
                left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                if min(len(left), len(right)) < max(1, p["min_child_samples"]):
                    continue
                if min(h[left].sum(), h[right].sum()) < p["min_child_weight"]:
                    continue
                gain = quality(g[left].sum(), h[left].sum()) + quality(g[right].sum(), h[right].sum()) - quality(g[rows].sum(), h[rows].sum())
                if gain > max(p["min_split_gain"], 1e-12) and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, left, right)
        return found

    for number in range(p["n_estimators"]):
        share = 1 / (1 + np.exp(-margin))
        g, h = share - y, share * (1 - share)
        features = drawn(number) if drawn(number) is not None else range(x.shape[1])
        queue, leaves = [], {1: np.arange(len(y))}

        def offer(node):
            found = best(leaves[node], g, h, features)
            if found and (p["max_depth"] <= 0 or node.bit_length() - 1 < p["max_depth"]):
                heapq.heappush(queue, (-found[0], node, found))

        offer(1)
        while queue and len(leaves) < p["num_leaves"]:
            _, node, (gain, f, left, right) = heapq.heappop(queue)
            gains[f] += gain
            del leaves[node]
            leaves[2 * node], leaves[2 * node + 1] = left, right
            offer(2 * node)
            offer(2 * node + 1)
        for rows in leaves.values():
            total = g[rows].sum()
            margin[rows] -= p["learning_rate"] * np.sign(total) * max(abs(total) - p["reg_alpha"], 0) / (h[rows].sum() + p["reg_lambda"])
        leaf_counts.append(len(leaves))
    return 1 / (1 + np.exp(-margin)), gains, leaf_counts


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 40, 900), rng.integers(0, 12, 900), rng.integers(0, 25, 900)], axis=1).astype(float)
    y = (rng.uniform(size=900) < 1 / (1 + np.exp(-(x[:, 0] - 20) / 8 + (x[:, 1] > 6) * (x[:, 2] - 12) / 5))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y = rows
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "key long, a double, b double, c double, y int")


def fitted(frame, params, **more):
    model = fit_leafwise(frame, NAMES, "y", params, **more)
    found = {r.key: r.score for r in score_leafwise(model, frame, "key").collect()}
    return model, np.array([found[i] for i in range(len(found))])


CASES = [
    {"n_estimators": 3, "num_leaves": 8, "max_depth": 9, "learning_rate": 0.3, "reg_alpha": 0.3},
    {"n_estimators": 3, "num_leaves": 31, "max_depth": 3, "learning_rate": 0.1, "reg_lambda": 2.0, "min_child_samples": 5},
    {"n_estimators": 2, "num_leaves": 60, "max_depth": -1, "min_child_weight": 3.0, "min_split_gain": 0.4, "min_child_samples": 1},
    {"n_estimators": 2, "num_leaves": 2, "max_depth": 9, "reg_alpha": 5.0},
]


@pytest.mark.parametrize("limit", [leafwise.DRIVER_BYTES, 0], ids=["driver", "executors"])
@pytest.mark.parametrize("params", CASES)
def test_booster_is_the_plain_one(frame, rows, monkeypatch, params, limit):
    monkeypatch.setattr(leafwise, "DRIVER_BYTES", limit)
    x, y = rows
    model, scores = fitted(frame.repartition(5), params)
    want, gains, leaves = plain_booster(x + 1, y, DEFAULTS | params)
    assert np.allclose(scores, want, atol=1e-6)
    assert np.allclose([model.gains()[n] for n in NAMES], gains, atol=1e-4)
    assert [int((t.feature < 0).sum()) for t in model.trees] == leaves and max(leaves) <= params["num_leaves"]


def test_model_does_not_depend_on_partitions_or_on_where_sums_meet(frame, monkeypatch):
    params = {"n_estimators": 20, "num_leaves": 12, "subsample": 0.7, "subsample_freq": 2, "colsample_bytree": 0.67}
    monkeypatch.setattr(leafwise, "TREES_A_CHECKPOINT", 6)
    edges = fit_bins(frame, NAMES)
    first = fitted(frame.repartition(3), params, edges=edges)[1]
    monkeypatch.setattr(leafwise, "DRIVER_BYTES", 0)
    assert (fitted(frame.repartition(7, "b"), params, edges=edges)[1] == first).all()
    assert (fitted(frame, params | {"subsample_freq": 0}, edges=edges)[1] != first).any()


def test_columns_drawn_per_tree(frame, rows):
    x, y = rows
    params = {"n_estimators": 4, "num_leaves": 6, "colsample_bytree": 0.67}
    drawn = [leafwise.drawn_features(3, DEFAULTS | params, 9, i) for i in range(4)]
    assert all(len(d) == 2 for d in drawn) and len({tuple(d) for d in drawn}) > 1
    _, scores = fitted(frame, params, seed=9)
    assert np.allclose(scores, plain_booster(x + 1, y, DEFAULTS | params, lambda i: drawn[i])[0], atol=1e-6)


def test_saved_model_scores_alike_and_its_nodes_hold_the_gains(spark, frame, tmp_path):
    path = str(tmp_path / "model")
    model = models.gbt_train_full(frame, NAMES, "y", {"n_estimators": 5, "num_leaves": 7}, path)
    saved = {r.key: r.score for r in models.gbt_predict(path, frame, "key").collect()}
    assert saved == {r.key: r.score for r in score_leafwise(model, frame, "key").collect()}
    nodes = spark.read.parquet(f"{path}/nodes")
    sums = {r.feature: r.gain for r in nodes.filter("feature IS NOT NULL").groupBy("feature").agg(F.sum("gain").alias("gain")).collect()}
    found = models.feature_importance(model).collect()
    assert [r.importance for r in found] == sorted((r.importance for r in found), reverse=True)
    assert all(r.importance == pytest.approx(sums.get(r.feature, 0.0)) for r in found)
    # Every inner node has two children that share its rows, and every tree its rows in the leaves.
    inner = nodes.alias("p").filter("feature IS NOT NULL").join(nodes.alias("l"), F.expr("p.tree = l.tree AND p.left_node = l.node")).join(
        nodes.alias("r"), F.expr("p.tree = r.tree AND p.right_node = r.node"))
    assert inner.filter("p.n_rows <> l.n_rows + r.n_rows").count() == 0
    assert {r.n for r in nodes.filter("feature IS NULL").groupBy("tree").agg(F.sum("n_rows").alias("n")).collect()} == {900}
    # The thresholds alone, applied to the values, give the same leaves.
    top = nodes.filter("tree = 0 AND node = 0").first()
    assert frame.filter(F.col(top.feature) <= top.threshold).count() == nodes.filter(f"tree = 0 AND node = {top.left_node}").first().n_rows


def test_missing_values_nothing_and_one_class(spark, frame):
    schema = "key long, a double, y int"
    params = {"n_estimators": 3, "min_child_samples": 1}
    rows = [(i, None if i % 3 == 0 else float("nan") if i % 3 == 1 else 1.0, int(i % 3 == 2)) for i in range(60)] + [(60, 1.0, None)]
    df = spark.createDataFrame(rows, schema)
    scores = {r.key: r.score for r in score_leafwise(fit_leafwise(df, ["a"], "y", params), df, "key").collect()}
    assert all((scores[i] > 0.4) == (i % 3 == 2 or i == 60) for i in range(61))
    none = spark.createDataFrame([], schema)
    for limit in (leafwise.DRIVER_BYTES, 0):
        assert [r.score for r in score_leafwise(fit_leafwise(none, ["a"], "y", params), df, "key").collect()] == [0.5] * 61
    assert score_leafwise(fit_leafwise(df, ["a"], "y", params), none, "key").count() == 0
    ones = df.withColumn("y", F.lit(1))
    assert all(r.score > 0.99 for r in score_leafwise(fit_leafwise(ones, ["a"], "y", params), df, "key").collect())
    with pytest.raises(ValueError):
        fit_leafwise(df, ["a"], "y", {"num_leafs": 3})


def test_few_passes_for_many_leaves(frame, monkeypatch):
    """Leaves that the queue will split are counted together: far fewer passes than splits, and the same tree."""
    asked = []
    plain = leafwise.grow

    def counting(evaluate, p):
        return plain(lambda splits: asked.append(len(splits)) or evaluate(splits), p)

    monkeypatch.setattr(leafwise, "grow", counting)
    model = fit_leafwise(frame, NAMES, "y", {"n_estimators": 1, "num_leaves": 30, "min_child_samples": 5})
    assert (model.trees[0].feature < 0).sum() == 30 and len(asked) <= 15


# ---- what is built on it --------------------------------------------------------------


def test_consistency_from_counts_is_that_of_the_rows(spark, frame):
    df = frame.withColumn("month", (F.col("key") * 7 % 10).cast("int"))
    params = {"n_estimators": 12, "num_leaves": 6, "learning_rate": 0.2}
    found = {r.feature: r for r in models.feature_time_consistency(df, NAMES, "y", "month", 4, params).collect()}
    assert set(found) == set(NAMES)
    for name in NAMES:
        aucs = models.gbt_train_cv(df, [name], "y", "month", 4, params)[0].collect()
        assert found[name].auc == pytest.approx(np.mean([r.auc for r in aucs]), abs=1e-9)
        assert found[name].flagged == (found[name].auc < 0.5)


def test_consistency_with_missing_values_and_a_fold_of_one_class(spark):
    rows = [(float(i % 50) if i % 4 else None, i % 50 > 25 if i >= 200 else False, i // 100) for i in range(400)]
    df = spark.createDataFrame([(x, int(y), m) for x, y, m in rows], "x double, y int, month int")
    found = models.feature_time_consistency(df, ["x"], "y", "month", 4).collect()
    assert len(found) == 1 and 0.5 < found[0].auc <= 1.0


SPACE = {"u": ("float", -4.0, 4.0), "v": ("float", 0.0, 1.0), "w": ("step", 1, 500, 1)}


def valley(d):
    return -((d["u"] - 1.3) ** 2) - 4 * (d["v"] - 0.2) ** 2 - ((d["w"] - 350) / 100.0) ** 2


def test_search_repeats_itself_and_beats_random_draws():
    judge = lambda drawn: [valley(d) for d in drawn]
    best = lambda h: max(s for _, s in h)
    assert search.adaptive_search(SPACE, judge, 20, 5, 3) == search.adaptive_search(SPACE, judge, 20, 5, 3)
    adaptive = [best(search.adaptive_search(SPACE, judge, 60, 5, s)) for s in range(12)]
    uniform = [best(search.adaptive_search(SPACE, judge, 60, 60, s)) for s in range(12)]
    assert np.mean(adaptive) > np.mean(uniform) and np.median(adaptive) > np.median(uniform)
    assert all(1 <= d["w"] <= 500 and isinstance(d["w"], int) and -4 <= d["u"] <= 4 for d, _ in search.adaptive_search(SPACE, judge, 40, 7, 1))


def test_search_covers_steps_and_its_whole_space():
    rule = ("step", 3, 8, 1)
    assert {search._value(rule, u) for u in np.linspace(0, 1, 100)} == {3, 4, 5, 6, 7, 8}
    assert all(search._value(rule, search._place(rule, v)) == v for v in range(3, 9))
    drawn = search.adaptive_search(models.SEARCH_SPACE, lambda d: [0.0] * len(d), 10, 5, 0)
    assert all(set(d) == set(models.SEARCH_SPACE) for d, _ in drawn)
    leafwise.settings(drawn[-1][0])


def test_searched_score_is_the_accuracy_of_the_folds(spark, frame):
    space = {"num_leaves": ("step", 2, 9, 1), "learning_rate": ("float", 0.05, 0.5)}
    found = models.hyperparam_search(frame, NAMES, "key", "y", space, 4, 3, seed=2, batch=2, fixed={"n_estimators": 3}).collect()
    again = models.hyperparam_search(frame.repartition(9), NAMES, "key", "y", space, 4, 3, seed=2, batch=2, fixed={"n_estimators": 3}).collect()
    assert found == again and [r.score for r in found] == sorted((r.score for r in found), reverse=True)
    import json

    best = {"n_estimators": 3} | json.loads(found[0].parameters)
    from tabloom.operators.splits import split_stratified_kfold

    folded = split_stratified_kfold(frame, "key", "y", 3, 2)
    edges, shares = fit_bins(frame, NAMES), []
    for i in range(3):
        model = fit_leafwise(folded.filter(F.col("fold") != i), NAMES, "y", best, 2, edges)
        scored = score_leafwise(model, folded.filter(F.col("fold") == i), "y")
        shares.append(scored.agg(F.avg(((F.col("score") > 0.5) == (F.col("y") == 1)).cast("int"))).first()[0])
    assert found[0].score == pytest.approx(np.mean(shares))


# ---- cells, and what reaches the driver ---------------------------------------------------


def test_rows_of_the_same_bins_are_one_cell(spark):
    rows = [(float(i % 4), float(i % 3), int(i % 12 < 5), i % 2) for i in range(6000)] + [(0.0, 0.0, None, 0)]
    df = spark.createDataFrame(rows, "a double, b double, y int, fold int").repartition(6)
    edges = fit_bins(df, ["a", "b"])
    blocks = leafwise.packed_blocks(df, ["a", "b"], edges, "y", "fold").collect()
    assert sum(len(b.fold) for b in blocks) == len({(a, b, f) for a, b, _, f in rows[:-1]})
    assert sum(int(b.n0.sum()) + int(b.n1.sum()) for b in blocks) == 6000 and sum(int(b.n1.sum()) for b in blocks) == sum(r[2] for r in rows[:-1])
    asked = {"n_estimators": 2, "num_leaves": 4, "subsample": 0.5, "subsample_freq": 1}
    with pytest.raises(Exception, match="ids"):
        leafwise.fit_blocks(leafwise.packed_blocks(df, ["a", "b"], edges, "y", "fold"), ["a", "b"], edges, asked)


def test_sums_of_heavy_cells_are_exact():
    block = leafwise.Block(np.asfortranarray(np.array([[1], [1], [2]], np.uint8)), np.zeros(3, np.int32), np.zeros(0, np.int64),
                           np.array([3 << 30, 1, 1]), np.array([0, 0, 1]), np.array([0.3, 0.1, -0.2]))
    g, h, n = block.sums(np.arange(3))
    total = np.zeros((3, 1, 4), np.int64)
    leafwise.add_sums(total, block, [(0, np.arange(3))], np.array([0]), 4)
    for found, want in zip(total[:, 0], (g, h, n)):
        assert found.tolist() == [0, int(want[0]) + int(want[1]), int(want[2]), 0]


def test_splits_are_sought_some_nodes_at_a_time(monkeypatch):
    sums = np.random.default_rng(3).integers(0, 1 << 30, (40, 5, 9, 3))
    whole = leafwise.best_splits(sums, np.arange(5), DEFAULTS)
    widest = []
    plain = np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda a, *k, **w: widest.append(a.nbytes) or plain(a, *k, **w))
    monkeypatch.setattr(leafwise, "SEARCH_BYTES", 4 * sums[0].nbytes)
    assert leafwise.best_splits(sums, np.arange(5), DEFAULTS) == whole and max(widest) <= leafwise.SEARCH_BYTES


def test_counted_scores_report_like_rows(spark):
    from tabloom.operators import metrics

    rows = [(i % 2, int(i % 7 < 3), (i % 5) / 5 + 0.1, 1 + i % 4) for i in range(60)]
    counted = spark.createDataFrame(rows, "fold int, y int, score double, n long")
    plain = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    found = [sorted(tuple(r) for r in d.collect()) for d in (metrics.fold_report(counted, "y", "score", "fold", "n"), metrics.fold_report(plain, "y", "score", "fold"))]
    assert found[0] == found[1]


# ---- trainings side by side ---------------------------------------------------------------


def same_trees(a, b):
    return a.first == b.first and len(a.trees) == len(b.trees) and all(
        (getattr(s, c) == getattr(t, c)).all() for s, t in zip(a.trees, b.trees) for c in vars(s))


@pytest.mark.parametrize("more", [{"max_depth": 4, "reg_alpha": 0.3, "colsample_bytree": 0.67}, {"subsample": 0.6, "subsample_freq": 1, "min_child_samples": 3}])
def test_trainings_in_tasks_are_those_in_passes(frame, monkeypatch, more):
    df = frame.withColumn("month", F.col("key") % 6).withColumn("a", F.when(F.col("key") % 9 > 0, F.col("a"))).drop("c")
    df = df.unionByName(df.withColumn("month", F.col("month") + 3)).unionByName(df.limit(20).withColumn("y", F.lit(None).cast("int")))
    params = {"n_estimators": 5, "num_leaves": 14, "learning_rate": 0.3} | more

    def found():
        report, model = models.gbt_train_cv(df, ["a", "b"], "y", "month", 3, params)
        return sorted(map(tuple, report.collect())), model

    with monkeypatch.context() as m:
        m.setattr(leafwise, "TASK_BYTES", 0)
        report, model = found()
    monkeypatch.setattr(leafwise, "SparkRows", None)
    again, other = found()
    assert again == report and same_trees(model, other) and max(len(t.feature) for t in model.trees) > 9


def test_search_needs_no_pass_over_the_blocks_for_a_tree(spark, frame, monkeypatch):
    """A search of many small trees waits for few jobs: each training is a task."""
    space = {"num_leaves": ("step", 2, 9, 1), "n_estimators": ("step", 1, 3, 1)}
    search_it = lambda: models.hyperparam_search(frame, NAMES, "key", "y", space, 4, 3, seed=2, batch=2).collect()
    with monkeypatch.context() as m:
        m.setattr(leafwise, "TASK_BYTES", 0)
        want = search_it()
    monkeypatch.setattr(leafwise, "SparkRows", None)
    assert search_it() == want
    assert models.hyperparam_search(frame.limit(0), NAMES, "key", "y", space, 2, 3).count() == 2


def test_children_that_cannot_be_split_are_not_counted(rows):
    x, y = rows
    asked = []
    plain = leafwise.grow

    def counting(evaluate, p):
        return plain(lambda splits: asked.append(len(splits)) or evaluate(splits), p)

    params = leafwise.settings({"num_leaves": 40, "max_depth": 3, "min_child_samples": 1})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(leafwise, "grow", counting)
        tree = leafwise.LocalRows((x + 1).astype(np.uint8), y, np.ones(len(y)), 42, params).tree(np.arange(3))
    leaf = tree.leaves((x + 1).astype(np.uint8))
    assert asked == [0, 1, 2] and (tree.feature < 0).sum() == 8
    assert (np.bincount(leaf, minlength=len(tree.rows))[tree.feature < 0] == tree.rows[tree.feature < 0]).all()
