"""Models: oversampling and explanations against brute force, and the ordering of results."""

from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import drift, evaluate, explain, learn, profile, windows
from cardwatch.operators.oversample import FAN, LEAF, TREES, _nearest_of, leaves, nearest, oversample
from cardwatch.operators.prepare import apply_prep, fit_prep
from cardwatch.plans import inputs, models
from cardwatch.sources import logs


def recall(df, x, k=5, **options):
    """Share of the true nearest distances that the search finds."""
    got = {}
    for r in nearest(df, k, **options).collect():
        got.setdefault(r["id"], []).append(r["distance"])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    ids = [r["id"] for r in df.select("id").collect()]
    order = {i: n for n, i in enumerate(sorted(ids))}
    hits = sum((np.array(v) <= np.sort(d[order[i]])[k - 1] * (1 + 1e-9)).sum() for i, v in got.items())
    return hits / (k * len(x))


def test_nearest_finds_most_neighbours(scattered):
    rng = np.random.default_rng(0)
    clouds = [rng.normal(size=(900, 8)), rng.normal(size=(80, 8)) * 0.01 + 5, rng.integers(0, 2, (20, 8)) + rng.normal(size=(20, 8)) * 1e-6]
    x = np.concatenate(clouds)
    df = scattered.createDataFrame([(f"p{i:04d}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, v array<double>")
    assert recall(df, x) >= 0.95


def test_nearest_of_the_given_frauds(spark, src):
    data = models.split(spark, src)
    v = F.array(*[F.col(c).cast("double") for c in data.prep.columns])
    df = data.train.where("is_fraud").groupBy(v.alias("v")).agg(F.min("transaction_bk").alias("id")).persist()
    rows = sorted(df.collect(), key=lambda r: r["id"])
    assert recall(df, np.array([r["v"] for r in rows])) >= 0.95


@pytest.mark.parametrize("n", [500, 4000])
def test_compared_points_are_bounded(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 6))
    df = spark.createDataFrame([(f"p{i}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, v array<double>")
    sizes = leaves(df, TREES, LEAF, FAN, 7).groupBy("tree", "node").count().collect()
    assert sum(r["count"] for r in sizes) == n * TREES
    assert max(r["count"] for r in sizes) <= 1.5 * LEAF


def test_only_the_nearest_leave_a_leaf(spark):
    """Ids of equal distance in order, a leaf of one point, and k rows of a point where all pairs were made before."""
    x = [(f"p{i:03}", [float(i % 40), float(i // 40)]) for i in range(200)]
    near = _nearest_of(pa.table({"id": [p for p, _ in x][::-1], "v": [v for _, v in x][::-1]}), 5, tile=64)
    assert near.num_rows == 200 * 5
    found = {}
    for r in near.to_pylist():
        found.setdefault(r["id"], []).append((r["distance"], r["other"]))
    for p, v in x:
        assert found[p] == sorted((float(np.hypot(v[0] - w[0], v[1] - w[1])), o) for o, w in x if o != p)[:5]
    assert _nearest_of(pa.table({"id": ["a"], "v": [[1.0, 2.0]]}), 5).num_rows == 0


def test_oversample_size_and_segments(spark):
    rng = np.random.default_rng(1)
    rows = [(f"n{i}", float(a), float(b), False) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    frauds = [tuple(map(float, p)) for p in rng.normal(size=(20, 2)) + 4] + [(9.0, 9.0)] * 10
    rows += [(f"f{i}", a, b, True) for i, (a, b) in enumerate(frauds)]
    df = spark.createDataFrame(rows, "transaction_bk string, x_a double, x_b double, is_fraud boolean")
    out = oversample(df, ["x_a", "x_b"], ratio=0.3)
    assert out.where("is_fraud").count() == 120 and out.where("NOT synthetic").count() == len(rows)
    made = np.array([(r["x_a"], r["x_b"]) for r in out.where("synthetic").collect()])
    # Ten equal frauds have only each other as neighbours, so their synthetic rows equal them: 3 each.
    assert (made == 9.0).all(axis=1).sum() == 30
    points = np.array(sorted(set(frauds)))
    for p in made[(made != 9.0).any(axis=1)]:
        assert any(
            abs(np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b)) < 1e-9 for a, b in combinations(points, 2)
        )
    assert same_rows(out, oversample(df, ["x_a", "x_b"], ratio=0.3))


def same_rows(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_oversample_of_a_single_vector(spark):
    rows = [(f"n{i}", float(i), False) for i in range(50)] + [(f"f{i}", 3.0, True) for i in range(2)]
    df = spark.createDataFrame(rows, "transaction_bk string, x_a double, is_fraud boolean")
    made = oversample(df, ["x_a"], ratio=0.3).where("synthetic")
    assert {r["x_a"] for r in made.collect()} == {3.0} and made.count() == 13


@pytest.fixture(scope="module")
def small_trees(spark):
    rows = (
        spark.range(2000)
        .select(
            F.concat(F.lit("t"), F.col("id")).alias("transaction_bk"),
            F.rand(1).alias("x_a"), F.rand(2).alias("x_b"), F.rand(3).alias("x_c"),
        )
        .withColumn("is_fraud", (F.col("x_a") + F.col("x_b") * F.col("x_c")) > 1.1)
        .persist()
    )
    return rows, learn.fit_boosted(rows, ["x_a", "x_b", "x_c"], trees=4, step=0.3, depth=3)


def test_contributions_add_up_to_log_odds(spark, small_trees):
    rows, model = small_trees
    explained = explain.tree_contributions(rows, model)
    scored = learn.apply_model(rows, model).join(explained, "transaction_bk")
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    worst = scored.select(F.max(F.abs(total - F.log(F.col("score") / (1 - F.col("score")))))).first()[0]
    assert worst < 1e-9


def test_logistic_contributions_add_up(spark, small_trees):
    rows, _ = small_trees
    model = learn.fit_logistic(rows, ["x_a", "x_b", "x_c"])
    explained = explain.logistic_contributions(rows, model, rows)
    scored = learn.apply_model(rows, model).join(explained, "transaction_bk")
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    gap = scored.select(F.max(F.abs(total - F.log(F.col("score") / (1 - F.col("score")))))).first()[0]
    means = explained.select(*[F.avg(F.col("contributions")[i]) for i in range(3)]).first()
    assert gap < 1e-6 and max(map(abs, means)) < 1e-9


def test_validation_rows_may_stop_boosting(spark, small_trees):
    rows, _ = small_trees
    marked = windows.holdout_split(rows, 0.2)
    share = marked.where("is_validation").count() / rows.count()
    assert 0.15 < share < 0.25
    model = learn.fit_boosted(marked, ["x_a", "x_b", "x_c"], trees=3, depth=2, validation="is_validation")
    assert 1 <= len(model.stages[-1].treeWeights) <= 3


def test_contributions_are_shapley_values(spark, small_trees):
    rows, model = small_trees
    trees = explain._tree_nodes(model, spark)
    weights = model.stages[-1].treeWeights

    def expected(tree, x, known, node=0):
        n = trees[tree][node]
        if n["leftChild"] < 0:
            return n["prediction"]
        f, limit = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
        left, right = n["leftChild"], n["rightChild"]
        if f in known:
            return expected(tree, x, known, left if x[f] <= limit else right)
        share = trees[tree][left]["rawCount"] / n["rawCount"]
        return share * expected(tree, x, known, left) + (1 - share) * expected(tree, x, known, right)

    for row in explain.tree_contributions(rows.limit(5), model, keep=("transaction_bk", "x_a", "x_b", "x_c")).collect():
        x = [row["x_a"], row["x_b"], row["x_c"]]
        for i in range(3):
            value = 0.0
            others = [j for j in range(3) if j != i]
            for size in range(3):
                for s in combinations(others, size):
                    gain = sum(
                        2 * w * (expected(t, x, {*s, i}) - expected(t, x, set(s))) for t, w in enumerate(weights)
                    )
                    value += factorial(size) * factorial(2 - size) / 6 * gain
            assert abs(value - row["contributions"][i]) < 1e-9


def test_top_factors_order(spark, small_trees):
    rows, model = small_trees
    top = explain.top_factors(explain.tree_contributions(rows.limit(20), model), ["x_a", "x_b", "x_c"], 2)
    for r in top.collect():
        sizes = [abs(f["impact"]) for f in r["top_features"]]
        assert len(sizes) == 2 and sizes == sorted(sizes, reverse=True)
        assert {f["feature"] for f in r["top_features"]} <= {"a", "b", "c"}


def test_labelled_rows_are_derived_once_for_all_fits(spark, src):
    """Both sides are read from one stored table, and are all labelled rows."""
    data = models.split(spark, src)
    for side in (data.train, data.test):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan
    columns = [c for c in data.train.columns if not c.startswith("x_") and c != "split"]
    both, derived = data.train.unionByName(data.test).select(*columns), inputs.labelled(spark, src).select(*columns)
    assert both.exceptAll(derived).isEmpty() and derived.exceptAll(both).isEmpty()


def test_oversampling_raises_recall(spark, src):
    data = models.split(spark, src)
    plain = evaluate.evaluate(learn.apply_model(data.test, models.logistic(spark, src))).first()
    more = evaluate.evaluate(learn.apply_model(data.test, models.oversampled_logistic(spark, src))).first()
    assert more["recall"] >= plain["recall"] and more["precision"] <= plain["precision"]
    assert plain["auc_roc"] > 0.95 and more["auc_roc"] > 0.95


def test_boosting_ranks_well(spark, src):
    data = models.split(spark, src)
    result = evaluate.evaluate(learn.apply_model(data.test, models.boosted(spark, src))).first()
    assert result["average_precision"] > 0.9


def test_reconstruction_flags_extremes_not_context(spark):
    base = spark.range(3000).select(
        F.concat(F.lit("t"), F.col("id")).alias("transaction_bk"),
        F.randn(1).alias("u"), F.randn(2).alias("w"), F.randn(3).alias("e1"), F.randn(4).alias("e2"), F.col("id"),
    )
    kind = F.when(F.col("id") % 100 == 0, "extreme").when(F.col("id") % 100 == 1, "context")
    rows = base.select(
        "transaction_bk",
        F.col("u").alias("x_a"), (F.col("u") + 0.05 * F.col("e1")).alias("x_b"),
        F.col("w").alias("x_c"), (F.col("w") + 0.05 * F.col("e2") + F.when(kind == "extreme", 5.0).otherwise(0.0)).alias("x_d"),
        kind.alias("fraud_type"), kind.isNotNull().alias("is_fraud"),
    ).persist()
    columns = ["x_a", "x_b", "x_c", "x_d"]
    model = learn.fit_reconstruction(rows, columns, size=2)
    errors = learn.reconstruction_error(rows, model)
    flagged = learn.anomaly_flags(errors, errors.where("NOT is_fraud"))
    found = {r["fraud_type"]: r["detected_pct"] for r in evaluate.detection_by_type(flagged.withColumn("score", F.col("flag").cast("int"))).collect()}
    assert found["extreme"] == 100.0 and found["context"] < 20.0
    alarms = flagged.where("NOT is_fraud AND flag").count()
    assert abs(alarms - 0.01 * 2940) <= 1


def test_reconstruction_error_is_the_mean_squared_residual(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([(f"t{i}", *map(float, r), False) for i, r in enumerate(x)], "transaction_bk string, a double, b double, c double, d double, is_fraud boolean")
    model = learn.fit_reconstruction(df, ["a", "b", "c", "d"], size=2)
    got = {r["transaction_bk"]: r["error"] for r in learn.reconstruction_error(df, model).collect()}
    centred = x - x.mean(0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    rest = centred - centred @ vt[:2].T @ vt[:2]
    want = (rest**2).mean(1)
    assert np.allclose([got[f"t{i}"] for i in range(200)], want)


def test_standardising_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "b")], "n double, c string")
    prep = fit_prep(df, ["n"], [], ["c"])
    unseen = spark.createDataFrame([(3.0, "zzz")], "n double, c string")
    assert tuple(apply_prep(unseen, prep).select(*prep.columns).first()) == (2.0, 0.0, 0.0)


def test_injected_drift_is_found_and_identity_is_not(spark, src):
    rows = inputs.labelled(spark, src).persist()
    numeric, categorical = ("amount", "home_distance_km", "hour", "day"), ("channel", "auth_method")
    same = drift.drift_report(rows, rows, numeric, categorical, "same").first()
    assert same["n_drifted"] == 0 and not same["alert"]
    moved = drift.drift_report(rows, drift.inject_drift(rows, "day", 31), numeric, categorical, "moved").first()
    assert moved["alert"] and {"amount", "day"} <= set(moved["drifted_columns"].split(","))
    assert "channel" not in moved["drifted_columns"]


def test_wasserstein_across_ranges(scattered):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400), rng.normal(size=300) * 2 + 1
    ref = scattered.createDataFrame([(float(v),) for v in a], "x double")
    cur = scattered.createDataFrame([(float(v),) for v in b], "x double")
    got = drift.numeric_drift(ref, cur, ["x"]).first()["score"]
    grid = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid[:-1], side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid[:-1], side="right") / len(b)
    assert abs(got - (np.abs(fa - fb) * np.diff(grid)).sum() / a.std()) < 1e-9


def test_model_log_points_to_the_highest_version(spark):
    runs = logs.model_run(spark, "gbt", 1, "/m/1", {"auc": 0.9}).unionByName(
        logs.model_run(spark, "gbt", 12, "/m/12", {"auc": 0.8, "ap": 0.7})
    )
    assert tuple(logs.production_model(runs).first()) == ("gbt", 12, "/m/12")


def test_detector_card_without_signals(spark):
    df = spark.createDataFrame([(False, True), (False, False)], "flag boolean, is_fraud boolean")
    assert tuple(profile.detector_card(df).first()) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_sample_is_stable_and_complete(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("transaction_bk"))
    one, two = windows.sample_rows(df, 50), windows.sample_rows(df.repartition(7), 50)
    assert {r[0] for r in one.collect()} == {r[0] for r in two.collect()} and one.count() == 50


def test_a_fit_reads_as_many_partitions_as_there_are_cores(spark):
    from pyspark.ml import Estimator
    from pyspark.ml.feature import VectorAssembler

    class Seen(Estimator):
        def _fit(self, dataset):
            self.partitions, self.rows = dataset.rdd.getNumPartitions(), dataset.count()
            return VectorAssembler(inputCols=["x"], outputCol="again")

    cores = spark.sparkContext.defaultParallelism
    for partitions in (1, 5 * cores):
        rows = spark.range(0, 400, 1, partitions).selectExpr("CAST(id AS double) AS x", "id % 7 = 0 AS is_fraud")
        seen = Seen()
        learn._fit(rows, ["x"], lambda counts: seen)
        assert (seen.partitions, seen.rows) == (cores, 400)


def test_boxes_of_several_trees_are_looked_up_once(spark):
    """One input of two values: however many trees there are, they have the same two leaves."""
    rows = spark.range(300).select(
        F.concat(F.lit("t"), "id").alias("transaction_bk"), (F.col("id") % 2).cast("double").alias("x_a"),
        (F.col("id") % 6).cast("double").alias("x_b"), ((F.col("id") % 2 == 0) != (F.col("id") % 11 == 0)).alias("is_fraud"),
    )
    model = learn.fit_boosted(rows.withColumn("x_b", F.lit(1.0)), ["x_a", "x_b"], trees=9)
    assert len(explain.ensemble_tables(model, spark)[1]) == 2
    parts = explain.tree_contributions(rows, model, keep=("transaction_bk", "x_a")).select("x_a", "contributions").distinct().collect()
    assert len(parts) == 2 and all(r["contributions"][1] == 0.0 for r in parts)
