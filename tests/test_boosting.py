"""Boosted trees: the same trees as Spark ML's own learner, in few passes over few bytes."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cardwatch.operators import boosting, explain, learn, windows
from cardwatch.operators.prepare import with_weight

NAMES = ["x_a", "x_b", "x_c", "x_d", "x_e", "x_f"]


@pytest.fixture(scope="module")
def rows(spark):
    """Many values, seven, two and one; 9,000 rows are few enough for Spark ML to look at all of them for its thresholds."""
    x = (
        spark.range(9000).select(
            F.concat(F.lit("t"), "id").alias("transaction_bk"), F.rand(1).alias("x_a"), F.rand(2).alias("x_b"),
            F.floor(F.rand(3) * 7).cast("double").alias("x_c"), (F.rand(4) < 0.3).cast("double").alias("x_d"),
            F.lit(1.0).alias("x_e"), (F.rand(6) < 0.6).cast("double").alias("x_f"),
        )
    )
    score = F.col("x_a") + F.col("x_b") * F.col("x_c") / 7 + 0.3 * F.col("x_d") + 0.2 * F.rand(9)
    out = windows.holdout_split(x.withColumn("is_fraud", score > 1.3), 0.2).persist()
    assert out.count() == 9000
    return out


def nodes(model, spark):
    """Nodes of all trees; figures to nine places, as sums of rows come in any order."""
    trees = explain._tree_nodes(model, spark)
    keep = ("prediction", "impurity", "gain", "rawCount", "leftChild", "rightChild", "impurityStats")
    return {
        (t, n): [x["split"]["featureIndex"], *x["split"]["leftCategoriesOrThreshold"], *np.hstack([x[k] for k in keep])]
        for t, found in trees.items() for n, x in found.items()
    }


@pytest.mark.parametrize("held", [None, "is_validation"])
def test_trees_are_those_of_spark_ml(spark, rows, held):
    mine = learn.fit_boosted(rows, NAMES, trees=40, step=0.3, depth=4, validation=held)
    learner = GBTClassifier(maxIter=40, stepSize=0.3, maxDepth=4, weightCol="weight", seed=42)
    if held:
        learner = learner.setValidationIndicatorCol(held)
    n, frauds = rows.count(), rows.where("is_fraud").count()
    labelled = with_weight(rows, (n - frauds) / frauds).withColumn("label", F.col("is_fraud").cast("double"))
    theirs = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), learner]).fit(labelled)
    assert mine.stages[-1].treeWeights == theirs.stages[-1].treeWeights
    got, want = nodes(mine, spark), nodes(theirs, spark)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k], rtol=1e-9, atol=1e-9) for k in want)
    assert np.allclose(mine.stages[-1].featureImportances.toArray(), theirs.stages[-1].featureImportances.toArray())
    both = learn.apply_model(rows, mine).select("transaction_bk", "score").join(
        learn.apply_model(rows, theirs).select("transaction_bk", F.col("score").alias("other")), "transaction_bk"
    )
    assert both.select(F.max(F.abs(F.col("score") - F.col("other")))).first()[0] < 1e-9


def test_a_tree_is_one_job_per_level(spark, rows):
    """Spark ML has a job for each level and others for thresholds, errors and copies of the rows."""
    sc, jobs = spark.sparkContext, {}
    for trees in (2, 20):
        sc.setJobGroup(f"fit-{trees}", "fit")
        learn.fit_boosted(rows, NAMES, trees=trees, depth=3)
        jobs[trees] = len(sc.statusTracker().getJobIdsForGroup(f"fit-{trees}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[20] - jobs[2] <= 18 * 3


def test_of_two_children_the_smaller_is_added_up(spark, rows, monkeypatch):
    looked_at = []
    one = boosting._Grower.sums

    def counted(self, levels, slots):
        found = one(self, levels, slots)
        looked_at.append((len(levels), found.whole[..., 0].sum()))
        return found

    monkeypatch.setattr(boosting._Grower, "sums", counted)
    learn.fit_boosted(rows, NAMES, trees=5, depth=4)
    assert {n for level, n in looked_at if level == 0} == {9000}
    assert all(n <= 4500 for level, n in looked_at if level) and len(looked_at) == 5 * 4 + 1


def test_rows_are_held_as_bytes(spark):
    """22 inputs, of them 16 of two values, are 8 bytes of a row and one for its label."""
    x = [F.rand(i).alias(f"x{i}") for i in range(6)] + [(F.rand(i) < 0.4).cast("double").alias(f"x{i}") for i in range(6, 22)]
    rows = spark.range(500).select(*x, (F.rand(50) < 0.3).alias("is_fraud")).persist()
    names = [f"x{i}" for i in range(22)]
    layout = boosting.fit_layout(rows, names, (1.0, 2.0), None)
    blocks = boosting._blocks(rows, names, layout, None).collect()
    assert sum(len(b.label) for b in blocks) == 500 and {len(b.codes) for b in blocks} == {8}
    # every input is found again in its byte or bit
    got = [np.concatenate([(b.codes[c] & bit) != 0 if bit else b.codes[c] for b in blocks]) for c, bit in zip(layout.column, layout.bit)]
    want = rows.toPandas()
    for i, name in enumerate(names):
        assert sorted(got[i]) == sorted(np.searchsorted(layout.thresholds[i], want[name].to_numpy()))


def test_thresholds_come_from_all_rows(spark):
    """One row in 50,000 has a value of its own, and a summary of few points keeps shares of the weight."""
    rows = spark.range(0, 50000, 1, 4).select(
        (F.col("id") == 31234).cast("double").alias("x_rare"), F.rand(1).alias("x_many"), (F.rand(2) < 0.1).alias("is_fraud")
    ).persist()
    layout = boosting.fit_layout(rows, ["x_rare", "x_many"], (1.0, 9.0), None, summary=512)
    assert list(layout.thresholds[0]) == [0.5]
    cut = layout.thresholds[1]
    assert len(cut) == boosting.MAX_BINS - 1
    seen = rows.toPandas()
    share = np.histogram(seen["x_many"], [-1, *cut, 2], weights=np.where(seen["is_fraud"], 9.0, 1.0))[0]
    assert np.abs(share / share.sum() - 1 / boosting.MAX_BINS).max() < 4 / 512


def test_a_summary_is_bounded_however_many_rows_a_task_has():
    rng = np.random.default_rng(3)
    parts = [boosting._shortened(*boosting._summary(rng.random(5000), rng.random(5000) < 0.1, (1.0, 9.0)), 256) for _ in range(20)]
    value, weight = boosting._shortened(*boosting._merged(parts), 256)
    assert len(value) <= 256 and np.isclose(weight.sum(), sum(w.sum() for _, w in parts))
    assert np.abs(np.cumsum(weight) / weight.sum() - value).max() < 0.02


def test_equal_splits_go_to_the_first_input(spark):
    rows = spark.range(400).select(
        (F.col("id") % 2).cast("double").alias("x_a"), (1 - F.col("id") % 2).cast("double").alias("x_b"),
        ((F.col("id") % 2 == 0) != (F.col("id") % 11 == 0)).alias("is_fraud"),
    )
    for partitions in (1, 7):
        model = learn.fit_boosted(rows.repartition(partitions), ["x_a", "x_b"], trees=20)
        assert list(model.stages[-1].featureImportances.toArray()) == [1.0, 0.0]


def test_missing_inputs_are_an_error(spark):
    rows = spark.createDataFrame([(1.0, True), (None, False), (2.0, False)], "x_a double, is_fraud boolean")
    with pytest.raises(Exception, match="missing values"):
        learn.fit_boosted(rows, ["x_a"], trees=1)


def test_nothing_to_split(spark):
    """Constant inputs, and fewer rows than bins."""
    rows = spark.createDataFrame([(1.0, True), (1.0, False), (1.0, False)], "x_a double, is_fraud boolean")
    model = learn.fit_boosted(rows, ["x_a"], trees=3)
    assert {r["score"] for r in learn.apply_model(rows, model).collect()} == {0.5}
    few = spark.createDataFrame([(1.0, True), (2.0, False), (3.0, False)], "x_a double, is_fraud boolean")
    found = learn.apply_model(few, learn.fit_boosted(few, ["x_a"], trees=3)).orderBy("x_a").collect()
    assert found[0]["score"] > 0.5 > found[1]["score"] == found[2]["score"]
