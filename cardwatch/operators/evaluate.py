"""Evaluation of scores: curves, exact ranking measures, threshold sweeps and business figures.

Inputs have one row per transaction with a boolean label and a score. Rows are first added up per
distinct score or per threshold band, with map-side combining, before anything is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.scalar import f1, ratio
from cardwatch.functions.spread import running_totals

# Price of a false alert in euros, and the factor from 2.5 months to a year.
ALERT_COST = 8.0
ANNUAL_FACTOR = 12 / 2.5


def score_steps(scores: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """Positives and negatives per distinct score, their totals from the top score down, and overall (p, n)."""
    counts = (
        scores.where(F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    )
    return running_totals(counts, [F.desc("score")], ["pos", "neg"]).withColumnsRenamed(
        {"run_pos": "tp", "run_neg": "fp", "all_pos": "p", "all_neg": "n"}
    )


def roc_points(scores: DataFrame, score: str = "score") -> DataFrame:
    """False and true positive rate at every distinct score."""
    return score_steps(scores, score).select(
        "score",
        F.round(ratio(F.col("fp"), F.col("n")), 6).alias("fpr"),
        F.round(ratio(F.col("tp"), F.col("p")), 6).alias("tpr"),
    )


def pr_points(scores: DataFrame, score: str = "score") -> DataFrame:
    """Precision and recall at every distinct score."""
    return score_steps(scores, score).select(
        "score",
        F.round(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"),
        F.round(ratio(F.col("tp"), F.col("p")), 6).alias("recall"),
    )


def evaluate(scores: DataFrame, threshold: float = 0.5, score: str = "score", digits: int = 4) -> DataFrame:
    """ROC-AUC with ties, Gini, average precision, and precision, recall and F1 at a threshold; one row."""
    steps = score_steps(scores, score)
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    above = F.col("score") >= threshold
    sums = steps.agg(
        # Twice the area under the steps, kept in whole numbers.
        F.sum(neg.cast("decimal(20,0)") * (tp + tp - pos)).cast("double").alias("area2"),
        F.sum(pos * ratio(tp, tp + fp)).alias("ap"),
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
        F.coalesce(F.sum(F.when(above, pos)), F.lit(0)).alias("hit"),
        F.coalesce(F.sum(F.when(above, neg)), F.lit(0)).alias("alarm"),
    )
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    auc = F.try_divide(F.col("area2"), F.lit(2.0) * p * n)
    precision = ratio(F.col("hit"), F.col("hit") + F.col("alarm"))
    recall = ratio(F.col("hit"), F.col("p"))
    return sums.select(
        F.lit(float(threshold)).alias("threshold"),
        F.bround(auc, digits).alias("auc_roc"),
        F.bround(auc * 2 - 1, digits).alias("gini"),
        F.bround(F.try_divide(F.col("ap"), p), digits).alias("average_precision"),
        F.bround(precision, digits).alias("precision"),
        F.bround(recall, digits).alias("recall"),
        F.bround(f1(precision, recall), digits).alias("f1"),
    )


def hundredth_band(score: Column) -> Column:
    """How many of the thresholds 0.01, 0.02, ..., 0.99 the score reaches, exact at the thresholds."""
    guess = F.floor(score * 100)
    low, high = guess / F.lit(100.0), (guess + 1) / F.lit(100.0)
    exact = guess + F.when(score >= high, 1).when(score < low, -1).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(99), exact)).cast("int")


def threshold_sweep(scores: DataFrame, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """Precision, recall and F1 at 0.01 ... 0.99: one pass into 100 bands, then sums over the bands above."""
    bands = (
        scores.where(F.col(label).isNotNull())
        .groupBy(hundredth_band(F.col(score).cast("double")).alias("band"))
        .agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    )
    all_bands = scores.sparkSession.range(100).select(F.col("id").cast("int").alias("band"))
    down = Window.orderBy(F.desc("band"))  # a hundred rows
    totals = all_bands.join(bands, "band", "left").select(
        "band",
        F.coalesce(F.sum("pos").over(down), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(down), F.lit(0)).alias("fp"),
        F.coalesce(F.sum("pos").over(Window.partitionBy()), F.lit(0)).alias("p"),
    )
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("p"))
    return totals.where(F.col("band") > 0).select(
        (F.col("band") / F.lit(100.0)).alias("threshold"),
        "tp",
        "fp",
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(f1(precision, recall), 6).alias("f1"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The lowest threshold with the highest F1."""
    best = F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("threshold"))).alias("b")
    return sweep.agg(best).select("b.threshold", "b.f1")


def confusion(scores: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """Row counts per label and decision."""
    return scores.groupBy(
        F.col("is_fraud").cast("int").alias("label"), (F.col(score) >= threshold).cast("int").alias("predicted")
    ).agg(F.count("*").alias("n"))


def detection_by_type(scores: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """Share of the frauds of each type that are flagged, highest first."""
    return (
        scores.where("is_fraud")
        .groupBy("fraud_type")
        .agg(
            F.count("*").alias("n_frauds"),
            F.bround(F.avg((F.col(score) >= threshold).cast("int")) * 100, 2).alias("detected_pct"),
        )
        .orderBy(F.desc("detected_pct"), "fraud_type")
    )


def align_scores(a: DataFrame, b: DataFrame, bk: str = "transaction_bk") -> DataFrame:
    """Two models' scores of the same transactions side by side (`score_a`, `score_b`)."""
    left = a.select(bk, "is_fraud", F.col("score").alias("score_a"))
    return left.join(b.select(bk, F.col("score").alias("score_b")), bk)


def complementarity(
    pairs: DataFrame, threshold_a: float = 0.5, threshold_b: float = 0.5
) -> DataFrame:
    """Frauds caught by both models, by one of them, or by none."""
    a, b = F.col("score_a") >= threshold_a, F.col("score_b") >= threshold_b
    return pairs.where("is_fraud").agg(
        F.count_if(a & b).alias("both"),
        F.count_if(a & ~b).alias("only_a"),
        F.count_if(~a & b).alias("only_b"),
        F.count_if(~a & ~b).alias("none"),
    )


def business_kpis(
    scores: DataFrame,
    thresholds: Sequence[float],
    cost: float = ALERT_COST,
    annual: float = ANNUAL_FACTOR,
    score: str = "score",
) -> DataFrame:
    """Fraud amount avoided and missed, alert cost and net benefit at each threshold.

    Rows are added up once per band between thresholds; the figures of all thresholds are sums over bands.
    """
    marks = sorted(thresholds)
    reached = sum((F.col(score) >= F.lit(float(t))).cast("int") for t in marks)
    amount = F.col("amount").cast("decimal(38,2)")
    bands = (
        scores.where(F.col("is_fraud").isNotNull())
        .groupBy(reached.alias("band"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("is_fraud"), amount)), F.lit(0)).cast("double").alias("fraud_amount"),
            F.count_if(~F.col("is_fraud")).alias("legit"),
        )
    )
    per_band = F.create_map(*[x for i, t in enumerate(marks, 1) for x in (F.lit(i), F.lit(float(t)))])
    levels = scores.sparkSession.range(len(marks) + 1).select(F.col("id").cast("int").alias("band"))
    down = Window.orderBy(F.desc("band"))  # one row per threshold
    table = levels.join(bands, "band", "left").select(
        "band",
        F.try_element_at(per_band, F.col("band")).alias("threshold"),
        F.coalesce(F.sum("fraud_amount").over(down), F.lit(0.0)).alias("avoided"),
        F.coalesce(F.sum("fraud_amount").over(Window.partitionBy()), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum("legit").over(down), F.lit(0)).alias("false_alerts"),
    )
    spent = F.col("false_alerts") * F.lit(cost)
    net = F.col("avoided") - spent
    return table.where(F.col("band") > 0).select(
        "threshold",
        F.round("total", 2).alias("fraud_amount_total"),
        F.round("avoided", 2).alias("fraud_amount_avoided"),
        F.round(F.col("total") - F.col("avoided"), 2).alias("fraud_amount_missed"),
        "false_alerts",
        F.round(spent, 2).alias("alert_cost"),
        F.round(net, 2).alias("net_benefit"),
        F.round(net * F.lit(annual), 2).alias("net_benefit_per_year"),
    )


def top_fraud(scores: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """The confirmed fraud with the highest score at or above the threshold."""
    return (
        scores.where(F.col("is_fraud") & (F.col(score) >= threshold))
        .orderBy(F.desc(score), "transaction_bk")
        .limit(1)
    )
