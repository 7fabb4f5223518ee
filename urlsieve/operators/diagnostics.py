"""Checks of a model on other data: external sets, thresholds, drift, leakage, bare domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import count_if, feature_moments, group_rate, ratio
from urlsieve.operators.evaluate import NOISE_FLOOR
from urlsieve.operators.shape import bare_domain_flag

BASELINE_RECALL = 0.9539
THRESHOLDS = (0.5, 0.4, 0.3, 0.2, 0.1)
MIN_SD = 1e-6


def external_metrics(scored: DataFrame) -> DataFrame:
    """One row per ``set``: recall always; precision, F1, accuracy and false alarms only with benign rows."""
    y, p = F.col("label"), F.col("prediction")
    c = scored.groupBy("set").agg(
        F.count(F.lit(1)).alias("n"), count_if(y == 1).alias("n_malicious"), count_if(y == 0).alias("n_benign"),
        count_if((y == 1) & (p == 1)).alias("caught"), count_if((y == 1) & (p == 0)).alias("missed"),
        count_if((y == 0) & (p == 1)).alias("fa"), count_if(y == p).alias("right"))
    recall = ratio(F.col("caught"), F.col("n_malicious"), None)
    precision = ratio(F.col("caught"), F.col("caught") + F.col("fa"))
    f1 = F.when(recall.isNotNull(), ratio(2 * precision * recall, precision + recall))

    def with_benign(column: Column) -> Column:
        return F.when(F.col("n_benign") > 0, column)

    return c.select("set", "n", "n_malicious", recall.alias("recall"), "caught", "missed",
                    with_benign(precision).alias("precision"), with_benign(f1).alias("f1"),
                    with_benign(F.col("right") / F.col("n")).alias("accuracy"),
                    with_benign(F.col("fa")).alias("false_alarms"))


def baseline_delta(results: DataFrame, baseline: float = BASELINE_RECALL) -> DataFrame:
    """Recall against the baseline: material drop (beyond 0.05), modest drop (beyond 0.01), or holds."""
    d = F.col("recall") - baseline
    text = F.when(d < -0.05, "material drop").when(d < -0.01, "modest drop").when(d.isNotNull(), "holds")
    return results.select("set", "recall", d.alias("delta"), text.alias("outcome"))


def external_summary(results: DataFrame) -> DataFrame:
    return results.select("set", "n", "n_malicious", "recall")


def threshold_sweep(scored: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Recall at each threshold; strictly greater, so that the 0.5 row equals the predictions.

    All thresholds are counted in one pass over the rows.
    """
    known = scored.where(F.col("label") == 1)
    one = known.agg(F.count(F.lit(1)).alias("n"),
                    *[count_if(F.col("score") > t).alias(f"_{i}") for i, t in enumerate(thresholds)])
    rows = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_{i}").alias("caught"))
                               for i, t in enumerate(thresholds)]))
    return (one.select("n", rows.alias("r"))
            .select("r.threshold", "r.caught", ratio(F.col("r.caught"), F.col("n"), None).alias("recall")))


def bare_rate(df: DataFrame) -> DataFrame:
    """How the labels treat bare domains (path of at most one character) and the rest."""
    return group_rate(bare_domain_flag(df), "bare")


def bare_domain_check(df: DataFrame, scored_test: DataFrame) -> DataFrame:
    """False-alarm rate on held-out benign rows, bare against the rest, the gap, and the verdict.

    ``df`` has path_length, ``scored_test`` label and prediction of the held-out rows, both by row_id.
    """
    benign = bare_domain_flag(df.select("row_id", "path_length")).join(
        scored_test.where(F.col("label") == 0).select("row_id", "prediction"), "row_id")
    c = benign.agg(count_if(F.col("bare")).alias("n_bare"), count_if(~F.col("bare")).alias("n_path"),
                   count_if(F.col("bare") & (F.col("prediction") == 1)).alias("fa_bare"),
                   count_if(~F.col("bare") & (F.col("prediction") == 1)).alias("fa_path"))
    bare = ratio(F.col("fa_bare"), F.col("n_bare"), None)
    path = ratio(F.col("fa_path"), F.col("n_path"), None)
    gap = bare - path
    text = (F.when(gap > 0.10, "confirmed").when(gap > 0.02, "partly supported")
            .when(gap.isNotNull(), "not supported"))
    return c.select("n_bare", "n_path", bare.alias("false_alarm_rate_bare"),
                    path.alias("false_alarm_rate_path"), gap.alias("gap"), text.alias("verdict"),
                    ratio(F.col("n_bare"), F.col("n_bare") + F.col("n_path"), None)
                    .alias("bare_share_of_benign"))


def benign_drift(ours: DataFrame, theirs: DataFrame, importance: DataFrame, names) -> DataFrame:
    """Per feature: both means, their difference in our standard deviations (null without spread), the
    importance, and their product as impact. Order by impact for the report."""
    a = feature_moments(ours, names).select("feature", F.col("mean").alias("ours"), "sd")
    b = feature_moments(theirs, names).select("feature", F.col("mean").alias("theirs"))
    diff = F.when(F.col("sd") >= MIN_SD, (F.col("theirs") - F.col("ours")) / F.col("sd"))
    return (a.join(b, "feature").join(importance.select("feature", "importance"), "feature")
            .select("feature", "ours", "theirs", diff.alias("diff_sd"), "importance",
                    (F.abs(diff) * F.col("importance")).alias("impact")))


def drift_top(drift: DataFrame, k: int = 12) -> DataFrame:
    """The k features with the greatest impact, with direction."""
    return (drift.where(F.col("diff_sd").isNotNull()).orderBy(F.desc("impact"), "feature").limit(k)
            .withColumn("direction", F.when(F.col("diff_sd") > 0, "higher").otherwise("lower")))


def leak_verdict(results: DataFrame, full: str, clean: str, floor: float = NOISE_FLOOR) -> DataFrame:
    """Recall with and without the suspected column, and what the change means."""
    def recall(model):
        return F.max(F.when(F.col("model") == model, F.col("recall")))

    one = results.agg(recall(full).alias("recall_full"), recall(clean).alias("recall_clean"))
    d = F.col("recall_clean") - F.col("recall_full")
    text = (F.when(F.abs(d) <= floor, "at the noise floor").when(d < 0, "artefact carried weight")
            .otherwise("artefact was misleading"))
    return one.withColumn("recall_change", d).withColumn("verdict", text)


def external_alarm_verdict(scored: DataFrame, full: str, clean: str) -> DataFrame:
    """False-alarm rate of both models on legitimate external addresses; a drop beyond 0.05 is substantial."""
    def rate(model):
        return F.avg(F.when(F.col("model") == model, (F.col("prediction") == 1).cast("int")))

    one = scored.agg(rate(full).alias("rate_full"), rate(clean).alias("rate_clean"))
    d = F.col("rate_clean") - F.col("rate_full")
    return one.withColumn("rate_change", d).withColumn(
        "verdict", F.when(d < -0.05, "substantial improvement").otherwise("little change"))
