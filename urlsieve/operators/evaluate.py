"""Metrics of a scored table (model, row_id, label, prediction, score) and comparisons of models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import class_balance, ratio
from urlsieve.operators.shape import error_rows
from urlsieve.session import stage_table

CV_SD = 0.0006
NOISE_FLOOR = 2 * CV_SD
HARD_OVERLAP = 0.7
_SCORE_STEPS = 1 << 16


def stack_results(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _spread(s: Column) -> Column:
    """A growing function of the score that is about as fine near 0, near 1 and far out as anywhere else."""
    small = F.signum(s) * (F.log2(F.greatest(F.abs(s), F.lit(2.0 ** -1020))) + 1030)
    return F.when(s <= 0.5, small).when(s < 1, 1100 - F.log2(1 - s)).otherwise(1200 + F.log2(s))


def roc_auc(scored: DataFrame, score: str = "score", by: str = "model") -> DataFrame:
    """Exact area under the ROC curve per model (ties count half); null when a class is missing.

    Rows are first reduced to one per distinct score. Scores are then cut into steps: benign rows in lower
    steps are counted from the table of steps, those lower in the same step by a window over that step, so
    no window runs over all scores.
    """
    y = F.col("label").cast("bigint") * (F.col("_w") if "_w" in scored.columns else 1)
    rows = F.col("_w") if "_w" in scored.columns else F.lit(1)
    points = (scored.where(F.col(score).isNotNull()).groupBy(by, F.col(score).alias("_s"))
              .agg(F.sum(y).alias("_pos"), F.sum(rows - y).alias("_neg"))
              .withColumn("_step", F.floor(_SCORE_STEPS * _spread(F.col("_s")))))
    steps = points.groupBy(by, "_step").agg(F.sum("_neg").alias("_n"))
    before = Window.partitionBy(by).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select(by, "_step", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_lower"))
    inside = Window.partitionBy(by, "_step").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    placed = (points.withColumn("_in", F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
              .join(steps, [by, "_step"]))
    won = F.sum(F.col("_pos") * (F.col("_lower") + F.col("_in") + F.col("_neg") / 2))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return placed.groupBy(by).agg(ratio(won, pairs, None).alias("roc_auc"))


def metric_columns() -> list[Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), precision.alias("precision"),
            recall.alias("recall"),
            ratio(2 * precision * recall, precision + recall).alias("f1")]


def evaluate_binary(scored: DataFrame, by: str = "model") -> DataFrame:
    """One row per model: accuracy, precision, recall, F1 (0 on zero division), ROC AUC, error counts.

    The scored rows are evaluated once, into a row per model, score, prediction and label.
    """
    table = stage_table(scored.groupBy(by, "score", "prediction", "label").agg(F.count(F.lit(1)).alias("_w")), "scores")
    y, p = F.col("label"), F.col("prediction")
    cells = {"tn": (y == 0) & (p == 0), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tp": (y == 1) & (p == 1)}
    counts = table.groupBy(by).agg(*[F.sum(F.when(c, F.col("_w")).otherwise(0)).alias(n) for n, c in cells.items()])
    return (counts.join(roc_auc(table, by=by), by, "left")
            .select(by, *metric_columns(), "roc_auc", F.col("fn").alias("missed"),
                    F.col("fp").alias("false_alarms")))


def model_comparison(*scored: DataFrame, digits: int = 4) -> DataFrame:
    """One evaluated row per model, rounded."""
    table = evaluate_binary(stack_results(*scored))
    return table.select(*[F.round(c, digits).alias(c) if c in
                          ("accuracy", "precision", "recall", "f1", "roc_auc") else c
                          for c in table.columns])


def noise_floor_verdict(results: DataFrame, baseline: str, floor: float = NOISE_FLOOR) -> DataFrame:
    """Recall of every other model against the baseline: tie, better or worse."""
    base = results.where(F.col("model") == baseline).select("recall").scalar()
    d = F.col("recall") - base
    verdict = F.when(F.abs(d) <= floor, "tie").when(d > 0, "better").otherwise("worse")
    return results.where(F.col("model") != baseline).select(
        "model", d.alias("recall_change"), verdict.alias("verdict"))


def _missed(scored: DataFrame) -> Column:
    return (F.col("label") == 1) & (F.col("prediction") == 0)


def error_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Misses of two models on the same rows: each, both, only one; overlap as a share of the first's."""
    left = a.where(_missed(a)).select("row_id", F.lit(1).alias("_a"))
    right = b.where(_missed(b)).select("row_id", F.lit(1).alias("_b"))
    both = left.join(right, "row_id", "full")
    in_a, in_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()

    def n(c):
        return F.coalesce(F.sum(c.cast("bigint")), F.lit(0))

    out = both.agg(n(in_a).alias("missed_a"), n(in_b).alias("missed_b"), n(in_a & in_b).alias("missed_both"),
                   n(in_a & ~in_b).alias("caught_by_b_only"), n(in_b & ~in_a).alias("caught_by_a_only"))
    overlap = F.col("missed_both") / F.greatest(F.col("missed_a"), F.lit(1))
    return out.withColumn("overlap", overlap).withColumn("hard_in_data", overlap > HARD_OVERLAP)


def caught_by_one(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows the first model misses and the second catches."""
    return a.where(_missed(a)).join(b.where(_missed(b)).select("row_id"), "row_id", "left_anti")


def hard_rows(df: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``df`` both models miss, with all columns."""
    return (df.join(a.where(_missed(a)).select("row_id"), "row_id", "left_semi")
            .join(b.where(_missed(b)).select("row_id"), "row_id", "left_semi"))


def hard_rows_by_type(df: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    return class_balance(hard_rows(df, a, b))


def error_report(df: DataFrame, scored: DataFrame) -> DataFrame:
    """Every misclassified row joined back to its source columns by ``row_id``."""
    errors = error_rows(scored).select("row_id", "prediction", "error")
    return df.join(errors, "row_id")
