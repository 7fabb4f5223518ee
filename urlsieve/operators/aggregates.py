"""Counts, rates and moments. Each is one partial/final aggregate; skewed groups combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    """top / bottom, ``empty`` when the bottom is 0."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(empty).cast("double"))


def long_form(df: DataFrame, ids, names, variable: str, value: str) -> DataFrame:
    """One row per id and name."""
    wide = df.select(*ids, *[F.col(n).cast("double").alias(n) for n in names])
    return wide.unpivot(list(ids), list(names), variable, value)


def class_balance(df: DataFrame, by: str = "type") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)


def malicious_share(df: DataFrame, by=()) -> DataFrame:
    """Rows and mean label, over the whole table or per group (each split, each external set)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share_malicious"))


def group_rate(df: DataFrame, flag: str) -> DataFrame:
    """Rows and malicious share per flag value, the overall share, and the lift over it."""
    groups = df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("_bad"))
    # One row per flag value is left for this window.
    every = Window.partitionBy()
    overall = F.sum("_bad").over(every) / F.sum("n").over(every)
    share = F.col("_bad") / F.col("n")
    return groups.select(flag, "n", share.alias("share_malicious"), overall.alias("overall"),
                         ratio(share, overall, None).alias("lift"))


def confusion_columns() -> dict[str, Column]:
    y, p = F.col("label"), F.col("prediction")
    return {"tn": count_if((y == 0) & (p == 0)), "fp": count_if((y == 0) & (p == 1)),
            "fn": count_if((y == 1) & (p == 0)), "tp": count_if((y == 1) & (p == 1))}


def confusion_counts(scored: DataFrame, by=()) -> DataFrame:
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in confusion_columns().items()])


def missed_by_class(scored: DataFrame) -> DataFrame:
    """Missed malicious rows per original type, most first."""
    return class_balance(scored.where((F.col("label") == 1) & (F.col("prediction") == 0)))


def verdict_counts(scored: DataFrame) -> DataFrame:
    return class_balance(scored, "verdict")


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    """Rows and share per cluster."""
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def label_composition(assigned: DataFrame) -> DataFrame:
    """cluster, type, share of the type in the cluster, share in all rows. Absent pairs have share 0.

    Any type counts, a missing one too. After the first aggregate a row is left per pair of cluster and type.
    """
    counts = assigned.groupBy("cluster", "type").agg(F.count(F.lit(1)).alias("n"))
    seen = counts.groupBy("type").agg(F.sum("n").alias("_of_type"))
    types = seen.agg(F.collect_list(F.struct("type", "_of_type")).alias("_types"), F.sum("_of_type").alias("_all"))
    clusters = counts.groupBy("cluster").agg(F.sum("n").alias("_in_cluster"))
    pairs = (clusters.withColumn("_one", F.lit(1)).join(F.broadcast(types.withColumn("_one", F.lit(1))), "_one")
             .select("cluster", "_in_cluster", "_all", F.explode("_types").alias("_t"))
             .select("cluster", F.col("_t.type").alias("type"), "_in_cluster", "_all", "_t._of_type"))
    have = counts.select(F.col("cluster").alias("_c"), F.col("type").alias("_k"), "n")
    out = pairs.join(have, F.col("cluster").eqNullSafe(F.col("_c")) & F.col("type").eqNullSafe(F.col("_k")), "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("cluster", "type", n.alias("n"), (n / F.col("_in_cluster")).alias("share"),
                      (F.col("_of_type") / F.col("_all")).alias("overall_share"))


def feature_moments(df: DataFrame, names) -> DataFrame:
    """feature, mean, sd (sample), from one pass."""
    one = df.agg(*[F.avg(n).alias(f"{n}__m") for n in names],
                 *[F.stddev_samp(n).alias(f"{n}__s") for n in names])
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(f"{n}__m").alias("mean"), F.col(f"{n}__s").alias("sd"))
        for n in names]))
    return one.select(rows.alias("r")).select("r.*")


def fold_summary(folds: DataFrame, value: str = "recall") -> DataFrame:
    """Mean and population standard deviation over folds."""
    return folds.agg(F.count(F.lit(1)).alias("folds"), F.avg(value).alias("mean"),
                     F.stddev_pop(value).alias("sd"))


def score_bands(scored: DataFrame) -> DataFrame:
    """Missed malicious rows by score: close call, middle, confidently wrong."""
    s = F.col("score")
    missed = scored.where((F.col("label") == 1) & (F.col("prediction") == 0))
    return missed.agg(count_if(s > 0.40).alias("above_040"),
                      count_if((s > 0.20) & (s <= 0.40)).alias("from_020_to_040"),
                      count_if(s <= 0.20).alias("up_to_020"))


def score_histogram(scored: DataFrame, bins: int = 40) -> DataFrame:
    """Known-malicious rows in equal bins between the least and the greatest score; the last bin is closed."""
    known = scored.where(F.col("label") == 1).select("score")
    span = known.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    place = F.floor((F.col("score") - lo) / (hi - lo) * bins).cast("int")
    filled = (known.select(F.least(place, F.lit(bins - 1)).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    all_bins = span.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return (all_bins.join(filled, "bin", "left")
            .select("bin", (F.col("lo") + width * F.col("bin")).alias("bin_from"),
                    F.coalesce("n", F.lit(0)).alias("n")))
