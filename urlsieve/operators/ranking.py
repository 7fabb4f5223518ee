"""Top-k and ranking over report tables (one row per feature, cluster or model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def importance_topk(importance: DataFrame, k: int, lowest: bool = False) -> DataFrame:
    order = F.asc("importance") if lowest else F.desc("importance")
    return importance.orderBy(order, "feature").limit(k)


def importance_rank(importance: DataFrame) -> DataFrame:
    """Rank per model by importance, highest first, ties averaged. One row per model and feature."""
    by_value = Window.partitionBy("model").orderBy(F.desc("importance"))
    ties = F.count(F.lit(1)).over(Window.partitionBy("model", "importance"))
    return importance.withColumn("rank", F.rank().over(by_value) + (ties - 1) / 2)


def cluster_top_features(profiles: DataFrame, k: int = 4) -> DataFrame:
    """The k largest |z| per cluster, with direction."""
    w = Window.partitionBy("cluster").orderBy(F.desc(F.abs("z")), "feature")
    side = F.when(F.col("z") > 0, "above").when(F.col("z") < 0, "below").otherwise("level")
    return (profiles.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
            .withColumn("side", side))


def profile_spread(profiles: DataFrame, k: int = 14) -> DataFrame:
    """The k features whose centres lie furthest from the average in some cluster."""
    return (profiles.groupBy("feature").agg(F.max(F.abs("z")).alias("spread"))
            .orderBy(F.desc("spread"), "feature").limit(k))


def distinctive_cluster(composition: DataFrame) -> DataFrame:
    """Per type, the cluster where its share is highest (lowest id on ties), against the overall share."""
    best = F.max_by(F.struct("cluster", "share"), F.struct(F.col("share"), (-F.col("cluster")).alias("c")))
    return (composition.groupBy("type").agg(best.alias("b"), F.first("overall_share").alias("overall_share"))
            .select("type", "b.cluster", "b.share", "overall_share"))


def dominant_cluster(sizes: DataFrame, threshold: float = 0.60) -> DataFrame:
    """The largest cluster (lowest id on ties), its share, and whether it calls for a second pass."""
    top = sizes.agg(F.max(F.struct("n", (-F.col("cluster")).alias("c"), "share")).alias("m"))
    return top.select((-F.col("m.c")).alias("cluster"), "m.n", "m.share",
                      (F.col("m.share") >= threshold).alias("second_pass"))


def best_challenger(results: DataFrame, baseline: str) -> DataFrame:
    """The model with the highest recall other than the baseline (first by name on ties)."""
    return results.where(F.col("model") != baseline).orderBy(F.desc("recall"), "model").limit(1)


def missed_sorted(scored: DataFrame) -> DataFrame:
    """Missed malicious rows, lowest score first."""
    return (scored.where((F.col("label") == 1) & (F.col("prediction") == 0))
            .orderBy("score", "row_id"))


def preview(df: DataFrame, n: int = 20, order: str = "row_id") -> DataFrame:
    """The first n rows and, on each, how many more there are."""
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    return (df.orderBy(order).limit(n)
            .withColumn("remaining", F.greatest(total - n, F.lit(0))))
