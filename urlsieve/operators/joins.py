"""Lookup joins that keep their shape when the list is large or one key is very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only after its size was measured and found to be below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Keys holding at least one row in MAX_HEAVY are "heavy"; there can be at most MAX_HEAVY of them.
MAX_HEAVY = 1024


def fits_broadcast(rows: int, text_bytes: int, fixed_columns: int = 2) -> bool:
    """Size check from exact counts: text bytes plus 16 bytes per row and fixed-width column."""
    return text_bytes + rows * 16 * (fixed_columns + 1) <= BROADCAST_BYTES


def broadcast_lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a list of checked size."""
    return left.join(F.broadcast(right), key, "left")


def spread_lookup(left: DataFrame, right: DataFrame, key: str, spread_by: str,
                  counts: DataFrame | None = None) -> DataFrame:
    """Left join to a list of any size, unique on ``key``.

    A key may hold a third of ``left``. Keys with at least 1/MAX_HEAVY of the rows (so at most MAX_HEAVY
    keys) are answered by a broadcast of just those keys; their rows then take part in the shuffle join
    under a key made from ``spread_by``, which matches nothing and spreads evenly. ``counts`` (key, count)
    saves the counting pass when the caller has it.
    """
    values = [c for c in right.columns if c != key]
    counts = left.groupBy(key).count() if counts is None else counts
    total = counts.select(F.sum("count").alias("n")).scalar()
    heavy = (counts.where(F.col(key).isNotNull() & (F.col("count") * MAX_HEAVY >= total))
             .select(key)
             .join(right, key, "left")
             .select(F.col(key), F.lit(True).alias("_heavy"),
                     *[F.col(v).alias(f"_heavy_{v}") for v in values]))
    step = left.join(F.broadcast(heavy), key, "left")
    light_key = F.when(F.col("_heavy").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64(spread_by).cast("string")))
    step = step.withColumn("_light_key", light_key)
    right = right.withColumnRenamed(key, "_light_key")
    joined = step.join(right, "_light_key", "left")
    return joined.select(
        *left.columns,
        *[F.coalesce(F.col(f"_heavy_{v}"), F.col(v)).alias(v) for v in values],
    )


def lookup(left: DataFrame, right: DataFrame, key: str, small: bool, spread_by: str) -> DataFrame:
    """A stream is joined to the whole list batch by batch, since its keys cannot be counted before."""
    if left.isStreaming and not small:
        return left.join(right, key, "left")
    return broadcast_lookup(left, right, key) if small else spread_lookup(left, right, key, spread_by)
