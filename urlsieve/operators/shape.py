"""Projections, filters, labels and duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.functions.features import FEATURE_NAMES

NON_FEATURES = ("row_id", "url", "type", "label")
LEAKY = ("is_https",)


def require_columns(df: DataFrame, cols) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def dedupe_urls(df: DataFrame, key: str = "url", order: str = "row_id") -> DataFrame:
    """Keep the first row of each exact address.

    An aggregate, not a window: copies collapse on the map side, so an address that makes up a large part
    of the table never meets in one task.
    """
    rest = [c for c in df.columns if c != key]
    ordered = F.struct(F.col(order).alias("_order"), *[F.col(c) for c in rest])
    kept = df.groupBy(key).agg(F.min_by(ordered, F.col(order)).alias("_first"))
    return kept.select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def dedupe_report(df: DataFrame, key: str = "url") -> DataFrame:
    """One row: rows read, rows dropped as duplicates, rows kept."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_read"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_dropped"),
                       F.count(F.lit(1)).alias("n_kept"))


def distinct_ordered(df: DataFrame, key: str = "url", order: str = "row_id") -> DataFrame:
    """Distinct addresses, each with the position of its first occurrence."""
    return df.groupBy(key).agg(F.min(order).alias(order)).select(order, key)


def binary_label(df: DataFrame) -> DataFrame:
    """1 unless the type is benign; a missing type counts as malicious."""
    return df.withColumn("label", (~F.col("type").eqNullSafe("benign")).cast("int"))


def flip_label(df: DataFrame, positive: int = 0) -> DataFrame:
    """Convert a convention where ``positive`` marks malicious rows; a missing label counts as another value."""
    return df.withColumn("label", F.col("label").eqNullSafe(positive).cast("int"))


def restrict_class(df: DataFrame, label: int) -> DataFrame:
    return df.where(F.col("label") == label)


def feature_contract(df: DataFrame, names) -> DataFrame:
    """Error when the table lacks a feature a model was trained on."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"the extractor no longer produces {missing}; retrain the model")
    return df


def feature_matrix(df: DataFrame, names=None, keep=("row_id",)) -> DataFrame:
    """Key columns and the features in contract order."""
    names = [n for n in FEATURE_NAMES if n in df.columns] if names is None else list(names)
    feature_contract(df, names)
    return df.select(*[k for k in keep if k in df.columns], *names)


def constant_columns(df: DataFrame, names) -> list[str]:
    """Names with at most one distinct value, from one min/max pass."""
    row = df.agg(*[F.min(n).alias(f"lo_{n}") for n in names],
                 *[F.max(n).alias(f"hi_{n}") for n in names]).first()
    return [n for n in names if row[f"lo_{n}"] == row[f"hi_{n}"]]


def drop_constant_columns(df: DataFrame, names) -> DataFrame:
    return df.drop(*constant_columns(df, names))


def ablate_columns(names, leaky=LEAKY) -> list[str]:
    """The names without the suspected leaky ones; an error when none of them is present."""
    names = list(names)
    if not any(n in names for n in leaky):
        raise ValueError(f"none of {list(leaky)} found")
    return [n for n in names if n not in leaky]


def bare_domain_flag(df: DataFrame) -> DataFrame:
    require_columns(df, ["path_length"])
    return df.withColumn("bare", F.col("path_length") <= 1)


def error_rows(scored: DataFrame, kind: str | None = None) -> DataFrame:
    """``missed`` (malicious called benign), ``false_alarm`` (the opposite), or both with an ``error`` column."""
    error = (F.when((F.col("label") == 1) & (F.col("prediction") == 0), F.lit("missed"))
             .when((F.col("label") == 0) & (F.col("prediction") == 1), F.lit("false_alarm")))
    marked = scored.withColumn("error", error).where(F.col("error").isNotNull())
    return marked if kind is None else marked.where(F.col("error") == kind).drop("error")
