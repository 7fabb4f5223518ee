"""Writers. Wide outputs are written by all tasks; only report tables (below 100 rows) as one file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.operators.shape import error_rows
from urlsieve.sources.readers import CSV


def write_feature_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """row_id, url, the features in contract order, type, label."""
    order = ["row_id", "url", *FEATURE_NAMES, "type", "label"]
    out = df.select(*[c for c in order if c in df.columns])
    writer = out.write.mode("overwrite")
    writer.options(**CSV).csv(path) if fmt == "csv" else writer.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small result table as one CSV file."""
    df.repartition(1).write.mode("overwrite").options(**CSV).csv(path)


def write_error_rows(scored: DataFrame, path: str, kind: str) -> None:
    """Missed or false-alarm rows with all their columns."""
    error_rows(scored, kind).write.mode("overwrite").parquet(path)


def write_scored(scored: DataFrame, path: str) -> None:
    """url, trust_score (one decimal), verdict."""
    (scored.select("url", (F.rint(F.col("trust_score") * 10) / 10).alias("trust_score"), "verdict")
     .write.mode("overwrite").options(**CSV).csv(path))
