"""Features and scores of addresses as they arrive in a folder, with the loaded site list.

The plans are those of the batch flows. On a stream the site list is joined as a static table and the brand distance is an array
expression over the bounded brand list, so no operator keeps state and late rows need no watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from urlsieve.operators.reference import ReferenceList
from urlsieve.plans.feature_table import url_feature_table
from urlsieve.plans.scoring import score_urls


def arriving(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, some at a time if asked for."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def feature_stream(stream: DataFrame, reference: ReferenceList | None = None) -> DataFrame:
    """Every arriving row with its features."""
    return url_feature_table(stream, reference)


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], reference: ReferenceList | None = None) -> DataFrame:
    """Every arriving row with score, trust score, verdict and reasons."""
    return score_urls(stream, scorer, reference)


def write_stream(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append to a parquet folder, each row exactly once over restarts. ``once``: what is there now, then stop."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
