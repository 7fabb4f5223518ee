"""Readers. All are plain Spark scans; none reads a file through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.functions.parts import BLANKS
from urlsieve.operators.numbering import number_lines
from urlsieve.operators.shape import distinct_ordered, flip_label, require_columns
from urlsieve.operators.splits import sample_n

#: One dialect for what is read and what is written: quotes are doubled, blanks and backslashes are text.
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_CSV = CSV | {"multiLine": False, "mode": "PERMISSIVE"}


def line_order() -> Column:
    """Position of a row in its files: path, offset of the split, position in the split."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"))


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def read_labelled_urls(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a ``url`` column and perhaps ``type`` -> row_id, line, url[, type]. No type inference.

    ``row_id`` counts the rows of the files in order from 0, however they are split.
    """
    raw = require_columns(spark.read.options(**_CSV).csv(path), ["url"])
    cols = [c for c in ("url", "type") if c in raw.columns]
    return number_lines(raw.select(line_order().alias("line"), *cols))


def read_reference_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``rank,domain`` -> line, rank, domain. Skips short lines and non-numeric ranks (a header)."""
    fields = F.split(_strip(F.col("value")), ",")
    lines = spark.read.text(path).select(
        line_order().alias("line"), F.size(fields).alias("n"),
        _strip(F.get(fields, F.lit(0))).alias("rank"),
        F.lower(_strip(F.get(fields, F.lit(1)))).alias("domain"))
    usable = (F.col("n") >= 2) & (F.col("domain") != "") & F.col("rank").rlike(r"^[0-9]+\z")
    return lines.where(usable).select("line", F.col("rank").cast("bigint").alias("rank"), "domain")


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """One address per line, blanks around it and empty lines dropped -> line, url."""
    return (spark.read.text(path).select(line_order().alias("line"), _strip(F.col("value")).alias("url"))
            .where(F.col("url") != ""))


def read_live_list(spark: SparkSession, path: str) -> DataFrame:
    """A list in which every address is malicious -> line, url, label = 1, each address once."""
    return distinct_ordered(read_url_lines(spark, path), order="line").withColumn("label", F.lit(1))


def read_external_labelled(spark: SparkSession, path: str, positive: int = 0,
                           sample: int | None = None, seed: int = 42) -> DataFrame:
    """CSV with ``URL`` and ``label`` among other columns -> line, url, label in our convention.

    A byte-order mark before the header is dropped, ``positive`` is their value for malicious, each
    address is kept once (first row), and ``sample`` keeps that many rows at random.
    """
    raw = spark.read.options(**_CSV).csv(path)
    raw = raw.toDF(*[c.lstrip("\ufeff") for c in raw.columns])
    require_columns(raw, ["URL", "label"])
    rows = raw.select(line_order().alias("line"), F.col("URL").alias("url"),
                      F.col("label").try_cast("int").alias("label"))
    first = rows.groupBy("url").agg(F.min_by(F.struct("line", "label"), "line").alias("_first"))
    rows = first.select("_first.line", "url", "_first.label")
    rows = flip_label(rows, positive)
    return rows if sample is None else sample_n(rows, sample, by="url", seed=seed)


def read_feature_table(spark: SparkSession, path: str, names=None) -> tuple[DataFrame, list[str]]:
    """The saved table and its feature names in contract order; url and label must be present."""
    df = require_columns(spark.read.parquet(path), ["url", "label"])
    wanted = FEATURE_NAMES if names is None else names
    return df, [n for n in wanted if n in df.columns]
