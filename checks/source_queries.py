"""Readers and writers: derived tables are written to the shared folder and read back with the operators."""

from pyspark.sql import functions as F

from checks.corpus import SEED, reference_list, scored, stored_features, top_sites, url_corpus
from checks.register import query, rounded
from urlsieve.functions.features import DOUBLE_FEATURES, FEATURE_NAMES
from urlsieve.operators.score import trust_score, verdict
from urlsieve.plans.feature_table import build_feature_table
from urlsieve.session import scratch_path
from urlsieve.sources import readers, writers


@query("SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, url, type FROM corpus")
def read_labelled_urls(spark, sf_dir):
    """Rows are numbered in the order of the files' lines."""
    path = scratch_path(spark, "labelled")
    url_corpus(spark, sf_dir).repartitionByRange("row_id").sortWithinPartitions("row_id").select("url", "type").write.option("header", True).csv(path)
    return readers.read_labelled_urls(spark, path).select("row_id", "url", "type")


@query("SELECT rank, domain FROM lines")
def read_reference_list(spark, sf_dir):
    path = scratch_path(spark, "sites")
    lines = top_sites(spark, sf_dir).select(F.concat(F.lit(" "), F.col("rank").cast("string"), F.lit(" , "),
                                                     F.upper("domain"), F.lit(",x")).alias("value"))
    noise = lines.limit(1).select(F.explode(F.array(F.lit("rank,domain"), F.lit("7"), F.lit("8, "))).alias("value"))
    lines.unionByName(noise).write.text(path)
    return readers.read_reference_list(spark, path).select("rank", "domain")


@query("SELECT url, count(*) AS n FROM corpus GROUP BY url")
def read_url_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    lines = url_corpus(spark, sf_dir).select(F.explode(F.array(F.concat(F.lit(" \t"), "url", F.lit(" ")),
                                                               F.lit("   "))).alias("value"))
    lines.write.text(path)
    return readers.read_url_lines(spark, path).groupBy("url").agg(F.count("line").alias("n"))


@query("SELECT DISTINCT url, 1 AS label FROM corpus WHERE type = 'phishing'")
def read_live_list(spark, sf_dir):
    path = scratch_path(spark, "live")
    url_corpus(spark, sf_dir).where("type = 'phishing'").select("url").write.text(path)
    return readers.read_live_list(spark, path).select("url", "label")


def external_csv(spark, sf_dir):
    """The corpus as an external file would have it, in the order of row_id: 1 means legitimate, other columns around."""
    path = scratch_path(spark, "external")
    (url_corpus(spark, sf_dir).repartitionByRange("row_id").sortWithinPartitions("row_id")
     .select(F.col("url").alias("﻿URL"), F.length("url").alias("URLLength"),
             F.when(F.col("type") == "benign", 1).otherwise(0).alias("label"), F.lit("x").alias("Title"))
     .write.options(**readers.CSV).csv(path))
    return path


@query("SELECT url, label FROM uniq")
def read_external_labelled(spark, sf_dir):
    return readers.read_external_labelled(spark, external_csv(spark, sf_dir)).select("url", "label")


@query(f"""SELECT url, label FROM (SELECT url, label, row_number() OVER (ORDER BY md5('{SEED}|' || url), url) AS rn FROM uniq)
  WHERE rn <= 1000""")
def read_external_sampled(spark, sf_dir):
    return readers.read_external_labelled(spark, external_csv(spark, sf_dir), sample=1000).select("url", "label")


_ALL = ", ".join(f"round({n}, 6) AS {n}" if n in DOUBLE_FEATURES else n for n in FEATURE_NAMES)


@query(f"SELECT row_id, url, type, label, {_ALL} FROM feats")
def read_feature_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    writers.write_feature_table(stored_features(spark, sf_dir), path)
    df, names = readers.read_feature_table(spark, path)
    return rounded(df.select("row_id", "url", "type", "label", *names))


@query(f"SELECT url, type, label, {_ALL} FROM feats")
def write_feature_table(spark, sf_dir):
    path = scratch_path(spark, "features-csv")
    writers.write_feature_table(
        build_feature_table(url_corpus(spark, sf_dir), reference_list(spark, sf_dir)), path, fmt="csv")
    back = spark.read.options(**readers.CSV).csv(path)
    return rounded(back.select("url", "type", F.col("label").cast("int").alias("label"),
                               *[F.col(n).cast("double" if n in DOUBLE_FEATURES else "int").alias(n) for n in FEATURE_NAMES]))


@query("SELECT type, count(*) AS n FROM uniq GROUP BY type")
def write_report(spark, sf_dir):
    path = scratch_path(spark, "report")
    writers.write_report(stored_features(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("type string, n bigint").options(**readers.CSV).csv(path)


@query("SELECT row_id, url, type, label, score, prediction FROM scored_a WHERE label = 1 AND prediction = 0")
def write_error_rows(spark, sf_dir):
    path = scratch_path(spark, "errors")
    writers.write_error_rows(scored(spark, sf_dir, "a").drop("model"), path, "missed")
    return spark.read.parquet(path)


@query("""SELECT url, round_even((1 - score) * 100 * 10, 0) / 10 AS trust_score,
  CASE WHEN (1 - score) * 100 >= 70 THEN 'SAFE' WHEN (1 - score) * 100 >= 40 THEN 'SUSPICIOUS' ELSE 'DANGEROUS' END AS verdict
  FROM scored_a""")
def write_scored(spark, sf_dir):
    path = scratch_path(spark, "scored")
    writers.write_scored(verdict(trust_score(scored(spark, sf_dir, "a"))), path)
    return spark.read.schema("url string, trust_score double, verdict string").options(**readers.CSV).csv(path)
