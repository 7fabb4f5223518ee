"""Labelled addresses, a site list and scorecards, all derived from the ``pages`` table by Spark.

They are test inputs: labels follow the rule that makes the addresses, and the scorecards are fixed
formulas, not trained models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlsieve.operators.reference import ReferenceList, load_reference
from urlsieve.plans.feature_table import build_feature_table
from urlsieve.session import scratch_path
from urlsieve.sources.writers import write_feature_table

VARIANTS = 25          # addresses made from each page
TEST_SHARE = 0.2
SEED = 42

# Sites put in front of the list counted from the pages.
SEED_SITES = ("google.com", "paypal.com", "microsoft.com", "amazon.com", "facebook.com",
              "bbc.co.uk", "example.com", "example.org", "netflix.com", "dropbox.com")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _host(url) -> F.Column:
    return F.regexp_replace(F.regexp_replace(url, "^[a-z]+://", ""), "[/?#].*$", "")


def url_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, url, type: every page address in 25 variants, benign and malicious.

    One scan of two columns, whose rows are dealt out before they are multiplied: a file of one row group is read by one task.
    """
    nk, page = F.col("nk"), F.col("page_id")
    src, host, tail = F.col("src"), F.col("host"), F.col("tail")
    pages = table(spark, sf_dir, "pages").select("page_id", "url").repartition(4 * spark.sparkContext.defaultParallelism, "page_id")
    base = pages.select(
        "page_id", F.col("url").alias("src"), _host(F.col("url")).alias("host"),
        F.regexp_replace("url", "^[a-z]+://[^/?#]*", "").alias("tail"),
        F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("nk"))
    mut = base.withColumn("m", (page * 7 + nk * 3) % 12).withColumn("row_id", page * 100 + nk)
    m = F.col("m")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    url = (F.when(m == 0, text("http://paypa1-secure.", host, ".tk/login", tail))
           .when(m == 1, text("http://g00gle.com.verify-", nk, ".xyz/account/update", tail))
           .when(m == 2, text("http://10.", nk, ".", page % 256, ".7:8080/a;v=1/bin.exe"))
           .when(m == 3, text(host, "/index.php?option=com_content&id=", page * 31 + nk))
           .when(m == 4, text("bit.ly/", F.substring(F.md5(F.col("row_id").cast("string")), 1, 7)))
           .when(m == 5, text("https://user@", host, "//x", tail))
           .when(m == 6, text("https://www.paypal.com", tail))
           .when(m == 7, text("https://", host, "/"))
           .when(m == 8, text("www.", host, tail))
           .otherwise(text(src, "&n=", nk % 20)))
    kind = (F.when(m.isin(0, 1, 4), "phishing").when(m == 2, "malware").when(m == 3, "defacement")
            .when((m == 5) & (nk % 2 == 0), "phishing").otherwise("benign"))
    return mut.select("row_id", url.alias("url"), kind.alias("type"))


def top_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line, rank, domain: ten fixed sites, then page hosts by number of pages (equal counts share a rank).

    Ranks come from the table of distinct page counts, which is far smaller than the table of hosts.
    """
    hosts = (table(spark, sf_dir, "pages").groupBy(_host(F.col("url")).alias("domain"))
             .agg(F.count(F.lit(1)).alias("n")))
    sizes = hosts.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    above = F.coalesce(F.sum("c").over(
        Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = sizes.select("n", (above + 1 + len(SEED_SITES)).alias("rank"))
    counted = hosts.join(ranks, "n").select("rank", "domain")
    seeds = spark.createDataFrame(list(enumerate(SEED_SITES, 1)), "rank bigint, domain string")
    return seeds.unionByName(counted).select(F.struct("rank", "domain").alias("line"), "rank", "domain")


_loaded: dict = {}
_stored: dict = {}


def reference_list(spark: SparkSession, sf_dir: str) -> ReferenceList:
    """The list, loaded once per session, as it is before any extraction."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = load_reference(top_sites(spark, sf_dir))
    return _loaded[key]


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of the corpus, written once per session and read back.

    Extraction is paid once and later steps read the saved table, as any user of it would do.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = scratch_path(spark, "features")
        write_feature_table(
            build_feature_table(url_corpus(spark, sf_dir), reference_list(spark, sf_dir)), path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


# Weights of the two scorecards over feature columns.
SCORECARDS = {
    "a": (-2.0, {"suspicious_tld": 1.6, "phish_hints": 0.7, "has_ip_host": 2.5,
                 "is_shortening_service": 2.2, "nb_at": 0.4, "is_https": -0.8, "url_length": 0.035}),
    "b": (-2.6, {"phish_hints": 0.5, "suspicious_tld": 2.0, "nb_at": 3.0, "is_https": -0.2,
                 "url_length": 0.045}),
}


def scorecard(which: str):
    """A scorer: adds ``score`` (6 decimals) and ``prediction`` (score above 0.5)."""
    intercept, weights = SCORECARDS[which]

    def apply(df: DataFrame) -> DataFrame:
        z = F.lit(intercept)
        for name, w in weights.items():
            z = z + F.lit(w) * F.col(name)
        scored = df.withColumn("score", F.round(1 / (1 + F.exp(-z)), 6))
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

    return apply


def scored(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """model, row_id, url, type, label, score, prediction over the whole feature table."""
    return scorecard(which)(stored_features(spark, sf_dir)).select(
        F.lit(which).alias("model"), "row_id", "url", "type", "label", "score", "prediction")
