"""Parsing, features, list derivations and lookups over the whole corpus."""

from pyspark.sql import functions as F

from checks.corpus import reference_list, top_sites, url_corpus
from checks.register import query, r6, rounded
from urlsieve.functions import text as T
from urlsieve.functions import vocab as V
from urlsieve.functions.features import DOUBLE_FEATURES, FEATURE_NAMES, PREFIX, with_parts
from urlsieve.functions.parts import parse_urls as parse
from urlsieve.operators import reference as R
from urlsieve.operators.shape import dedupe_urls
from urlsieve.plans.feature_table import build_feature_table
from urlsieve.session import scratch_path
from urlsieve.streaming import flows as S

LIST_FEATURES = ("min_brand_edit_distance", "brand_lookalike", "brand_is_registered_domain", "in_top_sites",
                 "domain_rank_score", "tld_popularity")


def unique(spark, sf_dir):
    return dedupe_urls(url_corpus(spark, sf_dir))


def hosts(spark, sf_dir):
    return with_parts(unique(spark, sf_dir)).select(
        "row_id", "url", *[PREFIX + n for n in ("host", "domain", "tld")])


def _columns(names):
    return ", ".join(r6(n) if n in DOUBLE_FEATURES else n for n in names)


@query("SELECT row_id, raw, scheme, host, path, query, port, malformed FROM parsed")
def parse_urls(spark, sf_dir):
    return parse(unique(spark, sf_dir)).select("row_id", "parts.*")


@query("SELECT row_id, host, rd AS domain FROM laid2")
def registered_domain(spark, sf_dir):
    host = F.col(PREFIX + "host")
    return hosts(spark, sf_dir).select("row_id", host.alias("host"), T.registered_domain(host).alias("domain"))


@query("SELECT row_id, round(entropy_url, 6) AS bits FROM plain")
def shannon_entropy(spark, sf_dir):
    return rounded(unique(spark, sf_dir).select("row_id", T.shannon_entropy(F.col("url")).alias("bits")))


@query("""SELECT row_id, CAST(levenshtein(rd_name, 'paypal') AS INT) AS distance,
  CAST(CASE WHEN levenshtein(rd_name, 'paypal') <= 2 THEN levenshtein(rd_name, 'paypal') END AS INT) AS within_2
  FROM laid2""")
def edit_distance(spark, sf_dir):
    name = F.substring_index(PREFIX + "domain", ".", 1)
    return hosts(spark, sf_dir).select(
        "row_id", T.edit_distance(name, F.lit("paypal")).alias("distance"),
        T.edit_distance(name, F.lit("paypal"), 2).alias("within_2"))


@query("""SELECT row_id, array_to_string([w for w in regexp_split_to_array(host, '[.-]') if length(w) >= 4], ' ') AS words
  FROM laid2""")
def host_tokens(spark, sf_dir):
    return hosts(spark, sf_dir).select(
        "row_id", F.concat_ws(" ", T.host_tokens(F.col(PREFIX + "host"))).alias("words"))


@query(f"SELECT row_id, url, {_columns(FEATURE_NAMES)}, type, label FROM feats")
def url_feature_table(spark, sf_dir):
    return rounded(build_feature_table(url_corpus(spark, sf_dir), reference_list(spark, sf_dir)))


@query(f"SELECT row_id, url, {_columns(FEATURE_NAMES)} FROM feats")
def feature_stream(spark, sf_dir):
    """The addresses as a stream of files run to its end: the same rows as the batch table."""
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "streamed")
    dedupe_urls(url_corpus(spark, sf_dir)).select("row_id", "url").repartition(4).write.parquet(source)
    arriving = S.arriving(spark, source, "row_id long, url string", files_per_batch=2)
    S.write_stream(S.feature_stream(arriving, reference_list(spark, sf_dir)), out, scratch_path(spark, "progress"), once=True).awaitTermination()
    return rounded(spark.read.parquet(out))


@query(f"""SELECT row_id, url, {_columns([n for n in FEATURE_NAMES if n not in LIST_FEATURES])},
  CAST(coalesce(d.d, 99) AS INT) AS min_brand_edit_distance,
  CAST(coalesce(d.d, 99) BETWEEN 1 AND 2 AS INT) AS brand_lookalike,
  CAST(rd_name IN (SELECT brand FROM builtin) AS INT) AS brand_is_registered_domain, 0 AS in_top_sites,
  CAST(0 AS DOUBLE) AS domain_rank_score, CAST(0 AS DOUBLE) AS tld_popularity, type, label
  FROM plain LEFT JOIN builtin_distance d USING (row_id)""")
def reference_optional(spark, sf_dir):
    return rounded(build_feature_table(url_corpus(spark, sf_dir), None))


@query("SELECT domain, rank FROM ranks")
def reference_ranks(spark, sf_dir):
    return R.reference_ranks(top_sites(spark, sf_dir))


@query("SELECT brand, CAST(ord AS INT) AS ord FROM brands")
def brand_vocabulary(spark, sf_dir):
    return R.brand_vocabulary(top_sites(spark, sf_dir)).select("brand", "ord")


@query("SELECT tld, round(share, 6) AS share FROM tlds")
def tld_shares(spark, sf_dir):
    lines = top_sites(spark, sf_dir)
    n = R.reference_ranks(lines).agg(F.count(F.lit(1)).alias("n")).scalar()
    return rounded(R.tld_shares(lines, n))


@query("""SELECT (SELECT count(*) FROM ranks) AS n_domains, (SELECT count(*) FROM brands) AS n_brands,
  (SELECT count(*) FROM tlds) AS n_tlds""")
def reference_summary(spark, sf_dir):
    return R.reference_summary(reference_list(spark, sf_dir))


@query("""SELECT row_id, rank, round(coalesce(log10((SELECT CAST(count(*) AS DOUBLE) FROM ranks) / rank),
  CAST(0 AS DOUBLE)), 6) AS rank_score FROM laid2 LEFT JOIN ranks ON domain = rd""")
def domain_rank_lookup(spark, sf_dir):
    out = R.domain_rank_lookup(hosts(spark, sf_dir), reference_list(spark, sf_dir))
    return rounded(out.select("row_id", F.col("_rank").alias("rank"), F.col("_rank_score").alias("rank_score")))


@query("SELECT row_id, round(coalesce(share, CAST(0 AS DOUBLE)), 6) AS share FROM laid2 LEFT JOIN tlds USING (tld)")
def tld_share_lookup(spark, sf_dir):
    out = R.tld_share_lookup(hosts(spark, sf_dir), reference_list(spark, sf_dir))
    return rounded(out.select("row_id", F.col("_tld_share").alias("share")))


@query("SELECT row_id, CAST(coalesce(d, 99) AS INT) AS distance FROM laid2 LEFT JOIN list_distance_of USING (row_id)")
def brand_proximity(spark, sf_dir):
    out = R.brand_proximity(hosts(spark, sf_dir), reference_list(spark, sf_dir))
    return out.select("row_id", F.col("_brand_distance").cast("int").alias("distance"))


@query("SELECT row_id, CAST(coalesce(d, 99) AS INT) AS distance FROM laid2 LEFT JOIN builtin_distance USING (row_id)")
def brand_proximity_builtin(spark, sf_dir):
    out = R.brand_proximity(hosts(spark, sf_dir), None)
    return out.select("row_id", F.col("_brand_distance").cast("int").alias("distance"))


@query("""SELECT row_id, CAST(b.brand IS NOT NULL AS INT) AS in_list, CAST(rd_name IN (SELECT brand FROM builtin) AS INT)
  AS in_builtin FROM laid2 LEFT JOIN brands b ON b.brand = rd_name""")
def known_brand(spark, sf_dir):
    out = R.known_brand(hosts(spark, sf_dir), reference_list(spark, sf_dir))
    name = F.substring_index(PREFIX + "domain", ".", 1)
    return out.select("row_id", F.col("_known_brand").alias("in_list"),
                      name.isin(*V.BUILTIN_BRANDS).cast("int").alias("in_builtin"))
