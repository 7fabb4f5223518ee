"""Projections, filters, labels, duplicates, splits and samples."""

from pyspark.sql import functions as F

from checks.corpus import SEED, scored, stored_features, url_corpus
from checks.register import query, r6, rounded
from urlsieve.functions.features import DOUBLE_FEATURES, FEATURE_NAMES
from urlsieve.operators import shape as S
from urlsieve.operators import splits as P


@query("SELECT row_id, url, type FROM corpus")
def require_columns(spark, sf_dir):
    return S.require_columns(url_corpus(spark, sf_dir), ["url", "type"])


@query("SELECT row_id, url, type FROM uniq")
def dedupe_urls(spark, sf_dir):
    return S.dedupe_urls(url_corpus(spark, sf_dir))


@query("""SELECT count(*) AS n_read, count(*) - count(DISTINCT url) AS n_dropped, count(DISTINCT url) AS n_kept FROM corpus""")
def dedupe_report(spark, sf_dir):
    return S.dedupe_report(url_corpus(spark, sf_dir))


@query("SELECT min(row_id) AS row_id, url FROM corpus GROUP BY url")
def distinct_ordered(spark, sf_dir):
    return S.distinct_ordered(url_corpus(spark, sf_dir))


@query("SELECT row_id, type, CAST(type <> 'benign' AS INT) AS label FROM corpus")
def binary_label(spark, sf_dir):
    return S.binary_label(url_corpus(spark, sf_dir)).select("row_id", "type", "label")


@query("SELECT row_id, CAST(type <> 'benign' AS INT) AS label FROM corpus")
def flip_label(spark, sf_dir):
    theirs = url_corpus(spark, sf_dir).select("row_id", (F.col("type") == "benign").cast("int").alias("label"))
    return S.flip_label(theirs)


@query("SELECT row_id, url, type FROM feats WHERE label = 1")
def restrict_class(spark, sf_dir):
    return S.restrict_class(stored_features(spark, sf_dir), 1).select("row_id", "url", "type")


@query("SELECT row_id, " + ", ".join(r6(n) if n in DOUBLE_FEATURES else n for n in FEATURE_NAMES) + " FROM feats")
def feature_matrix(spark, sf_dir):
    return rounded(S.feature_matrix(stored_features(spark, sf_dir)))


@query("SELECT row_id, url_length, nb_at FROM feats")
def feature_contract(spark, sf_dir):
    return S.feature_contract(stored_features(spark, sf_dir), FEATURE_NAMES).select("row_id", "url_length", "nb_at")


@query("SELECT feature FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, count(DISTINCT {n}) AS c FROM feats WHERE label = 1" for n in FEATURE_NAMES)
    + ") WHERE c > 1")
def drop_constant_columns(spark, sf_dir):
    malicious = S.restrict_class(stored_features(spark, sf_dir), 1).select(*FEATURE_NAMES)
    kept = S.drop_constant_columns(malicious, FEATURE_NAMES)
    # One row per kept column that is seen in the data.
    seen = kept.agg(*[F.count(c).alias(c) for c in kept.columns]).unpivot([], kept.columns, "feature", "n")
    return seen.where("n > 0").select("feature")


@query("SELECT row_id, is_malformed, url_length FROM feats")
def ablate_columns(spark, sf_dir):
    names = S.ablate_columns(FEATURE_NAMES)
    assert "is_https" not in names
    return S.feature_matrix(stored_features(spark, sf_dir), names).select("row_id", *names[:2])


@query("SELECT row_id, path_length, path_length <= 1 AS bare FROM feats")
def bare_domain_flag(spark, sf_dir):
    return S.bare_domain_flag(stored_features(spark, sf_dir)).select("row_id", "path_length", "bare")


@query("""SELECT row_id, label, prediction, CASE WHEN label = 1 THEN 'missed' ELSE 'false_alarm' END AS error
  FROM scored_b WHERE label <> prediction""")
def error_rows(spark, sf_dir):
    return S.error_rows(scored(spark, sf_dir, "b")).select("row_id", "label", "prediction", "error")


@query("SELECT row_id, label, is_test FROM split")
def stratified_split(spark, sf_dir):
    return P.stratified_split(stored_features(spark, sf_dir).select("row_id", "url", "label")).drop("url")


@query("SELECT row_id, label, fold FROM folds")
def stratified_folds(spark, sf_dir):
    return P.stratified_folds(stored_features(spark, sf_dir).select("row_id", "url", "label")).drop("url")


@query(f"""SELECT row_id, url FROM (SELECT row_id, url, row_number() OVER (ORDER BY md5('{SEED}|' || row_id), row_id) AS rn
  FROM uniq) WHERE rn <= 2000""")
def sample_n(spark, sf_dir):
    return P.sample_n(stored_features(spark, sf_dir).select("row_id", "url"), 2000)
