"""Aggregates, metrics, set operations, scoring, external validation and diagnostics, on the two scorecards."""

from pyspark.sql import functions as F

from checks.base_sql import CARD
from checks.corpus import SEED, scorecard, scored, stored_features, url_corpus
from checks.register import query, r6, rounded
from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.operators import aggregates as A
from urlsieve.operators import diagnostics as D
from urlsieve.operators import evaluate as E
from urlsieve.operators import models as M
from urlsieve.operators import ranking as K
from urlsieve.operators import score as S
from urlsieve.operators.shape import constant_columns, dedupe_urls, flip_label
from urlsieve.operators.splits import stratified_folds, stratified_split
from urlsieve.plans import validation as V
from urlsieve.plans.scoring import score_urls as plan_score_urls
from urlsieve.session import scratch_path
from urlsieve.streaming import flows


def both(spark, sf_dir):
    return E.stack_results(scored(spark, sf_dir, "a"), scored(spark, sf_dir, "b"))


def held_out(spark, sf_dir, which):
    table = stratified_split(scored(spark, sf_dir, which))
    return table.where("is_test").drop("is_test")


# ---- aggregates

@query("SELECT type, count(*) AS n FROM uniq GROUP BY type")
def class_balance(spark, sf_dir):
    return A.class_balance(stored_features(spark, sf_dir))


@query("SELECT is_test, count(*) AS n, round(avg(label), 6) AS share_malicious FROM split GROUP BY is_test")
def malicious_share(spark, sf_dir):
    table = stratified_split(stored_features(spark, sf_dir).select("row_id", "url", "label"))
    return rounded(A.malicious_share(table, ["is_test"]))


@query("""SELECT has_port, count(*) AS n, round(avg(label), 6) AS share_malicious,
  round((SELECT avg(label) FROM feats), 6) AS overall, round(avg(label) / (SELECT avg(label) FROM feats), 6) AS lift
  FROM feats GROUP BY has_port""")
def group_rate(spark, sf_dir):
    return rounded(A.group_rate(stored_features(spark, sf_dir), "has_port"))


_CONFUSION = """CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp"""


@query(f"SELECT model, {_CONFUSION} FROM scored_all GROUP BY model")
def confusion_counts(spark, sf_dir):
    return A.confusion_counts(both(spark, sf_dir), ["model"])


@query("SELECT type, count(*) AS n FROM scored_b WHERE label = 1 AND prediction = 0 GROUP BY type")
def missed_by_class(spark, sf_dir):
    return A.missed_by_class(scored(spark, sf_dir, "b"))


_VERDICT = "CASE WHEN (1 - score) * 100 >= 70 THEN 'SAFE' WHEN (1 - score) * 100 >= 40 THEN 'SUSPICIOUS' ELSE 'DANGEROUS' END"


@query(f"SELECT {_VERDICT} AS verdict, count(*) AS n FROM scored_a GROUP BY 1")
def verdict_counts(spark, sf_dir):
    return A.verdict_counts(S.verdict(S.trust_score(scored(spark, sf_dir, "a"))))


@query("SELECT feature, round(mean, 6) AS mean, round(sd, 6) AS sd FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, avg({n}) AS mean, stddev_samp({n}) AS sd FROM feats" for n in FEATURE_NAMES) + ")")
def feature_moments(spark, sf_dir):
    return rounded(A.feature_moments(stored_features(spark, sf_dir), FEATURE_NAMES))


_FOLD_RECALL = """fold_recall AS (
  SELECT fold, sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS recall
  FROM scored_b JOIN folds USING (row_id) WHERE scored_b.label = 1 GROUP BY fold)"""


def _fold_recall(spark, sf_dir):
    card = scorecard("b")
    return M.cross_validate_recall(stored_features(spark, sf_dir), FEATURE_NAMES, lambda train, test, names: card(test))


@query("SELECT fold, round(recall, 6) AS recall FROM fold_recall", _FOLD_RECALL)
def cross_validate_recall(spark, sf_dir):
    return rounded(_fold_recall(spark, sf_dir))


@query("SELECT count(*) AS folds, round(avg(recall), 6) AS mean, round(stddev_pop(recall), 6) AS sd FROM fold_recall",
       _FOLD_RECALL)
def fold_summary(spark, sf_dir):
    return rounded(A.fold_summary(_fold_recall(spark, sf_dir)))


@query("""SELECT CAST(sum(CASE WHEN score > 0.40 THEN 1 ELSE 0 END) AS BIGINT) AS above_040,
  CAST(sum(CASE WHEN score > 0.20 AND score <= 0.40 THEN 1 ELSE 0 END) AS BIGINT) AS from_020_to_040,
  CAST(sum(CASE WHEN score <= 0.20 THEN 1 ELSE 0 END) AS BIGINT) AS up_to_020
  FROM scored_b WHERE label = 1 AND prediction = 0""")
def score_bands(spark, sf_dir):
    return A.score_bands(scored(spark, sf_dir, "b"))


@query("""SELECT CAST(b.bin AS INT) AS bin, round(lo + (hi - lo) / 40 * b.bin, 6) AS bin_from, coalesce(n, 0) AS n
  FROM (SELECT unnest(range(40)) AS bin) b CROSS JOIN span LEFT JOIN (
    SELECT least(CAST(floor((score - lo) / (hi - lo) * 40) AS INT), 39) AS bin, count(*) AS n
    FROM scored_a CROSS JOIN span WHERE label = 1 GROUP BY 1) h ON h.bin = b.bin""",
       "span AS (SELECT min(score) AS lo, max(score) AS hi FROM scored_a WHERE label = 1)")
def score_histogram(spark, sf_dir):
    return rounded(A.score_histogram(scored(spark, sf_dir, "a")))


# ---- evaluation and comparison

_EVAL = f"""counts AS (SELECT model, {_CONFUSION} FROM {{rows}} GROUP BY model),
points AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM {{rows}} GROUP BY model, score),
auc AS (SELECT model, sum(pos * (lower_neg + neg / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_neg
  FROM points) GROUP BY model),
rates AS (SELECT model, (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall, fn AS missed, fp AS false_alarms FROM counts),
results AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM rates JOIN auc USING (model))"""
_EVAL_ALL = _EVAL.format(rows="scored_all")
_EVAL_TEST = "tested AS (SELECT s.* FROM scored_all s JOIN split USING (row_id) WHERE is_test), " + _EVAL.format(rows="tested")


@query(f"SELECT model, {r6('accuracy', 'precision', 'recall', 'f1', 'roc_auc')}, missed, false_alarms FROM results", _EVAL_ALL)
def evaluate_binary(spark, sf_dir):
    return rounded(E.evaluate_binary(both(spark, sf_dir)))


@query("SELECT model, round(roc_auc, 6) AS roc_auc FROM results", _EVAL_ALL)
def roc_auc(spark, sf_dir):
    return rounded(E.roc_auc(both(spark, sf_dir)))


@query("""SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(f1, 4) AS f1, round(roc_auc, 4) AS roc_auc, missed, false_alarms FROM results""", _EVAL_TEST)
def model_comparison(spark, sf_dir):
    return E.model_comparison(held_out(spark, sf_dir, "a"), held_out(spark, sf_dir, "b"))


@query("SELECT model, row_id, prediction FROM scored_all")
def stack_results(spark, sf_dir):
    return both(spark, sf_dir).select("model", "row_id", "prediction")


@query("""SELECT model, round(recall - base, 6) AS recall_change, CASE WHEN abs(recall - base) <= 0.0012 THEN 'tie'
  WHEN recall > base THEN 'better' ELSE 'worse' END AS verdict
  FROM results CROSS JOIN (SELECT recall AS base FROM results WHERE model = 'a') WHERE model <> 'a'""", _EVAL_ALL)
def noise_floor_verdict(spark, sf_dir):
    return rounded(E.noise_floor_verdict(E.evaluate_binary(both(spark, sf_dir)), "a"))


@query("SELECT model, round(recall, 6) AS recall FROM results WHERE model <> 'b' ORDER BY recall DESC, model LIMIT 1", _EVAL_ALL)
def best_challenger(spark, sf_dir):
    return rounded(K.best_challenger(E.evaluate_binary(both(spark, sf_dir)), "b").select("model", "recall"))


_MISS = """pairs AS (SELECT a.row_id, a.url, a.type, a.label = 1 AND a.prediction = 0 AS ma, b.label = 1 AND b.prediction = 0 AS mb
  FROM scored_a a JOIN scored_b b USING (row_id))"""


@query("""SELECT *, round(missed_both / CAST(greatest(missed_a, 1) AS DOUBLE), 6) AS overlap,
  missed_both / CAST(greatest(missed_a, 1) AS DOUBLE) > 0.7 AS hard_in_data FROM (
  SELECT count(*) FILTER (ma) AS missed_a, count(*) FILTER (mb) AS missed_b, count(*) FILTER (ma AND mb) AS missed_both,
  count(*) FILTER (ma AND NOT mb) AS caught_by_b_only, count(*) FILTER (mb AND NOT ma) AS caught_by_a_only FROM pairs)""", _MISS)
def error_overlap(spark, sf_dir):
    return rounded(E.error_overlap(scored(spark, sf_dir, "a"), scored(spark, sf_dir, "b")))


@query("SELECT row_id, url, type FROM pairs WHERE mb AND NOT ma", _MISS)
def caught_by_one(spark, sf_dir):
    return E.caught_by_one(scored(spark, sf_dir, "b"), scored(spark, sf_dir, "a")).select("row_id", "url", "type")


@query("SELECT row_id, url, type FROM pairs WHERE ma AND mb", _MISS)
def hard_rows(spark, sf_dir):
    rows = stored_features(spark, sf_dir).select("row_id", "url", "type")
    return E.hard_rows(rows, scored(spark, sf_dir, "a"), scored(spark, sf_dir, "b"))


@query("SELECT type, count(*) AS n FROM pairs WHERE ma AND mb GROUP BY type", _MISS)
def hard_rows_by_type(spark, sf_dir):
    rows = stored_features(spark, sf_dir).select("row_id", "url", "type")
    return E.hard_rows_by_type(rows, scored(spark, sf_dir, "a"), scored(spark, sf_dir, "b"))


@query("""SELECT row_id, url, type, prediction, CASE WHEN label = 1 THEN 'missed' ELSE 'false_alarm' END AS error
  FROM scored_a JOIN split USING (row_id, url, label) WHERE is_test AND label <> prediction""")
def error_report(spark, sf_dir):
    rows = stored_features(spark, sf_dir).select("row_id", "url", "type")
    return E.error_report(rows, held_out(spark, sf_dir, "a"))


@query("SELECT row_id, score, url FROM scored_b WHERE label = 1 AND prediction = 0")
def missed_sorted(spark, sf_dir):
    return K.missed_sorted(scored(spark, sf_dir, "b")).select("row_id", "score", "url")


@query("""SELECT row_id, url, (SELECT count(*) FROM uniq) - 20 AS remaining FROM uniq ORDER BY row_id LIMIT 20""")
def preview(spark, sf_dir):
    return K.preview(stored_features(spark, sf_dir).select("row_id", "url"))


# ---- scoring and explanation

@query("SELECT row_id, round((1 - score) * 100, 6) AS trust_score FROM scored_a")
def trust_score(spark, sf_dir):
    return rounded(S.trust_score(scored(spark, sf_dir, "a")).select("row_id", "trust_score"))


@query(f"SELECT row_id, {_VERDICT} AS verdict FROM scored_a")
def verdict(spark, sf_dir):
    return S.verdict(S.trust_score(scored(spark, sf_dir, "a"))).select("row_id", "verdict")


def _sentences(reassuring):
    rules = [f"CASE WHEN {n} {t} THEN '{s.replace(chr(39), chr(39) * 2)}' END" for n, t, s in S.SIGNALS
             if (n in S.REASSURING) == reassuring]
    return f"concat_ws('; ', {', '.join(rules)})"


_REASONS = f"{_sentences(False)} AS warnings, {_sentences(True)} AS reassurances"


@query(f"SELECT row_id, {_REASONS} FROM feats")
def explain_signals(spark, sf_dir):
    out = S.explain_signals(stored_features(spark, sf_dir))
    return out.select("row_id", F.concat_ws("; ", "warnings").alias("warnings"),
                      F.concat_ws("; ", "reassurances").alias("reassurances"))


def _scored_urls(spark, sf_dir):
    from checks.corpus import reference_list
    return plan_score_urls(dedupe_urls(url_corpus(spark, sf_dir)).select("row_id", "url"), scorecard("a"),
                           reference_list(spark, sf_dir))


@query(f"SELECT row_id, url, score, round((1 - score) * 100, 6) AS trust_score, {_VERDICT} AS verdict FROM scored_a")
def score_urls(spark, sf_dir):
    return rounded(_scored_urls(spark, sf_dir).select("row_id", "url", "score", "trust_score", "verdict"))


@query(f"""SELECT row_id, url, score, round((1 - score) * 100, 6) AS trust_score, {_VERDICT} AS verdict, warnings, reassurances
  FROM scored_a JOIN (SELECT row_id, {_REASONS} FROM feats) USING (row_id)""")
def score_stream(spark, sf_dir):
    """Addresses scored as a stream of files run to its end."""
    from checks.corpus import reference_list
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "streamed")
    dedupe_urls(url_corpus(spark, sf_dir)).select("row_id", "url").repartition(4).write.parquet(source)
    rows = flows.score_stream(flows.arriving(spark, source, "row_id long, url string"), scorecard("a"), reference_list(spark, sf_dir))
    flows.write_stream(rows, out, scratch_path(spark, "progress"), once=True).awaitTermination()
    told = [F.concat_ws("; ", c).alias(c) for c in ("warnings", "reassurances")]
    return rounded(spark.read.parquet(out).select("row_id", "url", "score", "trust_score", "verdict", *told))


@query(f"""SELECT row_id, url, round_even((1 - score) * 100 * 10, 0) / 10 AS trust_score, {_VERDICT} AS verdict, warnings,
  reassurances, CASE WHEN warnings = '' AND reassurances = '' THEN '{S.NO_SIGNAL}' ELSE '' END AS note
  FROM scored_a JOIN (SELECT row_id, {_REASONS} FROM feats) USING (row_id)""")
def score_report(spark, sf_dir):
    return S.score_report(_scored_urls(spark, sf_dir))


# ---- external sets and diagnostics

def _live(spark, sf_dir):
    rows = dedupe_urls(url_corpus(spark, sf_dir)).where(F.col("type") == "phishing")
    return rows.select("row_id", "url", F.lit(1).alias("label"))


def _external(spark, sf_dir):
    rows = dedupe_urls(url_corpus(spark, sf_dir))
    return flip_label(rows.select("row_id", "url", (F.col("type") == "benign").cast("int").alias("label")))


def _external_results(spark, sf_dir):
    card, names = scorecard("b"), ["url_length", "phish_hints", "nb_at"]
    return E.stack_results(V.validate_external(_live(spark, sf_dir), card, names, "live"),
                           V.validate_external(_external(spark, sf_dir), card, names, "external"))


_SETS = """sets AS (SELECT 'live' AS set, * FROM scored_b WHERE type = 'phishing' UNION ALL SELECT 'external', * FROM scored_b),
tallies AS (SELECT set, count(*) AS n, count(*) FILTER (label = 1) AS n_malicious, count(*) FILTER (label = 0) AS n_benign,
  count(*) FILTER (label = 1 AND prediction = 1) AS caught, count(*) FILTER (label = 1 AND prediction = 0) AS missed,
  count(*) FILTER (label = 0 AND prediction = 1) AS fa, count(*) FILTER (label = prediction) AS good FROM sets GROUP BY set),
outcome AS (SELECT set, n, n_malicious, caught / CAST(n_malicious AS DOUBLE) AS recall, caught, missed,
  CASE WHEN n_benign > 0 THEN caught / CAST(caught + fa AS DOUBLE) END AS precision,
  CASE WHEN n_benign > 0 THEN 2 * caught / CAST(2 * caught + fa + missed AS DOUBLE) END AS f1,
  CASE WHEN n_benign > 0 THEN good / CAST(n AS DOUBLE) END AS accuracy, CASE WHEN n_benign > 0 THEN fa END AS false_alarms FROM tallies)"""


@query(f"SELECT set, n, n_malicious, caught, missed, false_alarms, {r6('recall', 'precision', 'f1', 'accuracy')} FROM outcome", _SETS)
def validate_external(spark, sf_dir):
    return rounded(_external_results(spark, sf_dir))


@query("""SELECT set, round(recall, 6) AS recall, round(recall - CAST(0.9539 AS DOUBLE), 6) AS delta,
  CASE WHEN recall - 0.9539 < -0.05 THEN 'material drop' WHEN recall - 0.9539 < -0.01 THEN 'modest drop' ELSE 'holds' END AS outcome
  FROM outcome""", _SETS)
def baseline_delta(spark, sf_dir):
    return rounded(D.baseline_delta(_external_results(spark, sf_dir)))


@query("SELECT set, n, n_malicious, round(recall, 6) AS recall FROM outcome", _SETS)
def external_summary(spark, sf_dir):
    return rounded(D.external_summary(_external_results(spark, sf_dir)))


@query("""SELECT part, place, count(*) AS n FROM (
  SELECT 'missed' AS part, round(score, 2) AS place FROM scored_a WHERE label = 1 AND prediction = 0
  UNION ALL SELECT 'band', CASE WHEN score > 0.40 THEN CAST(0.4 AS DOUBLE) WHEN score > 0.20 THEN CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    FROM scored_a WHERE label = 1 AND prediction = 0
  UNION ALL SELECT 'bin', CAST(least(floor((score - lo) / (hi - lo) * 40), 39) AS DOUBLE)
    FROM scored_a, (SELECT min(score) AS lo, max(score) AS hi FROM scored_a WHERE label = 1) WHERE label = 1) GROUP BY part, place""")
def confidence_report(spark, sf_dir):
    parts = V.confidence_report(scored(spark, sf_dir, "a"))
    bands = parts["bands"].select(F.explode(F.array(*[
        F.struct(F.lit(at).alias("place"), F.col(c).alias("n"))
        for at, c in ((0.4, "above_040"), (0.2, "from_020_to_040"), (0.0, "up_to_020"))])).alias("b"))
    out = E.stack_results(
        parts["missed"].groupBy(F.round("score", 2).alias("place")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("part", F.lit("missed")),
        bands.select("b.place", "b.n", F.lit("band").alias("part")),
        parts["histogram"].select(F.col("bin").cast("double").alias("place"), "n", F.lit("bin").alias("part")))
    return out.where("n > 0")


@query("""SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (score > t) AS caught,
  round(count(*) FILTER (score > t) / CAST(count(*) AS DOUBLE), 6) AS recall
  FROM scored_b CROSS JOIN (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.4 AS DOUBLE)), (CAST(0.3 AS DOUBLE)), (CAST(0.2 AS DOUBLE)), (CAST(0.1 AS DOUBLE))) AS v(t)
  WHERE label = 1 GROUP BY t""")
def threshold_sweep(spark, sf_dir):
    return rounded(D.threshold_sweep(scored(spark, sf_dir, "b")))


@query("""SELECT path_length <= 1 AS bare, count(*) AS n, round(avg(label), 6) AS share_malicious,
  round((SELECT avg(label) FROM feats), 6) AS overall, round(avg(label) / (SELECT avg(label) FROM feats), 6) AS lift
  FROM feats GROUP BY 1""")
def bare_rate(spark, sf_dir):
    return rounded(D.bare_rate(stored_features(spark, sf_dir)))


@query("""SELECT n_bare, n_path, round(fb, 6) AS false_alarm_rate_bare, round(fp, 6) AS false_alarm_rate_path, round(fb - fp, 6) AS gap,
  CASE WHEN fb - fp > 0.10 THEN 'confirmed' WHEN fb - fp > 0.02 THEN 'partly supported' ELSE 'not supported' END AS verdict,
  round(n_bare / CAST(n_bare + n_path AS DOUBLE), 6) AS bare_share_of_benign FROM (
  SELECT count(*) FILTER (bare) AS n_bare, count(*) FILTER (NOT bare) AS n_path,
    count(*) FILTER (bare AND prediction = 1) / CAST(count(*) FILTER (bare) AS DOUBLE) AS fb,
    count(*) FILTER (NOT bare AND prediction = 1) / CAST(count(*) FILTER (NOT bare) AS DOUBLE) AS fp
  FROM (SELECT f.row_id, path_length <= 1 AS bare, prediction FROM feats f JOIN scored_b USING (row_id)
        JOIN split s USING (row_id) WHERE s.is_test AND f.label = 0))""")
def bare_domain_check(spark, sf_dir):
    return rounded(D.bare_domain_check(stored_features(spark, sf_dir), held_out(spark, sf_dir, "b")))


_IMPORTANCE = "importance AS (SELECT feature, CAST(length(feature) AS DOUBLE) / 100 AS importance FROM (VALUES " + ", ".join(
    f"('{n}')" for n in FEATURE_NAMES) + ") AS v(feature))"
_DRIFT = ", ".join([_IMPORTANCE, "drift AS (SELECT o.feature, o.mean AS ours, t.mean AS theirs, "
    "CASE WHEN o.sd >= 1e-6 THEN (t.mean - o.mean) / o.sd END AS diff_sd, importance FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, avg({n}) AS mean, stddev_samp({n}) AS sd FROM feats WHERE label = 0"
                         for n in FEATURE_NAMES) + ") o JOIN ("
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, avg({n}) AS mean FROM feats WHERE label = 0 AND path_length <= 1" for n in FEATURE_NAMES)
    + ") t USING (feature) JOIN importance USING (feature))"])


def name_importance(spark):
    """A fixed importance per feature, used where any importance table will do."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in FEATURE_NAMES])).alias("feature")).select(
        F.lit("m").alias("model"), "feature", (F.length("feature").cast("double") / 100).alias("importance"))


def _drift(spark, sf_dir):
    benign = stored_features(spark, sf_dir).where("label = 0")
    return D.benign_drift(benign, benign.where("path_length <= 1"), name_importance(spark), FEATURE_NAMES)


@query("""SELECT feature, round(ours, 6) AS ours, round(theirs, 6) AS theirs, round(diff_sd, 5) AS diff_sd, round(importance, 5) AS importance,
  round(abs(diff_sd) * importance, 5) AS impact FROM drift""", _DRIFT)
def benign_drift(spark, sf_dir):
    out = _drift(spark, sf_dir)
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("ours", "theirs")],
                      *[F.round(c, 5).alias(c) for c in ("diff_sd", "importance", "impact")])


@query("""SELECT feature, CASE WHEN diff_sd > 0 THEN 'higher' ELSE 'lower' END AS direction FROM drift WHERE diff_sd IS NOT NULL
  ORDER BY round(abs(diff_sd) * importance, 9) DESC, feature LIMIT 12""", _DRIFT)
def drift_top(spark, sf_dir):
    return D.drift_top(_drift(spark, sf_dir).withColumn("impact", F.round("impact", 9))).select("feature", "direction")


@query("""SELECT round(ra, 6) AS recall_full, round(rb, 6) AS recall_clean, round(rb - ra, 6) AS recall_change,
  CASE WHEN abs(rb - ra) <= 0.0012 THEN 'at the noise floor' WHEN rb < ra THEN 'artefact carried weight' ELSE 'artefact was misleading' END AS verdict
  FROM (SELECT max(recall) FILTER (model = 'a') AS ra, max(recall) FILTER (model = 'b') AS rb FROM results)""", _EVAL_TEST)
def leak_verdict(spark, sf_dir):
    results = E.evaluate_binary(E.stack_results(held_out(spark, sf_dir, "a"), held_out(spark, sf_dir, "b")))
    return rounded(D.leak_verdict(results, "a", "b"))


@query("""SELECT round(ra, 6) AS rate_full, round(rb, 6) AS rate_clean, round(rb - ra, 6) AS rate_change,
  CASE WHEN rb - ra < -0.05 THEN 'substantial improvement' ELSE 'little change' END AS verdict
  FROM (SELECT avg(prediction) FILTER (model = 'a') AS ra, avg(prediction) FILTER (model = 'b') AS rb FROM scored_all WHERE label = 0)""")
def external_alarm_verdict(spark, sf_dir):
    return rounded(D.external_alarm_verdict(both(spark, sf_dir).where("label = 0"), "a", "b"))


# ---- rankings of importances, and the importance by shuffling

@query("SELECT feature, round(importance, 6) AS importance FROM drops ORDER BY round(importance, 9) DESC, feature LIMIT 20",
       "drops AS (SELECT feature, round(abs(corr), 9) AS importance FROM (" + " UNION ALL ".join(
           f"SELECT '{n}' AS feature, corr({n}, label) AS corr FROM feats" for n in FEATURE_NAMES) + ") WHERE NOT isnan(corr))")
def importance_topk(spark, sf_dir):
    return rounded(K.importance_topk(_correlations(spark, sf_dir), 20).select("feature", "importance"))


_CORR = tuple(FEATURE_NAMES)


def _correlations(spark, sf_dir):
    """An importance table computed from the data: |correlation| of the features that vary with the label."""
    table = stored_features(spark, sf_dir)
    fixed = constant_columns(table, _CORR)
    names = [n for n in _CORR if n not in fixed]
    one = table.agg(*[F.round(F.abs(F.corr(n, "label")), 9).alias(n) for n in names])
    return one.unpivot([], names, "feature", "importance").withColumn("model", F.lit("m"))


@query("""SELECT feature, rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / CAST(2 AS DOUBLE) AS rank FROM (""" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, count(DISTINCT round({n}, 6)) AS n FROM feats" for n in FEATURE_NAMES) + ")")
def importance_rank(spark, sf_dir):
    one = stored_features(spark, sf_dir).agg(*[F.count_distinct(F.round(n, 6)).cast("double").alias(n) for n in FEATURE_NAMES])
    table = one.unpivot([], FEATURE_NAMES, "feature", "importance").withColumn("model", F.lit("m"))
    return K.importance_rank(table).select("feature", "rank")


_PERM = tuple(FEATURE_NAMES)


def _perm_sql():
    swapped = ", ".join(f"CASE WHEN k.feature = '{n}' THEN v.{n} ELSE k.{n} END AS {n}" for n in _PERM)
    return ("""base_rows AS (SELECT row_id, label, """ + ", ".join(_PERM) + f""", row_number() OVER (ORDER BY row_id) AS place
    FROM feats JOIN (SELECT row_id FROM split WHERE is_test) USING (row_id)),
  jobs AS (SELECT * FROM (VALUES {", ".join(f"('{n}')" for n in _PERM)}) AS f(feature) CROSS JOIN (VALUES (0), (1), (2)) AS r(r)),
  k AS (SELECT b.*, feature, r, row_number() OVER (PARTITION BY feature, r ORDER BY md5('{SEED}|' || feature || '|' || r || '|' || row_id), row_id) AS take
    FROM base_rows b CROSS JOIN jobs),
  mixed AS (SELECT k.row_id, k.label, k.feature, k.r, {swapped} FROM k JOIN base_rows v ON v.place = k.take),
  recalls AS (SELECT feature, r, avg(CASE WHEN {CARD['b']} > 0.5 THEN 1 ELSE 0 END) AS recall FROM mixed WHERE label = 1 GROUP BY feature, r),
  base_recall AS (SELECT avg(prediction) AS recall FROM scored_b JOIN split USING (row_id) WHERE is_test AND scored_b.label = 1)""")


@query("SELECT feature, round(avg((SELECT recall FROM base_recall) - recall), 6) AS importance FROM recalls GROUP BY feature", _perm_sql())
def permutation_importance(spark, sf_dir):
    table = stratified_split(stored_features(spark, sf_dir)).where("is_test").select("row_id", "label", *_PERM)
    return rounded(M.permutation_importance(scorecard("b"), table, list(_PERM)))


@query("""SELECT row_id, label, 1 AS prediction, CAST(1 AS DOUBLE) AS score FROM split WHERE is_test""")
def majority_baseline(spark, sf_dir):
    table = stratified_split(stored_features(spark, sf_dir).select("row_id", "url", "label"))
    return M.majority_baseline(table.where("not is_test"), table.where("is_test")).drop("model")


@query("""SELECT row_id, round(t.n / (2 * CAST(c.n AS DOUBLE)), 6) AS weight FROM split s JOIN
  (SELECT label, count(*) AS n FROM split WHERE NOT is_test GROUP BY label) c USING (label)
  CROSS JOIN (SELECT count(*) AS n FROM split WHERE NOT is_test) t WHERE NOT is_test""")
def balanced_weights(spark, sf_dir):
    table = stratified_split(stored_features(spark, sf_dir).select("row_id", "url", "label"))
    return rounded(M.balanced_weights(table.where("not is_test")).select("row_id", "weight"))


_STD = tuple(FEATURE_NAMES)


@query("SELECT row_id, " + ", ".join(
    f"round((f.{n} - m_{n}) / s_{n}, 5) AS {n}" for n in _STD)
    + " FROM feats f JOIN split USING (row_id) CROSS JOIN (SELECT " + ", ".join(
        f"avg({n}) AS m_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}" for n in _STD)
    + " FROM feats JOIN split USING (row_id) WHERE NOT is_test) WHERE is_test")
def standardise(spark, sf_dir):
    from urlsieve.operators import standardise as Z
    table = stratified_split(stored_features(spark, sf_dir))
    moments = Z.fit_moments(table.where("not is_test"), _STD)
    out = Z.standardise(table.where("is_test").select("row_id", *_STD), moments)
    return rounded(out, 5)
