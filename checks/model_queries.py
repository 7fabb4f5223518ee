"""Trained models. Linear and Gaussian ones are checked at their optimum; trees are rows-only, with smaller settings than the defaults."""

from functools import partial

from pyspark.sql import functions as F

from checks.corpus import reference_list, stored_features, table
from checks.metric_queries import _EVAL
from checks.register import query, r6, rounded
from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.operators import boosting as B
from urlsieve.operators import foldstats as G
from urlsieve.operators import linear as L
from urlsieve.operators import models as M
from urlsieve.operators.evaluate import error_overlap, evaluate_binary, stack_results
from urlsieve.operators.ranking import importance_rank as rank_of
from urlsieve.plans import training as T
from urlsieve.plans.feature_table import url_feature_table
from urlsieve.plans.scoring import model_scorer
from urlsieve.session import scratch_path, stage_table
from urlsieve.sources import bundles, readers

SMALL_FOREST = partial(M.train_forest, trees=20, depth=10)
SMALL_BOOSTER = partial(B.fit_boosted, rounds=10)
NB_NAMES = tuple(FEATURE_NAMES)


def split(spark, sf_dir):
    return T.train_test(stored_features(spark, sf_dir))


def _evaluated(spark, sf_dir, trainer, name):
    train, test = split(spark, sf_dir)
    return evaluate_binary(M.score_with(trainer(train, FEATURE_NAMES), test, name))


_TRAIN = "tr AS MATERIALIZED (SELECT f.* FROM feats f JOIN split USING (row_id) WHERE NOT is_test), te AS (SELECT f.* FROM feats f JOIN split USING (row_id) WHERE is_test)"


def _moments_sql(weight):
    """Per feature the sum of weighted labels times the scaled feature; ``weight`` is that of a row labelled 1."""
    scaled = ", ".join(f"(SELECT sum(({n} - m) / s) FROM tr CROSS JOIN (SELECT avg({n}) AS m, coalesce(nullif(stddev_pop({n}), 0), 1) AS s FROM tr) WHERE label = 1) AS {n}" for n in FEATURE_NAMES)
    parts = " UNION ALL ".join([f"SELECT '{n}' AS feature, {n} AS v FROM sums" for n in FEATURE_NAMES] + ["SELECT '(intercept)', CAST(count(*) AS DOUBLE) FROM tr WHERE label = 1"])
    return f"SELECT feature, round(v * {weight}, 3) + 0 AS moment FROM ({parts})", f"{_TRAIN}, sums AS (SELECT {scaled})"


def _certified(spark, sf_dir, balanced):
    train, _ = split(spark, sf_dir)
    found = L.moment_certificate(L.fit_logistic(train, FEATURE_NAMES, balanced=balanced), train)
    return found.select("feature", (F.round("moment", 3) + 0).alias("moment"))


@query(*_moments_sql("1"))
def train_logreg(spark, sf_dir):
    """The fit's moments: they equal those of the labels exactly at the optimum."""
    return _certified(spark, sf_dir, False)


@query(*_moments_sql("(SELECT count(*) / CAST(2 * count(*) FILTER (label = 1) AS DOUBLE) FROM tr)"))
def train_logreg_balanced(spark, sf_dir):
    return _certified(spark, sf_dir, True)


@query()
def logreg_metrics(spark, sf_dir):
    """Both logistic fits, evaluated on the rows kept for testing."""
    train, test = split(spark, sf_dir)
    return evaluate_binary(stack_results(*[L.fit_logistic(train, FEATURE_NAMES, balanced=b).score(test, n)
                                           for n, b in (("logistic regression", False), ("logistic regression, balanced", True))]))


@query()
def train_forest(spark, sf_dir):
    return _evaluated(spark, sf_dir, SMALL_FOREST, "random forest")


@query()
def train_booster(spark, sf_dir):
    """Trees of up to 63 leaves, the leaf with the greatest gain first; the published 300 rounds."""
    train, test = split(spark, sf_dir)
    return evaluate_binary(B.fit_boosted(train, FEATURE_NAMES).score(test, "gradient boosting"))


_LONG = "long AS MATERIALIZED (SELECT label, feature, v, CASE WHEN v = 0 THEN 1 ELSE pow(2, 8 - floor(log2(abs(v)))) END AS scale FROM (" + " UNION ALL ".join(
    f"SELECT label, {i} AS feature, CAST({n} AS DOUBLE) AS v FROM tr" for i, n in enumerate(FEATURE_NAMES)) + "))"
_BINS = """lows AS (SELECT feature, floor(v * scale) / scale AS low, count(*) AS n, count(*) FILTER (label = 1) AS n1 FROM long GROUP BY ALL),
placed AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY feature) <= 255 THEN row_number() OVER (PARTITION BY feature ORDER BY low) - 1
  ELSE floor((sum(n) OVER (PARTITION BY feature ORDER BY low) - n) * 255 / sum(n) OVER (PARTITION BY feature)) END AS bin FROM lows),
bins AS (SELECT feature, bin, min(low) AS low, sum(n) AS n, sum(n1) AS n1 FROM placed GROUP BY ALL),
unit AS (SELECT round(count(*) / (2.0::DOUBLE * count(*) FILTER (label = 1)) * 524288) AS g1, round(count(*) / (2.0::DOUBLE * count(*) FILTER (label = 0)) * 524288) AS g0,
  round(count(*) / (2.0::DOUBLE * count(*) FILTER (label = 1)) * 262144) AS h1, round(count(*) / (2.0::DOUBLE * count(*) FILTER (label = 0)) * 262144) AS h0 FROM tr),
sums AS (SELECT feature, low, lead(low) OVER f AS bound, sum(n) OVER f AS nl, sum(n) OVER (PARTITION BY feature) AS n,
  sum((n - n1) * g0 - n1 * g1) OVER f AS gl, sum((n - n1) * g0 - n1 * g1) OVER (PARTITION BY feature) AS g,
  sum((n - n1) * h0 + n1 * h1) OVER f AS hl, sum((n - n1) * h0 + n1 * h1) OVER (PARTITION BY feature) AS h FROM bins, unit WINDOW f AS (PARTITION BY feature ORDER BY low)),
gains AS (SELECT feature, bound, (gl * gl / hl + (g - gl) * (g - gl) / (h - hl) - g * g / h) / 1048576 AS gain FROM sums WHERE nl >= 20 AND n - nl >= 20)"""
_NAMED = "[" + ", ".join(f"'{n}'" for n in FEATURE_NAMES) + "]"


@query(f"SELECT {_NAMED}[feature + 1] AS feature, bound, round(gain, 3) AS gain FROM (SELECT * FROM gains ORDER BY round(gain, 6) DESC, feature, bound LIMIT 1)", _TRAIN, _LONG, _BINS)
def booster_first_split(spark, sf_dir):
    """The split that growth by greatest gain begins with, over all features and bins."""
    train, _ = split(spark, sf_dir)
    model = B.fit_boosted(train, FEATURE_NAMES, rounds=1, leaves=2)
    return model.nodes(spark).where("node = 0").select("feature", "bound", F.round("gain", 3).alias("gain"))


@query()
def boosted_bundle(spark, sf_dir):
    """Boosted trees saved and loaded: every test row scored by the loaded model, and by how much the fitted one differs."""
    train, test = split(spark, sf_dir)
    path, model = scratch_path(spark, "boosted"), B.fit_boosted(train, FEATURE_NAMES, rounds=2)
    bundles.save_boosted(model, path)
    again = bundles.load_boosted(path).score(test).select("row_id", "label", "prediction", "score")
    return again.join(model.score(test).select("row_id", F.col("score").alias("_s")), "row_id").withColumn("differs", F.abs(F.col("score") - F.col("_s"))).drop("_s")


@query("SELECT feature, CAST(0 AS DOUBLE) AS residual, (SELECT count(*) FROM tr) AS n FROM (SELECT unnest([" + ", ".join(
    f"'{n}'" for n in (*FEATURE_NAMES, "(intercept)")) + "]) AS feature)", _TRAIN)
def train_linear_svm(spark, sf_dir):
    """The gradient of the fit per weight over all training rows, which is zero at the optimum."""
    train, _ = split(spark, sf_dir)
    model = L.fit_squared_hinge(train, FEATURE_NAMES)
    return L.gradient_certificate(model, train).select("feature", (F.round("residual", 3) + 0).alias("residual"), F.lit(model.rows).cast("long").alias("n"))


@query()
def svm_metrics(spark, sf_dir):
    train, test = split(spark, sf_dir)
    return evaluate_binary(L.fit_squared_hinge(train, FEATURE_NAMES).score(test, "linear SVM"))


def _gaussian_sql(rows, parts, by=""):
    """CTEs nb_terms (log-odds of ``rows``): per feature the moments of both classes in ``parts``, a table with label, and a class prior."""
    one = lambda n: (f"(SELECT {by}avg({n}) FILTER (label = 0) AS m0, avg({n}) FILTER (label = 1) AS m1, "  # noqa: E731
                     f"var_pop({n}) FILTER (label = 0) + 1e-9::DOUBLE * coalesce(nullif(var_pop({n}), 0), 1) AS v0, "
                     f"var_pop({n}) FILTER (label = 1) + 1e-9::DOUBLE * coalesce(nullif(var_pop({n}), 0), 1) AS v1 FROM {parts} GROUP BY ALL)")
    joined = " ".join(f"JOIN {one(n)} g{i} ON {'r.fold = g%d.fold' % i if by else 'true'}" for i, n in enumerate(FEATURE_NAMES))
    terms = " + ".join(f"0.5::DOUBLE * ln(g{i}.v0 / g{i}.v1) + pow(r.{n} - g{i}.m0, 2) / (2 * g{i}.v0) - pow(r.{n} - g{i}.m1, 2) / (2 * g{i}.v1)" for i, n in enumerate(FEATURE_NAMES))
    prior = f"(SELECT {by}ln(count(*) FILTER (label = 1) / CAST(count(*) FILTER (label = 0) AS DOUBLE)) AS prior FROM {parts} GROUP BY ALL)"
    return f"SELECT r.*, p.prior + {terms} AS score FROM {rows} r JOIN {prior} p ON {'r.fold = p.fold' if by else 'true'} {joined}"


@query(f"SELECT model, {r6('accuracy', 'precision', 'recall', 'f1', 'roc_auc')}, missed, false_alarms FROM results", _TRAIN,
       f"nb AS MATERIALIZED (SELECT 'naive Bayes' AS model, row_id, label, score, CAST(score > 0 AS INT) AS prediction FROM ({_gaussian_sql('te', 'tr')}))", _EVAL.format(rows="nb"))
def train_gaussian_nb(spark, sf_dir):
    train, test = split(spark, sf_dir)
    return rounded(evaluate_binary(G.fit_gaussian(train, FEATURE_NAMES).score(test)))


_Z = ", ".join(f"({n} - (SELECT avg({n}) FROM t)) / (SELECT coalesce(nullif(stddev_samp({n}), 0), 1) FROM t) AS {n}" for n in NB_NAMES)


@query("SELECT label, feature, round(mean, 4) AS mean, round(variance, 4) AS variance FROM (" + " UNION ALL ".join(
    f"SELECT label, '{n}' AS feature, avg({n}) AS mean, var_pop({n}) AS variance FROM z GROUP BY label" for n in NB_NAMES) + ")",
    "t AS (SELECT f.* FROM feats f JOIN split USING (row_id) WHERE NOT is_test), z AS (SELECT label, " + _Z + " FROM t)")
def gaussian_nb_moments(spark, sf_dir):
    """The fitted means and variances per class, which have a closed form."""
    train, _ = split(spark, sf_dir)
    nb = M.train_gaussian_nb(train, list(NB_NAMES)).stages[-1]
    rows = [(c, n, float(nb.theta.toArray()[c, i]), float(nb.sigma.toArray()[c, i]))
            for c in (0, 1) for i, n in enumerate(NB_NAMES)]
    return rounded(spark.createDataFrame(rows, "label int, feature string, mean double, variance double"), 4)


_compared = {}


def _comparison(spark, sf_dir):
    """The published comparison, fitted once per session and table."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _compared:
        train, test = split(spark, sf_dir)
        _compared[at] = T.compare_models(train, test, FEATURE_NAMES, {
            "random forest": SMALL_FOREST, "gradient boosting": SMALL_BOOSTER, "naive Bayes": G.fit_gaussian, "linear SVM": L.fit_squared_hinge})
    return _compared[at]


@query()
def compare_models(spark, sf_dir):
    return _comparison(spark, sf_dir).results


@query()
def compared_errors(spark, sf_dir):
    """How the errors of the comparison's models overlap, from its own predictions."""
    found = _comparison(spark, sf_dir).predictions
    return error_overlap(found.where("model = 'random forest'"), found.where("model = 'gradient boosting'"))


@query()
def compared_importances(spark, sf_dir):
    """Importances of the comparison's own forest (impurity gain) and booster (splits), ranked side by side."""
    models = _comparison(spark, sf_dir).models
    return rank_of(M.feature_importance(models["random forest"], spark, "random forest").unionByName(models["gradient boosting"].split_counts(spark, "gradient boosting")))


@query("SELECT fold, round(avg(CAST(score > 0 AS INT)), 6) AS recall FROM cv WHERE label = 1 GROUP BY fold",
       "fr AS MATERIALIZED (SELECT f.*, fold FROM feats f JOIN folds USING (row_id))",
       "others AS MATERIALIZED (SELECT o.fold, fr.* EXCLUDE (fold) FROM fr JOIN (SELECT DISTINCT fold FROM fr) o ON o.fold <> fr.fold)",
       f"cv AS ({_gaussian_sql('fr', 'others', 'fold, ')})")
def cross_validate_trained(spark, sf_dir):
    """Recall of naive Bayes on every fold, learnt from the others."""
    return rounded(G.cross_validate_gaussian(stored_features(spark, sf_dir), FEATURE_NAMES))


@query()
def feature_importance(spark, sf_dir):
    train, _ = split(spark, sf_dir)
    return rank_of(M.feature_importance(SMALL_FOREST(train, FEATURE_NAMES), spark, "random forest"))


@query(*_moments_sql("1"))
def model_bundle(spark, sf_dir):
    """A logistic fit saved and loaded: the loaded model still meets its optimum's moments."""
    train, _ = split(spark, sf_dir)
    path = scratch_path(spark, "linear")
    bundles.save_linear(L.fit_logistic(train, FEATURE_NAMES), path)
    found = L.moment_certificate(bundles.load_linear(path), train)
    return found.select("feature", (F.round("moment", 3) + 0).alias("moment"))


@query()
def mllib_bundle(spark, sf_dir):
    """Save, load, score with the loaded model: every row with its score, and the number of features."""
    train, test = split(spark, sf_dir)
    path = scratch_path(spark, "model")
    bundles.save_model(M.train_logreg(train, FEATURE_NAMES, max_iter=20), path)
    model, names = bundles.load_model(path)
    return model_scorer(model)(test).select("row_id", "label", "prediction", "score", F.lit(len(names)).alias("n_features"))


def _legitimate(spark, sf_dir):
    """Features of legitimate addresses that no model was trained on: the pages' own, from a file as another source would give it."""
    path = scratch_path(spark, "legitimate")
    table(spark, sf_dir, "pages").select(F.col("url").alias("URL"), F.lit(1).alias("label")).write.options(**readers.CSV).csv(path)
    rows = stage_table(readers.read_external_labelled(spark, path).where("label = 0"), "legitimate")
    return stage_table(url_feature_table(rows, reference_list(spark, sf_dir)), "legitimate_features")


@query()
def leak_ablation(spark, sf_dir):
    """Forests of 100 trees with and without the suspected column, and what that changes on the test rows and on addresses from elsewhere.

    The published trees have no limit of depth, and 30 is the greatest that Spark takes. The model without the column is saved, and
    its number of features is that of the saved one.
    """
    out = T.leak_ablation(stored_features(spark, sf_dir), FEATURE_NAMES, partial(M.train_forest, depth=30), _legitimate(spark, sf_dir))
    path = scratch_path(spark, "clean")
    bundles.save_model(out.without, path)
    _, kept = bundles.load_model(path)
    n = F.when(F.col("model") == "full", len(FEATURE_NAMES)).otherwise(len(kept)).alias("n_features")
    change = out.verdict.select(F.lit("without").alias("model"), "recall_change", "verdict")
    alarms = out.external.select(F.lit("without").alias("model"), "rate_full", "rate_clean", "rate_change", F.col("verdict").alias("external_verdict"))
    return out.results.select("*", n).join(change, "model", "left").join(alarms, "model", "left")
