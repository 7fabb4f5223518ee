"""Trainers (MLlib pipelines), scoring with them, cross-validation and importances.

A trainer is ``trainer(train, names) -> PipelineModel``. Defaults are the settings of the published runs;
pass smaller ones for a quick look. Scaling is a stage of the pipeline, so it only ever sees training rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import count_if, ratio
from urlsieve.operators.evaluate import stack_results
from urlsieve.operators.numbering import number_rows
from urlsieve.operators.shape import feature_contract
from urlsieve.operators.splits import hash_key, sample_n, stratified_folds
from urlsieve.session import ensure_checkpoint_dir, stage_table

SEED = 42
Trainer = Callable[[DataFrame, list[str]], PipelineModel]


def majority_baseline(train: DataFrame, test: DataFrame, name: str = "always majority") -> DataFrame:
    """Score every test row with the most frequent training label (the lowest on ties)."""
    top = (train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
           .agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("l")).scalar())
    return test.select(F.lit(name).alias("model"), "row_id", "label",
                       top.cast("int").alias("prediction"), top.cast("double").alias("score"))


def balanced_weights(train: DataFrame, weight: str = "weight") -> DataFrame:
    """Add n / (classes * n_class). There is one row per label value to broadcast."""
    every = Window.partitionBy()
    per_class = train.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    per_class = per_class.select("label", (F.sum("_n").over(every)
                                           / (F.count(F.lit(1)).over(every) * F.col("_n"))).alias(weight))
    return train.join(F.broadcast(per_class), "label")


def _fit(train: DataFrame, names: list[str], classifier, scaled: bool, balanced: bool) -> PipelineModel:
    ensure_checkpoint_dir(train.sparkSession)
    feature_contract(train, names)
    stages = [VectorAssembler(inputCols=names, outputCol="raw_features" if scaled else "features")]
    if scaled:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features",
                                     withMean=True, withStd=True))
    if balanced:
        train = balanced_weights(train)
        classifier = classifier.setWeightCol("weight")
    return Pipeline(stages=[*stages, classifier]).fit(train)


def train_logreg(train: DataFrame, names: list[str], balanced: bool = False,
                 max_iter: int = 1000) -> PipelineModel:
    """Scaled logistic regression with an L2 penalty of strength 1 over the sum of losses."""
    n = train.count()
    clf = LogisticRegression(maxIter=max_iter, regParam=1.0 / max(n, 1), elasticNetParam=0.0)
    return _fit(train, names, clf, scaled=True, balanced=balanced)


def train_forest(train: DataFrame, names: list[str], trees: int = 100, depth: int = 20,
                 seed: int = SEED) -> PipelineModel:
    clf = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=128, seed=seed,
                                 featureSubsetStrategy="sqrt", cacheNodeIds=True, checkpointInterval=10,
                                 maxMemoryInMB=512)
    return _fit(train, names, clf, scaled=False, balanced=True)


def train_booster(train: DataFrame, names: list[str], rounds: int = 300, rate: float = 0.1,
                  depth: int = 6, seed: int = SEED) -> PipelineModel:
    """Gradient boosting; depth 6 gives at most 64 leaves per tree."""
    clf = GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, maxBins=128, seed=seed,
                        cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=512)
    return _fit(train, names, clf, scaled=False, balanced=True)


def train_linear_svm(train: DataFrame, names: list[str], max_iter: int = 3000) -> PipelineModel:
    n = train.count()
    clf = LinearSVC(maxIter=max_iter, regParam=1.0 / max(n, 1))
    return _fit(train, names, clf, scaled=True, balanced=True)


def train_gaussian_nb(train: DataFrame, names: list[str]) -> PipelineModel:
    return _fit(train, names, NaiveBayes(modelType="gaussian"), scaled=True, balanced=False)


def feature_order(model: PipelineModel) -> list[str]:
    """The features a model was trained on, in order."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def score_with(model: PipelineModel, df: DataFrame, name: str = "model") -> DataFrame:
    """Rows of ``df`` with model, prediction and score (probability of malicious, else the decision value)."""
    feature_contract(df, feature_order(model))
    out = model.transform(df)
    source = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(F.lit(name).alias("model"), *df.columns,
                      F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array(source)[1].alias("score"))


def recall_by(scored: DataFrame, *by: str) -> DataFrame:
    y, p = F.col("label") == 1, F.col("prediction") == 1
    return scored.groupBy(*by).agg(ratio(count_if(y & p), count_if(y)).alias("recall"))


def cross_validate_recall(df: DataFrame, names: list[str], fit_and_score, folds: int = 5, seed: int = SEED,
                          parallelism: int = 1) -> DataFrame:
    """fold, recall over stratified folds of the whole table.

    ``fit_and_score(train, test, names)`` returns the scored test rows; see ``with_trainer``. Folds are
    fitted from ``parallelism`` driver threads, each fit being a set of cluster jobs.
    """
    table = stage_table(stratified_folds(df, folds=folds, seed=seed), "folds")

    def one(f: int) -> DataFrame:
        scored = fit_and_score(table.where(F.col("fold") != f), table.where(F.col("fold") == f), names)
        return scored.withColumn("fold", F.lit(f))

    if parallelism == 1:
        parts = [one(f) for f in range(folds)]
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds)))
    return recall_by(stack_results(*parts), "fold")


def with_trainer(trainer: Trainer, **settings):
    def run(train: DataFrame, test: DataFrame, names: list[str]) -> DataFrame:
        return score_with(partial(trainer, **settings)(train, names), test)
    return run


def feature_importance(model: PipelineModel, spark, name: str = "model") -> DataFrame:
    """model, feature, importance of a tree model: one row per feature."""
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(name, f, float(g)) for f, g in zip(feature_order(model), gains)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def permutation_importance(scorer: Callable[[DataFrame], DataFrame], test: DataFrame, names: list[str],
                           repeats: int = 3, n: int | None = None, seed: int = SEED) -> DataFrame:
    """feature, importance: mean drop of recall when the feature is shuffled, on all rows or, if asked, ``n`` of them.

    Every (feature, repeat) is a shuffle of the sample: rows in hash order take the value of the row at the
    same place in row order. The places of all copies are exact and come from ranges of (copy, hash), so that a copy of any
    size is spread over many tasks; only hashes and single values are shuffled, and all copies are scored in one job.
    """
    sample = stage_table(test if n is None else sample_n(test, n, seed=seed), "permuted")
    base = recall_by(scorer(sample)).select("recall").scalar()
    types = dict(sample.dtypes)
    case = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(r).alias("r")) for f in names for r in range(repeats)]))
    copies = sample.select("row_id", case.alias("_c")).select("row_id", F.col("_c.f").alias("_f"), F.col("_c.r").alias("_r"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "_f", F.col("_r").cast("string"), F.col("row_id").cast("string")))
    takes = number_rows(copies.withColumn("_key", key), ["_key", "row_id"], ["_f", "_r"], "_place").drop("_key")
    placed = number_rows(sample.select("row_id", *names), ["row_id"], name="_place")
    values = placed.select("_place", F.posexplode(F.array(*[F.col(f).cast("double") for f in names])).alias("_j", "_value"))
    named = F.element_at(F.array(*map(F.lit, names)), F.col("_j") + 1)
    moved = takes.join(values.select("_place", named.alias("_f"), "_value"), ["_place", "_f"]).drop("_place")
    mixed = sample.join(moved, "row_id").withColumns({
        f: F.when(F.col("_f") == f, F.col("_value")).otherwise(F.col(f)).cast(types[f]) for f in names})
    drops = recall_by(scorer(mixed), "_f", "_r").select(
        F.col("_f").alias("feature"), (base - F.col("recall")).alias("_drop"))
    return drops.groupBy("feature").agg(F.avg("_drop").alias("importance"))
