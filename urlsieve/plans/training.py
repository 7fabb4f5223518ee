"""Train on one split, compare on it, and test what a suspected column contributes."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import confusion_counts
from urlsieve.operators.diagnostics import external_alarm_verdict, leak_verdict
from urlsieve.operators.evaluate import evaluate_binary, stack_results
from urlsieve.operators.shape import LEAKY, ablate_columns
from urlsieve.operators.splits import stratified_split
from urlsieve.operators.models import score_with
from urlsieve.session import stage_table


def train_test(df: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The same exact split every flow uses, so that results are measured on the same rows; computed and written once."""
    table = stage_table(stratified_split(df, test_share=test_share, seed=seed), "split")
    return table.where(~F.col("is_test")).drop("is_test"), table.where("is_test").drop("is_test")


@dataclass(frozen=True)
class Comparison:
    """What a comparison leaves: one evaluated row per run, the fitted models, and every run's scored test rows (written once)."""

    results: DataFrame
    models: dict
    predictions: DataFrame


def _scored(model, rows: DataFrame, name: str) -> DataFrame:
    """Rows scored by a fitted pipeline, or by a model that scores rows itself."""
    return score_with(model, rows, name) if isinstance(model, PipelineModel) else model.score(rows, name)


def compare_models(train: DataFrame, test: DataFrame, names: list[str], runs: dict) -> Comparison:
    """Fit, score and evaluate every run, with its training seconds. ``runs``: name -> trainer(train, names).

    Overlaps, challengers, importances and bundles go on from the same fits and predictions.
    """
    models, spent = {}, {}
    for name, trainer in runs.items():
        start = time.monotonic()
        models[name] = trainer(train, names)
        spent[name] = round(time.monotonic() - start, 1)
    predictions = stage_table(stack_results(*[_scored(m, test, n) for n, m in models.items()]), "predictions")
    seconds = F.create_map(*[F.lit(x) for pair in spent.items() for x in pair])
    results = evaluate_binary(predictions).withColumn("train_seconds", seconds[F.col("model")])
    return Comparison(results, models, predictions)


@dataclass(frozen=True)
class Ablation:
    """Results of both models, the verdict, the change of the false-alarm rate on external rows (if given) and both models."""

    results: DataFrame
    verdict: DataFrame
    external: DataFrame | None
    full: object
    without: object
    kept: list[str]
    clean_report: DataFrame


def leak_ablation(df: DataFrame, names: list[str], trainer, external: DataFrame | None = None, leaky=LEAKY) -> Ablation:
    """Train with and without the suspected columns. ``external``: legitimate rows with features.

    ``without`` is the model to go on with, ``kept`` its columns and ``clean_report`` its counts of right and wrong test rows.
    """
    kept = ablate_columns(names, leaky)
    train, test = train_test(df)
    full, without = trainer(train, names), trainer(train, kept)

    def scored(rows):
        return stack_results(_scored(full, rows, "full"), _scored(without, rows, "without"))

    predictions = stage_table(scored(test), "predictions")
    results = evaluate_binary(predictions)
    alarms = None if external is None else external_alarm_verdict(scored(external), "full", "without")
    return Ablation(results, leak_verdict(results, "full", "without"), alarms, full, without, kept,
                    confusion_counts(predictions.where("model = 'without'")))
