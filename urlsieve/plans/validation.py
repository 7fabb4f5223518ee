"""Measure a model on sets it was not trained on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import score_bands, score_histogram
from urlsieve.operators.diagnostics import external_metrics
from urlsieve.operators.ranking import missed_sorted
from urlsieve.operators.reference import ReferenceList
from urlsieve.operators.shape import feature_contract
from urlsieve.plans.feature_table import url_feature_table


def score_external(df: DataFrame, scorer: Callable[[DataFrame], DataFrame], names, set_name: str,
                   reference: ReferenceList | None = None) -> DataFrame:
    """Extract with our features, check the contract, score, and name the set."""
    features = feature_contract(url_feature_table(df, reference), names)
    return scorer(features).withColumn("set", F.lit(set_name))


def validate_external(df: DataFrame, scorer, names, set_name: str,
                      reference: ReferenceList | None = None) -> DataFrame:
    return external_metrics(score_external(df, scorer, names, set_name, reference))


def confidence_report(scored: DataFrame, bins: int = 40) -> dict[str, DataFrame]:
    """How sure the model was where it was wrong: bands, missed rows by score, histogram."""
    return {"bands": score_bands(scored), "missed": missed_sorted(scored),
            "histogram": score_histogram(scored, bins)}
