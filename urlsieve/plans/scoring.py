"""Score addresses: extract, predict, verdict, reasons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from urlsieve.operators.models import feature_order, score_with
from urlsieve.operators.reference import ReferenceList
from urlsieve.operators.score import explain_signals, trust_score, verdict
from urlsieve.plans.feature_table import url_feature_table


def model_scorer(model) -> Callable[[DataFrame], DataFrame]:
    """A scorer from a fitted model; it fails when the table lacks one of the model's features."""
    feature_order(model)
    return lambda features: score_with(model, features).drop("model")


def score_urls(df: DataFrame, scorer: Callable[[DataFrame], DataFrame],
               reference: ReferenceList | None = None) -> DataFrame:
    """row_id, url, ... with score, trust_score, verdict, warnings, reassurances. Works on one row or on a
    whole table alike; without joins unless a reference list is given."""
    return explain_signals(verdict(trust_score(scorer(url_feature_table(df, reference)))))
