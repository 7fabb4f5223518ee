"""Model folders: a fitted pipeline, whose assembler stage keeps the feature order; linear models, boosted trees and clusterings as small tables."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from urlsieve.operators.boosting import BoostedTrees, from_nodes
from urlsieve.operators.kmeans import nearest
from urlsieve.operators.linear import LinearModel
from urlsieve.operators.models import feature_order
from urlsieve.operators.shape import feature_contract
from urlsieve.operators.standardise import standardise


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> tuple[PipelineModel, list[str]]:
    """The model and its feature order; a clear error when there is none at ``path``."""
    try:
        SparkSession.active().read.text(f"{path}/metadata")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no saved model at {path}; train and save one first") from err
    model = PipelineModel.load(path)
    return model, feature_order(model)


def _rows(path: str) -> list:
    """A saved table by place; a clear error when there is none at ``path``."""
    try:
        return SparkSession.active().read.parquet(path).orderBy("place").collect()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no saved model at {path}; train and save one first") from err


def save_linear(model: LinearModel, path: str) -> None:
    """One row per feature, and one for the intercept and what belongs to the whole model."""
    rows = [(j, n, float(m), float(s), float(w), None, None) for j, (n, m, s, w) in enumerate(zip(model.names, model.mean, model.scale, model.weights))]
    rows.append((len(rows), model.kind, float(model.rows), float(model.scans), model.intercept, *map(float, model.class_weight)))
    SparkSession.active().createDataFrame(rows, "place int, name string, mean double, scale double, weight double, class0 double, class1 double") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_linear(path: str) -> LinearModel:
    *rows, last = _rows(path)
    column = lambda c: np.array([r[c] for r in rows])
    return LinearModel(last["name"], tuple(r["name"] for r in rows), column("mean"), column("scale"), column("weight"), last["weight"],
                       (last["class0"], last["class1"]), int(last["mean"]), int(last["scale"]))


def save_boosted(model: BoostedTrees, path: str) -> None:
    """Folders ``features`` (a row per feature with its bounds; the start margin is in each) and ``nodes``."""
    spark = SparkSession.active()
    features = [(j, n, [float(v) for v in b], model.start) for j, (n, b) in enumerate(zip(model.names, model.bounds))]
    spark.createDataFrame(features, "place int, name string, bounds array<double>, start double").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    model.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")


def load_boosted(path: str) -> BoostedTrees:
    rows = _rows(f"{path}/features")
    return from_nodes([r["name"] for r in rows], [r["bounds"] for r in rows], rows[0]["start"], SparkSession.active().read.parquet(f"{path}/nodes"))


@dataclass(frozen=True)
class ClusterBundle:
    """A clustering that can be kept: columns, their moments, centres, and what is high and low in each cluster."""

    names: tuple[str, ...]
    moments: dict[str, tuple[float, float]]
    centres: np.ndarray
    told: tuple[tuple[str, str], ...]

    def assign(self, rows: DataFrame) -> DataFrame:
        """Rows with ``cluster`` (in place of one that is there) by their raw features, which stay as they are."""
        feature_contract(rows, list(self.names))
        kept = [c for c in rows.columns if c != "cluster"]
        scaled = standardise(rows.select(*kept, *[rows[n].alias(f"_z_{n}") for n in self.names]), {f"_z_{n}": self.moments[n] for n in self.names})
        return scaled.select(*kept, nearest([f"_z_{n}" for n in self.names], self.centres).alias("cluster"))


def save_clustering(bundle: ClusterBundle, path: str) -> None:
    """Folders ``features`` (a row per column, with its moments and its part of each centre) and ``clusters``."""
    spark = SparkSession.active()
    features = [(j, n, *map(float, bundle.moments[n]), [float(v) for v in bundle.centres[:, j]]) for j, n in enumerate(bundle.names)]
    spark.createDataFrame(features, "place int, name string, mean double, scale double, centres array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    spark.createDataFrame([(c, *t) for c, t in enumerate(bundle.told)], "place int, above string, below string").coalesce(1).write.mode("overwrite").parquet(f"{path}/clusters")


def load_clustering(path: str) -> ClusterBundle:
    rows = _rows(f"{path}/features")
    return ClusterBundle(tuple(r["name"] for r in rows), {r["name"]: (r["mean"], r["scale"]) for r in rows}, np.array([r["centres"] for r in rows]).T,
                         tuple((r["above"], r["below"]) for r in _rows(f"{path}/clusters")))
