"""The clustering flow inside one class, and its second pass inside a dominant cluster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import cluster_sizes, label_composition
from urlsieve.operators.cluster import K_RANGE, assign, cluster_description, cluster_profiles, fit_all, pick_k
from urlsieve.operators.kmeans import KMeansFit
from urlsieve.operators.ranking import dominant_cluster
from urlsieve.operators.shape import constant_columns
from urlsieve.operators.standardise import fit_moments, standardise
from urlsieve.session import stage_table
from urlsieve.sources.bundles import ClusterBundle

DOMINANT_SHARE = 0.60


@dataclass(frozen=True)
class Clustering:
    """A fitted pass: the z-scores it ran on with ``cluster`` added, the columns used, its metrics per k, fit and moments."""

    assigned: DataFrame
    names: list[str]
    k: int
    metrics: DataFrame
    model: KMeansFit
    moments: dict

    def bundle(self) -> ClusterBundle:
        """What assigns new rows, and how each cluster is described."""
        told = {r["cluster"]: (r["above"], r["below"]) for r in cluster_description(self.assigned, self.names).collect()}
        return ClusterBundle(tuple(self.names), self.moments, self.model.centres, tuple(told.get(c, ("", "")) for c in range(self.k)))


def cluster_class(rows: DataFrame, names, ks=K_RANGE, **settings) -> Clustering:
    """Drop constant columns, standardise, fit every k at once and keep the chosen one. The z-scores are stored once, since every
    scan reads them."""
    fixed = constant_columns(rows, names)
    used = [n for n in names if n not in fixed]
    moments = fit_moments(rows, used)
    z = stage_table(standardise(rows.select("row_id", *used), moments), "zscores")
    fits, metrics = fit_all(z, used, ks, **settings)
    k = pick_k(metrics).first()["k"]
    return Clustering(assign(fits[k], z, used), used, k, metrics, fits[k], moments)


def second_pass(rows: DataFrame, first: Clustering, names, ks=K_RANGE, threshold: float = DOMINANT_SHARE,
                **settings) -> Clustering | None:
    """Cluster again inside a cluster that holds most rows, against that cluster's own average."""
    top = dominant_cluster(cluster_sizes(first.assigned), threshold).first()
    if not top["second_pass"]:
        return None
    inside = first.assigned.where(F.col("cluster") == top["cluster"]).select("row_id")
    return cluster_class(rows.join(inside, "row_id", "left_semi"), names, ks, **settings)


def pass_report(rows: DataFrame, found: Clustering, level: str) -> dict[str, DataFrame]:
    """What is told about a pass, the first or the second: sizes with descriptions, profiles, label mix and dominance."""
    typed = found.assigned.select("row_id", "cluster").join(rows.select("row_id", "type"), "row_id")
    sizes = cluster_sizes(found.assigned)
    tables = {"description": cluster_description(found.assigned, found.names), "profiles": cluster_profiles(found.assigned, found.names),
              "composition": label_composition(typed), "dominance": dominant_cluster(sizes, DOMINANT_SHARE)}
    return {name: table.withColumn("level", F.lit(level)) for name, table in tables.items()}
