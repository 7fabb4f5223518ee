"""Addresses in, feature table out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from urlsieve.functions.features import DOUBLE_FEATURES, FEATURES, PREFIX, row_parts, with_parts
from urlsieve.operators.reference import (ReferenceList, brand_proximity, domain_rank_lookup,
                                          known_brand, near_hosts, tld_share_lookup)
from urlsieve.operators.shape import binary_label, dedupe_urls

_LOOKUPS = {
    known_brand: ("brand_is_registered_domain",),
    domain_rank_lookup: ("in_top_sites", "domain_rank_score"),
    tld_share_lookup: ("tld_popularity",),
}
_DISTANCE = ("min_brand_edit_distance", "brand_lookalike")


def _hosts(df: DataFrame, col: str) -> DataFrame:
    return with_parts(df, col).select(*df.columns, PREFIX + "host")


def url_feature_table(df: DataFrame, reference: ReferenceList | None = None, col: str = "url",
                      features: dict | None = None, hosts_from: DataFrame | None = None) -> DataFrame:
    """The columns of ``df`` followed by the features, in contract order.

    Without a reference list the rank and share features are 0 and brands come from the built-in list; the
    whole plan is then one narrow projection. With one, rank, share and brand lookups are joins: broadcasts
    while the lists fit. When the hosts near a brand do not fit, that join shuffles the addresses and so runs
    first, while rows are still narrow. On a stream the distance is an expression, and no state is kept. ``hosts_from`` may name a table with the same addresses that is cheaper to read.
    """
    features = FEATURES if features is None else features
    keep = df.columns
    with_distance = any(n in features for n in _DISTANCE)
    near = None
    if with_distance and reference is not None and not df.isStreaming:
        near = near_hosts(_hosts((df if hosts_from is None else hosts_from).select(col), col), reference)
    if near is not None and not near.small:
        narrow = brand_proximity(_hosts(df, col), reference, spread_by=col, near=near)
        step = with_parts(narrow.select(*keep, "_brand_distance"), col)
    else:
        step = with_parts(df, col)
        if with_distance:
            step = brand_proximity(step, reference, spread_by=col, near=near)
    for add, names in _LOOKUPS.items():
        if any(n in features for n in names):
            step = add(step, reference)
    parts = row_parts()

    def typed(name, column):
        if name not in FEATURES:
            return column.alias(name)
        return column.cast("double" if name in DOUBLE_FEATURES else "int").alias(name)

    return step.select(*keep, *[typed(name, build(parts)) for name, build in features.items()])


def build_feature_table(labelled: DataFrame, reference: ReferenceList | None = None,
                        order: str = "row_id") -> DataFrame:
    """Dedupe by exact address, extract, attach type and label. Dedupe comes first, on purpose:
    repeated addresses would otherwise sit on both sides of a train/test split."""
    unique = dedupe_urls(labelled, order=order)
    if "type" in unique.columns:
        unique = binary_label(unique)
    return url_feature_table(unique, reference, hosts_from=labelled)
