"""All registered queries."""

from checks import cluster_queries, feature_queries, metric_queries, model_queries, shape_queries, source_queries  # noqa: F401  (registration)
from checks.register import QUERIES, SQL  # noqa: F401
