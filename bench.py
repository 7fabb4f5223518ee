"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once on the smallest tables (JVM warm-up) and then once, timed, on the bench tables. The
saved feature table is built first, and its building is timed as ``extract_and_store``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.corpus import stored_features, url_corpus  # noqa: E402
from checks.registry import QUERIES  # noqa: E402

HEADLINE = ("url_feature_table", "reference_optional", "brand_proximity", "dedupe_urls", "stratified_split",
            "stratified_folds", "sample_n", "feature_moments", "evaluate_binary", "model_comparison",
            "error_overlap", "threshold_sweep", "benign_drift", "bare_domain_check", "validate_external",
            "score_report", "cluster_profiles", "permutation_importance", "train_logreg", "train_forest",
            "train_gaussian_nb", "kmeans_fit", "silhouette_sample", "dbscan")
WARM_UP = "/root/testdata/sf0.001"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    stored_features(spark, WARM_UP)
    timed("extract_and_store", lambda: stored_features(spark, sf_dir))
    for name in HEADLINE:
        run(QUERIES[name](spark, WARM_UP))
        timed(name, lambda: run(QUERIES[name](spark, sf_dir)))
    rows = url_corpus(spark, sf_dir).select("url").distinct().count()  # duplicates are dropped before extraction
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "extraction_rows_per_sec": round(rows / times["url_feature_table"]), "rows": rows, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
