"""Structure inside one class: k-means with a choice of k, silhouettes, profiles, DBSCAN, PCA."""

from __future__ import annotations

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.operators.aggregates import cluster_sizes, long_form
from urlsieve.operators.blocks import block_pairs, distances, group_sums, reduce_half_grid, reduce_pairs
from urlsieve.operators.joins import fits_broadcast, lookup
from urlsieve.operators.kmeans import KMeansFit, fit_many
from urlsieve.operators.numbering import number_rows
from urlsieve.operators.ranking import cluster_top_features
from urlsieve.operators.splits import sample_n
from urlsieve.operators.sums import task_sums
from urlsieve.session import materialise, stage_table

SEED = 42
K_RANGE = tuple(range(2, 9))
SILHOUETTE_SAMPLE = 20_000
DBSCAN_SAMPLE = 30_000
EPS_SWEEP = (1.5, 2.5, 3.5, 5.0)
MIN_POINTS = 10
MIN_CLUSTER_SHARE = 0.01
SILHOUETTE_TOLERANCE = 0.02


def vectorise(z: DataFrame, names, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol=out).transform(z)


def kmeans_fit(z: DataFrame, names, k: int, n_init: int = 10, max_iter: int = 300, seed: int = SEED) -> KMeansFit:
    """The best of ``n_init`` restarts by inertia; all of them share their scans."""
    return fit_many(z, names, [k], n_init, max_iter, seed)[0][k]


def assign(model: KMeansFit, z: DataFrame, names) -> DataFrame:
    """Add ``cluster`` (in place of one that is there)."""
    if tuple(names) != model.names:
        raise ValueError(f"the clusters were fitted on {list(model.names)}")
    return z.select(*[c for c in z.columns if c != "cluster"], model.cluster().alias("cluster"))


def silhouette_points(assigned: DataFrame, names) -> DataFrame:
    """id, cluster, s: the Euclidean silhouette of each row against all other rows given.

    ``assigned`` has row_id, cluster and the (standardised) features. Rows with equal features in one cluster are one point with a
    weight. Work grows with the square of the points; for large tables use ``silhouette_linear``.
    """
    rows = stage_table(assigned.select(F.col("row_id").alias("id"), F.col("cluster").cast("int").alias("cluster"),
                                       F.array(*[F.col(n).cast("double") for n in names]).alias("vec")), "silhouette")
    points = stage_table(rows.groupBy("cluster", "vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")), "points")

    def sums(p: dict) -> dict:
        ends = [[p[f"{n}_{end}"] for n in ("vec", "weight", "cluster")] for end in "ab"]
        to_b, names_b, to_a, names_a = group_sums(*ends[0], *ends[1])
        out = []
        for end, total, others, weight, of in (("a", to_b, names_b, p["weight_b"], p["cluster_b"]), ("b", to_a, names_a, p["weight_a"], p["cluster_a"])):
            if end == "b" and p["same"]:
                continue
            sizes = np.array([weight[of == c].sum() for c in others])
            n = len(total)
            out.append((np.tile(p[f"id_{end}"], len(others)), np.tile(p[f"cluster_{end}"], len(others)), np.repeat(others, n), total.T.ravel(), np.repeat(sizes, n)))
        return dict(zip(("id", "own", "other", "total", "n"), map(np.concatenate, zip(*out))))

    parts = reduce_half_grid(points, ["cluster", "weight"], sums, "id bigint, own int, other int, total double, n bigint", points.count())
    per = parts.groupBy("id", "own", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    same = F.col("own") == F.col("other")
    a = F.max(F.when(same & (F.col("n") > 1), F.col("total") / F.when(F.col("n") > 1, F.col("n") - 1)))
    b = F.min(F.when(~same, F.col("total") / F.col("n")))
    both = per.groupBy("id", F.col("own").alias("cluster")).agg(a.alias("a"), b.alias("b"))
    top = F.greatest("a", "b")
    s = F.when(top > 0, (F.col("b") - F.col("a")) / F.when(top > 0, top))
    found = both.select(F.col("id").alias("_rep"), F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce(s, F.lit(0.0))).alias("s"))
    reps = points.select("cluster", "vec", F.col("id").alias("_rep")).join(found, "_rep")
    return rows.join(reps, ["cluster", "vec"]).select("id", "cluster", "s")


def silhouette_linear(assigned: DataFrame, names) -> float:
    """Mean silhouette over all rows by squared distances, from sums and squared norms per cluster (one pass)."""
    data = vectorise(assigned, names).select("features", F.col("cluster").cast("int").alias("prediction"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(data)


def silhouette_sample(assigned: DataFrame, names, n: int, seed: int = SEED) -> DataFrame:
    """One row: mean silhouette of at most ``n`` rows, each against the others in the sample; ``n`` in the result is what was used."""
    sample = sample_n(assigned, n, seed=seed)
    return silhouette_points(sample, names).agg(F.avg("s").alias("silhouette"),
                                                   F.count(F.lit(1)).alias("n"))


def fit_all(z: DataFrame, names, ks=K_RANGE, n_init: int = 10, max_iter: int = 300, sample: int | None = None,
            seed: int = SEED) -> tuple[dict[int, KMeansFit], DataFrame]:
    """The fit of every k, and k, inertia, silhouette, min_share: one row per candidate. All fits share their scans.

    The silhouette is the linear one over all rows, or the Euclidean one on ``sample`` rows where that is asked for.
    """
    fits, linear = fit_many(z, names, list(ks), n_init, max_iter, seed)
    rows = []
    for k, fit in fits.items():
        sil = linear[k] if sample is None else silhouette_sample(assign(fit, z, names), names, sample, seed).first()["silhouette"]
        rows.append((k, fit.inertia, sil, min(fit.sizes) / sum(fit.sizes)))
    return fits, z.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, min_share double")


def choose_k(z: DataFrame, names, ks=K_RANGE, n_init: int = 10, max_iter: int = 300,
             sample: int | None = None, seed: int = SEED) -> DataFrame:
    """The table of candidates alone."""
    return fit_all(z, names, ks, n_init, max_iter, sample, seed)[1]


def pick_k(metrics: DataFrame) -> DataFrame:
    """The smallest usable k within the tolerance of the best silhouette; k is usable unless its smallest
    cluster is tiny (when all are, all are usable). ``metrics`` has one row per candidate."""
    every = Window.partitionBy()
    fine = F.col("min_share") >= MIN_CLUSTER_SHARE
    step = metrics.withColumn("_any", F.max(fine).over(every))
    usable = step.where(fine | ~F.col("_any"))
    near = usable.withColumn("_peak", F.max("silhouette").over(every)).where(
        F.col("silhouette") >= F.col("_peak") - SILHOUETTE_TOLERANCE)
    return near.agg(F.min_by(F.struct("k", "silhouette", F.col("_peak").alias("peak")), "k").alias("b")).select("b.*")


def cluster_profiles(assigned: DataFrame, names) -> DataFrame:
    """cluster, feature, z: the centre of each cluster, in standard deviations from the average."""
    centres = assigned.groupBy("cluster").agg(*[F.avg(n).alias(n) for n in names])
    return long_form(centres, ["cluster"], names, "feature", "z")


def cluster_description(assigned: DataFrame, names, k: int = 4) -> DataFrame:
    """Per cluster: size, share, whether tiny, its k strongest features above and below the average, and
    whether it is defined mainly by what is missing."""
    top = cluster_top_features(cluster_profiles(assigned, names), k)

    def side(which):
        chosen = F.sort_array(F.collect_list(
            F.when(F.col("side") == which, F.struct("place", "feature"))))
        return F.concat_ws(", ", F.transform(chosen, lambda x: x["feature"]))

    def n(which):
        return F.sum((F.col("side") == which).cast("int"))

    text = top.groupBy("cluster").agg(side("above").alias("above"), side("below").alias("below"),
                                      (n("below") > n("above")).alias("defined_by_absence"))
    return cluster_sizes(assigned).join(text, "cluster").withColumn(
        "tiny", F.col("share") < MIN_CLUSTER_SHARE)


def clustered_rows(df: DataFrame, assigned: DataFrame) -> DataFrame:
    """url, type, cluster, by row_id."""
    return df.select("row_id", "url", "type").join(assigned.select("row_id", "cluster"), "row_id")


def _local_components(near: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray):
    """Least reachable id per row and per column of a bipartite neighbour matrix (by repeated minima)."""
    top = np.iinfo(np.int64).max
    lab_a, lab_b = ids_a.copy(), ids_b.copy()
    while True:
        new_b = np.minimum(lab_b, np.where(near, lab_a[:, None], top).min(axis=0, initial=top))
        new_a = np.minimum(lab_a, np.where(near, new_b[None, :], top).min(axis=1, initial=top))
        if (new_a == lab_a).all() and (new_b == lab_b).all():
            return lab_a, lab_b
        lab_a, lab_b = new_a, new_b


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """eps, id, label: least id of each connected component. Minima spread along edges, then labels jump to
    the label of their label; every round is checkpointed."""
    both = materialise(edges.unionByName(edges.select("eps", F.col("dst").alias("src"),
                                                      F.col("src").alias("dst"))).distinct())
    labels = nodes.select("eps", "id", F.col("id").alias("label"))
    while True:
        offered = (both.join(labels.withColumnRenamed("id", "src"), ["eps", "src"])
                   .groupBy("eps", F.col("dst").alias("id")).agg(F.min("label").alias("offer")))
        step = labels.join(offered, ["eps", "id"], "left").select(
            "eps", "id", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = step.select("eps", F.col("id").alias("label"), F.col("label").alias("further"))
        step = materialise(step.join(jump, ["eps", "label"], "left").select(
            "eps", "id", "old", F.least("label", "further").alias("label")))
        labels = step.select("eps", "id", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def dbscan_points(points: DataFrame, eps_values, min_points: int = MIN_POINTS,
                  max_rows: int = DBSCAN_SAMPLE) -> DataFrame:
    """eps, id, weight, core, label for every distinct vector; label is null for noise.

    ``points`` has id and vec, at most ``max_rows`` rows. Equal vectors are one point with a weight, so a
    large group of copies costs as much as one row. Three passes over block pairs: neighbour counts;
    connections between core points, reduced to a spanning star per block pair; and, for the remaining
    points, the least label among core neighbours.
    """
    eps_values = [float(e) for e in eps_values]
    width = max(eps_values)
    distinct = materialise(points.groupBy("vec").agg(F.min("id").alias("id"),
                                                     F.count(F.lit(1)).alias("weight")))

    def degree(p: dict) -> dict:
        d = distances(p["vec_a"], len(p["id_a"]), p["vec_b"], len(p["id_b"]))
        return {"eps": np.repeat(eps_values, len(p["id_a"])), "id": np.tile(p["id_a"], len(eps_values)),
                "n": np.concatenate([(d <= e) @ p["weight_b"] for e in eps_values])}

    pairs = block_pairs(distinct, ["weight"], width)
    degrees = (reduce_pairs(pairs, degree, "eps double, id bigint, n bigint", max_rows)
               .groupBy("eps", "id").agg(F.sum("n").alias("n")))
    is_core = degrees.groupBy("id").agg(F.array_compact(F.collect_list(
        F.when(F.col("n") >= min_points, F.col("eps")))).alias("core_at"))
    flagged = distinct.join(is_core, "id").select(
        "id", "vec", "weight",
        *[F.array_contains("core_at", e).cast("int").alias(f"core{i}") for i, e in enumerate(eps_values)])
    flagged = materialise(flagged)
    core_names = [f"core{i}" for i in range(len(eps_values))]

    def stars(p: dict) -> dict | None:
        if p["a"] > p["b"]:
            return None
        d = distances(p["vec_a"], len(p["id_a"]), p["vec_b"], len(p["id_b"]))
        out = []
        for e, c in zip(eps_values, core_names):
            in_a, in_b = p[c + "_a"] == 1, p[c + "_b"] == 1
            ids_a, ids_b = p["id_a"][in_a], p["id_b"][in_b]
            lab_a, lab_b = _local_components(d[np.ix_(in_a, in_b)] <= e, ids_a, ids_b)
            src, dst = np.concatenate([ids_a, ids_b]), np.concatenate([lab_a, lab_b])
            moved = src != dst
            out.append((np.full(moved.sum(), e), src[moved], dst[moved]))
        return {"eps": np.concatenate([o[0] for o in out]), "src": np.concatenate([o[1] for o in out]),
                "dst": np.concatenate([o[2] for o in out])}

    edges = reduce_pairs(block_pairs(flagged, core_names, width), stars,
                         "eps double, src bigint, dst bigint", max_rows)
    state = flagged.select("id", "weight", F.explode(F.array(*[
        F.struct(F.lit(e).alias("eps"), (F.col(c) == 1).alias("core"))
        for e, c in zip(eps_values, core_names)])).alias("s")).select("s.eps", "id", "weight", "s.core")
    labels = _components(state.where("core"), edges)

    by_eps = labels.groupBy("id").pivot("eps", eps_values).agg(F.min("label"))
    none = F.lit(-1).cast("bigint")
    named = flagged.join(by_eps, "id", "left").select(
        "id", "vec", *[F.coalesce(F.col(f"`{e}`"), none).alias(f"label{i}") for i, e in enumerate(eps_values)])
    label_names = [f"label{i}" for i in range(len(eps_values))]
    top = np.iinfo(np.int64).max

    def borders(p: dict) -> dict:
        d = distances(p["vec_a"], len(p["id_a"]), p["vec_b"], len(p["id_b"]))
        out = []
        for e, name in zip(eps_values, label_names):
            open_a, core_b = p[name + "_a"] < 0, p[name + "_b"] >= 0
            near = d[np.ix_(open_a, core_b)] <= e
            best = np.where(near, p[name + "_b"][core_b][None, :], top).min(axis=1, initial=top)
            hit = best < top
            out.append((np.full(hit.sum(), e), p["id_a"][open_a][hit], best[hit]))
        return {"eps": np.concatenate([o[0] for o in out]), "id": np.concatenate([o[1] for o in out]),
                "border": np.concatenate([o[2] for o in out])}

    reached = (reduce_pairs(block_pairs(named, label_names, width), borders,
                            "eps double, id bigint, border bigint", max_rows)
               .groupBy("eps", "id").agg(F.min("border").alias("border")))
    return (state.join(labels, ["eps", "id"], "left").join(reached, ["eps", "id"], "left")
            .select("eps", "id", "weight", "core", F.coalesce("label", "border").alias("label")))


def _points(z: DataFrame, names) -> DataFrame:
    return z.select(F.col("row_id").alias("id"),
                    F.array(*[F.col(n).cast("double") for n in names]).alias("vec"))


def dbscan(z: DataFrame, names, eps: float, min_points: int = MIN_POINTS,
           max_rows: int = DBSCAN_SAMPLE) -> DataFrame:
    """row_id, core, cluster: clusters numbered from 0 by their least core row; -1 is noise.

    A point next to several clusters goes to the first of them.
    """
    points = materialise(_points(z, names))
    found = dbscan_points(points, [eps], min_points, max_rows)
    numbers = number_rows(found.where("core").select(F.col("label").cast("string").alias("_label"), "label").distinct(), ["label"])
    numbers = stage_table(numbers.select("_label", (F.col("place") - 1).cast("int").alias("cluster")), "clusters")
    rows, text = numbers.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("_label")), F.lit(0))).first()
    found = lookup(found.withColumn("_label", F.col("label").cast("string")), numbers, "_label", fits_broadcast(rows, text), "id").select(
        F.col("id").alias("rep"), "core", F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    copies = points.groupBy("vec").agg(F.min("id").alias("rep"))
    return (points.join(copies, "vec").join(found, "rep")
            .select(F.col("id").alias("row_id"), "core", "cluster"))


def dbscan_sweep(z: DataFrame, names, eps_values=EPS_SWEEP, min_points: int = MIN_POINTS,
                 *, n: int, seed: int = SEED) -> DataFrame:
    """eps, clusters, noise_share on at most ``n`` rows (the caller states how many)."""
    sample = sample_n(z, n, seed=seed)
    found = dbscan_points(_points(sample, names), eps_values, min_points, n)
    return found.groupBy("eps").agg(
        F.count_distinct(F.when(F.col("core"), F.col("label"))).alias("clusters"),
        (F.sum(F.when(F.col("label").isNull(), F.col("weight")).otherwise(0))
         / F.sum("weight")).alias("noise_share"))


def pca_axes(z: DataFrame, names, k: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Axes (k, features) and their shares of the variance, from sums of products in one scan. Columns must be centred.

    The sign of an axis is fixed: its greatest loading is positive.
    """
    d = len(names)
    total = task_sums(z, names, [], d * d, lambda x, _: (x.T @ x).ravel()).reshape(d, d)
    values, vectors = np.linalg.eigh(total)
    axes = vectors[:, ::-1][:, :k].T
    axes = axes * np.sign(axes[np.arange(k), np.abs(axes).argmax(axis=1)])[:, None]
    return axes, values[::-1][:k] / max(values.sum(), 1e-300)


def pca_project(z: DataFrame, names, k: int = 2):
    """(row_id, pc1..pck) of all rows and (component, variance_share). Columns must be centred."""
    axes, shares = pca_axes(z, names, k)
    at = [F.expr(" + ".join(f"({float(v)!r}D) * `{n}`" for n, v in zip(names, axis))) for axis in axes]
    coords = z.select("row_id", *[c.alias(f"pc{i + 1}") for i, c in enumerate(at)])
    return coords, z.sparkSession.createDataFrame([(i + 1, float(v)) for i, v in enumerate(shares)], "component int, variance_share double")
