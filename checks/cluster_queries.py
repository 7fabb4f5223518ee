"""Clustering operators. Some run on a grouping given by a rule over the features; fitted ones are fitted by the SQL as well."""

from pyspark.sql import functions as F

from checks.corpus import SEED, stored_features
from checks.register import query, r6, rounded
from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.operators import aggregates as A
from urlsieve.operators import cluster as C
from urlsieve.operators import ranking as K
from urlsieve.operators.shape import restrict_class
from urlsieve.operators.standardise import fit_moments, standardise
from urlsieve.plans import clustering as P
from urlsieve.session import scratch_path
from urlsieve.sources import bundles

NAMES = tuple(FEATURE_NAMES)

# A grouping of the malicious rows by rule: numeric hosts, shorteners, abused endings, the rest.
RULE = ("CASE WHEN has_ip_host = 1 THEN 0 WHEN is_shortening_service = 1 THEN 1 "
        "WHEN suspicious_tld = 1 THEN 2 ELSE 3 END")

_ASSIGNED = f"""mal AS (SELECT row_id, url, type, CAST({RULE} AS INT) AS cluster, {', '.join(NAMES)} FROM feats WHERE label = 1),
mom AS (SELECT {', '.join(f'avg({n}) AS m_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}' for n in NAMES)} FROM mal),
z AS (SELECT row_id, cluster, {', '.join(f'({n} - m_{n}) / s_{n} AS {n}' for n in NAMES)} FROM mal CROSS JOIN mom)"""
_PROFILES = _ASSIGNED + ", profiles AS (" + " UNION ALL ".join(
    f"SELECT cluster, '{n}' AS feature, round(avg({n}), 9) AS z FROM z GROUP BY cluster" for n in NAMES) + ")"
_VECTORS = _ASSIGNED + f""", v AS (SELECT row_id AS id, cluster, [{', '.join(NAMES)}] AS vec FROM z)"""


def _sampled(ctes, n):
    """The same with the first n rows in the order of the operators' sample."""
    first = f"(SELECT * FROM z ORDER BY md5('{SEED}|' || row_id), row_id LIMIT {n})"
    return ctes.replace("AS vec FROM z)", f"AS vec FROM {first})")


def malicious(spark, sf_dir):
    return restrict_class(stored_features(spark, sf_dir), 1)


def z_scores(spark, sf_dir):
    rows = malicious(spark, sf_dir).withColumn("cluster", F.expr(RULE))
    return standardise(rows.select("row_id", "cluster", *NAMES), fit_moments(rows, NAMES))


def labelled(spark, sf_dir):
    return malicious(spark, sf_dir).select("row_id", "url", "type", F.expr(RULE).alias("cluster"))


def profiles(spark, sf_dir):
    return rounded(C.cluster_profiles(z_scores(spark, sf_dir), NAMES), 9)


@query("SELECT cluster, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM mal) AS DOUBLE), 6) AS share FROM mal GROUP BY cluster", _ASSIGNED)
def cluster_sizes(spark, sf_dir):
    return rounded(A.cluster_sizes(labelled(spark, sf_dir)))


_COMP = _ASSIGNED + """, comp AS (SELECT c.cluster, t.type, count(m.row_id) AS n, count(m.row_id) / CAST(any_value(c.n) AS DOUBLE) AS share,
  any_value(t.n) / CAST((SELECT count(*) FROM mal) AS DOUBLE) AS overall_share
  FROM (SELECT cluster, count(*) AS n FROM mal GROUP BY cluster) c CROSS JOIN (SELECT type, count(*) AS n FROM mal GROUP BY type) t
  LEFT JOIN mal m ON m.cluster = c.cluster AND m.type = t.type GROUP BY c.cluster, t.type)"""


@query(f"SELECT cluster, type, n, {r6('share', 'overall_share')} FROM comp", _COMP)
def label_composition(spark, sf_dir):
    return rounded(A.label_composition(labelled(spark, sf_dir)))


@query(f"""SELECT type, cluster, {r6('share', 'overall_share')} FROM (
  SELECT *, row_number() OVER (PARTITION BY type ORDER BY share DESC, cluster) AS rn FROM comp) WHERE rn = 1""", _COMP)
def distinctive_cluster(spark, sf_dir):
    return rounded(K.distinctive_cluster(A.label_composition(labelled(spark, sf_dir))))


@query("""SELECT cluster, n, round(share, 6) AS share, share >= 0.60 AS second_pass FROM (
  SELECT cluster, count(*) AS n, count(*) / CAST((SELECT count(*) FROM mal) AS DOUBLE) AS share FROM mal GROUP BY cluster)
  ORDER BY n DESC, cluster LIMIT 1""", _ASSIGNED)
def dominant_cluster(spark, sf_dir):
    return rounded(K.dominant_cluster(A.cluster_sizes(labelled(spark, sf_dir))))


@query("SELECT cluster, feature, round(z, 6) AS z FROM profiles", _PROFILES)
def cluster_profiles(spark, sf_dir):
    return rounded(profiles(spark, sf_dir))


_TOP = _PROFILES + """, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(z) DESC, feature) AS place
  FROM profiles) WHERE place <= 4)"""


@query("""SELECT cluster, feature, round(z, 6) AS z, CAST(place AS INT) AS place, CASE WHEN z > 0 THEN 'above' WHEN z < 0 THEN 'below' ELSE 'level' END AS side
  FROM top""", _TOP)
def cluster_top_features(spark, sf_dir):
    return rounded(K.cluster_top_features(profiles(spark, sf_dir)))


@query("SELECT feature, round(max(abs(z)), 6) AS spread FROM profiles GROUP BY feature ORDER BY max(abs(z)) DESC, feature LIMIT 14", _PROFILES)
def profile_spread(spark, sf_dir):
    return rounded(K.profile_spread(profiles(spark, sf_dir)))


@query("""SELECT cluster, n, round(n / CAST((SELECT count(*) FROM mal) AS DOUBLE), 6) AS share, n / CAST((SELECT count(*) FROM mal) AS DOUBLE) < 0.01 AS tiny,
  coalesce(string_agg(feature, ', ' ORDER BY place) FILTER (z > 0), '') AS above, coalesce(string_agg(feature, ', ' ORDER BY place) FILTER (z < 0), '') AS below,
  count(*) FILTER (z < 0) > count(*) FILTER (z > 0) AS defined_by_absence
  FROM top JOIN (SELECT cluster, count(*) AS n FROM mal GROUP BY cluster) USING (cluster) GROUP BY cluster, n""", _TOP)
def cluster_description(spark, sf_dir):
    return rounded(C.cluster_description(z_scores(spark, sf_dir), NAMES))


@query("SELECT row_id, url, type, cluster FROM mal", _ASSIGNED)
def clustered_rows(spark, sf_dir):
    return C.clustered_rows(malicious(spark, sf_dir), labelled(spark, sf_dir))


_SIL = _VECTORS + """, sums AS (SELECT a.id, a.cluster AS own, b.cluster AS other, sum(list_distance(a.vec, b.vec)) AS total, count(*) AS n
  FROM v a CROSS JOIN v b GROUP BY a.id, a.cluster, b.cluster),
ab AS (SELECT id, own, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b
  FROM sums GROUP BY id, own),
sil AS (SELECT id, own, CASE WHEN a IS NULL THEN CAST(0 AS DOUBLE) WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE CAST(0 AS DOUBLE) END AS s FROM ab)"""


@query("SELECT round(avg(s), 6) AS silhouette, count(*) AS n FROM sil", _sampled(_SIL, C.SILHOUETTE_SAMPLE))
def silhouette_sample(spark, sf_dir):
    return rounded(C.silhouette_sample(z_scores(spark, sf_dir), NAMES, C.SILHOUETTE_SAMPLE))


@query("SELECT row_id, own AS cluster, round(s, 6) AS s FROM sil JOIN mal ON row_id = id", _SIL)
def silhouette_points(spark, sf_dir):
    out = C.silhouette_points(z_scores(spark, sf_dir), NAMES)
    return rounded(out.select(F.col("id").alias("row_id"), "cluster", "s"))


_METRICS = _ASSIGNED + ", metrics AS (" + " UNION ALL ".join(
    f"""SELECT {k} AS k, round(sqrt(max(c) / CAST(sum(c) AS DOUBLE)), 6) AS silhouette, min(c) / CAST(sum(c) AS DOUBLE) AS min_share
  FROM (SELECT url_length % {k} AS g, count(*) AS c FROM feats WHERE label = 1 GROUP BY 1)""" for k in C.K_RANGE) + """),
usable AS (SELECT * FROM metrics WHERE min_share >= 0.01 OR (SELECT max(min_share) FROM metrics) < 0.01)"""


@query("""SELECT CAST(k AS INT) AS k, silhouette, (SELECT max(silhouette) FROM usable) AS peak FROM usable
  WHERE silhouette >= (SELECT max(silhouette) FROM usable) - CAST(0.02 AS DOUBLE) ORDER BY k LIMIT 1""", _METRICS)
def pick_k(spark, sf_dir):
    """The choice rule on a table of candidates computed from the malicious rows (any measure per k will do)."""
    rows = malicious(spark, sf_dir).select("url_length")
    tables = []
    for k in C.K_RANGE:
        sizes = rows.groupBy((F.col("url_length") % k).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        tables.append(sizes.agg(F.lit(k).alias("k"), F.round(F.sqrt(F.max("c") / F.sum("c")), 6).alias("silhouette"),
                                (F.min("c") / F.sum("c")).alias("min_share")))
    metrics = tables[0]
    for t in tables[1:]:
        metrics = metrics.unionByName(t)
    return C.pick_k(metrics)


def _dbscan_sql(eps):
    values = ", ".join(f"(CAST({e} AS DOUBLE))" for e in eps)
    return _VECTORS + f""", eps_at AS (SELECT * FROM (VALUES {values}) AS t(eps)),
d AS MATERIALIZED (SELECT a.id AS a, b.id AS b, list_distance(a.vec, b.vec) AS d FROM v a CROSS JOIN v b WHERE list_distance(a.vec, b.vec) <= {max(eps)}),
core AS MATERIALIZED (SELECT eps, a AS id FROM d JOIN eps_at ON d <= eps GROUP BY eps, a HAVING count(*) >= 10),
edges AS MATERIALIZED (SELECT x.eps, a, b FROM d JOIN core x ON x.id = a AND d <= x.eps JOIN core y ON y.id = b AND y.eps = x.eps),
cc(eps, id, label) USING KEY (eps, id) AS (
  SELECT eps, id, id FROM core
  UNION
  SELECT e.eps, e.a, min(c.label) FROM cc c JOIN edges e ON e.eps = c.eps AND e.b = c.id
  JOIN recurring.cc r ON r.eps = e.eps AND r.id = e.a WHERE c.label < r.label GROUP BY e.eps, e.a),
lab AS (SELECT eps_at.eps, v.id, CASE WHEN cc.id IS NOT NULL THEN cc.label ELSE border.label END AS label, cc.id IS NOT NULL AS core
  FROM v CROSS JOIN eps_at LEFT JOIN cc ON cc.eps = eps_at.eps AND cc.id = v.id
  LEFT JOIN (SELECT eps_at.eps, a AS id, min(cc.label) AS label FROM d JOIN eps_at ON d <= eps_at.eps JOIN cc ON cc.eps = eps_at.eps AND cc.id = b GROUP BY eps_at.eps, a) border
    ON border.eps = eps_at.eps AND border.id = v.id)"""


@query("""SELECT id AS row_id, core, CAST(CASE WHEN label IS NULL THEN -1 ELSE (
  SELECT count(DISTINCT l.label) FROM lab l WHERE l.core AND l.label < lab.label) END AS INT) AS cluster FROM lab""", _dbscan_sql([0.5]))
def dbscan(spark, sf_dir):
    return C.dbscan(z_scores(spark, sf_dir), NAMES, 0.5)


@query("""SELECT eps, count(DISTINCT label) FILTER (core) AS clusters, round(count(*) FILTER (label IS NULL) / CAST(count(*) AS DOUBLE), 6) AS noise_share
  FROM lab GROUP BY eps""", _sampled(_dbscan_sql(C.EPS_SWEEP), C.DBSCAN_SAMPLE))
def dbscan_sweep(spark, sf_dir):
    return rounded(C.dbscan_sweep(z_scores(spark, sf_dir), NAMES, n=C.DBSCAN_SAMPLE))


# ---- fitted: the SQL draws the same starts and walks to the same centres, k and restart by k and restart

_N = tuple(f"x.{n}" for n in NAMES)


def _far(a, b):
    return "round(" + " + ".join(f"pow({a}.{n} - {b}.{n}, 2)" for n in NAMES) + ", 9)"


def _kmeans(p, z, ks, restarts=10):
    """CTEs {p}fit (k, c, the winning centres), {p}row (k, row_id, c) and {p}all (k, inertia) over the z-scores ``z``."""
    race = f"-ln((('0x' || substr(md5('{SEED}|' || r || '|' || s || '|' || row_id), 1, 13))::BIGINT + 0.5::DOUBLE) / pow(16::DOUBLE, 13)) / d"
    own = ", ".join(NAMES)
    moved = ", ".join(f"coalesce(n.{n}, m.{n}) AS {n}" for n in NAMES)
    way = " + ".join(f"pow(coalesce(n.{n}, m.{n}) - m.{n}, 2)" for n in NAMES)
    means = ", ".join(f"avg(x.{n}) AS {n}" for n in NAMES)
    return f"""{p}x AS MATERIALIZED (SELECT row_id, {own} FROM {z}),
{p}st(s, r, row_id, d) AS (
  SELECT CAST(0 AS BIGINT), r, row_id, CAST(1 AS DOUBLE) FROM {p}x CROSS JOIN range({restarts}) t(r)
  UNION ALL SELECT o.s + 1, o.r, o.row_id, CASE o.s WHEN 0 THEN {_far('x', 'y')} ELSE least(o.d, {_far('x', 'y')}) END
  FROM {p}st o JOIN (SELECT s, r, min({{'t': {race}, 'id': row_id}}).id AS pick FROM {p}st WHERE d > 0 GROUP BY s, r) q ON q.s = o.s AND q.r = o.r
  JOIN {p}x x ON x.row_id = o.row_id JOIN {p}x y ON y.row_id = q.pick WHERE o.s < {max(ks) - 1}),
{p}pick AS MATERIALIZED (SELECT s, r, min({{'t': {race}, 'id': row_id}}).id AS row_id FROM {p}st WHERE d > 0 GROUP BY s, r),
{p}km(k, r, c, i, go, {own}) AS (
  SELECT k, r, s, 0, true, {own} FROM {p}pick JOIN {p}x USING (row_id) JOIN (VALUES {', '.join(f'({k})' for k in ks)}) t(k) ON s < k
  UNION ALL SELECT m.k, m.r, m.c, m.i + 1, sum({way}) OVER (PARTITION BY m.k, m.r) > 0.0001::DOUBLE AND m.i + 1 < 300, {moved}
  FROM {p}km m LEFT JOIN (SELECT k, r, c, {means} FROM (
      SELECT f.k, f.r, x.row_id, min({{'d': {_far('x', 'f')}, 'c': f.c}}).c AS c FROM {p}km f CROSS JOIN {p}x x WHERE f.go GROUP BY f.k, f.r, x.row_id) a
    JOIN {p}x x USING (row_id) GROUP BY k, r, c) n ON n.k = m.k AND n.r = m.r AND n.c = m.c WHERE m.go),
{p}end AS MATERIALIZED (SELECT * FROM {p}km WHERE NOT go),
{p}near AS MATERIALIZED (SELECT k, r, row_id, min({{'d': {_far('x', 'f')}, 'c': f.c}}) AS best FROM {p}end f CROSS JOIN {p}x x GROUP BY k, r, row_id),
{p}all AS (SELECT k, min({{'i': round(inertia, 4), 'r': r}}).r AS r, min({{'i': round(inertia, 4), 'r': r}}).i AS inertia
  FROM (SELECT k, r, sum(best.d) AS inertia FROM {p}near GROUP BY k, r) GROUP BY k),
{p}row AS MATERIALIZED (SELECT k, row_id, best.c AS c FROM {p}near JOIN {p}all USING (k, r)),
{p}fit AS MATERIALIZED (SELECT e.* FROM {p}end e JOIN {p}all USING (k, r))"""


def _candidates(p):
    """CTE {p}metrics: k, inertia, silhouette by squared distances, min_share."""
    dot = " + ".join(f"x.{n} * g.{n}" for n in NAMES)
    norm = " + ".join(f"pow(x.{n}, 2)" for n in NAMES)
    means = ", ".join(f"avg(x.{n}) AS {n}" for n in NAMES)
    return f"""{p}of AS MATERIALIZED (SELECT k, c, count(*) AS n, avg({norm}) AS q, {means} FROM {p}row JOIN {p}x x USING (row_id) GROUP BY k, c),
{p}ab AS (SELECT o.k, o.row_id, max(CASE WHEN g.c = o.c THEN greatest({norm} - 2 * ({dot}) + g.q, 0) * g.n / greatest(g.n - 1, 1) END) AS a,
    min(CASE WHEN g.c <> o.c THEN greatest({norm} - 2 * ({dot}) + g.q, 0) END) AS b, max(CASE WHEN g.c = o.c THEN g.n END) AS n
  FROM {p}row o JOIN {p}x x USING (row_id) JOIN {p}of g ON g.k = o.k GROUP BY o.k, o.row_id),
{p}metrics AS (SELECT CAST(k AS INT) AS k, inertia, silhouette, min_share FROM {p}all
  JOIN (SELECT k, avg(CASE WHEN n > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette FROM {p}ab GROUP BY k) USING (k)
  JOIN (SELECT k, CASE WHEN count(*) < k THEN 0 ELSE min(n) END / CAST(sum(n) AS DOUBLE) AS min_share FROM {p}of GROUP BY k) USING (k)),
{p}usable AS (SELECT * FROM {p}metrics WHERE min_share >= 0.01 OR (SELECT max(min_share) FROM {p}metrics) < 0.01),
{p}best AS (SELECT min(k) AS k FROM {p}usable WHERE silhouette >= (SELECT max(silhouette) FROM {p}usable) - CAST(0.02 AS DOUBLE))"""


_FIT4 = (_ASSIGNED, _kmeans("f", "z", [4]))


@query("SELECT CAST(cluster AS INT) AS cluster, feature, round(z, 5) + 0 AS z FROM (" + " UNION ALL ".join(
    f"SELECT c AS cluster, '{n}' AS feature, {n} AS z FROM ffit" for n in NAMES) + ")", *_FIT4)
def kmeans_fit(spark, sf_dir):
    """Centres of the best of the operator's restarts."""
    model = C.kmeans_fit(z_scores(spark, sf_dir), NAMES, 4)
    rows = [(c, n, float(v)) for c, centre in enumerate(model.centres) for n, v in zip(NAMES, centre)]
    found = spark.createDataFrame(rows, "cluster int, feature string, z double")
    return found.select("cluster", "feature", (F.round("z", 5) + 0).alias("z"))


@query("SELECT k, round(inertia, 3) AS inertia, round(silhouette, 6) AS silhouette, round(min_share, 6) AS min_share FROM fmetrics",
       _ASSIGNED, _kmeans("f", "z", C.K_RANGE), _candidates("f"))
def choose_k(spark, sf_dir):
    found = C.choose_k(z_scores(spark, sf_dir), NAMES)
    return found.select("k", F.round("inertia", 3).alias("inertia"), F.round("silhouette", 6).alias("silhouette"), F.round("min_share", 6).alias("min_share"))


@query("SELECT row_id, CAST(c AS INT) AS cluster FROM frow", *_FIT4)
def cluster_bundle(spark, sf_dir):
    """A clustering saved, loaded and applied to the raw features of all malicious rows."""
    rows, path = malicious(spark, sf_dir), scratch_path(spark, "clusters")
    found = P.cluster_class(rows, NAMES, [4])
    bundles.save_clustering(found.bundle(), path)
    return bundles.load_clustering(path).assign(rows).select("row_id", "cluster")


_TWICE = (_ASSIGNED, _kmeans("f", "z", C.K_RANGE), _candidates("f"),
          """fsize AS (SELECT c AS cluster, count(*) AS n, sum(count(*)) OVER () AS every FROM frow WHERE k = (SELECT k FROM fbest) GROUP BY c)""",
          "inside AS MATERIALIZED (SELECT m.* FROM mal m JOIN frow f ON f.row_id = m.row_id AND f.k = (SELECT k FROM fbest) AND f.c = (SELECT cluster FROM fsize WHERE n >= 0.6 * every))",
          f"imom AS (SELECT {', '.join(f'avg({n}) AS m_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}' for n in NAMES)} FROM inside)",
          f"z2 AS (SELECT row_id, {', '.join(f'({n} - m_{n}) / s_{n} AS {n}' for n in NAMES)} FROM inside CROSS JOIN imom)",
          _kmeans("g", "z2", C.K_RANGE), _candidates("g"),
          "gsize AS (SELECT c AS cluster, count(*) AS n, sum(count(*)) OVER () AS every FROM grow WHERE k = (SELECT k FROM gbest) GROUP BY c)")


@query("""SELECT level, CAST(cluster AS INT) AS cluster, n, round(n / CAST(every AS DOUBLE), 6) AS share FROM (
  SELECT 'first' AS level, * FROM fsize UNION ALL SELECT 'second', * FROM gsize)""", *_TWICE)
def second_pass(spark, sf_dir):
    """Sizes of the clusters of both passes; of the first alone where no cluster holds 0.6 of the rows."""
    rows = malicious(spark, sf_dir)
    first = P.cluster_class(rows, FEATURE_NAMES)
    sizes = A.cluster_sizes(first.assigned).withColumn("level", F.lit("first"))
    second = P.second_pass(rows, first, FEATURE_NAMES)
    if second is not None:
        sizes = sizes.unionByName(A.cluster_sizes(second.assigned).withColumn("level", F.lit("second")))
    return rounded(sizes)


def _both_passes(spark, sf_dir, table):
    rows = malicious(spark, sf_dir)
    first = P.cluster_class(rows, FEATURE_NAMES)
    found = P.pass_report(rows, first, "first")[table]
    second = P.second_pass(rows, first, FEATURE_NAMES)
    return found if second is None else found.unionByName(P.pass_report(rows, second, "second")[table])


def _levels(select):
    """The same over the rows of both passes: {row} their clusters, {best} the chosen k, {x} the z-scores."""
    return " UNION ALL ".join(select.format(level=level, row=f"{p}row", best=f"{p}best", x=f"{p}x") for level, p in (("first", "f"), ("second", "g")))


@query("SELECT level, CAST(cluster AS INT) AS cluster, feature, round(z, 5) + 0 AS z FROM (" + " UNION ALL ".join(_levels(
    "SELECT '{level}' AS level, c AS cluster, '" + n + "' AS feature, avg(" + n + ") AS z FROM {row} JOIN {x} USING (row_id) WHERE k = (SELECT k FROM {best}) GROUP BY c") for n in NAMES)
    + ") q JOIN (" + " UNION ALL ".join(f"SELECT 'first' AS level, '{n}' AS feature, count(DISTINCT {n}) AS values FROM mal UNION ALL SELECT 'second', '{n}', count(DISTINCT {n}) FROM inside"
                                        for n in NAMES) + ") USING (level, feature) WHERE values > 1", *_TWICE)
def second_pass_profiles(spark, sf_dir):
    """Centres of both passes over the columns that vary in each."""
    found = _both_passes(spark, sf_dir, "profiles")
    return found.select("level", "cluster", "feature", (F.round("z", 5) + 0).alias("z"))


@query("""SELECT level, CAST(cluster AS INT) AS cluster, type, coalesce(n, 0) AS n, round(coalesce(n, 0) / CAST(size AS DOUBLE), 6) AS share, round(of_type / CAST(every AS DOUBLE), 6) AS overall_share FROM (
  SELECT level, cluster, sum(n) AS size FROM typed GROUP BY ALL) JOIN (SELECT level, type, sum(n) AS of_type, sum(sum(n)) OVER (PARTITION BY level) AS every FROM typed GROUP BY level, type) USING (level)
  LEFT JOIN typed USING (level, cluster, type)""", *_TWICE,
       "typed AS (" + _levels("SELECT '{level}' AS level, c AS cluster, type, count(*) AS n FROM {row} JOIN mal USING (row_id) WHERE k = (SELECT k FROM {best}) GROUP BY c, type") + ")")
def second_pass_composition(spark, sf_dir):
    """Label mix of the clusters of both passes."""
    return rounded(_both_passes(spark, sf_dir, "composition"))


@query("""SELECT level, CAST(cluster AS INT) AS cluster, n, round(n / CAST(every AS DOUBLE), 6) AS share, n >= 0.6 * every AS second_pass FROM (
  SELECT level, cluster, n, every, row_number() OVER (PARTITION BY level ORDER BY n DESC, cluster) AS place FROM (
    SELECT 'first' AS level, * FROM fsize UNION ALL SELECT 'second', * FROM gsize)) WHERE place = 1""", *_TWICE)
def second_pass_dominance(spark, sf_dir):
    found = _both_passes(spark, sf_dir, "dominance")
    return rounded(found.select("level", "cluster", "n", "share", "second_pass"))


def _axes_sql():
    """CTE axes: loadings a_* and b_* of the first two axes after 600 rounds of simultaneous power iteration."""
    cols = lambda v: ", ".join(f"{v}_{n}" for n in NAMES)
    dot = lambda u, v: " + ".join(f"{u}_{n} * {v}_{n}" for n in NAMES)
    score = lambda v: " + ".join(f"x.{n} * p.{v}_{n}" for n in NAMES)
    start = ", ".join([*[f"1::DOUBLE + {i} / 100::DOUBLE AS a_{n}" for i, n in enumerate(NAMES)], *[f"{(-1) ** i}::DOUBLE + {i} / 50::DOUBLE AS b_{n}" for i, n in enumerate(NAMES)]])
    sums = ", ".join(f"sum(x.{n} * sa) AS a_{n}, sum(x.{n} * sb) AS b_{n}" for n in NAMES)
    unit = ", ".join(f"a_{n} / la AS a_{n}" for n in NAMES)
    free = ", ".join(f"b_{n} - ab * a_{n} AS b_{n}" for n in NAMES)
    unit_b = ", ".join(f"b_{n} / sqrt({dot('b', 'b')}) AS b_{n}" for n in NAMES)
    sign = lambda v: f"SELECT sign(arg_max(v, abs(v))) AS s FROM (SELECT unnest([{cols(v)}]) AS v FROM pw WHERE i = 600)"
    fixed = ", ".join(f"a_{n} * (SELECT s FROM sign_a) AS a_{n}, b_{n} * (SELECT s FROM sign_b) AS b_{n}" for n in NAMES)
    return f"""pw(i, la, {cols('a')}, {cols('b')}) AS (SELECT 0, 1::DOUBLE, {start}
  UNION ALL SELECT i, la, {cols('a')}, {unit_b} FROM (SELECT i, la, {cols('a')}, {free} FROM (
    SELECT *, {dot('a', 'b')} AS ab FROM (SELECT i, la, {unit}, {cols('b')} FROM (
      SELECT *, sqrt({dot('a', 'a')}) AS la FROM (SELECT i + 1 AS i, {sums} FROM (
        SELECT x.*, p.i, {score('a')} AS sa, {score('b')} AS sb FROM pw p CROSS JOIN zm x WHERE p.i < 600) x GROUP BY i)))))),
sign_a AS ({sign('a')}), sign_b AS ({sign('b')}),
axes AS MATERIALIZED (SELECT {fixed} FROM pw WHERE i = 600)"""


_PCA = (_ASSIGNED, "zm AS MATERIALIZED (SELECT * FROM z)", _axes_sql())


@query("SELECT row_id, " + ", ".join(f"round({' + '.join(f'{n} * {v}_{n}' for n in NAMES)}, 4) + 0 AS {pc}" for v, pc in (("a", "pc1"), ("b", "pc2"))) + " FROM zm CROSS JOIN axes", *_PCA)
def pca_project(spark, sf_dir):
    coords, _ = C.pca_project(z_scores(spark, sf_dir), NAMES)
    return coords.select("row_id", (F.round("pc1", 4) + 0).alias("pc1"), (F.round("pc2", 4) + 0).alias("pc2"))


@query("SELECT component, round(v / (SELECT " + " + ".join(f"sum(pow({n}, 2))" for n in NAMES) + " FROM zm), 6) AS variance_share FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS component, sum(pow({' + '.join(f'{n} * {v}_{n}' for n in NAMES)}, 2)) AS v FROM zm CROSS JOIN axes" for i, v in ((1, "a"), (2, "b"))) + ")", *_PCA)
def pca_variance(spark, sf_dir):
    _, shares = C.pca_project(z_scores(spark, sf_dir), NAMES)
    return rounded(shares)
