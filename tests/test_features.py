import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from urlsieve.functions import text as T
from urlsieve.functions.features import FEATURE_NAMES
from urlsieve.operators.joins import MAX_HEAVY, spread_lookup
from urlsieve.operators.reference import brand_proximity, load_reference
from urlsieve.plans.feature_table import build_feature_table, url_feature_table

URLS = ["https://www.paypal.com/signin", "http://paypa1-secure.verify-account.tk/login",
        "http://192.168.1.1/verify/account", "bit.ly/3xR2p", "https://xn--pypal-4ve.com/login",
        "www.example.com/a/b/c?id=12345"]

GOLDEN = """
is_malformed 0 0 0 0 0 0
url_length 29 44 33 12 31 30
hostname_length 14 31 11 6 17 15
path_length 7 6 15 6 6 6
query_length 0 0 0 0 0 8
nb_subdomains 1 1 2 0 0 1
avg_subdomain_length 3.000000 13.000000 3.000000 0.000000 0.000000 3.000000
nb_dots 2 2 3 1 1 2
path_depth 1 1 2 1 1 3
ratio_digits_url 0.000000 0.022727 0.242424 0.166667 0.032258 0.166667
ratio_digits_host 0.000000 0.032258 0.727273 0.000000 0.058824 0.000000
nb_hyphens 0 2 0 0 3 0
nb_at 0 0 0 0 0 0
nb_percent 0 0 0 0 0 0
nb_underscore 0 0 0 0 0 0
nb_double_slash 0 0 0 0 0 0
char_repeat 3 2 2 1 2 3
nb_www 0 0 0 0 0 0
nb_com 0 0 0 0 0 0
has_ip_host 0 0 1 0 0 0
is_https 1 0 0 0 1 0
https_token_in_host 0 0 0 0 0 0
has_port 0 0 0 0 0 0
has_punycode 0 0 0 0 1 0
tld_length 3 2 1 2 3 3
suspicious_tld 0 1 0 0 0 0
tld_in_subdomain 0 0 0 0 0 0
tld_in_path 0 0 0 0 0 0
phish_hints 1 4 2 0 1 0
brand_in_subdomain 0 0 0 0 0 0
brand_in_path 0 0 0 0 0 0
min_brand_edit_distance 0 1 99 99 1 3
brand_lookalike 0 1 0 0 1 0
brand_is_registered_domain 1 0 0 0 0 0
is_shortening_service 0 0 0 1 0 0
in_top_sites 0 0 0 0 0 0
domain_rank_score 0 0 0 0 0 0
tld_popularity 0 0 0 0 0 0
entropy_url 3.952303 4.373649 4.210765 3.584963 4.235981 4.256565
entropy_domain 2.921928 3.852169 0.918296 2.584963 3.690117 3.095795
vowel_ratio 0.333333 0.312500 0.000000 0.200000 0.187500 0.400000
char_continuation_rate 0.714286 0.697674 0.625000 0.363636 0.633333 0.517241
"""


def test_golden_features(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "i int, url string")
    rows = {r["i"]: r for r in url_feature_table(df).collect()}
    lines = [l.split() for l in GOLDEN.strip().splitlines()]
    assert [l[0] for l in lines] == FEATURE_NAMES
    for name, *values in lines:
        for i, v in enumerate(values):
            assert round(float(rows[i][name]), 6) == float(v), (name, URLS[i])


def test_extraction_without_a_list_is_narrow(spark):
    df = spark.range(3).selectExpr("concat('http://h', id, '.com/x') AS url")
    plan = url_feature_table(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_extraction_works_on_a_stream(spark, tmp_path):
    spark.range(5).selectExpr("id AS row_id", "concat('http://paypa1.com/', id) AS url").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("row_id long, url string").parquet(str(tmp_path / "in"))
    q = (url_feature_table(stream).writeStream.format("memory").queryName("feature_stream")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.table("feature_stream").where("brand_lookalike = 1").count() == 5


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="aab1-/.é", max_size=30), min_size=1, max_size=20))
def test_text_measures_against_plain_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    t = F.col("t")
    got = df.select("i", "t", T.shannon_entropy(t).alias("e"), T.longest_run(t).alias("r"),
                    T.same_class_rate(t).alias("c")).collect()
    for r in got:
        s, n = r.t, len(r.t)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0
        assert r.e == pytest.approx(entropy, abs=1e-9)
        runs, run = 0, 0
        for i, ch in enumerate(s):
            run = run + 1 if i and s[i - 1] == ch else 1
            runs = max(runs, run)
        assert r.r == runs
        kinds = ["a" if ch.isalpha() else "d" if ch.isdigit() else "s" for ch in s]
        same = sum(a == b for a, b in zip(kinds, kinds[1:]))
        assert r.c == pytest.approx(same / (n - 1) if n > 1 else 0.0)


LINES = [(1, "google.com"), (2, "paypal.com"), (3, "bbc.co.uk"), (4, "facebook.com"), (5, "google.de"),
         (9, "paypal.com"), (7, "nodot"), (8, "netflix.com")]


def reference(spark):
    rows = [(i, r, d) for i, (r, d) in enumerate(LINES)]
    return load_reference(spark.createDataFrame(rows, "line int, rank bigint, domain string"))


def test_reference_tables(spark):
    ref = reference(spark)
    assert ref.n_domains == 7 and ref.ranks_small and ref.tlds_small
    assert {r.domain: r["rank"] for r in ref.ranks.collect()}["paypal.com"] == 9
    assert [r.brand for r in ref.brands.orderBy("ord").collect()] == ["google", "paypal", "facebook", "netflix"]
    assert {r.tld: r.share for r in ref.tlds.collect()} == pytest.approx({"com": 5 / 7, "uk": 1 / 7, "de": 1 / 7})


def test_empty_reference_is_an_error(spark):
    with pytest.raises(ValueError):
        load_reference(spark.createDataFrame([], "line int, rank bigint, domain string"))


def test_brand_proximity_equals_brute_force(spark):
    words = ["google", "gogle", "g00gle", "googles", "gooooogle", "paypa1", "netflx", "facebok", "fcbk", "zzzzzz", "pal",
             "paypallll", "nettflixx", "my-paypal", "x-g0ogl3-y"]
    hosts = [f"{w}.example{i % 3}.com" for i, w in enumerate(words)] + ["", "a.b"]
    df = spark.createDataFrame([(h, h) for h in hosts], "url string, host string")
    got = {r.host: r._brand_distance for r in brand_proximity(df, reference(spark), host="host").collect()}

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    brands = ["google", "paypal", "facebook", "netflix"]
    for h in hosts:
        tokens = [t for label in h.split(".") for t in label.split("-") if len(t) >= 5]
        near = [d for t in tokens for d in (lev(t, b) for b in brands) if d <= 2]
        assert got[h] == (min(near) if near else 99), h


def test_spread_lookup_with_a_hot_key(spark):
    """A third of the rows share one key, and the list knows it: same answer as a plain left join."""
    left = spark.range(6000).selectExpr("id AS row_id", "IF(id % 3 = 0, 'hot', concat('k', id % 2500)) AS k",
                                        "concat('u', id) AS url")
    left = left.unionByName(spark.sql("SELECT 9999L AS row_id, CAST(NULL AS STRING) AS k, 'n' AS url"))
    right = spark.range(1500).selectExpr("concat('k', id) AS k", "id AS v").unionByName(
        spark.sql("SELECT 'hot' AS k, -1L AS v"))
    got = spread_lookup(left, right, "k", "url")
    want = left.join(right, "k", "left").select("row_id", "k", "url", "v")
    assert got.count() == 6001
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert MAX_HEAVY == 1024


def test_large_lists_take_the_shuffle_path(spark):
    from dataclasses import replace
    ref = reference(spark)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(
        ["http://www.google.com/x", "http://paypal.com", "http://none.xyz", "http://bbc.co.uk"])], "row_id long, url string")
    small = url_feature_table(df, ref).orderBy("row_id").collect()
    large = url_feature_table(df, replace(ref, ranks_small=False, tlds_small=False)).orderBy("row_id").collect()
    assert small == large
    assert [r.in_top_sites for r in small] == [1, 1, 0, 0]
    assert small[1].domain_rank_score == pytest.approx(math.log10(7 / 9))


def test_many_near_hosts_take_the_shuffle_path(spark, monkeypatch):
    from dataclasses import replace

    from urlsieve.operators import reference as R
    from urlsieve.plans import feature_table as P
    ref = reference(spark)
    df = spark.range(900).selectExpr(
        "id AS row_id", "concat(IF(id % 3 = 0, 'http://g00gle.com/', concat('http://h', id, '.paypa1.org/')), id) AS url")
    small = url_feature_table(df, ref)
    monkeypatch.setattr(P, "near_hosts", lambda *a: replace(R.near_hosts(*a), small=False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = url_feature_table(df, ref)
    assert "Exchange hashpartitioning(_light_key" in large._jdf.queryExecution().executedPlan().toString()
    assert small.exceptAll(large).count() == 0 and large.count() == 900
    assert {r.min_brand_edit_distance for r in large.collect()} == {1, 2}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_row_of_an_address_survives(spark):
    rows = [(5, "http://a.com", "benign"), (2, "http://a.com", "phishing"), (9, "http://b.com", "malware")]
    df = spark.createDataFrame(rows, "row_id long, url string, type string")
    got = {r.url: (r.row_id, r.type, r.label) for r in build_feature_table(df).collect()}
    assert got == {"http://a.com": (2, "phishing", 1), "http://b.com": (9, "malware", 1)}


def test_corpus_of_one_file_is_spread(spark, sf_dir):
    """The pages' one row group is one task's; the addresses made of it are not."""
    from checks.corpus import url_corpus
    made = url_corpus(spark, sf_dir).groupBy(F.spark_partition_id()).count().collect()
    assert len(made) > 8 and sum(r["count"] for r in made) == 1250


def test_runs_and_entropy_of_odd_texts(spark):
    """Single characters need no entry in the list of runs."""
    rows = [None, "", "a", "ab", "aab", "abba", "🙂🙂🙂x", "a\n\n"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select("i", T.longest_run(F.col("t")), T.shannon_entropy(F.col("t"))).collect()
    assert [r[1] for r in sorted(got)] == [0, 0, 1, 1, 2, 2, 3, 2]
    assert [round(r[2], 6) for r in sorted(got)] == [0, 0, 0, 1, 0.918296, 1, 0.811278, 0.918296]
