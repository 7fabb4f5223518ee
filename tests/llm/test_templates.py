import random
import re
from collections import defaultdict

import pytest
from checks.compare import compare, duck
from urlsieve.llm import queries, templates

NAME = "op12_url_filters"
LOWER = str.maketrans(templates.UPPER, templates.UPPER.lower())


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def ruled(host, path, rules):
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def shape(path):
    return "/".join(re.sub("[0-9]+", "{n}", re.sub("[0-9a-fA-F-]{16,}", "{x}", s)) for s in path.split("/") if s)


def close(a, b, c, d):
    a, b, c, d = map(float, (a, b, c, d))
    return (a + b + c + d) * (a * d - b * c) ** 2 <= 3.841 * (a + b) * (c + d) * (a + c) * (b + d)


def brute(pages, rules, labels=None):
    """The tree by recursion, one host at a time."""
    rows = []
    for i, (page, url) in enumerate(pages):
        host, path = parse(url)
        rule, verdict = ruled(host, path, rules)
        rows.append(dict(page=page, host=host, path=path, rule=rule, verdict=verdict, label=labels[i] if labels else verdict, parts=[s for s in shape(path).split("/") if s]))

    def split(group, node, d):
        if len(group) < 8:
            for r in group:
                r["template"] = node + "/**"
            return
        kids = defaultdict(list)
        for r in group:
            kids[r["parts"][d] if d < len(r["parts"]) else ""].append(r)
        for r in kids.pop("", []):
            r["template"] = node or "/"
        branches = defaultdict(list)
        for k, rs in kids.items():
            branches[k if len(rs) >= 8 and len(rs) * 20 >= len(group) else "*"] += rs
        facts = []
        for b, rs in branches.items():
            bad, good = (sum(r["label"] == v for r in rs) for v in ("block", "allow"))
            facts.append((bad + good > 0, (bad + 2) / (bad + good + 4), b, bad, good, sum(len(r["parts"]) == d + 1 for r in rs), len(rs)))
        classes = []
        for f in sorted(facts):
            last = classes[-1][-1] if classes else None
            if last and last[0] == f[0] and close(f[3], last[3], f[4], last[4]) and close(f[5], last[5], f[6] - f[5], last[6] - last[5]):
                classes[-1].append(f)
            else:
                classes.append([f])
        for c in classes:
            names = sorted(f[2] for f in c)
            split([r for n in names for r in branches[n]], f"{node}/{names[0] if len(names) == 1 else '{' + ','.join(names) + '}'}", d + 1)

    hosts = defaultdict(list)
    for r in rows:
        hosts[r["host"]].append(r)
    for group in hosts.values():
        split(group, "", 0)
    sums = defaultdict(lambda: [0, 0])
    for r in rows:
        if r["label"]:
            sums[r["host"], r["template"]][r["label"] == "block"] += 1
    for r in rows:
        good, bad = sums[r["host"], r["template"]]
        r["verdict"] = r["verdict"] or ("block" if good + bad and (bad + 2) / (good + bad + 4) >= 0.8 else "allow")
    return sorted(((r["page"], r["host"], r["path"], r["rule"], r["template"], r["verdict"]) for r in rows), key=str)


def got(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.template, r.verdict) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    result = compare(spark, duck(d), NAME, queries.QUERIES[NAME], queries.SQL[NAME], d)
    assert result.startswith("ok"), result


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url").collect()
    assert got(queries.QUERIES[NAME](spark, d)) == brute([tuple(r) for r in pages], queries.RULES)


def test_random_trees_equal_brute_force(spark):
    rng = random.Random(9)
    words = ["en", "de", "shop", "win", "news", "*", "a{n}"]
    urls = []
    for _ in range(2500):
        host = rng.choice(["a.net", "b.net", "A.NET", "c.org", f"h{rng.randrange(60)}.net", "www.example.com", "x.example.com"])
        path = "".join("/" + (rng.choice(words) if rng.random() < 0.6 else rng.choice(["", str(rng.randrange(99)), f"slug-{rng.randrange(500)}", "%032x" % rng.randrange(1 << 120)])) for _ in range(rng.randrange(7)))
        urls.append(rng.choice(["http", "https", "://"]) + "://" + host + path + rng.choice(["", "/", "?q=/x", "#f", "?a#b"]))
    pages = list(enumerate(urls)) + [(None, None), (None, None), (1, "no scheme"), (2, ""), (3, "x://"), (4, "http://com/"), (5, "http://com"), (6, "http://a.com?/x")]
    pages += [(7, "http://deep.net" + "/d" * 9)] * 20 + [(8, "http://long.net/" + "z" * 200_000 + "/es/")] * 9
    labels = [None if rng.random() < 0.5 else "block" if "/win" in (u or "") or rng.random() < 0.1 else "allow" for _, u in pages]
    df = spark.createDataFrame([(p, u, v, "x", 1) for (p, u), v in zip(pages, labels)], "page_id long, url string, mark string, host string, n int").repartition(4)
    assert got(templates.judge_urls(df, queries.RULES)) == brute(pages, queries.RULES)
    want = brute(pages, [], labels)
    assert got(templates.judge_urls(df, [], "mark")) == want
    assert {r[5] for r in want} == {"allow", "block"}
    assert templates.judge_urls(df.limit(0), queries.RULES).count() == 0


def test_held_out_labels(spark):
    """Templates labelled on a third of their pages judge the others; a sound branch beside a spam branch stays."""
    rows = []
    for k in range(30):
        for i in range(60):
            rows += [(f"http://site{k}.org/{part}/item-{i * 7}.html", part in ("win", "pills")) for part in ("win", "pills", "news")]
    rng = random.Random(1)
    df = spark.createDataFrame([(i, u, ("block" if bad else "allow") if rng.random() < 0.33 else None, bad) for i, (u, bad) in enumerate(rows)],
                               "page_id long, url string, mark string, bad boolean")
    judged = templates.judge_urls(df, [], "mark").join(df.select("page_id", "bad", "mark"), "page_id").filter("mark is null").collect()
    assert len(judged) > 3000
    assert sum((r.verdict == "block") == r.bad for r in judged) / len(judged) > 0.98
