"""Parser edge cases: expected parts are those of Python's urllib.parse after strip and default scheme."""

from urlsieve.functions.parts import parse_urls

CASES = [
    ("http://user:pw@Evil_Host.com:8080/a;p=1/b;q=2?x=1", "http", "evil_host.com", "/a;p=1/b", "x=1", 8080, 0),
    ("http://a.com:abc/x", "http", "a.com", "/x", "", None, 0),
    ("http://a.com:99999/x", "http", "a.com", "/x", "", None, 0),
    ("http://[::1]:8080/x", "http", "::1", "/x", "", 8080, 0),
    ("http://[bad/x", "", "", "", "", None, 1),
    ("HTTPS://A.COM", "https", "a.com", "", "", None, 0),
    ("a.com:8080/x", "http", "a.com", "/x", "", 8080, 0),
    ("", "http", "", "", "", None, 0),
    ("http://a.com?x=/y", "http", "a.com", "", "x=/y", None, 0),
    ("http://ex.com./z", "http", "ex.com.", "/z", "", None, 0),
    ("http://m\xfcnchen.de/\xe4", "http", "m\xfcnchen.de", "/\xe4", "", None, 0),
    ("ftp://h/p;x", "ftp", "h", "/p", "", None, 0),
    ("foo://h/p;x", "foo", "h", "/p;x", "", None, 0),
    ("http://a..b/c", "http", "a..b", "/c", "", None, 0),
    ("http://x/%zz 1|2", "http", "x", "/%zz 1|2", "", None, 0),
    ("http://a.com/x\ty", "http", "a.com", "/xy", "", None, 0),
    ("mailto:x@y.com", "http", "y.com", "", "", None, 0),
    ("http://a@b@c.com/", "http", "c.com", "/", "", None, 0),
    (" \xa0http://paypal.com.login.evil.xyz//a//b.com/apple ", "http", "paypal.com.login.evil.xyz",
     "//a//b.com/apple", "", None, 0),
    ("http://[fe80::1]/p", "http", "fe80::1", "/p", "", None, 0),
    ("http://[1.2.3.4]/p", "", "", "", "", None, 1),
    ("http://[zz::1]/p", "", "", "", "", None, 1),
    ("http://[v1.a]/p", "http", "v1.a", "/p", "", None, 0),
    ("http://a\uff0fb.com/x", "", "", "", "", None, 1),
    ("http://256.1.1.1/", "http", "256.1.1.1", "/", "", None, 0),
    ("http://01.2.3.4/", "http", "01.2.3.4", "/", "", None, 0),
    ("http://x]y/", "", "", "", "", None, 1),
    ("www-paypal.com.com/www", "http", "www-paypal.com.com", "/www", "", None, 0),
    ("///x", "http", "", "///x", "", None, 0),
    ("http://", "http", "", "", "", None, 0),
    ("a", "http", "a", "", "", None, 0),
    ("http://sub.bit.ly/x", "http", "sub.bit.ly", "/x", "", None, 0),
    ("HTTP://WWW.Google.COM:443/COM", "http", "www.google.com", "/COM", "", 443, 0),
    ("http://[::ffff:1.2.3.4]/a", "http", "::ffff:1.2.3.4", "/a", "", None, 0),
    ("http://[1:2:3:4:5:6:7:8]/", "http", "1:2:3:4:5:6:7:8", "/", "", None, 0),
    ("http://\xe9.com:\u0663/", "http", "\xe9.com", "/", "", None, 0),
    ("x://y://z//w", "x", "y", "//z//w", "", None, 0),
    (None, "http", "", "", "", None, 0),
]


def test_parser_edge_cases(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, url string")
    got = {r["i"]: r["parts"] for r in parse_urls(df).collect()}
    for i, (url, *want) in enumerate(CASES):
        p = got[i]
        assert [p.scheme, p.host, p.path, p.query, p.port, p.malformed] == want, url


def test_parsing_is_narrow(spark):
    df = spark.range(10).selectExpr("concat('http://h', id, '.com/x') AS url")
    plan = parse_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_ip_literals_agree_with_the_standard_library(spark):
    import ipaddress

    from pyspark.sql import functions as F

    from urlsieve.functions.parts import is_ip_literal
    texts = ["::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1:2:3", ":1", "1:",
             ":::", "1::2::3", "12345::", "::1.2.3.4", "::1.2.3.256", "1.2.3.4::", "fe80::1%eth0", "fe80::1%", "::%a%b",
             "1.2.3.4", "1.2.3", "1.2.3.4.5", "01.2.3.4", "0.0.0.0", "255.255.255.255", "256.0.0.1", "a", "", "1:2:3:4:5:6:1.2.3.4",
             "1:2:3:4:5:6:7:1.2.3.4", "::ffff:0:0", "g::1", "1:2:3:4::5:6:7:8"]

    def is_ip(t):
        try:
            ipaddress.ip_address(t)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", is_ip_literal(F.col("t")).alias("ip")).collect():
        assert r.ip == is_ip(r.t), r.t
