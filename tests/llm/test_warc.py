import hashlib

from urlsieve.llm import warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def test_round_trip_edges(spark):
    big, shared = "ü" * 70_000, "s" * 1000
    rows = [(1, "http://a/ü x", ""), (2, None, None), (3, "u", f"x{FAKE}y"), (4, "u", FAKE), (5, "u", "\r\n\r\nWARC/1.0\r\n"), (6, "u", big),
            (7, "u", shared), (8, "u\r\nWARC-Type: x", shared), (9, "u", shared), (9, "u", shared), (10, "u", "s" * 999), (11, "u", "s" * 999), (None, "u", "n")]
    pages = spark.createDataFrame([(*r, "k", "d") for r in rows], "page_id long, url string, html string, key string, digest string")
    got = warc.round_trip(pages.repartition(3)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for page, _, html in rows:
        raw = (html or "").encode()
        again = page in (7, 8)
        assert (by[page].payload_bytes, by[page].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest()), page
        assert (by[page].record_type, by[page].refers_to) == (("revisit", 9) if again else ("response", None))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_blocks_of_a_file_are_summed(spark, tmp_path):
    pages = spark.range(300).selectExpr("id as page_id", "cast(null as string) url", f"concat('p', id, repeat('WARC/1.0\r\n', cast(id % 7 as int)), repeat('z', 900)) html")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
        got = {r.page_id: r.payload_digest for r in warc.round_trip(pages.coalesce(1), compression="none").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {r.page_id: hashlib.sha1(r.html.encode()).hexdigest() for r in pages.collect()}
