"""WARC archives written and read with DataFrame operations.

Reading splits the files at the magic line, wherever it stands. Every piece is a candidate record; its header gives
the offset of its successor. Offsets come from lengths summed per file block and then over a file's blocks. Pointer
jumping from the start of each file keeps the records that the chain reaches, so a magic line inside a payload,
even one with a well-formed header after it, is not a record but part of the payload around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlsieve.llm.narrow import join_narrow
from urlsieve.session import scratch_path, stage_table

MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n\r\n"
FILE_RECORDS = 20_000


def plan_records(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = 1000) -> DataFrame:
    """(key, url, payload, digest, refers_to): of equal payloads of at least ``least`` bytes the largest key holds the payload.

    Null payloads count as empty. Only digests that repeat are looked up, one row each however many pages share
    one; beyond NARROW_ROWS of them the pages are shuffled and AQE splits a hot digest.
    """
    url = pages["url"] if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(pages[key].alias("key"), url.alias("url"), F.coalesce(pages[payload], F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    kept = (rows.filter(F.octet_length("payload") >= least).groupBy("digest")
            .agg(F.max("key").alias("first_key"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    other = F.col("first_key") != F.col("key")
    return (join_narrow(rows, kept, "digest", "left")
            .select("key", "url", "payload", "digest", F.when(other, F.col("first_key")).alias("refers_to")))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """One record per row into text files under ``path``; the writer's line end is the last byte of a record.

    Files hold at most FILE_RECORDS records. Compressed files are read whole by one task, others in blocks.
    """
    again = F.col("refers_to").isNotNull()
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    safe = F.url_encode("url")
    record = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", urn(F.col("key"))), _line("WARC-Refers-To", urn(F.col("refers_to"))),
        _line("WARC-Target-URI", safe), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body, F.lit("\r\n\r"))
    records.select(record.alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS).text(path, compression=compression)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, off, next, whole, value, ...): each piece after a magic line with its offset and its successor's."""
    raw = (spark.read.option("lineSep", MAGIC).text(path)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("seq"), "value"))
    pieces = stage_table(raw.withColumn("size", F.octet_length("value").cast("long") + len(MAGIC)), "warc-pieces")
    narrow = pieces.select("file", "block", "seq", "size")
    within = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    blocks = narrow.groupBy("file", "block").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = narrow.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(blocks, ["file", "block"])
    placed = placed.select("seq", (F.col("base") + F.col("inside") - len(MAGIC)).alias("off"))
    cut = F.instr("value", BREAK)
    head = F.when(cut > 0, F.substring(F.col("value"), F.lit(1), cut + 1))
    get = lambda name, form: F.nullif(F.regexp_extract(head, rf"(?md)^{name}: {form}\r$", 1), F.lit(""))
    parsed = pieces.select(
        "file", "block", "seq", "value", (F.octet_length(head) + 2).alias("skip"), get("WARC-Type", "(.*)").alias("record_type"),
        get("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("key"),
        get("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        get("WARC-Payload-Digest", "sha1:([0-9a-f]+)").alias("digest"),
        get("Content-Length", "([0-9]{1,18})").cast("long").alias("length"))
    body = F.substring(F.col("value").cast("binary"), F.col("skip") + 1, F.col("length").cast("int"))
    parsed = (parsed.withColumn("whole", F.octet_length("value") >= F.col("skip") + F.col("length") + 4)
              .withColumn("sha1", F.when(F.col("whole"), F.sha1(body))))
    split = stage_table(parsed.drop("value"), "warc-headers")
    return (split.join(placed, "seq").withColumn("next", F.col("off") + len(MAGIC) + F.col("skip") + F.col("length") + 4),
            pieces.select("seq", "value"))


def reachable(nodes: DataFrame) -> DataFrame:
    """Pointer jumping: the (file, off) that chains of (file, block, seq, off, next) reach from offset 0.

    Neighbours that link to each other are first joined into runs, inside a file block; a run starts anew wherever
    some other record's jump lands, so it is entered at its head only. Each round doubles the jumps between runs and
    the reached part, so rounds are the logarithm of the longest chain of runs; each round's tables are written to the
    shared folder.
    """
    order = Window.partitionBy("file", "block").orderBy("seq")
    sided = nodes.select("file", "block", "seq", "off", "next", F.lag("next").over(order).alias("from"), F.lead("off").over(order).alias("then"))
    far = (sided.filter("next is not null and not next <=> then").select("file", F.col("next").alias("off"), F.lit(True).alias("landed")).distinct())
    marked = sided.join(far, ["file", "off"], "left").withColumn("head", F.col("landed").isNotNull() | ~F.col("from").eqNullSafe(F.col("off")))
    runs = marked.select("file", "off", "next", F.last(F.when(F.col("head"), F.col("off")), ignorenulls=True).over(order).alias("run"),
                         F.coalesce(F.lead("head").over(order), F.lit(True)).alias("tail"))
    runs = stage_table(runs, "warc-runs")
    jump = runs.filter("tail and next is not null").select("file", F.col("run").alias("off"), F.col("next").alias("to"))
    reach = stage_table(runs.filter("off = 0").select("file", "off"), "warc-reach")
    had, have = -1, reach.count()
    while have != had:
        step = reach.join(jump, ["file", "off"]).select("file", F.col("to").alias("off"))
        reach = stage_table(reach.union(step).distinct(), "warc-reach")
        far = jump.select("file", F.col("off").alias("to"), F.col("to").alias("far"))
        jump = stage_table(jump.join(far, ["file", "to"]).select("file", "off", F.col("far").alias("to")), "warc-jump")
        had, have = have, reach.count()
    return runs.join(reach.withColumnRenamed("off", "run"), ["file", "run"], "left_semi").select("file", "off")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(key, record_type, refers_to, digest, payload_bytes, payload_sha1) of every true record under ``path``.

    payload_bytes and payload_sha1 are those of what stands in the archive; for a revisit that is empty.
    """
    found, values = candidates(spark, path)
    nodes = stage_table(found, "warc-nodes")
    reach = reachable(nodes)
    true = nodes.join(reach, ["file", "off"])
    plain = true.filter("whole").select("key", "record_type", "refers_to", "digest", "length", "sha1")
    spans = true.filter("not whole").select("file", F.col("off").alias("start"), "next", "skip", "length", "key",
                                            "record_type", "refers_to", "digest")
    held = nodes.select("file", "off", "seq").join(reach.withColumn("start", F.col("off")), ["file", "off"], "left")
    upto = Window.partitionBy("file").orderBy("off")
    held = held.withColumn("start", F.last("start", ignorenulls=True).over(upto))
    inner = join_narrow(held, spans, ["file", "start"])
    inner = join_narrow(values, inner, "seq")
    joined = (inner.groupBy("file", "start", "skip", "length", "key", "record_type", "refers_to", "digest")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("off", "value"))), lambda x: x["value"]), MAGIC).alias("text")))
    body = F.substring(F.col("text").cast("binary"), F.col("skip") + 1, F.col("length").cast("int"))
    joined = joined.select("key", "record_type", "refers_to", "digest", "length", F.sha1(body).alias("sha1"))
    return plain.union(joined).withColumnsRenamed({"length": "payload_bytes", "sha1": "payload_sha1"})


def resolve_revisits(records: DataFrame) -> DataFrame:
    """payload_bytes and payload_digest of the full payload: a revisit takes them from the record it refers to."""
    records = stage_table(records, "warc-records")
    wanted = records.select("refers_to").filter("refers_to is not null").distinct()
    held = (join_narrow(records.filter("record_type = 'response'").drop("refers_to").withColumnRenamed("key", "refers_to"), wanted, "refers_to")
            .groupBy("refers_to").agg(F.max_by("payload_bytes", "payload_bytes").alias("full_bytes"), F.max_by("payload_sha1", "payload_bytes").alias("full_sha1")))
    again = F.col("record_type") == "revisit"
    return join_narrow(records, held, "refers_to", "left").select(
        "key", F.when(again, F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("full_sha1")).otherwise(F.col("payload_sha1")).alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = 1000, compression: str = "gzip") -> DataFrame:
    """Archives of all pages written to the shared folder and read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(plan_records(pages, key, payload, least), path, compression)
    return resolve_revisits(read_archives(spark, path)).withColumnRenamed("key", key)
