"""One registered query per operator, with production parameters, over the whole intended table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsieve.llm import bpe, decontaminate, jaccard, lm, neighbours, pii, quality, repair, repeats, runs, templates, toolcalls, warc
from urlsieve.session import stage_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again; the digests are taken of the ids and of the decoded bytes."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded="bytes").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, strlen(h) AS b, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN b >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN b >= 1000 AND top <> page_id THEN top END AS refers_to
FROM g""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back through the verified chain of records."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


TOOLS = {"search": {"limit": ("integer", True), "query": ("string", True)},
         "convert": {"amount": ("number", True), "text": ("string", False)}}


@query("""
WITH calls AS (SELECT conv_id, turn, text, CASE WHEN turn % 3 = 0 THEN 'convert' WHEN turn % 11 = 10 THEN 'lookup' ELSE 'search' END AS name,
    'c' || conv_id || '-' || turn AS call_id FROM conversations WHERE role = 'assistant'),
args AS (SELECT *, CASE name WHEN 'convert' THEN '{"amount":' || length(text) || '.5,"text":' || to_json(text) || '}'
    ELSE '{"limit":' || CASE WHEN turn % 5 = 4 THEN '"' || turn || '"' ELSE turn::VARCHAR END || ',"query":' || to_json(text) || '}' END AS a FROM calls),
res AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content FROM conversations WHERE role = 'user' GROUP BY ALL),
runs AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM (SELECT DISTINCT conv_id, turn FROM calls)),
d AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS depth FROM runs)
SELECT a.conv_id, a.call_id, CAST(d.depth AS BIGINT) AS depth, a.name,
  CASE WHEN a.name = 'lookup' THEN 'unknown tool' WHEN a.name = 'search' AND a.turn % 5 = 4 THEN 'type:limit' ELSE '' END AS problems,
  '{"arguments":' || a.a || ',"id":"' || a.call_id || '","name":"' || a.name || '","result":' || coalesce(to_json(res.content)::VARCHAR, 'null') || '}' AS json
FROM args a JOIN d USING (conv_id, turn) LEFT JOIN res USING (conv_id, turn)""")
def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assistant turn as a call that builds on the one two turns before, the user's answer as its result."""
    turns = table(spark, sf_dir, "conversations")
    name_id = lambda turn: F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), turn)
    turn, text = F.col("turn"), F.col("text")
    name = F.when(turn % 3 == 0, "convert").when(turn % 11 == 10, "lookup").otherwise("search")
    limit = F.when(turn % 5 == 4, F.concat(F.lit('"'), turn, F.lit('"'))).otherwise(turn.cast("string"))
    quoted = F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)
    arguments = F.when(name == "convert", F.concat(F.lit('{ "text" : '), quoted, F.lit(', "amount" : '), F.length(text), F.lit(".5}"))) \
        .otherwise(F.concat(F.lit('{"query":'), quoted, F.lit(' ,"limit": '), limit, F.lit("}")))
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", name_id(turn).alias("call_id"), name.alias("name"), arguments.alias("arguments"), name_id(turn - 2).alias("parent_id"))
    results = turns.filter("role = 'user'").select("conv_id", name_id(turn - 1).alias("call_id"), text.alias("content"))
    return toolcalls.link_calls(calls, results, TOOLS)


def held_out(modulus: int):
    """crc32 of the identifier as text leaves remainder 2: never learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 2


def learnt_rules(spark: SparkSession, stats: DataFrame, sf_dir: str) -> quality.Rules:
    """The rules learnt from (doc_id, stats) of the documents that are labelled and not held out."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("label"))
    return quality.fit_rules(stats.filter(~held_out(4)).join(labels, "doc_id"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> tuple[DataFrame, quality.Rules]:
    """Statistics of all documents, written once, and the rules learnt from them."""
    stats = stage_table(quality.text_stats(docs.select("doc_id", "text")).drop("text"), "text-stats")
    return stats, learnt_rules(spark, stats, sf_dir)


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text; the rules see statistics of the text only."""
    stats, rules = quality_rules(spark, table(spark, sf_dir, "documents"), sf_dir)
    return stats.select("doc_id", F.coalesce(held_out(4), F.lit(False)).alias("held_out"), rules.score().alias("score")) \
        .withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans by kind, their digest, and all spans; the counts are those of the base spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, pii.fit_trees(docs))
    count = lambda i: F.size(F.filter("base_spans", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                        F.sha2(pii.written("base_spans").cast("binary"), 256).alias("base_sha256"), pii.written("spans").alias("spans"))


@query()
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by shingles of five words at a similarity of 0.75 or more."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query()
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with copies of benchmark items, exact or edited, and how well each aligns."""
    return decontaminate.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine to every fiftieth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the 400-byte strings that also start elsewhere."""
    found = repeats.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's log-probability under the attention model and under the word unigrams of the training rows."""
    scored = lm.score_texts(table(spark, sf_dir, "documents"), ~held_out(7), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return scored.withColumn("held_out", F.coalesce(held_out(7), F.lit(False))).drop("learnt_from")


WORD = r"[^\x20\x09-\x0D]+"


def repeated_tail(doc_id, text):
    """The text of every tenth document, by its checksum, with the words from some place on replaced by repeats of the first of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words):
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")

    once = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), repeat)
    return F.when(h % 10 == 0, F.get(once, 0)).otherwise(text)


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every text, the longest one of each, and digests of all runs and of the text without repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.periodic_runs(docs)
    longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"), F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, without full stops, repeated or of the wrong role, by the checksum of conversation and turn."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    rows = turns.filter(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
                                          F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


@query(r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
c AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(key)), lambda i: ('0x' || substr(hex(key), 2 * i + 1, 2))::BIGINT)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))),
    4294967295::BIGINT) % 20 AS kind FROM k),
d AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, kind, conv_id FROM c),
e AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i
    FROM (SELECT * FROM d WHERE kind <> 0 UNION ALL SELECT * FROM d WHERE kind = 3)),
f AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS said,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, lag(role[1]) OVER (PARTITION BY conv ORDER BY i) || role[1] AS pair,
    max(i) OVER (PARTITION BY conv) AS n FROM e),
g AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (NOT blank AND said) AS duplicate, count(*) FILTER (NOT blank AND NOT said AND cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv),
v(conv, i, state, best) AS (
    SELECT DISTINCT conv, 0::BIGINT, '', {'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]} FROM f
    UNION ALL
    SELECT conv, i + 1, step.state, min(step.best) FROM (
        SELECT w.conv, w.i, unnest(CASE WHEN r.n < w.i + 1 THEN [] WHEN r.blank OR r.said THEN [
                {'state': w.state, 'best': {'cost': w.cost + 3, 'audit': w.audit || 'D', 'said': w.said}}] ELSE [
                {'state': w.state, 'best': {'cost': w.cost + 3, 'audit': w.audit || 'D', 'said': w.said}},
                CASE WHEN r.role[1] = w.next OR r.role[1] = 's' AND w.state = '' THEN
                    {'state': r.role[1], 'best': {'cost': w.cost + r.cut::INT, 'audit': w.audit || 'K', 'said': list_append(w.said, r.role || ':' || r.text)}} END,
                {'state': w.next, 'best': {'cost': w.cost + 2 + r.cut::INT, 'audit': w.audit || 'R',
                    'said': list_append(w.said, CASE w.next WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text)}}] END) AS step
        FROM (SELECT conv, i, state, CASE state WHEN 'u' THEN 'a' ELSE 'u' END AS next, best.cost AS cost, best.audit AS audit, best.said AS said FROM (
            SELECT conv, i, state, best FROM v
            UNION ALL SELECT conv, i, CASE state WHEN 'u' THEN 'a' ELSE 'u' END, {'cost': best.cost + 2, 'audit': best.audit || 'I',
                'said': list_append(best.said, CASE state WHEN 'u' THEN 'assistant:' ELSE 'user:' END)} FROM v
            UNION ALL SELECT conv, i, CASE state WHEN 'u' THEN 'u' ELSE 'a' END, {'cost': best.cost + 4, 'audit': best.audit || 'II',
                'said': list_concat(best.said, CASE state WHEN 'u' THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END)} FROM v)) w
        JOIN f r ON r.conv = w.conv AND r.i = w.i + 1) WHERE step IS NOT NULL GROUP BY ALL),
z AS (SELECT conv, min(best) AS best FROM (
        SELECT conv, i, state, best FROM v
        UNION ALL SELECT conv, i, 'a', {'cost': best.cost + 2, 'audit': best.audit || 'I', 'said': list_append(best.said, 'assistant:')} FROM v WHERE state = 'u'
        UNION ALL SELECT conv, i, 'a', {'cost': best.cost + 4, 'audit': best.audit || 'II', 'said': list_concat(best.said, ['user:', 'assistant:'])} FROM v WHERE state <> 'u')
    JOIN (SELECT DISTINCT conv, n FROM f) USING (conv) WHERE i = n AND state IN ('', 'a') GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
    sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM d) LEFT JOIN g USING (conv) LEFT JOIN z USING (conv)""")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, what is wrong with each, and the cheapest edits that mend it."""
    turns = table(spark, sf_dir, "conversations")
    report, repaired = repair.repair_turns(damaged(turns))
    found = report.join(repair.digests(repaired).withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    every = turns.select(F.col("conv_id").alias("_conv")).distinct()
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return rows.select(F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                       F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
_FITS = "\n".join(f"    WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
_VERDICTS = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)


def _close(a, b, c, d):
    a, b, c, d = (f"({x})::DOUBLE" for x in (a, b, c, d))
    return (f"({a} + {b} + {c} + {d}) * ({a} * {d} - {b} * {c}) * ({a} * {d} - {b} * {c}) <= {templates.SIMILAR}::DOUBLE * ({a} + {b}) * ({c} + {d}) * ({a} + {c}) * ({b} + {d})")


@query(f"""
WITH RECURSIVE u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{templates.UPPER}', '{templates.UPPER.lower()}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE
{_FITS} END AS rule, array_to_string(list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
    lambda s: regexp_replace(regexp_replace(s, '[0-9a-fA-F-]{{16,}}', '{{x}}', 'g'), '[0-9]+', '{{n}}', 'g')), '/') AS shape FROM u),
l AS (SELECT *, CASE rule {_VERDICTS} END AS ruled FROM r),
v(host, shape, n, good, bad, node, d, template) AS (
    SELECT host, shape, count(*), count(*) FILTER (ruled = 'allow'), count(*) FILTER (ruled = 'block'), '', 1, NULL::VARCHAR FROM l GROUP BY host, shape
    UNION ALL
    SELECT k.host, k.shape, k.n, k.good, k.bad, k.node || '/' || m.name, k.d + 1,
        CASE WHEN k.total < {templates.SUPPORT} THEN k.node || '/**' WHEN k.child = '' THEN CASE k.node WHEN '' THEN '/' ELSE k.node END END
    FROM (SELECT *, CASE WHEN total >= {templates.SUPPORT} AND child <> '' THEN CASE WHEN kn >= {templates.SUPPORT} AND kn * {templates.RARE} >= total THEN child ELSE '*' END END AS branch
        FROM (SELECT *, sum(n) OVER (PARTITION BY host, node) AS total, sum(n) OVER (PARTITION BY host, node, child) AS kn
            FROM (SELECT *, coalesce(string_split(shape, '/')[d], '') AS child FROM v WHERE template IS NULL))) k
    LEFT JOIN (SELECT host, node, branch, CASE count(*) OVER g WHEN 1 THEN branch
            ELSE '{{' || array_to_string(list_sort(list(branch) OVER g), ',') || '}}' END AS name
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY host, node, labelled ORDER BY share, branch) AS class
            FROM (SELECT *, CASE WHEN coalesce({_close('bad', 'lag(bad) OVER o', 'good', 'lag(good) OVER o')}
                    AND {_close('ends', 'lag(ends) OVER o', 'n - ends', 'lag(n) OVER o - lag(ends) OVER o')}, false) THEN 0 ELSE 1 END AS fresh
                FROM (SELECT host, node, branch, sum(n) AS n, sum(good) AS good, sum(bad) AS bad, sum(ending) AS ends,
                        sum(good) + sum(bad) > 0 AS labelled, (sum(bad) + 2) / (sum(good) + sum(bad) + 4) AS share
                    FROM (SELECT *, CASE WHEN total >= {templates.SUPPORT} AND child <> '' THEN
                                CASE WHEN kn >= {templates.SUPPORT} AND kn * {templates.RARE} >= total THEN child ELSE '*' END END AS branch
                        FROM (SELECT *, sum(n) OVER (PARTITION BY host, node) AS total, sum(n) OVER (PARTITION BY host, node, child) AS kn
                            FROM (SELECT *, coalesce(string_split(shape, '/')[d], '') AS child,
                                CASE len(string_split(shape, '/')) WHEN d THEN n ELSE 0 END AS ending FROM v WHERE template IS NULL)))
                    WHERE branch IS NOT NULL GROUP BY host, node, branch)
                WINDOW o AS (PARTITION BY host, node, labelled ORDER BY share, branch)))
        WINDOW g AS (PARTITION BY host, node, labelled, class)) m ON m.host = k.host AND m.node = k.node AND m.branch = k.branch),
t AS (SELECT host, shape, template, sum(good) OVER (PARTITION BY host, template) AS good, sum(bad) OVER (PARTITION BY host, template) AS bad FROM v WHERE template IS NOT NULL)
SELECT page_id, host, path, rule, template, coalesce(ruled, CASE WHEN good + bad > 0 AND (bad + 2) / (good + bad + 4) >= {templates.REJECT} THEN 'block' ELSE 'allow' END) AS verdict
FROM l JOIN t USING (host, shape)""")
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address judged by the longest rule, or by its host's path templates, which learn from the pages under rules."""
    return templates.judge_urls(table(spark, sf_dir, "pages"), RULES).drop("purity")
