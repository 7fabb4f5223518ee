"""From raw documents to token ids: quality, near copies, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
``documents``. Stages that remove rows decide by row, so repeated and null identifiers change nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsieve.llm import bpe, decontaminate, jaccard, pii, quality
from urlsieve.llm.narrow import join_narrow
from urlsieve.llm.queries import learnt_rules, table
from urlsieve.session import scratch_path, stage_table

KEY = "_row_key"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.7 or more. Statistics are computed once, for the fit and for the scores."""
    name = quality.free_name(docs, "stats")
    scored = stage_table(quality.text_stats(docs, "text", name), "scored")
    rules = learnt_rules(spark, scored.select("doc_id", F.col(name).alias("stats")), sf_dir)
    return scored.filter(rules.score(name) >= 0.7).select(*docs.columns)


def with_key(docs: DataFrame, key: str) -> DataFrame:
    """All columns and ``key``, a 64-bit hash of the whole row, nulls included: the same in every scan, unlike a running number."""
    return docs.withColumn(key, F.xxhash64(*[x for c in docs.columns for x in (F.col(c), F.col(c).isNull())]))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least identifier, null last; of rows equal in all columns one.

    Rows are told apart by a hash of the row, so rows that share an identifier but not their text, or have none, are judged each on its own.
    """
    key = quality.free_name(docs, KEY)
    keyed = with_key(docs, key)
    groups = jaccard.similar_documents(keyed.select(F.col(key).alias("doc_id"), "text"))
    groups = stage_table(groups.select(F.col("doc_id").alias(key), "component_id"), "groups")
    repeated = groups.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    several = groups.filter(f"{key} <> component_id")
    linked = several.unionByName(several.select(F.col("component_id").alias(key), "component_id")).distinct()
    named = join_narrow(keyed.select(key, "doc_id"), linked, key).distinct()
    named = stage_table(named.select(key, "component_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key).alias("place")), "linked")
    best = named.groupBy("component_id").agg(F.min("place").alias("best"))
    lost = named.join(best, "component_id").filter("place <> best").select(key)
    rest = join_narrow(keyed, lost, key, "left_anti")
    if repeated.isEmpty():
        return rest.select(*docs.columns)
    once = join_narrow(rest, repeated, key).dropDuplicates([key])
    return join_narrow(rest, repeated, key, "left_anti").unionByName(once).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a copy of a benchmark item, told apart by a hash of the row."""
    key = quality.free_name(docs, KEY)
    keyed = with_key(docs, key)
    found = decontaminate.leaked(keyed, table(spark, sf_dir, "benchmark"), key=key)
    return join_narrow(keyed, found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(pii.find_spans(docs, pii.fit_trees(docs)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids of every text, and the text decoded from them."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="bytes").select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.decode("bytes", "UTF-8").alias("text"))


STAGES = [("quality", keep_good), ("near copies", keep_one_of_each), ("decontamination", drop_leaks), ("personal data", redact_personal),
          ("tokens", to_tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
