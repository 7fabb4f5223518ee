"""Joins to narrow tables of counted size, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.session import stage_table

#: A side of so many rows of a few numbers or digests (some 20 MB) is broadcast; a larger one is shuffled.
NARROW_ROWS = 200_000


#: Rows of whole texts that are handed to Python at a time; it bounds memory only.
TEXT_BATCH = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows, in Arrow batches of TEXT_BATCH at most from now on in this session, as fits whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= TEXT_BATCH:
        df.sparkSession.conf.set(name, TEXT_BATCH)
    return df


def join_narrow(left: DataFrame, narrow: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join to rows of a few short columns: they are written and counted, and broadcast only below NARROW_ROWS."""
    narrow = stage_table(narrow, "narrow")
    return left.join(F.broadcast(narrow) if narrow.count() <= NARROW_ROWS else narrow, on, how)


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of the vertices of (a, b): the label is the component's least id.

    Each round takes the least label among neighbours and then that label's own label, so paths shrink fast. Sums are
    map-side; every round's labels are written to the shared folder, and broadcast while there are few.
    """
    both = stage_table(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage_table(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels")
    vertices = labels.count()
    few = F.broadcast if vertices <= NARROW_ROWS else lambda df: df
    parts = max(8, vertices // 20_000)  # files follow the rows, not the session's partitions
    while True:
        near = both.join(few(labels.withColumnRenamed("id", "b")), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        low = near.join(few(labels), "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = few(labels.select(F.col("id").alias("label"), F.col("label").alias("far")))
        low = stage_table(low.join(jump, "label").select("id", F.least("label", "far").alias("label"), "old").coalesce(parts), "labels")
        labels = low.select("id", "label")
        if not low.filter("label <> old").count():
            return labels


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label) after further edges (a, b): only the components that these join are looked at, as single vertices."""
    ends = stage_table(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    known = stage_table(join_narrow(labels, ends, "id"), "known")
    fresh = stage_table(join_narrow(ends, known.select("id"), "id", "left_anti").withColumn("label", F.col("id")), "fresh")
    left, right = (known.union(fresh).select(F.col("id").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    joined = join_narrow(join_narrow(edges, left, "a"), right, "b").filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    changed = components(joined).select(F.col("id").alias("label"), F.col("label").alias("least"))
    placed = join_narrow(labels.union(fresh), changed, "label", "left")
    return stage_table(placed.select("id", F.coalesce("least", "label").alias("label")), "labels")


def most_frequent(counts: DataFrame, n: str, rows: int) -> DataFrame:
    """The rows with the greatest counts, at most ``rows`` of them: all whose count is at least some bound.

    The bound comes from how often each count occurs, a table of at most about the square root of all that was counted.
    """
    left, bound = rows, None
    for r in counts.groupBy(n).agg(F.count(F.lit(1)).alias("_rows")).orderBy(F.desc(n)).collect():
        left -= r["_rows"]
        if left < 0:
            break
        bound = r[n]
    return counts.filter(F.col(n) >= bound) if bound is not None else counts.limit(0)


def least_by_hash(df: DataFrame, bound: int, *columns: str) -> DataFrame:
    """At most ``bound`` rows, those with the least hash of ``columns``; rows that agree in them count once.

    Only the hashes are sorted; the rows themselves are then picked by a filter and combined on the map side.
    """
    rows = df.withColumn("_hash", F.xxhash64(*columns))
    cut = rows.select("_hash").distinct().orderBy("_hash").limit(bound).agg(F.max("_hash")).first()[0]
    if cut is None:
        return df.limit(0)
    others = [F.first(c).alias(c) for c in df.columns]
    return rows.filter(F.col("_hash") <= cut).groupBy("_hash").agg(*others).drop("_hash")
