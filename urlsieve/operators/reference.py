"""The ranked list of popular domains, what is derived from it, and the lookups against it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.functions import text as T
from urlsieve.functions import vocab as V
from urlsieve.functions.features import PREFIX, builtin_brand_distance
from urlsieve.operators.joins import broadcast_lookup, fits_broadcast, lookup, spread_lookup
from urlsieve.session import stage_measured, stage_table


def reference_ranks(lines: DataFrame) -> DataFrame:
    """domain, rank: a repeated domain keeps the rank of its last line."""
    return lines.groupBy("domain").agg(F.max_by("rank", "line").alias("rank"))


def brand_vocabulary(lines: DataFrame, size: int = V.BRAND_LIST_SIZE,
                     min_length: int = V.MIN_BRAND_LENGTH) -> DataFrame:
    """brand, ord, length: the first ``size`` distinct first labels of the list, in line order."""
    named = lines.where(F.col("domain").contains(".")).select(
        F.substring_index("domain", ".", 1).alias("brand"), "line")
    first = (named.where(F.length("brand") >= min_length)
             .groupBy("brand").agg(F.min("line").alias("line"))
             .orderBy("line", "brand").limit(size))
    # At most ``size`` rows are left, so one window over all of them is bounded.
    order = F.row_number().over(Window.orderBy("line", "brand"))
    return first.select("brand", order.alias("ord"), F.length("brand").alias("length"))


def tld_shares(lines: DataFrame, n_domains: int | Column) -> DataFrame:
    """tld, share: lines per top-level domain over the number of distinct domains."""
    return (lines.where(F.col("domain").contains("."))
            .groupBy(F.substring_index("domain", ".", -1).alias("tld"))
            .agg((F.count(F.lit(1)) / n_domains).alias("share")))


@dataclass(frozen=True)
class ReferenceList:
    """A loaded list: three tables and the sizes measured while loading it."""

    ranks: DataFrame
    brands: DataFrame
    tlds: DataFrame
    n_domains: int
    ranks_small: bool
    tlds_small: bool


def load_reference(lines: DataFrame, brands: int = V.BRAND_LIST_SIZE) -> ReferenceList:
    """Derive the three tables of a (line, rank, domain) list once, and measure them; empty is an error.

    They are stored in the shared folder, so that every later use is a plain scan.
    """
    ranks, rows, text = stage_measured(reference_ranks(lines), "ranks", "domain")
    if rows == 0:
        raise ValueError("the reference list has no usable 'rank,domain' lines")
    tlds, n_tlds, tld_text = stage_measured(tld_shares(lines, F.lit(rows)), "tlds", "tld")
    return ReferenceList(
        ranks=ranks, brands=stage_table(brand_vocabulary(lines, brands), "brands"), tlds=tlds, n_domains=rows,
        ranks_small=fits_broadcast(rows, text), tlds_small=fits_broadcast(n_tlds, tld_text))


def reference_summary(ref: ReferenceList) -> DataFrame:
    """One row: number of domains, brands and top-level domains."""
    parts = (ref.ranks.select(F.lit("n_domains").alias("what"), F.lit(1).alias("n"))
             .unionByName(ref.brands.select(F.lit("n_brands").alias("what"), F.lit(1).alias("n")))
             .unionByName(ref.tlds.select(F.lit("n_tlds").alias("what"), F.lit(1).alias("n"))))
    counts = [F.sum(F.when(F.col("what") == w, F.col("n")).otherwise(0)).alias(w)
              for w in ("n_domains", "n_brands", "n_tlds")]
    return parts.agg(*counts)


def domain_rank_lookup(df: DataFrame, ref: ReferenceList | None, domain: str = PREFIX + "domain",
                       spread_by: str = "url") -> DataFrame:
    """Add ``_rank`` (null when unranked) and ``_rank_score`` = log10(domains / rank), 0 when unranked."""
    if ref is None:
        return df.withColumn("_rank", F.lit(None).cast("bigint")).withColumn("_rank_score", F.lit(0.0))
    ranks = ref.ranks.select(F.col("domain").alias(domain), F.col("rank").alias("_rank"))
    joined = lookup(df, ranks, domain, ref.ranks_small, spread_by)
    score = F.when(F.col("_rank") > 0, F.log10(F.lit(float(ref.n_domains)) / F.col("_rank")))
    return joined.withColumn("_rank_score", F.coalesce(score, F.lit(0.0)))


def tld_share_lookup(df: DataFrame, ref: ReferenceList | None, tld: str = PREFIX + "tld",
                     spread_by: str = "url") -> DataFrame:
    """Add ``_tld_share``, 0 for a top-level domain the list does not have."""
    if ref is None:
        return df.withColumn("_tld_share", F.lit(0.0))
    shares = ref.tlds.select(F.col("tld").alias(tld), F.col("share").alias("_tld_share"))
    joined = lookup(df, shares, tld, ref.tlds_small, spread_by)
    return joined.withColumn("_tld_share", F.coalesce("_tld_share", F.lit(0.0)))


def known_brand(df: DataFrame, ref: ReferenceList | None, domain: str = PREFIX + "domain") -> DataFrame:
    """Add ``_known_brand``: 1 when the first label of the domain is in the brand vocabulary."""
    if ref is None:
        name = F.substring_index(domain, ".", 1)
        return df.withColumn("_known_brand", name.isin(*V.BUILTIN_BRANDS).cast("int"))
    # The vocabulary has at most BRAND_LIST_SIZE rows by construction.
    brands = ref.brands.select(F.col("brand").alias("_name"), F.lit(1).alias("_hit"))
    named = df.withColumn("_name", F.substring_index(domain, ".", 1))
    joined = broadcast_lookup(named, brands, "_name")
    return joined.withColumn("_known_brand", F.coalesce("_hit", F.lit(0))).drop("_name", "_hit")


@dataclass(frozen=True)
class NearHosts:
    """Hosts with a word near some brand: host, distance; and how often every host occurs."""

    table: DataFrame
    small: bool
    counts: DataFrame


def near_hosts(df: DataFrame, ref: ReferenceList, host: str = PREFIX + "host",
               cutoff: int = V.BRAND_CUTOFF) -> NearHosts:
    """Compare the words of every distinct host with the brands, once, and store the few that are near.

    Hosts repeat far more than addresses. Their words meet the brands of nearly their length through a
    broadcast equi-join, and the minimum is taken in the partition the host already is in.
    """
    brands = ref.brands.select("brand", "length")
    counts = df.groupBy(host).count()
    words = (counts.select(host, F.explode(F.array_distinct(
                 T.host_tokens(F.col(host), V.MIN_BRAND_LENGTH))).alias("_word"))
             .select(host, "_word", F.explode(F.sequence(
                 F.length("_word") - cutoff, F.length("_word") + cutoff)).alias("length")))
    near = (words.join(F.broadcast(brands), "length")
            .select(host, T.edit_distance(F.col("_word"), F.col("brand"), cutoff).alias("_d"))
            .where(F.col("_d").isNotNull())
            .groupBy(host).agg(F.min("_d").alias("_brand_distance")))
    stored, rows, text = stage_measured(near, "near-hosts", host)
    return NearHosts(stored, fits_broadcast(rows, text), counts)


def listed_brand_distance(host: Column, brands: list[str], cutoff: int = V.BRAND_CUTOFF) -> Column:
    """The same distance as one expression over the list's brands (at most BRAND_LIST_SIZE); null when none is near."""
    words = F.array_distinct(T.host_tokens(host, V.MIN_BRAND_LENGTH))
    near = lambda w, b: F.abs(F.length(w) - F.length(b)) <= cutoff
    of_word = lambda w: F.array_min(F.transform(F.filter(F.array(*map(F.lit, brands)), lambda b: near(w, b)),
                                                lambda b: T.edit_distance(w, b, cutoff)))
    return F.array_min(F.transform(words, of_word))


def brand_proximity(df: DataFrame, ref: ReferenceList | None, host: str = PREFIX + "host",
                    spread_by: str = "url", near: NearHosts | None = None) -> DataFrame:
    """Add ``_brand_distance``: least edit distance of any word of the host to a brand, 99 when none is near.

    With a list, only distances up to 2 count and words under five characters are left out. Addresses are
    shuffled only when the hosts near a brand are too many to broadcast.
    """
    if ref is None:
        return df.withColumn("_brand_distance", builtin_brand_distance(F.col(host)))
    if df.isStreaming:
        brands = [r["brand"] for r in ref.brands.select("brand").collect()]
        found = listed_brand_distance(F.col(host), brands) if brands else F.lit(None)
        return df.withColumn("_brand_distance", F.coalesce(found, F.lit(V.NO_BRAND_DISTANCE)))
    near = near_hosts(df, ref, host) if near is None else near
    if near.small:
        joined = broadcast_lookup(df, near.table, host)
    else:
        joined = spread_lookup(df, near.table, host, spread_by, near.counts)
    return joined.withColumn("_brand_distance", F.coalesce("_brand_distance", F.lit(V.NO_BRAND_DISTANCE)))
