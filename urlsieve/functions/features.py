"""The 42 features of one address, as an ordered table of column builders.

The order of ``FEATURES`` is a contract: models store it, and ``feature_matrix`` selects by it. To add a
feature, append an entry; a builder gets the row's parts (see ``with_parts``) and returns a Column.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.functions import text as T
from urlsieve.functions import vocab as V
from urlsieve.functions.parts import is_ip_literal, parse_urls

PART_COLUMNS = ("raw", "low", "scheme", "host", "path", "low_path", "query", "port", "malformed",
                "labels", "sub", "domain", "tld")
PREFIX = "_p_"


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def with_parts(df: DataFrame, col: str = "url") -> DataFrame:
    """Parse ``col`` and lay out the parts the features read, each computed once."""
    keep = df.columns
    step = parse_urls(df, col, into="_parts")
    step = step.select(
        *keep,
        *[F.col(f"_parts.{n}").alias(PREFIX + n)
          for n in ("raw", "scheme", "host", "path", "query", "port", "malformed")],
    )
    step = step.select(
        "*",
        F.lower(PREFIX + "raw").alias(PREFIX + "low"),
        F.lower(PREFIX + "path").alias(PREFIX + "low_path"),
        F.split(PREFIX + "host", "[.]").alias(PREFIX + "labels"),
        T.registered_domain(F.col(PREFIX + "host")).alias(PREFIX + "domain"),
    )
    labels = F.col(PREFIX + "labels")
    return step.select(
        "*",
        F.slice(labels, 1, F.greatest(F.lit(0), F.size(labels) - 2)).alias(PREFIX + "sub"),
        T.domain_tld(F.col(PREFIX + "domain")).alias(PREFIX + "tld"),
    )


def row_parts() -> SimpleNamespace:
    return SimpleNamespace(**{n: F.col(PREFIX + n) for n in PART_COLUMNS})


def drop_parts(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(PREFIX)])


def _avg_length(labels: Column) -> Column:
    total = F.aggregate(labels, F.lit(0), lambda acc, x: acc + F.length(x))
    return F.when(F.size(labels) > 0, total / F.size(labels)).otherwise(F.lit(0.0))


def _after_scheme(raw: Column) -> Column:
    at = F.instr(raw, "://")
    return F.when(at > 0, F.substring(raw, at + 3, F.length(raw))).otherwise(raw)


def _beyond_expected(count: Column, expected: Column) -> Column:
    return F.greatest(F.lit(0), count - expected.cast("int"))


def _under_any(host: Column, domains) -> Column:
    return reduce(or_, [(host == d) | host.endswith("." + d) for d in domains])


def builtin_brand_distance(host: Column) -> Column:
    """Least edit distance of any host word to a built-in brand, 99 when there is no word."""
    per_token = F.transform(
        T.host_tokens(host),
        lambda t: F.least(*[F.levenshtein(t, F.lit(b)) for b in V.BUILTIN_BRANDS]))
    none = F.lit(V.NO_BRAND_DISTANCE)
    return F.least(F.coalesce(F.array_min(per_token), none), none)


_STRUCTURE = {
    "is_malformed": lambda p: p.malformed,
    "url_length": lambda p: F.length(p.raw),
    "hostname_length": lambda p: F.length(p.host),
    "path_length": lambda p: F.length(p.path),
    "query_length": lambda p: F.length(p.query),
    "nb_subdomains": lambda p: F.size(p.sub),
    "avg_subdomain_length": lambda p: _avg_length(p.sub),
    "nb_dots": lambda p: T.count_of(p.raw, "[.]"),
    "path_depth": lambda p: T.count_of(p.path, "[^/]+"),
}

_COMPOSITION = {
    "ratio_digits_url": lambda p: T.share_of(p.raw, r"\p{Nd}"),
    "ratio_digits_host": lambda p: T.share_of(p.host, r"\p{Nd}"),
    "nb_hyphens": lambda p: T.count_of(p.raw, "-"),
    "nb_at": lambda p: T.count_of(p.raw, "@"),
    "nb_percent": lambda p: T.count_of(p.raw, "%"),
    "nb_underscore": lambda p: T.count_of(p.raw, "_"),
    "nb_double_slash": lambda p: T.count_of(_after_scheme(p.raw), "//"),
    "char_repeat": lambda p: T.longest_run(p.raw),
    "nb_www": lambda p: _beyond_expected(T.count_of(p.low, "www"), p.host.startswith("www.")),
    "nb_com": lambda p: _beyond_expected(T.count_of(p.low, "com"), p.host.endswith(".com")),
}

_HOST = {
    "has_ip_host": lambda p: _flag(is_ip_literal(p.host)),
    "is_https": lambda p: _flag(p.scheme == "https"),
    "https_token_in_host": lambda p: _flag(p.host.contains("https")),
    "has_port": lambda p: _flag(~p.port.isin(80, 443)),
    "has_punycode": lambda p: _flag(p.host.contains("xn--")),
    "tld_length": lambda p: F.length(p.tld),
    "suspicious_tld": lambda p: _flag(p.tld.isin(*V.SUSPICIOUS_TLDS)),
    "tld_in_subdomain": lambda p: _flag(
        F.arrays_overlap(p.sub, F.array(*[F.lit(t) for t in V.COMMON_TLDS]))),
    "tld_in_path": lambda p: _flag(
        p.low_path.rlike(r"\.(" + "|".join(V.COMMON_TLDS) + r")(/|\z)")),
}

_DECEPTION = {
    "phish_hints": lambda p: T.words_present(p.low, V.PHISH_HINT_WORDS),
    "brand_in_subdomain": lambda p: _flag(
        T.contains_any(F.array_join(p.sub, "."), V.BUILTIN_BRANDS)),
    "brand_in_path": lambda p: _flag(T.contains_any(p.low_path, V.BUILTIN_BRANDS)),
    # The next three and the three list features read columns the lookups add first.
    "min_brand_edit_distance": lambda p: F.col("_brand_distance"),
    "brand_lookalike": lambda p: _flag(F.col("_brand_distance").between(1, V.BRAND_CUTOFF)),
    "brand_is_registered_domain": lambda p: F.col("_known_brand"),
    "is_shortening_service": lambda p: _flag(_under_any(p.host, V.SHORTENERS)),
    "in_top_sites": lambda p: F.col("_rank").isNotNull().cast("int"),
    "domain_rank_score": lambda p: F.col("_rank_score"),
    "tld_popularity": lambda p: F.col("_tld_share"),
}

_RANDOMNESS = {
    "entropy_url": lambda p: T.shannon_entropy(p.raw),
    "entropy_domain": lambda p: T.shannon_entropy(p.domain),
    "vowel_ratio": lambda p: T.share_of(F.replace(p.domain, F.lit("."), F.lit("")), "[aeiou]"),
    "char_continuation_rate": lambda p: T.same_class_rate(p.raw),
}

FEATURES = {**_STRUCTURE, **_COMPOSITION, **_HOST, **_DECEPTION, **_RANDOMNESS}
FEATURE_NAMES = list(FEATURES)
DOUBLE_FEATURES = ("avg_subdomain_length", "ratio_digits_url", "ratio_digits_host", "domain_rank_score",
                   "tld_popularity", "entropy_url", "entropy_domain", "vowel_ratio",
                   "char_continuation_rate")
