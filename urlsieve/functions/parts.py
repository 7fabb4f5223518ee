"""Splitting an address into scheme, host, path, query and port.

Follows ``urllib.parse.urlparse`` of current Python (strict bracket checks), because Spark's own
``parse_url`` rejects or rewrites many of the malformed addresses this data is about. Every step is a
built-in expression; the steps are separate projections so that each is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.functions.vocab import PARAM_SCHEMES

# Characters Python's str.strip() removes.
BLANKS = ("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
          "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_SCHEME = r"[a-zA-Z][a-zA-Z0-9+.\-]*"
_SPLIT = rf"(?s)^({_SCHEME})://([^/?#]*)([^?#]*)(?:\?([^#]*))?"

# Characters whose NFKC form contains one of / ? # @ : and which therefore make an authority ambiguous.
_UNSAFE_NFKC = (
    r"[\x{2047}-\x{2049}\x{2100}\x{2101}\x{2105}\x{2106}\x{2A74}\x{FE13}\x{FE16}\x{FE55}\x{FE56}"
    r"\x{FE5F}\x{FE6B}\x{FF03}\x{FF0F}\x{FF1A}\x{FF1F}\x{FF20}]"
)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_HEXTET = r"[0-9a-fA-F]{1,4}"


def is_ipv4(text: Column) -> Column:
    """Dotted quad without leading zeros."""
    return text.rlike(rf"^{_IPV4}\z")


def is_ipv6(text: Column) -> Column:
    """IPv6 literal, with an optional zone and an optional dotted-quad tail."""
    plain = F.regexp_replace(text, r"%[^%]+\z", "")
    plain = F.regexp_replace(plain, rf"(?<=^|:){_IPV4}\z", "0:0")
    full = plain.rlike(rf"^(?:{_HEXTET}:){{7}}{_HEXTET}\z")
    side = rf"(?:{_HEXTET}(?::{_HEXTET})*)?"
    shortened = plain.rlike(rf"^{side}::{side}\z") & (F.regexp_count(plain, F.lit(_HEXTET)) <= 7)
    return full | shortened


def is_ip_literal(host: Column) -> Column:
    return is_ipv4(host) | (host.contains(":") & is_ipv6(host))


def parse_urls(df: DataFrame, col: str = "url", into: str = "parts") -> DataFrame:
    """Add ``into``: struct<raw, scheme, host, path, query, port, malformed>. No shuffle, no UDF.

    A null address is read as empty. When the whole parse fails, ``malformed`` is 1 and every part is
    empty; a bad port alone only leaves ``port`` null.
    """
    keep = [c for c in df.columns if c != into]
    raw = F.btrim(F.coalesce(F.col(col), F.lit("")), F.lit(BLANKS))
    step = df.select(*keep, raw.alias("_raw"))

    complete = F.when(F.col("_raw").rlike(rf"^{_SCHEME}://"), F.col("_raw")).otherwise(
        F.concat(F.lit("http://"), F.col("_raw")))
    step = step.select(*keep, "_raw", F.regexp_replace(complete, r"[\t\r\n]", "").alias("_full"))

    step = step.select(
        *keep, "_raw",
        F.lower(F.regexp_extract("_full", _SPLIT, 1)).alias("_scheme"),
        F.regexp_extract("_full", _SPLIT, 2).alias("_netloc"),
        F.regexp_extract("_full", _SPLIT, 3).alias("_path"),
        F.regexp_extract("_full", _SPLIT, 4).alias("_query"),
    )
    step = step.select(
        *keep, "_raw", "_scheme", "_netloc", "_path", "_query",
        F.regexp_extract("_netloc", r"(?s)([^@]*)\z", 1).alias("_hostport"),
    )

    netloc, hostport = F.col("_netloc"), F.col("_hostport")
    bracketed = hostport.contains("[")
    inside = F.regexp_extract(hostport, r"(?s)^\[([^\]\[]*)\](?::.*)?\z", 1)
    opened, closed = netloc.contains("["), netloc.contains("]")
    literal_ok = inside.rlike(r"(?s)^v[0-9a-fA-F]+[.].+\z") | is_ipv6(inside)
    not_ascii = F.octet_length(netloc) != F.length(netloc)
    bad = (opened != closed) | (opened & closed & ~literal_ok) | (not_ascii & netloc.rlike(_UNSAFE_NFKC))

    host = F.when(bracketed, F.regexp_extract(hostport, r"(?s)\[([^\]]*)", 1)).otherwise(
        F.substring_index(hostport, ":", 1))
    port_text = F.when(bracketed, F.regexp_extract(hostport, r"(?s)\][^:]*:(.*)\z", 1)).otherwise(
        F.regexp_extract(hostport, r"(?s)^[^:]*:(.*)\z", 1))
    step = step.select(
        *keep, "_raw", "_scheme", "_path", "_query",
        bad.alias("_bad"), F.lower(host).alias("_host"), port_text.alias("_port"),
    )

    number = F.when(F.col("_port").rlike(r"^[0-9]+\z"), F.col("_port")).try_cast("bigint")
    port = F.when(number <= 65535, number.cast("int"))
    path = F.when(F.col("_scheme").isin(*PARAM_SCHEMES),
                  F.regexp_replace("_path", r"(?s);[^/]*\z", "")).otherwise(F.col("_path"))

    def unless_bad(c: Column) -> Column:
        return F.when(F.col("_bad"), F.lit("")).otherwise(c)

    parts = F.struct(
        F.col("_raw").alias("raw"),
        unless_bad(F.col("_scheme")).alias("scheme"),
        unless_bad(F.col("_host")).alias("host"),
        unless_bad(path).alias("path"),
        unless_bad(F.col("_query")).alias("query"),
        F.when(~F.col("_bad"), port).alias("port"),
        F.col("_bad").cast("int").alias("malformed"),
    )
    return step.select(*keep, parts.alias(into))
