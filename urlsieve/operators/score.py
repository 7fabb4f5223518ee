"""Trust score, verdict and the plain-language reasons behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAFE_FROM = 70
SUSPICIOUS_FROM = 40

# Feature, test, sentence, in display order.
SIGNALS = (
    ("has_ip_host", "= 1", "Host is a numeric IP address rather than a domain name"),
    ("brand_lookalike", "= 1", "Resembles a well-known brand without matching it"),
    ("is_shortening_service", "= 1", "Uses a link shortener, so the real destination is hidden"),
    ("has_punycode", "= 1", "Uses an internationalised domain, a technique behind look-alike attacks"),
    ("suspicious_tld", "= 1", "Top-level domain is one commonly associated with abuse"),
    ("https_token_in_host", "= 1", "The word 'https' appears inside the host name, which fakes security"),
    ("nb_at", "> 0", "Contains an @ symbol, which hides the real host from the reader"),
    ("is_https", "= 0", "Connection is not encrypted"),
    ("in_top_sites", "= 1", "Domain appears in a list of the most visited sites worldwide"),
    ("brand_is_registered_domain", "= 1", "Domain is itself a well-known brand"),
    ("phish_hints", ">= 2", "Contains several words common in phishing, such as verify or account"),
    ("url_length", "> 75", "Unusually long address"),
    ("nb_subdomains", ">= 3", "Unusually deep chain of subdomains"),
)
REASSURING = ("in_top_sites", "brand_is_registered_domain")
NO_SIGNAL = "No individual signal stood out"


def trust_score(scored: DataFrame) -> DataFrame:
    """Add ``trust_score`` = 100 * (1 - malicious score)."""
    return scored.withColumn("trust_score", (1 - F.col("score")) * 100)


def verdict(scored: DataFrame) -> DataFrame:
    """Add ``verdict`` from the unrounded trust score."""
    s = F.col("trust_score")
    return scored.withColumn("verdict", F.when(s >= SAFE_FROM, "SAFE")
                             .when(s >= SUSPICIOUS_FROM, "SUSPICIOUS").otherwise("DANGEROUS"))


def rounded_score():
    """One decimal, halves to even."""
    return F.rint(F.col("trust_score") * 10) / 10


def explain_signals(features: DataFrame) -> DataFrame:
    """Add ``warnings`` and ``reassurances``: the sentences whose test holds, in order."""
    def fired(reassuring: bool):
        rules = [F.when(F.expr(f"{name} {test}"), F.lit(sentence)) for name, test, sentence in SIGNALS
                 if name in features.columns and (name in REASSURING) == reassuring]
        return F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")

    return features.withColumn("warnings", fired(False)).withColumn("reassurances", fired(True))


def score_report(scored: DataFrame) -> DataFrame:
    """url, trust_score (one decimal), verdict and the reasons as text."""
    silent = (F.size("warnings") == 0) & (F.size("reassurances") == 0)
    return scored.select(
        "row_id", "url", rounded_score().alias("trust_score"), "verdict",
        F.concat_ws("; ", "warnings").alias("warnings"),
        F.concat_ws("; ", "reassurances").alias("reassurances"),
        F.when(silent, F.lit(NO_SIGNAL)).otherwise(F.lit("")).alias("note"))
