"""Text measures as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from urlsieve.functions.vocab import MIN_TOKEN_LENGTH

#: Runs of two or more equal characters; most characters stand alone, and those need no entry.
_RUNS = r"(?s)((.)\2+)"


def count_of(text: Column, pattern: str) -> Column:
    """Non-overlapping matches of a regular expression."""
    return F.regexp_count(text, F.lit(pattern))


def share_of(text: Column, pattern: str) -> Column:
    """Matches per character, 0 for an empty text."""
    return F.when(F.length(text) > 0, count_of(text, pattern) / F.length(text)).otherwise(F.lit(0.0))


def contains_any(text: Column, words) -> Column:
    return reduce(or_, [text.contains(w) for w in words])


def words_present(text: Column, words) -> Column:
    """How many of the words occur at least once."""
    return reduce(add, [text.contains(w).cast("int") for w in words])


def longest_run(text: Column) -> Column:
    """Length of the longest run of one character."""
    runs = F.regexp_extract_all(text, F.lit(_RUNS), F.lit(1))
    alone = F.when(F.length(text) > 0, 1).otherwise(0)
    return F.coalesce(F.array_max(F.transform(runs, F.length)), alone)


def same_class_rate(text: Column) -> Column:
    """Share of neighbouring characters of one class (letter, digit, other)."""
    class_runs = count_of(text, r"\p{L}+|\p{Nd}+|[^\p{L}\p{Nd}]+")
    size = F.length(text)
    return F.when(size > 1, (size - class_runs) / (size - 1)).otherwise(F.lit(0.0))


def shannon_entropy(text: Column) -> Column:
    """Bits per character; 0 for an empty text.

    Sorting the characters turns equal ones into runs, so their counts are run lengths; with counts c and
    length n the entropy is log2(n) - sum(c * log2(c)) / n; single characters add 0.
    """
    size = F.length(text)
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(_RUNS), F.lit(1))
    weighted = F.aggregate(runs, F.lit(0.0), lambda acc, r: acc + F.length(r) * F.log2(F.length(r)))
    return F.when(size > 0, F.log2(size) - weighted / size).otherwise(F.lit(0.0))


def edit_distance(a: Column, b: Column, cutoff: int | None = None) -> Column:
    """Levenshtein distance; with a cutoff, null when the distance exceeds it."""
    if cutoff is None:
        return F.levenshtein(a, b)
    d = F.levenshtein(a, b, cutoff)
    return F.when(d >= 0, d)


def registered_domain(host: Column) -> Column:
    """Last two labels of a host. No public-suffix list, so "bbc.co.uk" gives "co.uk"."""
    return F.substring_index(host, ".", -2)


def domain_tld(domain: Column) -> Column:
    """Last label of a domain, empty when it has no dot."""
    return F.when(domain.contains("."), F.substring_index(domain, ".", -1)).otherwise(F.lit(""))


def host_tokens(host: Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Words of a host: split on dots and hyphens, short ones dropped."""
    return F.filter(F.split(host, "[.-]"), lambda t: F.length(t) >= min_length)
