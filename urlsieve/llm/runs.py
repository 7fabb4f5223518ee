"""Periodic runs of words, found by dyadic catchers while the words of a text are appended.

A run of period q is a stretch of at least 2q words in which words q apart are equal. At level L = 1, 2, 4, ... every
completed block of L words, aligned to a multiple of L, is a catcher for the periods 2L to 4L - 1 (level 1 also has period 1):
the first half of any square of such a period holds a whole block. Each appended word ends a suffix of L words; that suffix is
compared with the two blocks that lie two and three blocks before its own. Equal ones are a hit of period q = distance, unless
the q words between are themselves a power, which a shorter period catches. Hits of one period in neighbouring blocks form a
chain, and a chain is lengthened by less than a block on each side to the maximal stretch; it is a run if it holds a square.

Words are appended a stretch at a time: all words of a stretch advance together in NumPy, and what is kept between stretches
is one chain per period and place. A word costs about two comparisons a level, so a text of n words takes n log n steps.
Equality of long stretches is decided by prefix sums modulo two primes, equality of words by 64-bit hashes. Memory is some 100
bytes per word of the longest text or of a megabyte of texts, whichever is more.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from urlsieve.llm.words import CASED, chunks, word_hashes

SHORTEST = 12
STRETCH = 1 << 18
_PRIMES = ((2147483647, 1103515245), (2147483629, 1664525013))
_powers: list[np.ndarray] = [np.ones(1, np.uint64) for _ in _PRIMES]
SCHEMA = "doc_id {}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _power(n: int) -> list[np.ndarray]:
    """At least n powers of each base, modulo its prime."""
    for k, (prime, base) in enumerate(_PRIMES):
        have, p = _powers[k], np.uint64(prime)
        while len(have) < n:
            have = np.concatenate((have, have * np.uint64(pow(base, len(have), prime)) % p))
        _powers[k] = have
    return _powers


class Equal:
    """Equality of stretches of one sequence of words."""

    def __init__(self, words: np.ndarray):
        self.words, self.power, self.sums = words, _power(len(words) + 1), []
        for (prime, _), power in zip(_PRIMES, self.power):
            p = np.uint64(prime)
            terms = words % p * power[:len(words)] % p
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms))))

    def same(self, i: np.ndarray, j: np.ndarray, length) -> np.ndarray:
        """Whether the ``length`` words from i equal those from j, for arrays of places with i <= j."""
        out = np.ones(len(i), bool)
        for (prime, _), power, sums in zip(_PRIMES, self.power, self.sums):
            p = np.uint64(prime)
            out &= (sums[i + length] - sums[i]) % p * power[j - i] % p == (sums[j + length] - sums[j]) % p
        return out


def is_power(equal: Equal, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the q words from ``at`` are a shorter stretch repeated: they have period q / f for a prime factor f of q."""
    out = np.zeros(len(at), bool)
    rest, f = q.copy(), 2
    while len(rest) and f * f <= rest.max():
        here = rest % f == 0
        if here.any():
            step = q[here] // f
            out[here] |= equal.same(at[here], at[here] + step, q[here] - step)
            while here.any():
                rest[here] //= f
                here = rest % f == 0
        f += 1
    prime = rest > 1
    step = q[prime] // rest[prime]
    out[prime] |= equal.same(at[prime], at[prime] + step, q[prime] - step)
    return out


def chains(q: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of equal period that touch, joined; in order of period and place."""
    order = np.lexsort((begin, q))
    q, begin, end = q[order], begin[order], end[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (begin[1:] != end[:-1])
    last = np.append(fresh[1:], True)[:len(q)]
    return q[fresh], begin[fresh], end[last]


def advance(equal: Equal, place: np.ndarray, size: np.ndarray, lo: int, hi: int) -> Iterator[tuple]:
    """(level, period, begin, end) arrays of the blocks caught again by suffixes that end at the words lo to hi - 1.

    ``place``: number of each word in its text; ``size``: words of its text.
    """
    words, level = equal.words, 1
    e = lo + np.flatnonzero(size[lo:hi] >= SHORTEST)
    while len(e):
        j = e - level + 1
        block = place[e] - level + 1
        zero, block = j - block, block // level
        for back in (1, 2, 3) if level == 1 else (2, 3):
            b = zero + (block - back) * level
            there = np.flatnonzero((block >= back) & (words[np.maximum(b, 0)] == words[j]) & (words[np.maximum(b, 0) + level - 1] == words[e]))
            b, at = b[there], j[there]
            if level > 2:
                good = equal.same(b, at, level)
                b, at = b[good], at[good]
            whole = ~is_power(equal, b, at - b)
            if whole.any():
                yield level, *chains((at - b)[whole], b[whole], b[whole] + level)
        level *= 2
        e = e[(size[e] >= 4 * level) & (place[e] >= 3 * level - 1)]


def lengthen(equal: Equal, level: int, q: np.ndarray, begin: np.ndarray, end: np.ndarray, before: np.ndarray, after: np.ndarray):
    """Begin and end moved apart, by less than ``level`` and at most ``before`` and ``after``, while words q apart are equal."""
    left, right = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
    step = level // 2
    while step:
        go = np.flatnonzero(left + step <= before)
        go = go[equal.same(i := begin[go] - left[go] - step, i + q[go], step)]
        left[go] += step
        go = np.flatnonzero(right + step <= after)
        go = go[equal.same(i := end[go] + right[go], i + q[go], step)]
        right[go] += step
        step //= 2
    return begin - left, end + right


def find_runs(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least ``shortest`` words in texts laid end to end, by place and period.

    ``first``: each text's first word, and the number of words. ``shortest`` is SHORTEST at least.
    """
    count = np.diff(first)
    size = np.repeat(count, count)
    place = np.arange(len(words)) - np.repeat(first[:-1], count)
    equal, caught = Equal(words), {}
    for lo in range(0, len(words), stretch):
        for level, *found in advance(equal, place, size, lo, min(lo + stretch, len(words))):
            caught.setdefault(level, []).append(found)
    out = [np.zeros((3, 0), np.int64)]
    for level, found in caught.items():
        q, begin, end = chains(*(np.concatenate(x) for x in zip(*found)))
        after = begin - place[begin] + size[begin] - q - end
        begin, end = lengthen(equal, level, q, begin, end, place[begin], after)
        run = (end - begin >= q) & (end - begin + q >= shortest)
        out.append(np.stack((begin, end - begin + q, q))[:, run])
    start, length, period = np.concatenate(out, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _collapse(data: np.ndarray, starts: np.ndarray, first: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of every text, joined by one space, and the n + 1 offsets of the texts."""
    inside = CASED[data] != 0
    run = np.concatenate((np.zeros(1, np.int64), np.cumsum(inside)))
    length = (run[np.append(starts[1:], len(data))[:len(starts)]] - run[starts])[kept]
    text = np.searchsorted(first, np.flatnonzero(kept), "right") - 1
    last = np.append(text[1:] != text[:-1], True)[:len(text)]
    room = length + ~last
    to = np.concatenate((np.zeros(1, np.int64), np.cumsum(room)))
    out = np.full(to[-1], 32, np.uint8)
    spot = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[spot + np.repeat(to[:-1], length)] = data[spot + np.repeat(starts[kept], length)]
    return out, to[np.searchsorted(text, np.arange(len(first)))]


def scan_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text: number of words, its runs, and the text with each run cut to its first period."""
    for batch in batches:
        for rows, data, offsets in chunks(batch, "text"):
            words, starts, first = word_hashes(data, offsets, CASED)
            start, length, period = find_runs(words, first)
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            text, ends = _collapse(data, starts, first, np.cumsum(cover)[:-1] == 0)
            begin = np.searchsorted(start, first)
            place = start - np.repeat(first[:-1], np.diff(begin))
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (place, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), runs),
                pa.StringArray.from_buffers(rows.num_rows, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text))],
                ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs`` (doc_id of any type, text).

    Words are maximal runs of anything but 0x20 and 0x09-0x0D, compared exactly; they are numbered from 0. ``runs`` lists every
    maximal stretch of at least 12 words and two periods with its start, length and smallest period, by start, then period.
    ``collapsed``: the words that no run holds beyond its first period, joined by one space. A null, empty or blank text has no
    words, no runs and an empty ``collapsed``; repeated rows and null identifiers are scanned each on its own; other columns
    are left out, so their names cannot clash. No row is shuffled.
    """
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(scan_runs, SCHEMA.format(docs.schema["doc_id"].dataType.simpleString()))
