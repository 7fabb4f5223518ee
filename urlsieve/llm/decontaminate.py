"""Copies of benchmark items in documents, edited ones too: word n-grams seed them, local alignment scores them.

Items are taken in blocks of at most ``BLOCK`` n-grams (about 60 MB broadcast), so any number of items works: each block
is one more pass over the documents. A pass keeps, per document and item, the words around the seeds that met.
No seed is left out for being frequent: an edited version that leaks often makes just the intact n-grams frequent. What
keeps common phrases cheap is a bound that no alignment exceeds, the share of an item's words that the region holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.llm.words import chunks, shingles, word_hashes
from urlsieve.session import stage_table

BLOCK = 2_000_000
_HIT = "doc_id long, item_id long, seeds int, words binary"


def item_words(items: DataFrame, n: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, words, grams) of each different text of an item: its own key, hashes of its words and of its n-grams, if it has n words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                hashes, _, first = word_hashes(data, offsets)
                rows = [hashes[first[i]:first[i + 1]] for i in range(part.num_rows)]
                grams = [shingles(r, np.array([0, len(r)]), n)[0] if len(r) >= n else np.zeros(0, np.uint64) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("item"), part.column("item_id"), pa.array([r.tobytes() for r in rows], pa.binary()),
                     pa.array([g.view(np.int64) for g in grams], pa.list_(pa.int64()))], names=["item", "item_id", "words", "grams"])

    own = F.col(key).cast("long")
    rows = items.select(F.xxhash64(own.isNull(), own, text).alias("item"), own.alias("item_id"), F.col(text).alias("text")).distinct()
    return rows.mapInArrow(run, "item long, item_id long, words binary, grams array<long>").filter("size(grams) > 0")


class Seeds:
    """Sorted n-grams of a block of items, with item and place of each, and a bit table to pass over most words fast."""

    def __init__(self, rows):
        self.words = {r.item: np.frombuffer(r.words, np.uint64) for r in rows}
        self.names = {r.item: r.item_id for r in rows}
        grams = np.concatenate([np.array(r.grams, np.int64).view(np.uint64) for r in rows])
        item = np.concatenate([np.full(len(r.grams), r.item, np.int64) for r in rows])
        place = np.concatenate([np.arange(len(r.grams)) for r in rows])
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.place = grams[order], item[order], place[order]
        self.bits = np.uint64((1 << max(16, (8 * len(grams)).bit_length())) - 1)
        self.table = np.zeros(int(self.bits) + 1, bool)
        self.table[(self.grams & self.bits).astype(np.int64)] = True

    def meet(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index into grams, index into the seeds)."""
        maybe = np.flatnonzero(self.table[(grams & self.bits).astype(np.int64)])
        low, high = np.searchsorted(self.grams, grams[maybe], "left"), np.searchsorted(self.grams, grams[maybe], "right")
        count = high - low
        at = np.repeat(maybe, count)
        return at, np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)


def regions(diagonals: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Runs of sorted diagonals (document place less item place) no further apart than half the item."""
    cut = np.flatnonzero(np.diff(diagonals) > max(length // 2, 4)) + 1
    return [(int(p[0]), int(p[-1])) for p in np.split(diagonals, cut)]


def scan(docs: DataFrame, seeds, n: int, least: float, key: str, text: str) -> DataFrame:
    """A row for each document, item and region of meeting seeds, with the number of distinct seeds and the region's word hashes.

    An alignment matches each item word at most once, so regions that hold less than ``least`` of them cannot reach it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = seeds.value
        for batch in batches:
            out = ([], [], [], [])
            for part, data, offsets in chunks(batch, "text"):
                hashes, _, first = word_hashes(data, offsets)
                grams, begin = shingles(hashes, first, n)
                at, seed = s.meet(grams)
                if not len(at):
                    continue
                row = np.searchsorted(begin, at, "right") - 1
                item, place = s.item[seed], at - begin[row]
                diagonal = place - s.place[seed]
                order = np.lexsort((diagonal, item, row))
                row, item, diagonal, gram = row[order], item[order], diagonal[order], grams[at][order]
                edge = np.flatnonzero((np.diff(row) != 0) | (np.diff(item) != 0)) + 1
                ids = part.column("doc_id").to_pylist()
                for a, b in zip(np.append(0, edge), np.append(edge, len(row))):
                    words, wanted = hashes[first[row[a]]:first[row[a] + 1]], s.words[item[a]]
                    length = len(wanted)
                    for low, high in regions(diagonal[a:b], length):
                        slack = length // 4 + n
                        start, end = max(low - slack, 0), min(high + length + slack, len(words))
                        if np.isin(wanted, words[start:end]).sum() / length < least:
                            continue
                        inside = (diagonal[a:b] >= low) & (diagonal[a:b] <= high)
                        for column, value in zip(out, (ids[row[a]], int(item[a]), len(np.unique(gram[a:b][inside])), words[start:end].tobytes())):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "item_id", "seeds", "words"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _HIT)


def align(item: np.ndarray, regions_: np.ndarray, lengths: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1) -> np.ndarray:
    """Smith-Waterman scores of one item against many padded regions at once (linear gaps)."""
    width = regions_.shape[1]
    ramp = -gap * np.arange(1, width + 1)
    inside = np.arange(width) < lengths[:, None]
    above = np.zeros((len(regions_), width + 1), np.int32)
    best = np.zeros(len(regions_), np.int32)
    for word in item:
        step = np.where((regions_ == word) & inside, match, mismatch)
        here = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + gap), 0)
        here = np.maximum.accumulate(here + ramp, axis=1) - ramp
        above[:, 1:] = here
        best = np.maximum(best, np.where(inside, here, 0).max(axis=1, initial=0))
    return best


def leaked(docs: DataFrame, items: DataFrame, n: int = 4, least: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, align, seeds) of documents that hold an item or an edited copy of at least half of it.

    ``align`` is the best alignment's score over that of the item with itself, ``seeds`` the distinct n-grams met in the
    best region. Null or empty texts and items with fewer than n words meet nothing; repeated rows give one
    result per (doc_id, item_id), repeated items count once. Every text of an item_id is searched, items without one as well;
    the best of them counts. Other columns are left out.
    """
    spark = docs.sparkSession
    words = stage_table(item_words(items, n), "items")
    total = words.agg(F.coalesce(F.sum(F.size("grams") + F.length("words") / 8), F.lit(0))).first()[0]
    blocks = int(total // BLOCK) + 1
    found = []
    for b in range(blocks):
        mine = words.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        held = mine.collect()  # a block of items, of bounded size
        if not held:
            continue
        seeds = spark.sparkContext.broadcast(Seeds(held))
        hits = stage_table(scan(docs, seeds, n, least, key, text), "seed-hits")
        found.append(score_regions(hits, seeds, least))
    if not found:
        return spark.createDataFrame([], "doc_id long, item_id long, align double, seeds int")
    every = reduce(DataFrame.union, found)
    return every.groupBy("doc_id", "item_id").agg(F.max("align").alias("align"), F.max_by("seeds", F.struct("align", "seeds")).alias("seeds"))


def score_regions(seeded: DataFrame, seeds, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                item = np.asarray(batch.column("item_id"))
                held = [np.frombuffer(w.as_py(), np.uint64) for w in batch.column("words")]
                score = np.zeros(batch.num_rows)
                for i in np.unique(item):
                    rows = np.flatnonzero(item == i)
                    rows = rows[np.argsort([len(held[r]) for r in rows], kind="stable")]
                    for some in np.array_split(rows, len(rows) // 32 + 1):
                        if not len(some):
                            continue
                        lengths = np.array([len(held[r]) for r in some])
                        padded = np.zeros((len(some), max(int(lengths.max()), 1)), np.uint64)
                        for j, r in enumerate(some):
                            padded[j, :lengths[j]] = held[r]
                        words = seeds.value.words[int(i)]
                        score[some] = align(words, padded, lengths) / (2 * len(words))
                named = pa.array([seeds.value.names[int(i)] for i in item], pa.int64())
                out = pa.RecordBatch.from_arrays([batch.column("doc_id"), named, pa.array(score), batch.column("seeds")],
                                                 names=["doc_id", "item_id", "align", "seeds"])
                yield out.filter(pa.array(score >= least))

    return seeded.mapInArrow(run, "doc_id long, item_id long, align double, seeds int")
