"""Quality score by a sparse ensemble of rules: tree paths over text statistics, weighted by lasso logistic regression.

The fit takes at most ``bound`` labelled rows (those with the least hash of the identifier); statistics and scores
cover every row. Rules and weights are compiled into one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.llm.narrow import least_by_hash, small_batches
from urlsieve.llm.words import chunks, give_back, word_hashes

STATS = ("log_bytes", "log_words", "word_length", "upper", "digit", "mark", "pipe", "noise", "control", "high", "newline",
         "line_repeats", "word_repeats", "pair_repeats", "top_word", "stop_end", "word_bytes_max")


def _classes() -> np.ndarray:
    sets = (bytes(range(65, 91)), bytes(range(48, 58)), b".,;:!?", b"|", b"#$%&*<>{}[]=@^~\\_", bytes([*range(9), *range(14, 32), 127]),
            bytes(range(128, 256)), b"\n")
    out = np.zeros((256, len(sets)))
    for j, s in enumerate(sets):
        out[list(s), j] = 1
    return out


_CLASSES = _classes()


def _repeats(values: np.ndarray) -> tuple[float, float]:
    """Share of values that repeat an earlier one, share of the commonest value."""
    if not len(values):
        return 0.0, 0.0
    _, counts = np.unique(values, return_counts=True)
    return 1 - len(counts) / len(values), counts.max() / len(values)


def _row(text: bytes, hashes: np.ndarray, lengths: np.ndarray) -> list[float]:
    n, w = len(text), len(hashes)
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / max(n, 1)
    lines = [x for x in text.split(b"\n") if x]
    pairs = hashes[1:] * np.uint64(3) + hashes[:-1]
    repeated, top = _repeats(hashes)
    ends = sum(x[-1:] in b".!?" for x in lines) / max(len(lines), 1)
    return [np.log1p(n), np.log1p(w), lengths.mean() if w else 0.0, *shares, 1 - len(set(lines)) / max(len(lines), 1),
            repeated, _repeats(pairs)[0], top, ends, np.log1p(lengths.max()) if w else 0.0]


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column is called so."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def text_stats(docs: DataFrame, text: str = "text", stats_name: str = "stats") -> DataFrame:
    """Every row with a struct column ``stats_name`` of doubles, which must be free; null texts count as empty and have defined
    statistics."""
    names = docs.columns
    kinds = ", ".join(f"`{n}` {k}" for n, k in docs.dtypes)
    if free_name(docs, stats_name) != stats_name:
        raise ValueError(f"a column is already called {stats_name}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                hashes, starts, first = word_hashes(data, offsets)
                ends = np.append(starts[1:], len(data))
                lengths = np.minimum(ends, np.repeat(offsets[1:], np.diff(first))) - starts
                raw = data.tobytes()
                rows = np.array([_row(raw[offsets[i]:offsets[i + 1]], hashes[first[i]:first[i + 1]], lengths[first[i]:first[i + 1]])
                                 for i in range(part.num_rows)])
                stats = pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names=list(STATS))
                yield pa.RecordBatch.from_arrays([*part.columns, stats], names=[*names, stats_name])
        give_back()

    return small_batches(docs).mapInArrow(run, f"{kinds}, `{stats_name}` struct<{', '.join(f'{s}: double' for s in STATS)}>")


@dataclass(frozen=True)
class Rules:
    """Conjunctions of (statistic, at most?, bound) with logistic weights."""

    intercept: float
    rules: tuple[tuple[tuple[tuple[str, bool, float], ...], float], ...]

    def score(self, stats: str = "stats") -> Column:
        terms = [F.when(_holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def _holds(rule, stats: str | None) -> Column:
    """Whether a rule holds of the fields of a struct, or of columns."""
    of = lambda s: F.col(f"`{stats}`.{s}" if stats else s)
    tests = [of(s) <= bound if low else of(s) > bound for s, low, bound in rule]
    return reduce(lambda a, b: a & b, tests)


def _paths(node, so_far=()):
    """Every path from the root of a fitted tree, inner nodes included."""
    if so_far:
        yield so_far
    if node.subtreeDepth() > 0:
        split = node.split()
        name, bound = STATS[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*so_far, (name, True, bound)))
        yield from _paths(node.rightChild(), (*so_far, (name, False, bound)))


def fit_rules(labelled: DataFrame, bound: int = 20_000, trees: int = 12, depth: int = 3, penalty: float = 0.002) -> Rules:
    """labelled: ``stats`` and ``label`` (0 or 1), null labels left out. At most ``bound`` rows, a documented limit of the
    fit, chosen by the hash of their statistics. Without both labels the score is the share of label 1 (0.5 of none)."""
    rows = labelled.filter("label in (0, 1)").select("stats", F.col("label").cast("double").alias("label"))
    rows = least_by_hash(rows, bound, "stats", "label").select("label", *[F.col(f"stats.{s}") for s in STATS])
    held = rows.toPandas()
    n, ones = len(held), float(held.label.sum())
    if ones in (0.0, float(n)):
        share = (ones + 0.5) / (n + 1)
        return Rules(float(np.log(share / (1 - share))), ())
    spark = labelled.sparkSession
    local = VectorAssembler(inputCols=list(STATS), outputCol="x").transform(spark.createDataFrame(held).coalesce(2)).cache()
    booster = GBTClassifier(featuresCol="x", labelCol="label", maxDepth=depth, maxIter=trees, maxBins=64, seed=7, subsamplingRate=0.8).fit(local)
    fitted = booster._java_obj.trees()
    rules = sorted({path for i in range(len(fitted)) for path in _paths(fitted[i].rootNode())})
    met = F.array(*[_holds(rule, None).cast("double") for rule in rules])
    frame = local.select("label", array_to_vector(met).alias("x")).cache()
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=200)
    model = lasso.fit(frame)
    frame.unpersist()
    local.unpersist()
    weights = model.coefficients.toArray()
    return Rules(float(model.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def score_quality(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """All columns and ``score`` (in place of one that is there): 0 to 1, higher where label 1 is likelier. Empty and null texts
    get a score too."""
    name = free_name(docs, "stats")
    return text_stats(docs, text, name).withColumn("score", rules.score(name)).drop(name)
