"""Log-probabilities of whole texts under a small causal self-attention model, beside a word unigram base.

The model: token and place embeddings, one causal attention head with a residual, and three softmaxes for the three base-37
digits of the next subword id. The digits' biases are logarithms of the subword counts of all training texts. The weights are
learnt in one pass over all training texts: every task descends from the same start over its own texts, and the results are
averaged by tokens, slice by slice. Scoring moves a window of WINDOW tokens by WINDOW - OVERLAP, so each token is scored once, with
at least OVERLAP tokens before it where the text has them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.llm.narrow import most_frequent
from urlsieve.llm.words import chunks, word_hashes
from urlsieve.session import stage_table

SIDE = 37
WIDTH = 16
WINDOW, OVERLAP = 32, 8
BATCH = 64
RATE = 0.5
FREQUENT = 300_000
STRETCH = 1 << 21
END_WORD = np.uint64(0xE0F)
_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    if path not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        if len(ranks) >= SIDE ** 3:
            raise ValueError("the vocabulary does not fit three digits")
        _encoders[path] = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def sequences(texts: list[str | None], enc: tiktoken.Encoding) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids with the mark (first free id) before and after each, and where each sequence starts (n + 1)."""
    return marked([np.array(enc.encode_ordinary(t or ""), np.uint16) for t in texts], enc.n_vocab)


def marked(ids: list[np.ndarray], mark: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.concatenate(([mark], i, [mark])).astype(np.int32) for i in ids]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def held_sequences(part: pa.RecordBatch, mark: int) -> tuple[np.ndarray, np.ndarray]:
    return marked([np.frombuffer(i, np.uint16) for i in part.column("ids").to_pylist()], mark)


def encoded(rows: DataFrame, enc_of) -> DataFrame:
    """The rows and their ids, two bytes each, written once: encoding costs more than reading them again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = enc_of()
        for batch in batches:
            for part, _, _ in chunks(batch, "text"):
                ids = [np.array(enc.encode_ordinary(t), np.uint16).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "ids"])

    return stage_table(rows.mapInArrow(run, "doc_id long, text string, learnt_from boolean, ids binary"), "ids")


def windows(begin: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: places of its inputs, which of them exist, and its text. Targets stand one place on."""
    step = WINDOW - overlap
    length = np.diff(begin) - 1
    count = -(-length // step)
    text = np.repeat(np.arange(len(length)), count)
    at = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step - overlap
    inside = at[:, None] + np.arange(WINDOW)
    real = (inside >= 0) & (inside < length[text][:, None])
    return np.where(real, inside + begin[text][:, None], begin[text][:, None]), real, text


def start(counts: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights, and the digits' log-frequencies of the counted ids as biases."""
    rng = np.random.default_rng(seed)
    f = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else 1)).astype(np.float32)
    cube = (np.bincount(np.arange(len(counts)), counts, SIDE ** 3) + 0.01).reshape(SIDE, SIDE, SIDE)
    first, second = cube.sum(axis=(1, 2)), cube.sum(axis=2)
    w = {"embed": 0.3 * rng.standard_normal((SIDE ** 3, WIDTH)).astype(np.float32), "place": 0.05 * rng.standard_normal((WINDOW, WIDTH)).astype(np.float32)}
    w |= {n: f(WIDTH, WIDTH) for n in ("query", "key", "value", "mix")} | {n: 0.1 * f(WIDTH, SIDE) for n in ("out1", "out2", "out3")}
    return w | {"b1": np.log(first / first.sum()).astype(np.float32), "b2": np.log(second / first[:, None]).astype(np.float32),
                "b3": np.log(cube / second[:, :, None]).reshape(-1, SIDE).astype(np.float32)}


LEARNT = ("embed", "place", "query", "key", "value", "mix", "out1", "out2", "out3")
_ONES = np.ones(64, np.float32)
_CAUSAL = np.where(np.tri(WINDOW, dtype=bool), 0, -1e9).astype(np.float32)


def forward(w: dict, ids: np.ndarray, real: np.ndarray):
    x = w["embed"][ids] + w["place"]
    q, k, v = x @ w["query"], x @ w["key"], x @ w["value"]
    s = q @ k.transpose(0, 2, 1)
    s *= np.float32(WIDTH ** -0.5)
    s += _CAUSAL
    if not real.all():
        s += np.where(real | ~real.any(axis=1, keepdims=True), np.float32(0), np.float32(-1e9))[:, None, :]
    if s.max() > 60:
        s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)
    s *= 1 / np.maximum(s @ _ONES[:WINDOW], np.float32(1e-30))[:, :, None]
    mixed = s @ v
    return x, q, k, v, s, mixed, x + mixed @ w["mix"]


def digits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return ids // (SIDE * SIDE), ids // SIDE % SIDE, ids % SIDE


def heads(w: dict, h: np.ndarray, target: np.ndarray, soft: bool = True):
    """For hidden rows and targets: (softmax, digit) of each digit, if wanted, and the natural log-probability."""
    a, b, c = digits(target)
    rows, total, out = np.arange(len(target)), np.zeros(len(target), np.float64), []
    for name, bias, digit in (("out1", w["b1"], a), ("out2", w["b2"][a], b), ("out3", w["b3"][a * SIDE + b], c)):
        z = h @ w[name]
        z += bias
        if z.size and z.max() > 60:
            z -= z.max(axis=1, keepdims=True)
        total += z[rows, digit]
        np.exp(z, out=z)
        sums = np.maximum(z @ _ONES[:SIDE], 1e-30)
        total -= np.log(sums)
        if soft:
            z *= (1 / sums)[:, None]
            out.append((z, digit))
    return out, total


def descend(w: dict, ids: np.ndarray, target: np.ndarray, real: np.ndarray, rate: float) -> None:
    """One step of gradient descent on a batch of windows, in place."""
    x, q, k, v, s, mixed, hidden = forward(w, ids, real)
    flat, n = hidden.reshape(-1, WIDTH), max(int(real.sum()), 1)
    soft, _ = heads(w, flat, target.ravel())
    rows, keep, full = np.arange(len(flat)), real.ravel()[:, None], bool(real.all())
    g_h = np.zeros_like(flat)
    step = {}
    for name, (z, digit) in zip(("out1", "out2", "out3"), soft):
        z[rows, digit] -= 1
        if not full:
            z *= keep
        step[name] = flat.T @ z
        g_h += z @ w[name].T
    g_h = g_h.reshape(hidden.shape)
    m = mixed.reshape(-1, WIDTH)
    step["mix"] = m.T @ g_h.reshape(-1, WIDTH)
    g_m = g_h @ w["mix"].T
    g_s = g_m @ v.transpose(0, 2, 1)
    g_v = s.transpose(0, 2, 1) @ g_m
    g_s -= (g_s * s).sum(axis=2, keepdims=True)
    g_s *= s
    g_s *= np.float32(WIDTH ** -0.5)
    g_q, g_k = g_s @ k, g_s.transpose(0, 2, 1) @ q
    g_x = g_h.copy()
    xf = x.reshape(-1, WIDTH)
    for name, g in (("query", g_q), ("key", g_k), ("value", g_v)):
        step[name] = xf.T @ g.reshape(-1, WIDTH)
        g_x += g @ w[name].T
    step["place"] = g_x.sum(axis=0)
    for name, g in step.items():
        w[name] -= np.float32(rate / n) * np.clip(g, -n, n)
    order = np.argsort(ids.ravel(), kind="stable")
    found, at = np.unique(ids.ravel()[order], return_index=True)
    g_e = np.add.reduceat(g_x.reshape(-1, WIDTH)[order], at)
    norm = np.sqrt(np.diff(np.append(at, len(order))))[:, None]
    w["embed"][found] -= np.float32(0.1 * rate) * np.clip(g_e / norm, -1, 1)


def log10_scores(w: dict, texts: list[str | None], enc: tiktoken.Encoding) -> np.ndarray:
    """log10 probability of each whole text, its end included."""
    return sequence_scores(w, *sequences(texts, enc))


def sequence_scores(w: dict, flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
    inside, real, text = windows(begin, OVERLAP)
    texts = len(begin) - 1
    out = np.zeros(texts)
    for at in range(0, len(text), BATCH):
        some, ok = inside[at:at + BATCH], real[at:at + BATCH]
        hidden = forward(w, flat[some], ok)[-1][:, OVERLAP:]
        counted = ok[:, OVERLAP:]
        _, p = heads(w, hidden[counted], flat[some[:, OVERLAP:][counted] + 1], soft=False)
        out += np.bincount(np.broadcast_to(text[at:at + BATCH, None], counted.shape)[counted], p, texts)
    return out / np.log(10)


def count_tokens(train: DataFrame, mark: int) -> tuple[DataFrame, np.ndarray]:
    """(word, n) over all training texts, the end counted as a word, and the counts of subword ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        ids = np.zeros(SIDE ** 3, np.int64)
        emit = lambda kind, key, n: pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n)], names=["kind", "word", "n"])
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                hashes, _, _ = word_hashes(data, offsets)
                held += [hashes, np.full(part.num_rows, END_WORD)]
                size += len(hashes) + part.num_rows
                flat, begin = held_sequences(part, mark)
                ids += np.bincount(np.delete(flat, begin[:-1]), minlength=len(ids))
            if size >= STRETCH:
                word, n = np.unique(np.concatenate(held), return_counts=True)
                yield emit(0, word.view(np.int64), n)
                held, size = [], 0
        if held:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            yield emit(0, word.view(np.int64), n)
        some = np.flatnonzero(ids)
        yield emit(1, some, ids[some])

    counts = train.mapInArrow(run, "kind int, word long, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    counts = stage_table(counts, "counts")
    pieces = counts.filter("kind = 1").select("word", "n").toPandas()  # at most SIDE ** 3 rows
    return counts.filter("kind = 0").select("word", "n"), np.bincount(pieces.word.astype(int), pieces.n, SIDE ** 3)


def train_model(train: DataFrame, first, mark: int, rate: float = RATE) -> dict[str, np.ndarray]:
    """One pass of descent over all training texts in every task, and the average of the tasks' weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, tokens = {n: x.copy() for n, x in first.value.items()}, 0
        for batch in batches:
            for part, _, _ in chunks(batch, "ids"):
                flat, begin = held_sequences(part, mark)
                inside, real, _ = windows(begin, 0)
                for at in range(0, len(inside), BATCH):
                    some, ok = inside[at:at + BATCH], real[at:at + BATCH]
                    descend(w, flat[some], flat[np.minimum(some + 1, len(flat) - 1)], ok, rate)
                tokens += int(real.sum())
        if tokens:
            flat = np.concatenate([w[n].ravel() for n in LEARNT]) * np.float64(tokens)
            parts = np.array_split(flat, 64)
            turn = TaskContext.get().partitionId() % 16
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(64)), pa.array(np.full(64, turn)), pa.array([p.tobytes() for p in parts], pa.binary()),
                                              pa.array(np.full(64, tokens))], names=["slice", "turn", "sums", "tokens"])

    def add(p: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.float64) for b in p.sums)
        return pd.DataFrame({"slice": p.slice[:1], "turn": p.turn[:1], "sums": [total.tobytes()], "tokens": [p.tokens.sum()]})

    kind = "slice long, turn long, sums binary, tokens long"
    some = train.mapInArrow(run, kind).groupBy("slice", "turn").applyInPandas(add, kind)
    rows = some.withColumn("turn", F.lit(0).cast("long")).groupBy("slice", "turn").applyInPandas(add, kind).orderBy("slice").toPandas()  # 64 rows
    w = dict(first.value)
    if len(rows):
        flat, at = np.concatenate([np.frombuffer(b, np.float64) / t for b, t in zip(rows.sums, rows.tokens)]), 0
        for n in LEARNT:
            w[n] = flat[at:at + w[n].size].reshape(w[n].shape).astype(np.float32)
            at += w[n].size
    return w


def score_texts(docs: DataFrame, learn, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, learnt_from, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``learn``: condition of the rows to learn from; null counts as false. Null texts are empty: one token, the end. Repeated rows are
    scored each; other columns are left out. Without training rows all counts are 0.
    Words beyond the FREQUENT commonest (5 MB broadcast) are looked up by a join.
    """
    spark = docs.sparkSession
    enc_of = lambda: encoder(path, pattern)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learnt_from"))
    rows, mark = encoded(rows, enc_of), enc_of().n_vocab
    train = rows.filter("learnt_from")
    counts, pieces = count_tokens(train.select("text", "ids"), mark)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    first = spark.sparkContext.broadcast(start(pieces))
    model = spark.sparkContext.broadcast(train_model(train.select("ids"), first, mark))
    ranked = most_frequent(counts, "n", FREQUENT).toPandas().sort_values("word")
    top = spark.sparkContext.broadcast((ranked.word.to_numpy(np.int64), ranked.n.to_numpy(np.int64)))
    below = total + distinct + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times = top.value
        base, serial = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                hashes, _, begin = word_hashes(data, offsets)
                lists = []
                for i in range(part.num_rows):
                    mine, n = np.unique(np.append(hashes[begin[i]:begin[i + 1]], END_WORD).view(np.int64), return_counts=True)
                    at = np.minimum(np.searchsorted(words, mine), max(len(words) - 1, 0))
                    hit = words[at] == mine if len(words) else np.zeros(len(mine), bool)
                    known = times[at[hit]] if len(words) else np.zeros(0)
                    lists.append((int(n.sum()), int(n[hit].sum()), float(n[hit] @ np.log10((known + 1) / below)), mine[~hit], n[~hit]))
                score = sequence_scores(model.value, *held_sequences(part, mark))
                tokens, known, sums, rest, times_ = zip(*lists)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + serial + np.arange(part.num_rows)), part.column("doc_id"), part.column("learnt_from"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(sums, pa.float64()), pa.array(score), pa.array(rest, pa.list_(pa.int64())), pa.array([t.astype(np.int32) for t in times_], pa.list_(pa.int32()))],
                    names=["row", "doc_id", "learnt_from", "n_tokens", "n_known", "base_score", "score", "rest", "times"])
                serial += part.num_rows

    scored = stage_table(rows.mapInArrow(run, "row long, doc_id long, learnt_from boolean, n_tokens long, n_known long, base_score double, score double, "
                                              "rest array<long>, times array<int>"), "scores")
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    rest = rest.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(below)))).alias("terms"))
    return scored.drop("rest", "times").join(rest, "row", "left").select(
        "doc_id", "learnt_from", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("terms", F.lit(0.0))).alias("base_score"), "score")
