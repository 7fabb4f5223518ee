"""Removal of long byte strings that occur more than once in a collection, by suffix order built column by column.

Every window of ``length`` bytes belongs to the k-gram of least hash inside it, so equal windows have equal keys.
Neighbouring windows of one key form a segment; equal segments are counted first and never fetched twice. The
different segments of a key go to one bucket of bounded size. There the Burrows-Wheeler transform and the common
prefixes of all its strings are built by inserting one symbol of every string per round, right to left. The arrays of a bucket
are bounded by ``BUCKET``, so they stay in memory; what is larger passes between tasks through shuffle files. A key with more than
``MANY`` different segments is not gathered: its windows are counted one by one, by hash, instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.llm.words import _BASE, _VALUE, chunks, mix, powers
from urlsieve.session import stage_table

K = 100
PIECE = 512
MANY = 64
BUCKET = 1 << 15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _VALUE[65])
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_back = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _back
    if len(_back) < n:
        more = np.full(max(n, 2 * len(_back), 256), _INVERSE, np.uint64)
        more[0] = 1
        _back = np.multiply.accumulate(more)
    return _back


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any substring by one difference and one product."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(len(data))[:len(data)], out=out[1:])
    return out


def gram_hashes(sums: np.ndarray, k: int) -> np.ndarray:
    n = len(sums) - k
    return mix((sums[k:] - sums[:-k]) * inverse_powers(n)[:n]) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each run of w values."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)
    rows = np.concatenate((x, pad)).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def segments(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(start, windows, key, content hash, twice) of a text's segments.

    ``twice``: the key's k-gram stands there at two places, so the segment may repeat a window of its own.
    """
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, bool))
    sums = prefix_sums(data)
    grams, reach = gram_hashes(sums, k), length - k + 1
    least = sliding_min(grams, reach)
    wall = np.full(reach - 1, np.iinfo(np.uint64).max, np.uint64)
    chosen = np.flatnonzero(~sliding_min(np.concatenate((wall, ~least, wall)), reach) == grams)
    again = (grams[chosen[1:]] == grams[chosen[:-1]]) & (np.diff(chosen) < length)
    double = grams[chosen[1:][again]]
    edge = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]))
    pieces = -(-np.diff(edge) // PIECE)
    start = np.repeat(edge[:-1], pieces) + PIECE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    windows = np.append(start[1:], len(least)) - start
    end = start + windows + length - 1
    content = mix(mix((sums[end] - sums[start]) * inverse_powers(len(data))[start]) + windows.astype(np.uint64))
    twice = np.isin(least[start], double) if len(double) else np.zeros(len(start), bool)
    return start, windows, least[start], content, twice


def symbol_bytes(length: int) -> int:
    """The bytes of a symbol: the greatest divisor of ``length`` up to an eighth of it, so that a window is eight symbols at least."""
    return max(u for u in range(1, max(length // 8, 1) + 1) if length % u == 0)


def symbol_codes(data: np.ndarray, unit: int) -> np.ndarray:
    """A number for the ``unit`` bytes from each place on, equal for equal bytes; places too near the end are left out.

    Up to 8 bytes are the number itself; then numbers are paired to those of twice as many bytes, the last pair may overlap. Nothing
    is hashed.
    """
    width = min(unit, 8)
    codes = np.zeros(len(data) - width + 1, np.uint64)
    for i in range(width):
        codes = (codes << np.uint64(8)) | data[i:i + len(codes)]
    if width < unit:
        codes = np.unique(codes, return_inverse=True)[1].astype(np.uint64)
    while width < unit:
        step = min(width, unit - width)
        codes = np.unique((codes[:-step] << np.uint64(32)) | codes[step:], return_inverse=True)[1].astype(np.uint64)
        width += step
    return codes


def columns_of(strings: list[bytes], unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each string once per offset below ``unit``, in symbols of ``unit`` bytes from last to first: (codes, sizes, first places).

    Row ``unit * i + offset`` holds string i from that offset on, so that every place of a string is the start of one symbol.
    """
    codes = symbol_codes(np.frombuffer(b"".join(strings) + bytes(unit), np.uint8), unit)
    begin = np.cumsum([0, *map(len, strings)])[:-1]
    starts = (begin[:, None] + np.arange(unit)).ravel()
    sizes = np.maximum(np.array([len(s) for s in strings])[:, None] - np.arange(unit), 0).ravel() // unit
    turn = np.arange(int(sizes.max(initial=0)))
    inside = turn < sizes[:, None]
    at = np.where(inside, starts[:, None] + (sizes[:, None] - 1 - turn) * unit, 0)
    found, held = np.unique(codes[at[inside]], return_inverse=True)
    kind = np.uint8 if len(found) < 255 else np.uint16 if len(found) < 65_535 else np.uint32
    table = np.zeros(inside.shape, kind)
    table[inside] = held + 1
    return table, sizes, np.arange(len(sizes))


def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, whether the window at each place starts elsewhere in the strings too.

    One symbol of every string per round, from its last to its first: the transform's stable order by symbol gives the places of
    the new suffixes, the least common prefix between neighbours of one symbol gives theirs. Symbols are words of
    ``symbol_bytes``; a string then takes part once per offset, which makes the rounds fewer by that number.
    """
    unit = symbol_bytes(length)
    text, sizes, place = columns_of(strings, unit)
    count, kind, least = len(text), text.dtype, length // unit
    before, common = np.zeros(count, kind), np.zeros(count, np.int32)
    for column in range(text.shape[1]):
        active = np.flatnonzero(sizes > column)
        before[place[active]] = text[active, column]
        order = np.argsort(before, kind="stable")
        order = order[len(before) - np.count_nonzero(before):]
        symbol = before[order]
        rank = np.empty(len(before), np.int64)
        rank[order] = np.arange(len(order))
        mine = rank[place[active]]
        fresh = np.sort(mine)
        total = len(before) + len(active)
        held = np.append(common, 0)
        old = np.ones(total, bool)
        old[count + fresh] = False
        grown = np.zeros(total, np.int32)
        grown[old] = common
        for at in (fresh, fresh[fresh + 1 < len(order)] + 1):
            at = at[at > 0]
            at = at[symbol[at] == symbol[at - 1]]
            if len(at):
                low, high = order[at - 1] + 1, order[at] + 1
                grown[count + at] = 1 + np.minimum.reduceat(held, np.column_stack((low, high)).ravel())[::2]
        wider = np.zeros(total, kind)
        wider[old] = before
        place[active] = count + mine
        before, common = wider, grown
    near = common >= least
    near[:-1] |= common[1:] >= least
    order = np.argsort(before, kind="stable")
    rank = np.empty(len(before), np.int64)
    rank[order[len(before) - np.count_nonzero(before):]] = np.arange(count, len(before))
    flags = np.zeros(text.shape, bool)
    at = np.arange(count)
    for column in range(text.shape[1]):
        active = np.flatnonzero(sizes > column)
        at[active] = rank[at[active]]
        flags[active, column] = near[at[active]]
    out = []
    for i, s in enumerate(strings):
        mine = np.zeros(len(s) + unit, bool)
        for offset in range(unit):
            row = unit * i + offset
            mine[offset:offset + unit * sizes[row]:unit] = flags[row, :sizes[row]][::-1]
        out.append(mine[:max(len(s) - length + 1, 0)])
    return out


def _scan(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                rows = [segments(data[a:b], length, K) for a, b in zip(offsets[:-1], offsets[1:])]
                each = [len(r[0]) for r in rows]
                start, windows, key, content, twice = (np.concatenate(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.asarray(part.column("uid")), each)), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(twice)],
                    names=["uid", "start", "windows", "key", "content", "twice"])

    return docs.mapInArrow(run, "uid long, start int, windows int, key long, content long, twice boolean")


def _fetch(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, content, many, held) with the bytes of each wanted segment."""
    lists = wanted.groupBy("uid").agg(F.collect_list(F.struct("start", "windows", "key", "content", "many")).alias("parts"))
    both = docs.join(lists, "uid").select(F.col("text").cast("binary").alias("text"), "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pydict()
                out = [(p["key"], p["content"], p["many"], t[p["start"]:p["start"] + p["windows"] + length - 1])
                       for t, parts in zip(part["text"], part["parts"]) for p in parts]
                columns = zip(*out) if out else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                                                 names=["key", "content", "many", "held"])

    return both.mapInArrow(run, "key long, content long, many boolean, held binary")


def _order(held: DataFrame, length: int) -> DataFrame:
    """(key, content, places): the repeated windows of the segments, bucket by bucket of whole keys."""

    def solve(rows):
        flags = repeated_windows([r[2] for r in rows], length)
        kept = [(r[0], r[1], np.flatnonzero(f).astype(np.int32)) for r, f in zip(rows, flags) if f.any()]
        columns = zip(*kept) if kept else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int32())))],
                                          names=["key", "content", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, size, group = [], 0, []
        for batch in batches:
            for row in zip(batch.column("key").to_pylist(), batch.column("content").to_pylist(), batch.column("held").to_pylist()):
                if group and group[-1][0] != row[0]:
                    bucket += group
                    size += sum(len(r[2]) for r in group)
                    group = []
                    if size >= BUCKET:
                        yield solve(bucket)
                        bucket, size = [], 0
                group.append(row)
        if bucket or group:
            yield solve(bucket + group)

    # equal segments that two rows with one uid brought are one
    tasks = 4 * int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the work is far more than the bytes tell
    rows = held.dropDuplicates(["key", "content"]).repartition(tasks, "key").sortWithinPartitions("key").select("key", "content", "held")
    return rows.mapInArrow(run, "key long, content long, places array<int>")


def _windows(held: DataFrame, length: int) -> DataFrame:
    """(key, content, places) for keys of many segments: equal windows counted by hash, over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes = [gram_hashes(prefix_sums(np.frombuffer(h, np.uint8)), length) for h in part.column("held").to_pylist()]
                each = [len(h) for h in hashes]
                if sum(each):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.asarray(part.column(c)), each)) for c in ("key", "content")]
                        + [pa.array(np.concatenate([np.arange(e, dtype=np.int32) for e in each])), pa.array(np.concatenate(hashes).view(np.int64))],
                        names=["key", "content", "place", "window"])

    rows = stage_table(held.select("key", "content", "held").dropDuplicates(["key", "content"]).mapInArrow(run, "key long, content long, place int, window long"), "windows")
    counts = rows.groupBy("key", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return rows.join(counts, ["key", "window"]).groupBy("key", "content").agg(F.collect_list("place").alias("places"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 400, key: str = "doc_id") -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans) of every row.

    Each byte inside a ``length``-byte string that also starts anywhere else, in the same text or another, is removed; all strings
    are judged on the input. Texts are UTF-8 bytes, null counts as empty. Shorter texts keep everything. Repeated rows are separate
    texts, so they repeat each other. Null identifiers are kept. Other columns are left out.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("uid", F.xxhash64("doc_id", "text"))
    parts = stage_table(_scan(docs.select("uid", "text"), length), "segments")
    spot = F.struct("uid", "start", "windows")
    contents = parts.groupBy("key", "content").agg(F.min(spot).alias("spot"), F.max(spot).alias("last"), F.bool_or("twice").alias("twice"))
    contents = contents.select("key", "content", "spot", "twice", (F.col("spot") != F.col("last")).alias("multiple"))
    sizes = F.count(F.lit(1)).over(Window.partitionBy("key"))
    contents = stage_table(contents.withColumn("n", sizes).filter("n > 1 or multiple or twice"), "contents")
    wanted = contents.filter("n > 1 or (twice and not multiple)").select("spot.*", "key", "content", (F.col("n") > MANY).alias("many"))
    held = stage_table(_fetch(docs, wanted, length), "held")
    found = _order(held.filter("not many"), length).union(_windows(held.filter("many"), length))
    whole = contents.filter("multiple").select("key", "content", F.lit(None).cast("array<int>").alias("places"))
    single = found.join(contents.filter("multiple").select("key", "content"), ["key", "content"], "left_anti")
    marks = parts.join(whole.union(single), ["key", "content"]).select("uid", F.struct("start", "windows", "places").alias("mark"))
    marks = stage_table(marks.distinct().groupBy("uid").agg(F.collect_list("mark").alias("marks")), "marks")
    copies = docs.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("uid", F.lit(True).alias("copied"))
    extra = marks.join(copies, "uid", "full").select("uid", "marks", F.coalesce("copied", F.lit(False)).alias("copied"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = [remove(t, m or [], c, length) for t, m, c in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)))]
                kept, spans = zip(*rows)
                sizes = [len(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64()),
                     pa.array(spans, pa.int64())], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    rows = docs.join(extra, "uid", "left").select("doc_id", F.col("text").cast("binary").alias("text"), "marks", F.coalesce("copied", F.lit(False)).alias("copied"))
    return rows.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def remove(text: bytes, marks: list[dict], copied: bool, length: int) -> tuple[bytes, int]:
    """What is left of a text, and how many maximal runs went."""
    n = len(text)
    if n < length or not (marks or copied):
        return text, 0
    steps = np.zeros(n + 1, np.int32)
    if copied:
        steps[0], steps[n] = 1, -1
    for m in marks:
        places = m["start"] + (np.arange(m["windows"]) if m["places"] is None else np.array(m["places"], np.int64))
        np.add.at(steps, places, 1)
        np.add.at(steps, places + length, -1)
    gone = np.cumsum(steps)[:n] > 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
