"""Documents whose sets of word shingles are alike, joined through parity sketches.

A set's sketch holds the parity of the tokens hashed to each bit, so two sketches differ in at most as many bits as the
sets differ in tokens. Sets of similarity s and sizes a <= b differ in at most (1 - s) / (1 + s) * (a + b) tokens, d.
Per size band a very wide sketch is cut into blocks (its words are kept as the XOR of token hashes); of more than d
blocks two linked sets share one, so equal words of equal blocks are the only candidates. The blocks of tokens that are
common in the corpus come last; this order decides which d + 1 non-empty blocks a set shows, not what is found. A
set with too few non-empty blocks also shows its first tokens in the same order, so many that a partner of like kind must
share one. Candidates are first held to the least set
of their block word; then only pairs in different components are looked at, first by a short foldable sketch, then by
a long one, then by their tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.llm.narrow import components, join_narrow, merged, most_frequent, small_batches
from urlsieve.llm.words import chunks, give_back, mix, shingles, word_hashes
from urlsieve.session import stage_table

BLOCKS = 1.0
#: Tokens are counted in stretches of so many; only the order of blocks depends on it.
STRETCH = 1 << 21
#: Sets that a set is held to per turn, before what is left meets directly.
CENTRES = 3
COMMON_ROWS = 300_000
GROUP = 128
SLICE = 32 * GROUP


def token_sets(batch: pa.RecordBatch, text: str, k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of rows with the sorted distinct shingle hashes of each."""
    for part, data, offsets in chunks(batch, text):
        hashes, _, first = word_hashes(data, offsets)
        all_, begin = shingles(hashes, first, k)
        yield part, [np.unique(all_[begin[i]:begin[i + 1]]) for i in range(part.num_rows)]


def set_id(tokens: np.ndarray) -> int:
    weighed = np.add.reduce(mix(tokens ^ np.uint64(0xA5A5))) + np.uint64(len(tokens)) if len(tokens) else np.uint64(0)
    return int(mix(np.array([weighed], np.uint64)).view(np.int64)[0])


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of tokens per bit; a power of two of bits, at least four times as many as tokens. Folding halves it.

    Linked sets of n tokens (at 0.75) differ in at most 2n / 7 bits; at that distance a pair has a similarity of 0.73 on average.
    """
    bits = 64
    while bits < 4 * len(tokens):
        bits *= 2
    return np.packbits(np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def shortened(long: bytes, tokens: int) -> bytes:
    """The sketch folded to about as many bits as tokens, for where sets are many; at the bound a pair has a similarity of 0.65 on average."""
    x = np.frombuffer(long, np.uint8)
    while len(x) > 8 and 4 * len(x) >= max(tokens, 64):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x.tobytes()


def differ(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def signatures(tokens: np.ndarray, common: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the shown block words in the bands where the set can meet a partner. Similarity is num / den."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    often = np.zeros(n, bool)
    if len(common):
        at = np.searchsorted(common, tokens)
        often = common[np.minimum(at, len(common) - 1)] == tokens
    most = n * den // num
    own = (n - 1).bit_length()
    out = []
    for band in range(own, (most - 1).bit_length() + 1 if most > 1 else own + 1):
        top = 1 << band
        d = (den - num) * (n + min(most, top)) // (den + num)
        m = max(1, int(BLOCKS * top) + 1)
        block = (mix(tokens ^ np.uint64(band)) % np.uint64(m)).astype(np.int64) + m * often
        order = np.argsort(block, kind="stable")
        ids, start = np.unique(block[order], return_index=True)
        words = np.bitwise_xor.reduceat(mix(tokens + np.uint64(0x51ED))[order], start)
        seed = np.uint64(band * 0x9E3779B1)
        out.append(mix(mix(words) + ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)[:d + 1])
        if len(ids) <= d:
            shown = np.lexsort((tokens, often))[:n - -(-num * n // den) + 1]
            out.append(mix(tokens[shown] + seed * np.uint64(77) + np.uint64(1)))
    return np.unique(np.concatenate(out))


def scan_sets(docs: DataFrame, text: str, k: int) -> tuple[DataFrame, DataFrame]:
    """One pass over the texts: (doc_id, n, set_id, sketch, short) of every row, and the counts of frequent tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def frequent():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 3
            none = pa.nulls(int(often.sum()), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, pa.array(tokens[often].view(np.int64)), pa.nulls(len(none), pa.binary()), pa.nulls(len(none), pa.binary()), pa.array(counts[often])],
                names=["doc_id", "n", "set_id", "sketch", "short", "times"])

        for batch in batches:
            for part, sets in token_sets(batch, text, k):
                ids, long = [set_id(s) for s in sets], [sketch(s) for s in sets]
                for s, i in zip(sets, ids):
                    if len(s) and i not in seen:
                        held.append(s)
                        size += len(s)
                        seen.add(i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()),
                     pa.array(long, pa.binary()), pa.array([shortened(x, len(s)) for x, s in zip(long, sets)], pa.binary()), pa.nulls(len(ids), pa.int64())],
                    names=["doc_id", "n", "set_id", "sketch", "short", "times"])
                if size >= STRETCH:
                    yield frequent()
                    held, size, seen = [], 0, set()
        if held:
            yield frequent()
        held.clear()
        give_back()

    both = stage_table(docs.select("doc_id", text).mapInArrow(run, "doc_id long, n long, set_id long, sketch binary, short binary, times long"), "sets")
    counts = both.filter("times is not null").groupBy(F.col("set_id").alias("token")).agg(F.sum("times").alias("times"))
    return both.filter("times is null").drop("times"), counts


def common_tokens(counts: DataFrame, rows: int = COMMON_ROWS) -> np.ndarray:
    """The most frequent tokens, at most ``rows`` of them; fewer only change the order of blocks."""
    top = most_frequent(counts, "times", rows).select("token").toPandas()
    return np.sort(top.token.to_numpy(np.int64).view(np.uint64))


def signature_rows(docs: DataFrame, text: str, k: int, common, num: int, den: int) -> DataFrame:
    """(sig, set_id), each set once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, sets in token_sets(batch, text, k):
                sigs, owners = [], []
                for s in sets:
                    i = set_id(s)
                    if i in seen or not len(s):
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(i)
                    sigs.append(signatures(s, common.value, num, den))
                    owners.append(np.full(len(sigs[-1]), i, np.int64))
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(owners))], names=["sig", "set_id"])
        seen.clear()
        give_back()

    return docs.select(F.col(text).alias(text)).mapInArrow(run, "sig long, set_id long")


def held_tokens(docs: DataFrame, text: str, k: int, needed: DataFrame) -> DataFrame:
    """(set_id, tokens) of some sets; ``needed`` has set_id and the doc_id of a text with that set."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in token_sets(batch, text, k):
                ids = pa.array([set_id(s) for s in found], pa.int64())
                out = pa.RecordBatch.from_arrays([ids, pa.array([s.tobytes() for s in found], pa.binary())], names=["set_id", "tokens"])
                yield out.filter(pc.equal(ids, part.column("set_id")))

    texts = join_narrow(docs.select("doc_id", F.col(text).alias(text)), needed, "doc_id").select("set_id", text)
    return stage_table(texts.mapInArrow(tokens, "set_id long, tokens binary").dropDuplicates(["set_id"]), "tokens")


def verify(pairs: DataFrame, brief: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those (a, b) of set ids that link: the sketches' distance is held to the bound, then the tokens are intersected.

    Tokens take more room than the texts, so they are made only for sets of pairs within the bound.
    """
    left, right = (brief.select(F.col("set_id").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    fits = join_narrow(join_narrow(pairs, left, "a"), right, "b").filter(F.expr(f"{den} * least(na, nb) >= {num} * greatest(na, nb)"))
    fits = stage_table(fits, "fits")
    named = join_narrow(brief.select("set_id", "sketch"), fits.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "set_id")
    sized = fits.join(named.select(F.col("set_id").alias("a"), F.col("sketch").alias("sa")), "a").join(named.select(F.col("set_id").alias("b"), F.col("sketch").alias("sb")), "b")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            d = t.to_pydict()
            keep = [(den - num) * (p + q) >= (den + num) * differ(x, y) for p, x, q, y in zip(d["na"], d["sa"], d["nb"], d["sb"])]
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = stage_table(sized.mapInArrow(close, "a long, b long"), "near")
    owners = near.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    held = held_tokens(docs, "text", k, brief.join(owners, "set_id").select("set_id", "doc_id"))
    full = near.join(held.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb")), "b") \
        .join(held.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta")), "a")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for x, y in zip(t.column("ta"), t.column("tb")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "ta", "tb").mapInArrow(exact, "a long, b long")


def still_open(met: DataFrame, label: DataFrame) -> DataFrame:
    """(sig, set_id, label, n) of the words whose sets are in different components; n is the word's number of sets in ``met``.

    Of words that show exactly the same sets (a shared passage has many) one
    stays: the others would compare them again.
    """
    placed = join_narrow(met.select("sig", "set_id"), label.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    members = [F.bit_xor(F.xxhash64("set_id", F.lit(i))).alias(f"m{i}") for i in (1, 2)]
    mixed = placed.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"), *members)
    asked = mixed.filter("low <> high").groupBy("n", "m1", "m2").agg(F.min("sig").alias("sig"))
    return stage_table(placed.join(asked.select("sig", "n"), "sig"), "open")


def met_in_groups(open_: DataFrame, brief: DataFrame, column: str) -> DataFrame:
    """(sig, items, others): lists of a word's sets with a sketch, each pair of lists that have to meet; ``others`` is null for a list with itself.

    A word's sets are dealt into groups of about GROUP; most words need one, and no join. A component with more sets than that in a
    word has groups of its own there, which don't meet each other. A word of over SLICE sets is dealt into slices that meet all of it,
    each in one task.
    """
    named = brief.select("set_id", F.col("n").alias("size"), F.col(column).alias("sketch"))
    large = stage_table(open_.filter(f"n > {GROUP}").groupBy("sig", "label").agg(F.count(F.lit(1)).alias("c")), "shares")
    loose = large.groupBy("sig").agg(F.sum(F.expr(f"if(c > {GROUP}, 0, c)")).alias("loose"))
    large = large.join(loose, "sig")
    rows = open_.filter(f"n > {GROUP}").join(large, ["sig", "label"])
    own = F.xxhash64("label", F.pmod(F.xxhash64("set_id"), F.ceil(F.col("c") / GROUP)))
    group = F.when(F.col("c") > GROUP, own).otherwise(F.pmod(F.xxhash64("label"), F.ceil(F.col("loose") / GROUP)))
    rows = rows.select(*open_.columns, group.alias("group")).unionByName(open_.filter(f"n <= {GROUP}").withColumn("group", F.lit(0).cast("long")))
    sized = rows.join(join_narrow(named, open_.select("set_id").distinct(), "set_id"), "set_id")
    items = F.collect_list(F.struct("set_id", "label", "size", "sketch"))
    lists = stage_table(sized.groupBy("sig", "n", "group").agg(items.alias("items"), F.min("label").alias("low"), F.max("label").alias("high")), "groups")
    several = lists.filter(f"n > {GROUP}").withColumn("slices", F.ceil(F.col("n") / SLICE))
    left = several.select("sig", F.pmod(F.xxhash64("group"), "slices").alias("slice"), "group", "items", "low", "high")
    right = several.select("sig", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), *[F.col(c).alias(f"{c}_b") for c in ("group", "items", "low", "high")])
    pairs = left.repartition("sig", "slice").join(right.repartition("sig", "slice"), ["sig", "slice"])
    pairs = pairs.filter("group <= group_b and least(low, low_b) < greatest(high, high_b)")
    return pairs.select("sig", "items", F.col("items_b").alias("others")).union(lists.filter(f"n <= {GROUP}").select("sig", "items", F.lit(None).alias("others")))


def with_partner(open_: DataFrame, brief: DataFrame, num: int, den: int) -> DataFrame:
    """(sig, set_id) of the words and their sets that share it with a set of another component whose short sketch is near enough.

    A task compares two groups as matrices of sketch bits and names sets, not pairs. The groups of a word come one after another,
    and a set is named there once, so there are no more rows than sets in words, once a slice.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, named = None, set()
        for batch in batches:
            sigs, sets = [], []
            for sig, xs, ys in listed(batch, "sig", "items", "others"):
                if sig != word:
                    word, named = sig, set()
                found = set()
                for _, fits, one, other, _, _ in near(xs, ys, num, den):
                    found.update(one[fits.any(axis=1)].tolist(), other[fits.any(axis=0)].tolist())
                fresh = found - named
                named |= fresh
                sigs += [sig] * len(fresh)
                sets += fresh
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(sets, pa.int64())], names=["sig", "set_id"])

    return met_in_groups(open_, brief, "short").mapInArrow(compare, "sig long, set_id long").distinct()


def across(open_: DataFrame, brief: DataFrame, num: int, den: int, forest: bool = False) -> DataFrame:
    """(a, b) of sets that share a word, are in different components and whose long sketches are near enough.

    Sets that share many words meet in each; a task lets them out once. With ``forest`` a task lets out a pair only if it joins two
    components that no earlier pair of the task joined, nearest pairs first: fewer rows than sets.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        root: dict[int, int] = {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        def joins(pair):
            x, y = find(pair[3]), find(pair[4])
            root[x] = y
            return x != y

        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                found = np.concatenate([near_pairs(xs, ys, num, den) for xs, ys in listed(batch.slice(at, 16), "items", "others")], axis=1)
                if forest:
                    found = found[:, np.lexsort(found[2::-1])]
                    first = np.unique(np.sort(found[3:], axis=0), axis=1, return_index=True)[1]  # the nearest of two components
                    out = [x[1:3] for x in found[:, np.sort(first)].T.tolist() if joins(x)]
                else:
                    out = list(set(map(tuple, np.unique(found[1:3], axis=1).T.tolist())) - seen)
                    if len(seen) > 300_000:
                        seen.clear()
                    seen.update(out)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return met_in_groups(open_, brief, "sketch").mapInArrow(compare, "a long, b long").distinct()


def listed(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The rows' values; lists stay arrays, and null is the row's first list."""
    for i in range(batch.num_rows):
        row = [batch.column(c)[i] for c in columns]
        lists = [getattr(x, "values", None) if pa.types.is_list(x.type) else x.as_py() for x in row]
        yield tuple(lists[-2] if x is None else x for x in lists)


def by_length(items: pa.StructArray) -> Iterator[tuple[np.ndarray, ...]]:
    """(sketches as a matrix of bytes, set_id, label, size) of the sets whose sketches have one length, length by length."""
    ids, label, size, sketches = items.flatten()
    ids, label, size, lengths = (np.asarray(x) for x in (ids, label, size, pc.binary_length(sketches)))
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        flat = np.frombuffer(b"".join(sketches.take(pa.array(at)).to_pylist()), np.uint8)
        yield flat.reshape(len(at), width), ids[at], label[at], size[at]


def near(xs: pa.StructArray, ys: pa.StructArray, num: int, den: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bits, fits, sets of xs, sets of ys, their labels): how many bits the sketches differ in and whether sizes, bits and labels allow a link.

    Longer sketches are folded to one length per pair of lengths.
    """
    if pc.min(label := pa.concat_arrays([xs.flatten()[1], ys.flatten()[1]])).as_py() == pc.max(label).as_py():
        return  # one component
    mine, theirs = list(by_length(xs)), list(by_length(ys))
    for x, one, l, p in mine:
        for y, other, m, q in theirs:
            width = min(x.shape[1], y.shape[1])
            a, b = (np.ascontiguousarray(np.bitwise_xor.reduce(s.reshape(len(s), -1, width), axis=1)).view(np.uint64) for s in (x, y))
            fits = l[:, None] != m
            fits &= den * np.minimum(p[:, None], q) >= num * np.maximum(p[:, None], q)
            if fits.any():
                apart = np.zeros(fits.shape, np.int32)
                for j in range(a.shape[1]):
                    apart += np.bitwise_count(a[:, None, j] ^ b[None, :, j])
                fits &= (den - num) * (p[:, None] + q) >= (den + num) * apart
                yield apart, fits, one, other, l, m


def near_pairs(xs: pa.StructArray, ys: pa.StructArray, num: int, den: int) -> np.ndarray:
    """Rows bits, a, b, component of a, component of b: the pairs across components whose sizes and sketches allow a link, a being the lesser."""
    out = [np.zeros((5, 0), np.int64)]
    for apart, fits, one, other, l, m in near(xs, ys, num, den):
        i, j = np.nonzero(fits)
        turned = one[i] > other[j]
        sides = [np.where(turned, z, w) for w, z in ((one[i], other[j]), (other[j], one[i]), (l[i], m[j]), (m[j], l[i]))]
        out.append(np.stack([apart[i, j], *sides]))
    return np.concatenate(out, axis=1)


def asked(proposals: DataFrame) -> DataFrame:
    """(a, b) of the CENTRES first distinct proposals (h, a) of every set."""
    few = proposals.groupBy("set_id").agg(F.slice(F.array_sort(F.collect_set("c")), 1, CENTRES).alias("few")).select("set_id", F.explode("few").alias("c"))
    return few.select(F.least("c.a", "set_id").alias("a"), F.greatest("c.a", "set_id").alias("b")).distinct()


def first_pairs(met: DataFrame) -> DataFrame:
    """(a, b) of the sets that meet first, from (sig, set_id, least, several).

    In a word of two sets these are a pair, all of which are taken: no later step looks at such words, and there is one pair a word
    at most. In a word of several, every set is held to the least one, to CENTRES of them at most; the turns and the direct
    meeting take the rest.
    """
    held = met.filter("set_id <> least")
    star = asked(held.filter("several").select("set_id", F.struct(F.col("least").alias("h"), F.col("least").alias("a")).alias("c")))
    return star.union(held.filter("not several").select(F.col("least").alias("a"), F.col("set_id").alias("b"))).distinct()


def similar_documents(docs: DataFrame, text: str = "text", k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; documents link when den * intersection >= num * union.

    Texts without words (null and empty ones too) have no shingles and link with nothing. Equal sets count as one and
    are linked. Rows with a null doc_id get a null component; repeated identifiers keep their rows. Other columns are
    left out.
    """
    spark = docs.sparkSession
    docs = small_batches(docs.select("doc_id", F.col(text).alias("text")))
    rows, counts = scan_sets(docs, "text", k)
    common = spark.sparkContext.broadcast(common_tokens(counts))
    sets = rows.filter("n > 0 and doc_id is not null")
    group = Window.partitionBy("sig")
    shown = signature_rows(docs.filter("doc_id is not null"), "text", k, common, num, den)
    met = shown.withColumn("least", F.min("set_id").over(group)).withColumn("most", F.max("set_id").over(group)).filter("least <> most")
    met = met.withColumn("several", F.max((F.col("set_id") != F.col("least")) & (F.col("set_id") != F.col("most"))).over(group))
    met = stage_table(met.select("sig", "set_id", "least", "several").distinct(), "met")  # dealt by sig already
    brief = sets.groupBy("set_id").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("short").alias("short"), F.min("doc_id").alias("doc_id"))
    brief = stage_table(brief.join(met.select("set_id").distinct(), "set_id"), "brief")
    star = stage_table(first_pairs(met), "star")
    several = met.filter("several")  # words of two sets have met
    label, turn = components(verify(star, brief, docs, k, num, den)), 0
    while True:
        open_ = still_open(several, label)
        turn += 1
        # sets are held to sets of other components in their words, in an order that is new in each turn, for as long as that links many
        rank = F.xxhash64("set_id", F.lit(turn))
        centre = open_.groupBy("sig").agg(F.min(F.struct(rank.alias("h"), F.col("set_id").alias("a"), F.col("label").alias("la"))).alias("c"))
        star = stage_table(asked(open_.join(centre, "sig").filter("label <> c.la").select("set_id", F.struct("c.h", "c.a").alias("c"))), "star")
        more = stage_table(verify(star, brief, docs, k, num, den), "edges")
        label = merged(label, more)
        if more.count() * 10 <= star.count():
            break
    # whatever the stars left in different components meets directly: forests of near pairs first, for as long as these link many
    left = stage_table(with_partner(still_open(several, label), brief, num, den), "left")
    forest = True
    while True:
        pairs = stage_table(across(still_open(left, label), brief, num, den, forest), "pairs")
        more = stage_table(verify(pairs, brief, docs, k, num, den), "edges")
        label = merged(label, more)
        if not forest:
            break
        forest = more.count() * 4 > pairs.count()
    known = sets.groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    known = known.join(label.withColumnRenamed("id", "set_id"), "set_id", "left").filter("copies > 1 or label is not null")
    known = known.withColumn("label", F.coalesce("label", "set_id"))
    least = known.groupBy("label").agg(F.min("first").alias("component_id"))
    placed = join_narrow(rows.drop("sketch", "short"), known.join(least, "label").select("set_id", "component_id"), "set_id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
