"""Personal data in whole texts: checked base patterns, and further spans chosen by boosted trees; DataFrame only.

Generators propose spans beyond the base formats. Boosted trees, learnt from base candidates and proposals that pass or fail
their check, see format and context only (never the check itself) and are compiled to one column expression; a threshold per
kind, calibrated on the other half of the documents, decides which proposals are added. Base spans always stay. All work on a
document stays in its row: nothing is exploded or shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.session import stage_table

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_HEX = "[0-9A-Fa-f]{1,4}"
#: The base patterns, written so that no input makes them backtrack or recurse: possessive, begun at a run's start.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: (what a text must hold, pattern, whether the base check is asked too) of the generators beyond the base formats; their
#: spans can overlap each other and base matches that failed.
MORE = {
    "email": [(r"[\[(](?:at|AT)[\])]", rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{{1,63}}+(?:(?: ?[\[(](?:dot|DOT)[\])] ?|\.)[A-Za-z0-9-]{{2,63}}+){{1,4}}+", False)],
    "ip": [(r":[0-9A-Fa-f]{1,4}:", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", False),
           ("::", rf"(?<![0-9A-Za-z:])(?:{_HEX}(?::{_HEX}){{0,6}}+::(?:{_HEX}(?::{_HEX}){{0,6}}+)?|::{_HEX}(?::{_HEX}){{0,6}}+)(?![0-9A-Za-z:])", False),
           (r"[0-9]\.[0-9]", rf"(?<![0-9]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])", True)],
    "card": [(r"[0-9][./_][0-9]{4}[./_]", r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", True),
             (r"[0-9][./_][0-9]{2,7}[./_ -]", r"(?<![0-9])[0-9]{2,7}(?:[ ./_-][0-9]{2,7}){1,7}(?![0-9])", True)],
    "phone": [(r"[0-9][-. ][0-9]{4}", r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])", False),
              (r"[0-9][-. )/][0-9 ]", r"(?<![0-9+])(?:\([0-9]{1,5}\)[ -]?|[0-9]{2,5}[-. /])[0-9]{2,8}(?:[-. ][0-9]{2,8}){0,4}(?![0-9])", True)],
}
_EMPTY = "cast(array() as array<struct<start:int,kind:int,end:int,held:string>>)"


def _located(text: Column, pattern: str, kind: int, gate: Column) -> Column:
    """array<struct<start, kind, end, held>> of the leftmost non-overlapping matches, in code points.

    Matches and the gaps between them come from two passes of the pattern, the second one only where something matched.
    """
    matches = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.expr(_EMPTY).alias("out"))

    def add(acc, x):
        begin = acc["at"] + x["g"]
        end = begin + F.length(x["m"])
        one = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("held"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, add, lambda acc: acc["out"])).otherwise(F.expr(_EMPTY))


def _digits(held: Column) -> Column:
    return F.regexp_replace(held, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""
    parts = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: Column, held: Column) -> Column:
    """The base check of a match."""
    digits = _digits(held)
    return (F.when(kind == 1, held.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
            .when(kind == 2, F.length(digits).between(12, 19) & luhn(digits))
            .when(kind == 3, F.length(digits).between(9, 15)).otherwise(F.lit(True)))


def base_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and ``_matches``: every base match, whether or not it passes its check."""
    body = F.coalesce(docs[text], F.lit(""))
    gates = (F.contains(body, F.lit("@")), body.rlike(r"[0-9]\.[0-9]"), body.rlike("[0-9]"), F.contains(body, F.lit("+")))
    return docs.withColumn("_matches", F.concat(*[_located(body, BASE[k], i, gates[i]) for i, k in enumerate(KINDS)]))


def _card_windows(m: Column) -> Column:
    """Spans inside a card match, at borders of its groups, that pass the check.

    Only the runs of groups with at most 19 digits that end at the present group are held, so the work is linear.
    """
    window = "array<struct<at: int, digits: string>>"
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {window})").alias("open"), F.expr(_EMPTY).alias("out"))

    def add(acc, group):
        end = acc["at"] + F.length(group)
        longer = F.transform(acc["open"], lambda w: F.struct(w["at"].alias("at"), F.concat(w["digits"], group).alias("digits")))
        open_ = F.filter(F.concat(longer, F.array(F.struct(acc["at"].alias("at"), group.alias("digits")))), lambda w: F.length(w["digits"]) <= 19)
        good = F.filter(open_, lambda w: (F.length(w["digits"]) >= 12) & luhn(w["digits"]))
        spans = F.transform(good, lambda w: F.struct(
            (m["start"] + w["at"]).alias("start"), F.lit(2).alias("kind"), (m["start"] + end).alias("end"), F.substring(m["held"], w["at"] + 1, end - w["at"]).alias("held")))
        return F.struct((end + 1).alias("at"), open_.alias("open"), F.concat(acc["out"], spans).alias("out"))

    return F.aggregate(F.split(m["held"], "[ -]"), start, add, lambda acc: acc["out"])


def _phone_windows(m: Column) -> Column:
    """Spans of a phone match from its sign to the end of a group of digits, with as many digits as the check wants.

    Only the first 15 digits and what stands between them can matter.
    """
    held = F.regexp_extract(m["held"], r"^\+(?:[^0-9]*+[0-9]){1,15}+(?![0-9])|^\+(?:[^0-9]*+[0-9]){1,15}", 0)
    ends = F.filter(F.sequence(F.lit(10), F.greatest(F.length(held), F.lit(10))), lambda i: F.substring(held, i, F.lit(1)).rlike("[0-9]") & ~F.substring(m["held"], i + 1, F.lit(1)).rlike("[0-9]"))
    spans = F.transform(ends, lambda i: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), (m["start"] + i).alias("end"), F.substring(held, F.lit(1), i).alias("held")))
    return F.filter(spans, lambda x: passes(x["kind"], x["held"]))


def _inside_failed(failed: Column) -> Column:
    """Spans inside base matches that failed their check."""
    cards = F.filter(failed, lambda m: (m["kind"] == 2) & (F.length(_digits(m["held"])) > 12) & m["held"].rlike("[ -]"))
    phones = F.filter(failed, lambda m: (m["kind"] == 3) & (F.length(_digits(m["held"])) > 15))
    return F.flatten(F.concat(F.transform(cards, _card_windows), F.transform(phones, _phone_windows)))


FEATURES = ("digits", "length", "letters", "separators", "before_letter", "before_space", "after_letter", "after_space", "before_word", "before_sign", "kind")
_WORDS = "(?i)(?:mail|phone|tel|call|card|visa|pay|ip|host|server|addr|contact)"


def _features(span: Column, text: Column) -> Column:
    held, left = span["held"], F.substring(text, F.greatest(span["start"] - F.lit(23), F.lit(1)), F.least(span["start"], F.lit(24)))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    count = lambda c, cls: F.length(F.regexp_replace(c, f"[^{cls}]", "")).cast("double")
    flag = lambda c: c.cast("double")
    return F.array(count(held, "0-9"), F.length(held).cast("double"), count(held, "A-Za-z"), count(held, " ().:/_-"),
                   flag(left.rlike("[A-Za-z]$")), flag(left.rlike(r"\s$")), flag(after.rlike("^[A-Za-z]")), flag(after.rlike(r"^\s")),
                   flag(left.rlike(_WORDS)), flag(left.rlike("[:=#]\\s*$")), span["kind"].cast("double"))


@dataclass(frozen=True)
class Trees:
    """Boosted trees as nested (feature, bound, left, right) or leaf values, their weights, and a threshold, or one per kind."""

    trees: tuple
    weights: tuple
    threshold: float
    by_kind: tuple = ()

    def takes(self, span: Column, text: Column) -> Column:
        """Whether a proposed span's score reaches the threshold of its kind."""
        least = F.element_at(F.array(*map(F.lit, self.by_kind)), span["kind"] + 1) if self.by_kind else F.lit(self.threshold)
        return self.score(_features(span, text)) >= least

    def score(self, features: Column) -> Column:
        total = reduce(lambda a, b: a + b, [_tree(t, features) * F.lit(w) for t, w in zip(self.trees, self.weights)], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * total))


#: Adds nothing.
NONE = Trees((), (), 2.0)


def _tree(node, features: Column) -> Column:
    if isinstance(node, float):
        return F.lit(node)
    j, bound, left, right = node
    return F.when(features[j] <= bound, _tree(left, features)).otherwise(_tree(right, features))


def _nested(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _nested(node.leftChild()), _nested(node.rightChild())


#: Scores are calibrated in steps of 1 / STEPS, rounded down, so that what counted as good is taken when met again.
STEPS = 100
#: A kind with fewer spans than this in the calibration half takes the threshold of all kinds together.
ENOUGH = 20
#: How often digits at random pass the check of a kind, where the check rules chance out.
BY_CHANCE = {"card": 0.1}


def least_share(kind: str, precision: float) -> float:
    """The share of all spans that must pass for those that pass to have the wanted precision.

    Proposals of a kind with a check must pass it as well. If a share f of all passes and c does by chance, (f - c) / ((1 - c) f)
    of those that pass are meant. Where chance says nothing, the share is the precision.
    """
    c = BY_CHANCE.get(kind)
    return precision if c is None else c / (1 - precision * (1 - c))


def checkable(text: Column) -> Column:
    """The proposals, beyond the base matches, whose kind has a check, before that check."""
    return F.concat(*[_located(text, pattern, i, text.rlike(gate)) for i, k in enumerate(KINDS) for gate, pattern, checked in MORE[k] if checked])


def least_threshold(steps: list, share: float) -> float:
    """The least score down to which the share of good spans stays at ``share`` or more; ``steps``: (step, n, good)."""
    n = good = 0
    best = 2.0
    for step, count, right in sorted(steps, reverse=True):
        n, good = n + count, good + right
        if good >= share * n:
            best = step / STEPS
    return best


def fit_trees(docs: DataFrame, text: str = "text", precision: float = 0.9, rounds: int = 8, depth: int = 3) -> Trees:
    """Learn from all documents.

    Examples are base matches and the generators' proposals of a kind with a check, labelled by that check. The documents whose
    text has an even hash fit the trees; on the others each kind's least threshold with the wanted precision is chosen. If there is
    none, or one class is missing, nothing is ever added. Equal examples are counted, on the map side, and become one row with a
    weight, so what the trees are fitted on grows with the examples that differ.
    """
    met = base_candidates(docs.select(F.col(text).alias("body")).filter("body is not null"), "body")
    every = F.filter(F.array_distinct(F.concat("_matches", checkable(F.col("body")))), lambda m: F.length(m["held"]) >= 7)
    example = lambda m: F.struct(m["kind"].alias("kind"), passes(m["kind"], m["held"]).cast("double").alias("label"), _features(m, F.col("body")).alias("f"))
    rows = met.select((F.xxhash64("body") % 2 == 0).alias("first"), F.explode(F.transform(every, example)).alias("e")).select("first", "e.*")
    rows = stage_table(rows.groupBy("first", "kind", "label", "f").agg(F.count(F.lit(1)).alias("n")), "examples")
    seen = {(r.first, r.label) for r in rows.select("first", "label").distinct().collect()}
    if len(seen) < 4:
        return NONE
    learn = rows.filter("first").select("label", F.col("n").cast("double").alias("n"), array_to_vector("f").alias("x"))
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=rounds, maxDepth=depth, maxBins=32, seed=7).fit(learn)
    made = model._java_obj.trees()
    trees = Trees(tuple(_nested(made[i].rootNode()) for i in range(len(made))), tuple(float(w) for w in model.treeWeights), 2.0)
    step = F.floor(trees.score(F.col("f")) * STEPS).alias("step")
    scored = rows.filter("not first").select("kind", "label", "n", step).groupBy("kind", "step").agg(
        F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good")).collect()  # at most 101 rows a kind
    every = least_threshold(_by_step(scored), precision)
    by_kind = [[r for r in scored if r.kind == k] for k in range(len(KINDS))]
    return Trees(trees.trees, trees.weights, every, tuple(
        least_threshold(_by_step(p), least_share(k, precision)) if sum(r.n for r in p) >= ENOUGH else every for k, p in zip(KINDS, by_kind)))


def _by_step(scored) -> list[tuple[int, int, float]]:
    total: dict[int, tuple[int, float]] = {}
    for r in scored:
        n, good = total.get(r.step, (0, 0.0))
        total[r.step] = (n + r.n, good + r.good)
    return [(s, *c) for s, c in total.items()]


def find_spans(docs: DataFrame, trees: Trees = NONE, text: str = "text") -> DataFrame:
    """All columns with ``base_spans`` and ``spans``: arrays of (start, kind, end, held) by start, then kind.

    start and end are code points, end exclusive; kind indexes KINDS. Null and empty texts have none; rows never meet,
    so repeated rows and identifiers change nothing. A column of the input called like one of these is replaced.
    """
    names = [c for c in docs.columns if c not in ("base_spans", "spans", "_matches", "_more", "_base", "_failed")]
    rows = base_candidates(docs.select(*names), text)
    good = lambda m: passes(m["kind"], m["held"])
    rows = rows.select(*names, F.array_sort(F.filter("_matches", good)).alias("_base"), F.filter("_matches", lambda m: ~good(m)).alias("_failed"))
    body = F.coalesce(F.col(text), F.lit(""))
    located = []
    for i, k in enumerate(KINDS):
        for gate, pattern, checked in MORE[k]:
            one = _located(body, pattern, i, body.rlike(gate))
            located.append(F.filter(one, good) if checked else one)
    more = F.array_distinct(F.concat(*located, _inside_failed(F.col("_failed"))))
    rows = rows.select(*names, F.col("_base").alias("base_spans"), (more if trees.trees else F.expr(_EMPTY)).alias("_more"))
    free = lambda m: ~F.exists("base_spans", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    likely = lambda m: trees.takes(m, body)
    return rows.select(*names, "base_spans", F.array_sort(F.concat("base_spans", F.filter("_more", lambda m: free(m) & likely(m)))).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat(name(s["kind"]), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def redact(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The texts with each span replaced by its kind in angle brackets; of overlapping spans the first is named."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def add(acc, s):
        gap = F.substring(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        tag = F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(gap, tag)).alias("out"))

    def close(acc):
        rest = F.substring(F.col(text), acc["at"] + 1, F.length(text))
        return F.array_join(F.concat(acc["out"], F.array(rest)), "")

    return found.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(spans, start, add, close)).otherwise(F.col(text)))
