"""Repair of conversations: rows aligned to the alternating grammar (s?(ua)+)? at the least cost.

Rows of a conversation are kept (K, 0), given the other role (R, 2) or deleted (D, 3); empty turns are inserted (I, 2). Blank
rows and rows said before must be deleted; keeping a row that breaks off costs 1 more. Of equally cheap edits those whose letters
come first in ASCII order win.

Rows are spread by ranges of (conversation, turn), so a conversation with a third of all rows lies in many tasks, and every task
cuts its share of each conversation into blocks of bounded size. A block is aligned to the grammar's alternating string by
Wagner-Fischer. The strings of all feasible lengths that end in one symbol are suffixes of each other, so one table, filled from
the end, serves them all; the cost of changing every misplaced role in place is the incumbent that bounds Ukkonen's band around
the diagonal. The cheapest lengths are traced back and their audits compared. Of a block whose neighbours lie elsewhere the
best audit is kept for each state of the grammar before and behind it (16 at most), and such tables are combined like
matrices: first those of one task and conversation, then one table per task. A conversation inside a task and a block, as
nearly all are, is done at once.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsieve.llm.narrow import join_narrow
from urlsieve.session import stage_table

BLANKS = " \t\n\x0b\x0c\r"
BLOCK_ROWS, BLOCK_CHARS = 64, 1 << 20
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
#: States of the grammar: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NAMES = {"u": "user", "a": "assistant"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
Paths = dict[tuple[int, int], tuple[int, str]]


class Grid:
    """Costs of aligning rows i.. to the last r symbols of the alternating string that ends in ``last``, within the band."""

    def __init__(self, rows: list[tuple[str, int]], last: str):
        self.rows, self.last, self.other = rows, last, "a" if last == "u" else "u"
        n = self.n = len(rows)
        wrong = sum(role != self.symbol(n - i) for i, (role, _) in enumerate(rows))
        #: Any alignment as cheap as the incumbent, 2 * wrong with at most two turns inserted, strays less from the diagonal.
        width = self.width = wrong + 2
        self.cost = [[]] * n + [[INSERT * r for r in range(width + 1)]]
        for i in range(n - 1, -1, -1):
            role, broken = rows[i]
            low, below, under = max(0, n - i - width), max(0, n - i - 1 - width), self.cost[i + 1]
            here: list[int] = []
            for r in range(low, n - i + width + 1):
                best = 1 << 60
                if 0 <= r - below < len(under):
                    best = DELETE + under[r - below]
                if r and 0 <= r - 1 - below < len(under):
                    best = min(best, under[r - 1 - below] + broken + (KEEP if role == self.symbol(r) else REROLE))
                if here:
                    best = min(best, INSERT + here[-1])
                here.append(best)
            self.cost[i] = here

    def symbol(self, r: int) -> str:
        """The r-th symbol from the end."""
        return self.last if r % 2 else self.other

    def at(self, i: int, r: int) -> int:
        place = r - max(0, self.n - i - self.width)
        return self.cost[i][place] if 0 <= place < len(self.cost[i]) else 1 << 60

    def lengths(self, i: int, first: str) -> Iterator[int]:
        """Feasible lengths of 1 or more from row i on, of strings that start with ``first``."""
        low = max(1, self.n - i - self.width)
        return (r for r in range(low, self.n - i + self.width + 1) if self.symbol(r) == first)

    def trace(self, i: int, r: int) -> str:
        """The first in ASCII order of the cheapest audits."""
        out = []
        while i < self.n or r:
            cost = self.at(i, r)
            if i < self.n and cost == DELETE + self.at(i + 1, r):
                out.append("D")
                i += 1
            elif r and cost == INSERT + self.at(i, r - 1):
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.rows[i][0] == self.symbol(r) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


def _least(found: list) -> tuple[int, str] | None:
    """Of (cost, function giving the audit) the cheapest, audits compared only between equals."""
    low = min((c for c, _ in found), default=1 << 60)
    return (low, min(audit() for c, audit in found if c == low)) if low < 1 << 60 else None


def align(rows: list[tuple[str, int]], entries: Iterable[int], exits: Iterable[int]) -> Paths:
    """Cheapest (cost, audit) for rows of (role initial, 1 if broken off) between states of the grammar."""
    out: dict = {}
    n, entries = len(rows), set(entries)
    for state in entries & set(exits):
        out[state, state] = [(DELETE * n, lambda: "D" * n)]
    if START in entries and SYSTEM in exits:
        out[START, SYSTEM] = [(DELETE * (n - 1) + broken, lambda i=i: "D" * i + "K" + "D" * (n - 1 - i))
                              for i, (role, broken) in enumerate(rows) if role == "s"]
    for exit_ in {USER, ASSISTANT} & set(exits):
        grid = Grid(rows, "u" if exit_ == USER else "a")
        for entry in entries:
            out.setdefault((entry, exit_), []).extend(
                (grid.at(0, r), functools.partial(grid.trace, 0, r)) for r in grid.lengths(0, NEXT[entry]))
        if START in entries:
            for i, (role, broken) in enumerate(rows[:grid.width + 1]):
                if role == "s":
                    out[START, exit_].extend((DELETE * i + broken + grid.at(i + 1, r), lambda g=grid, i=i, r=r: "D" * i + "K" + g.trace(i + 1, r))
                                             for r in grid.lengths(i + 1, "u"))
    return {k: best for k, found in out.items() if (best := _least(found))}


def block_paths(rows: list[tuple], entries: Iterable[int], exits: Iterable[int]) -> Paths:
    """The same for rows of (role, text, copies, said before); rows that must go are deleted as early as they can be."""
    live, gone = [], [0]
    for role, text, copies, said in rows:
        bare = text.strip(BLANKS)
        if bare and not said:
            live.append((role[:1], BROKEN * (bare[-1] not in ".!?")))
            gone.append(copies - 1)
        else:
            gone[-1] += copies

    def whole(audit: str) -> str:
        out, i = ["D" * gone[0]], 0
        for letter in audit:
            i += letter != "I"
            out.append(letter if letter == "I" else letter + "D" * gone[i])
        return "".join(out)

    return {k: (cost + DELETE * sum(gone), whole(audit)) for k, (cost, audit) in align(live, entries, exits).items()}


def combine(left: Paths, right: Paths) -> tuple[Paths, dict]:
    """Cheapest paths through two blocks in a row, and the state between them."""
    found: dict = {}
    for (entry, mid), (cost, _) in left.items():
        for (again, exit_), (more, _) in right.items():
            if mid == again:
                found.setdefault((entry, exit_), []).append((cost + more, mid))
    paths, mids = {}, {}
    for (entry, exit_), ways in found.items():
        low = min(ways)[0]
        audit, mids[entry, exit_] = min((left[entry, mid][1] + right[mid, exit_][1], mid) for cost, mid in ways if cost == low)
        paths[entry, exit_] = (low, audit)
    return paths, mids


def fold(tables: list[Paths]) -> tuple:
    """A balanced tree over blocks in a row: (paths, states between, left, right), or (paths,) for a leaf."""
    if len(tables) == 1:
        return (tables[0],)
    half = len(tables) // 2
    left, right = fold(tables[:half]), fold(tables[half:])
    return (*combine(left[0], right[0]), left, right)


def choose(tree: tuple, entry: int, exit_: int) -> list[tuple[int, int]]:
    """States before and behind every block on the best path."""
    if len(tree) == 1:
        return [(entry, exit_)]
    mid = tree[1][entry, exit_]
    return choose(tree[2], entry, mid) + choose(tree[3], mid, exit_)


def best_end(paths: Paths) -> int:
    """The state a whole conversation ends in: nothing left, or after an assistant."""
    return min((paths[START, e], e) for e in (START, ASSISTANT) if (START, e) in paths)[1]


def edited(rows: list[tuple], audit: str, state: int) -> list[tuple[str, str]]:
    """(role, text) of the turns that an audit leaves or makes of rows of (role, text, copies, ...)."""
    out, at, skip = [], iter(rows), 0
    for letter in audit:
        if letter == "I":
            role, text = NAMES[NEXT[state]], ""
        elif skip:
            skip -= 1
            continue
        else:
            role, text, copies = next(at)[:3]
            skip = copies - 1
            if letter == "D":
                continue
            role = NAMES[NEXT[state]] if letter == "R" else role
        out.append((role, text))
        state = AFTER[role[:1]]
    return out


FACTS = ("blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "low", "high")


def block_facts(rows: list[tuple]) -> dict:
    """Counts of faults and turns of (role, text, copies, said before, turn), and what their neighbours need to go on."""
    f = dict(blank=0, duplicate=0, truncated=0, illegal=0, first=None, last=None, turns=0, low=None, high=None)
    for role, text, copies, said, turn in rows:
        bare = text.strip(BLANKS)
        if not bare:
            f["blank"] += copies
        else:
            f["duplicate"] += copies - (not said)
            f["truncated"] += not said and bare[-1] not in ".!?"
        f = joined(f, dict(blank=0, duplicate=0, truncated=0, illegal=copies - 1, first=role[:1], last=role[:1], turns=turn is not None, low=turn, high=turn))
    return f


def joined(a: dict, b: dict) -> dict:
    """Facts of two stretches in a row."""
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last"] is not None and b["first"] is not None and a["last"] + b["first"] not in LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    pick = lambda x, y: y if x is None else x
    return out | dict(first=pick(a["first"], b["first"]), last=pick(b["last"], a["last"]), low=pick(a["low"], b["low"]), high=pick(b["high"], a["high"]))


def _as_list(paths: Paths) -> list[dict]:
    return [dict(entry=e, exit=x, cost=c, audit=a) for (e, x), (c, a) in paths.items()]


def _as_paths(found: list[dict]) -> Paths:
    return {(p["entry"], p["exit"]): (p["cost"], p["audit"]) for p in found}


_PATHS = "paths array<struct<entry: int, exit: int, cost: long, audit: string>>"
_FACTS = "facts struct<blank: long, duplicate: long, truncated: long, illegal: long, first: string, last: string, turns: long, low: long, high: long>"
_LINES = "lines array<struct<role: string, text: string, copies: long>>"
_ARROW_PATHS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_ARROW_FACTS = pa.struct([(k, pa.string() if k in ("first", "last") else pa.int64()) for k in FACTS])
_ARROW_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())]))
_ARROW = {"part": pa.int32(), "seq": pa.int64(), "whole": pa.bool_(), "paths": _ARROW_PATHS, "facts": _ARROW_FACTS, "lines": _ARROW_LINES,
          "entry": pa.int32(), "exit": pa.int32(), "cost": pa.int64(), "audit": pa.string(), "name": pa.string()}


def _rows_of(lines: list[dict]) -> list[tuple]:
    return [(x["role"], x["text"], x["copies"]) for x in lines]


def cut_blocks(batches: Iterable[pa.RecordBatch], block_rows: int, block_chars: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one task's rows, which come by conversation and turn. ``whole``: all of a conversation, repaired already."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    kind = None
    name, conv, seq, rows, chars, inner = None, None, 0, [], 0, False

    def close(over: bool) -> None:
        nonlocal seq, rows, chars
        if rows:
            if over and inner and seq == 0:
                paths = block_paths([r[:4] for r in rows], (START,), (START, ASSISTANT))
                end = best_end(paths)
                lines = edited(rows, paths[START, end][1], START)
                found = {(START, end): paths[START, end]}
                out.append((name, conv, part, 0, True, _as_list(found), block_facts(rows), [dict(role=a, text=b, copies=1) for a, b in lines]))
            else:
                found = block_paths([r[:4] for r in rows], range(4), range(4))
                out.append((name, conv, part, seq, False, _as_list(found), block_facts(rows), [dict(role=r[0], text=r[1], copies=r[2]) for r in rows]))
        seq, rows, chars = seq + 1, [], 0

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        kinds = (pa.string(), kind, *[_ARROW[k] for k in ("part", "seq", "whole", "paths", "facts", "lines")])
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["name", "conv_id", "part", "seq", "whole", "paths", "facts", "lines"])
        out.clear()
        return made

    seen, held = False, 0
    for b in batches:
        kind = b.schema.field("conv_id").type
        for n, c, turn, role, text, copies, said in zip(*(b.column(x).to_pylist() for x in ("name", "conv_id", "turn", "role", "text", "copies", "said"))):
            if not seen or n != name:
                close(over=True)
                name, conv, seq, inner, seen = n, c, 0, seen, True
            elif len(rows) >= block_rows or chars >= block_chars:
                close(over=False)
            rows.append((role, text, copies, said, turn))
            chars += len(text)
            held += len(text)
            if len(out) >= 1000 or out and held >= 1 << 22:
                held = 0
                yield batch()
    close(over=False)
    if out:
        yield batch()


def _table(schema: dict, rows: list[tuple], conv: pa.ChunkedArray) -> pa.Table:
    kinds = [conv.type if k == "conv_id" else _ARROW[k] for k in schema]
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(schema))


def fold_part(table: pa.Table) -> pa.Table:
    """One table of paths for the blocks of one conversation in one task."""
    rows = sorted(table.select(["name", "conv_id", "part", "seq", "paths", "facts"]).to_pylist(), key=lambda r: r["seq"])
    tree = fold([_as_paths(r["paths"]) for r in rows])
    facts = functools.reduce(joined, (r["facts"] for r in rows))
    one = rows[0]
    return _table(("name", "conv_id", "part", "paths", "facts"), [(one["name"], one["conv_id"], one["part"], _as_list(tree[0]), facts)], table["conv_id"])


def fold_whole(table: pa.Table) -> pa.Table:
    """The states before and behind each task's share of a conversation; its facts, cost and audit on the first row."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    tree = fold([_as_paths(r["paths"]) for r in rows])
    end = best_end(tree[0])
    facts = functools.reduce(joined, (r["facts"] for r in rows))
    out = []
    for k, (r, (entry, exit_)) in enumerate(zip(rows, choose(tree, START, end))):
        more = (facts, *tree[0][START, end]) if k == 0 else (None, None, None)
        out.append((r["name"], r["conv_id"], r["part"], entry, exit_, *more))
    return _table(("name", "conv_id", "part", "entry", "exit", "facts", "cost", "audit"), out, table["conv_id"])


def edit_part(table: pa.Table) -> pa.Table:
    """The turns left of one task's share of a conversation."""
    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    tables = [_as_paths(r["paths"]) for r in rows]
    out = []
    for r, paths, (entry, exit_) in zip(rows, tables, choose(fold(tables), rows[0]["entry"], rows[0]["exit"])):
        lines = edited(_rows_of(r["lines"]), paths[entry, exit_][1], entry)
        out.append((r["name"], r["conv_id"], r["part"], r["seq"], False, [dict(role=a, text=b, copies=1) for a, b in lines]))
    return _table(("name", "conv_id", "part", "seq", "whole", "lines"), out, table["conv_id"])


def repair_turns(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """(report, repaired) of rows (conv_id of any type, turn, role, text).

    report: one row per conversation with gaps, blank, duplicate, truncated, illegal, cost and audit. repaired: name, conv_id, part,
    seq, whole, lines; the turns left are the ``lines`` (role, text) of a conversation's rows by part and seq, and ``whole`` marks
    conversations that are one row. Turns are taken in order, null ones first, equal ones by role and text. A null role or text
    counts as one space (so the row is blank or of no known role), a null conv_id as a conversation of its own. Repeated rows are
    duplicates and are counted together. An empty table gives empty ones; other columns are left out, so names cannot clash.
    """
    rows = turns.select(F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).alias("name"),
                        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    words = F.md5(F.to_json(F.struct("name", "role", "text")).cast("binary"))
    spoken = rows.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).groupBy(words.alias("words")).agg(
        F.max(F.col("turn").isNull()).alias("early"), F.min("turn").alias("low"), F.max("turn").alias("high"))
    again = spoken.filter("low < high or early and high is not null").select("words", F.when(~F.col("early"), F.col("low")).alias("from"), F.lit(True).alias("more"))
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("words", words)
    marked = join_narrow(counted, again, "words", "left").withColumn("said", F.coalesce(F.col("more") & ~F.col("turn").eqNullSafe(F.col("from")), F.lit(False)))
    place = [F.col("name"), F.col("turn"), F.col("role"), F.substring("text", 1, 64)]
    spread = marked.repartitionByRange(*place).sortWithinPartitions(*place, "text").select(*rows.columns, "copies", "said")
    conv = "conv_id " + rows.schema["conv_id"].dataType.simpleString()
    cut = functools.partial(cut_blocks, block_rows=block_rows, block_chars=block_chars)
    blocks = stage_table(spread.mapInArrow(cut, f"name string, {conv}, part int, seq long, whole boolean, {_PATHS}, {_FACTS}, {_LINES}"), "repair-blocks")
    cut_up = blocks.filter("not whole")
    parts = cut_up.drop("lines", "whole").groupBy("name", "part").applyInArrow(fold_part, f"name string, {conv}, part int, {_PATHS}, {_FACTS}")
    ways = stage_table(parts.groupBy("name").applyInArrow(
        fold_whole, f"name string, {conv}, part int, entry int, exit int, {_FACTS}, cost long, audit string"), "repair-ways")
    shares = cut_up.drop("facts", "whole").join(ways.select("name", "part", "entry", "exit"), ["name", "part"])
    mended = shares.groupBy("name", "part").applyInArrow(edit_part, f"name string, {conv}, part int, seq long, whole boolean, {_LINES}")
    done = blocks.filter("whole")
    repaired = done.select("name", "conv_id", "part", "seq", "whole", "lines").unionByName(mended)
    report = done.select("conv_id", "facts", F.col("paths")[0]["cost"].alias("cost"), F.col("paths")[0]["audit"].alias("audit")) \
        .unionByName(ways.filter("facts is not null").select("conv_id", "facts", "cost", "audit"))
    gaps = F.coalesce(F.expr("facts.high - facts.low + 1 - facts.turns"), F.lit(0)).alias("gaps")
    return report.select("conv_id", gaps, *[F.col(f"facts.{k}").alias(k) for k in ("blank", "duplicate", "truncated", "illegal")], "cost", "audit"), repaired


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, conv, state, begun = None, None, None, False

    def row(kind) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], ["conv_id", "sha256"])

    for b in batches:
        kind = b.schema.field("conv_id").type
        for n, c, lines in zip(*(b.column(x).to_pylist() for x in ("name", "conv_id", "lines"))):
            if state is None or n != name:
                if state is not None:
                    yield row(kind)
                name, conv, state, begun = n, c, hashlib.sha256(), False
            for x in lines:
                state.update((("\n" if begun else "") + x["role"] + ":" + x["text"]).encode())
                begun = True
    if state is not None:
        yield row(kind)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` lines joined by newlines.

    A conversation cut into several rows is read in order by one task, which holds one of them at a time: the digest of a sequence
    cannot be put together from digests of its parts.
    """
    conv = repaired.schema["conv_id"].dataType.simpleString()
    text = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    one = repaired.filter("whole").select("conv_id", F.sha2(text.cast("binary"), 256).alias("sha256"))
    more = repaired.filter("not whole").repartition("name").sortWithinPartitions("name", "part", "seq").select("name", "conv_id", "lines")
    return one.unionByName(more.mapInArrow(_digests, f"conv_id {conv}, sha256 string"))
