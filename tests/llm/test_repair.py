import hashlib
import random

import pytest
from checks.compare import compare, duck
from pyspark.sql import functions as F
from urlsieve.llm import queries, repair

BLANKS = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string, audit int, part string"


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of rows (turn, role, text) by one pass over the grammar's states."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for s, (c, a, x) in list(out.items()):
                to = "a" if s == "u" else "u"
                out[to] = min(out.get(to, (1 << 40,)), (c + 2, a + "I", (*x, name[to] + ":")))
        return out

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        put = lambda s, *v: new.__setitem__(s, min(new.get(s, (1 << 40,)), v))
        for s, (c, a, x) in inserted(best).items():
            put(s, c + 3, a + "D", x)
            if fault in ("blank", "duplicate"):
                continue
            to, more = "a" if s == "u" else "u", fault == "truncated"
            put(to, c + 2 + more, a + "R", (*x, f"{name[to]}:{text}"))
            if role[:1] == to or role[:1] == "s" and s == "":
                put(role[:1], c + more, a + "K", (*x, f"{role}:{text}"))
        best = new
    cost, audit, lines = min(v for s, v in inserted(best).items() if s in ("", "a"))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, "\n".join(lines))


def invent(rng, n):
    roles = ["system"] * (rng.random() < 0.5) + ["user", "assistant"] * n
    rows = []
    for t, role in enumerate(roles[:n]):
        role = rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.25 else role
        text = rng.choice(["a.", "b!", "", " \t", "cut", None, f"say {t}.", f"say {t}.", f"more {t}? ", f"open {t}"])
        for _ in range(rng.choice((0, 1, 1, 1, 1, 2, 4))):
            rows.append((None if rng.random() < 0.05 else t * 2 if rng.random() < 0.1 else t, role, text))
    return rows


def found(spark, convs, **blocks):
    rows = [(c, *r, 1, "x") for c, x in convs.items() for r in x]
    random.Random(0).shuffle(rows)
    report, repaired = repair.repair_turns(spark.createDataFrame(rows, COLUMNS).repartition(3), **blocks)
    sha = {r.conv_id: r.sha256 for r in repair.digests(repaired).collect()}
    got = report.collect()
    assert len(got) == len(sha) == len({r.conv_id for r in got})
    return {r.conv_id: (*tuple(r)[1:], sha[r.conv_id]) for r in got}


def want(convs):
    return {c: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for c, x in convs.items() if x for w in [brute(x)]}


@pytest.mark.parametrize("rows,chars", [(64, 1 << 20), (3, 1 << 20), (64, 12)])
def test_random_conversations_equal_brute_force(spark, rows, chars):
    """Also cut into small blocks over many tasks, with one conversation of most rows."""
    rng = random.Random(rows + chars)
    convs = {c: invent(rng, rng.randrange(0, 14)) for c in range(150)} | {None: invent(rng, 30), 1000: invent(rng, 900)}
    assert found(spark, convs, block_rows=rows, block_chars=chars) == want(convs)


def test_blocks_equal_brute_force():
    """Every way to cut short rows into blocks gives the audit of the whole."""
    rng = random.Random(11)
    for _ in range(1500):
        rows = [(rng.choice("suat"), rng.choice(("x.", "y")) + str(i) + rng.choice(("", ".")), rng.choice((1, 1, 2)), rng.random() < 0.2) for i in range(rng.randrange(0, 9))]
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(3)))
        blocks = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        tables = [repair.block_paths(b, range(4), range(4)) for b in blocks]
        tree = repair.fold(tables)
        end = repair.best_end(tree[0])
        whole = repair.block_paths(rows, (0,), (0, 3))
        assert tree[0][0, end] == whole[0, repair.best_end(whole)]
        parts = [repair.edited(b, t[e, x][1], e) for b, t, (e, x) in zip(blocks, tables, repair.choose(tree, 0, end))]
        assert sum(parts, []) == repair.edited(rows, tree[0][0, end][1], 0)


def test_edges(spark):
    same = [(3, "user", "again.")] * 500
    convs = {1: [(None, None, None)], 2: [(0, "system", "only.")], 3: [(5, "user", "q?"), (9, "assistant", "a.")], 4: same + [(4, "assistant", "ok.")],
             5: [(t, "user", "again.") for t in range(400)], 6: [(0, "user", "x" * 3_000_000), (1, "assistant", "y.")], None: [(None, "user", "q"), (None, "user", "q")]}
    got = found(spark, convs)
    assert got == want(convs)
    assert got[4][:7] == (0, 0, 499, 0, 499, 1497, "K" + "D" * 499 + "K")
    empty = spark.createDataFrame([], COLUMNS)
    report, repaired = repair.repair_turns(empty)
    assert report.count() == repaired.count() == repair.digests(repaired).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    name, d = "op11_conversation_repair", f"/root/testdata/{sf}"
    result = compare(spark, duck(d), name, queries.QUERIES[name], queries.SQL[name], d)
    assert result.startswith("ok"), result


def test_query_keeps_dropped_conversations(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for c in range(200) for t in range(1 + c % 2)] + [(None, None, None, None), (None, 1, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert got.count() == 201 and got.filter(F.col("conv_id").isNull()).count() == 1
    gone = {r.conv_id for r in spark.read.parquet(f"{tmp_path}/conversations.parquet").select("conv_id").distinct().collect()} - {
        r.conv_id for r in queries.damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).collect()}
    assert gone
    for r in got.filter(F.col("conv_id").isin([c for c in gone if c is not None])).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
