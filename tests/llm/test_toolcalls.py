import json

from urlsieve.llm import toolcalls

SCHEMAS = {"t": {"n": ("integer", True), "s": ("string", False)}}


def test_edges(spark):
    calls = spark.createDataFrame([
        (1, "a", "t", '{"s":"x", "n": 1}', None), (1, "b", "t", '{"n":"1"}', "a"), (1, "c", "t", "{}", "b"), (1, "c", "t", "{}", "b"),
        (1, "d", "t", "not json", "gone"), (1, "e", "u", None, "f"), (1, "f", "t", "[1]", "e"), (None, None, None, None, None),
        (2, "g", "t", '{"b":{"z":1,"a":[2]},"n":2.5}', "c"), (2, "h", "t", '{"n":null}', None)],
        "conv_id long, call_id string, name string, arguments string, parent_id string").withColumn("depth", toolcalls.F.lit("clash"))
    results = spark.createDataFrame([(1, "a", "r2"), (1, "a", "r1"), (2, "a", "r0"), (1, "z", "?"), (1, None, "?"), (None, "a", "?"), (1, "b", None)],
                                    "conv_id long, call_id string, content string")
    got = [r.asDict() for r in toolcalls.link_calls(calls, results, SCHEMAS).collect()]
    assert len(got) == 10
    by = {r["call_id"]: r for r in got}
    assert {k: r["depth"] for k, r in by.items()} == {"a": 0, "b": 1, "c": 2, "d": 0, "e": None, "f": None, None: None, "g": 0, "h": 0}
    assert {k: r["problems"] for k, r in by.items()} == {
        "a": "", "b": "type:n", "c": "missing:n", "d": "not an object", "e": "unknown tool", "f": "not an object", None: "unknown tool",
        "g": "type:n", "h": "missing:n"}
    assert by["a"]["json"] == '{"arguments":{"n":1,"s":"x"},"id":"a","name":"t","result":"r1"}'
    assert '"arguments":{"b":{"a":[2],"z":1},"n":2.5}' in by["g"]["json"]
    assert all(json.loads(r["json"]) for r in got)
    assert toolcalls.link_calls(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def test_long_chain(spark):
    chain = spark.range(700).selectExpr("1L conv_id", "cast(id as string) call_id", "'t' name", "'{\"n\":1}' arguments", "cast(id - 1 as string) parent_id")
    results = chain.limit(0).selectExpr("conv_id", "call_id", "name content")
    assert all(int(r.call_id) == r.depth for r in toolcalls.link_calls(chain, results, SCHEMAS).collect())


def test_identifiers_repeat_over_conversations(spark):
    """Every conversation, the one without an identifier too, has its own c1 and c2."""
    calls = spark.createDataFrame([(c, f"c{i}", "t", '{"n":1}', f"c{i - 1}") for c in (1, 2, 3, None) for i in (1, 2, 3) if c != 3 or i > 1],
                                  "conv_id long, call_id string, name string, arguments string, parent_id string")
    results = spark.createDataFrame([(1, "c1", "one"), (2, "c1", "two"), (None, "c1", "none"), (2, "c2", "deep")], "conv_id long, call_id string, content string")
    got = {(r.conv_id, r.call_id): (r.depth, json.loads(r.json)["result"]) for r in toolcalls.link_calls(calls, results, SCHEMAS).collect()}
    assert got == {(1, "c1"): (0, "one"), (1, "c2"): (1, None), (1, "c3"): (2, None), (2, "c1"): (0, "two"), (2, "c2"): (1, "deep"), (2, "c3"): (2, None),
                   (3, "c2"): (0, None), (3, "c3"): (1, None), (None, "c1"): (0, "none"), (None, "c2"): (1, None), (None, "c3"): (2, None)}
