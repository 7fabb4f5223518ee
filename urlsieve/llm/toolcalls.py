"""Tool calls linked to their results, ordered after the calls they build on, validated and serialised; DataFrame only.

Links are equi-joins on the identifier. Depth in the dependency forest comes from pointer doubling, so a conversation
of any length takes logarithmically many rounds and no conversation is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsieve.session import stage_table

INTEGERS = ("BIGINT",)
KINDS = {"integer": r"^BIGINT$|^DECIMAL\([0-9]+,0\)$", "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$", "string": "^STRING$",
         "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY"}


def canonical(json: Column) -> Column:
    """JSON without blanks, keys of every object in order; null where the text is not JSON."""
    return F.to_json(F.try_parse_json(json))


def call_key(call_id: str) -> Column:
    """A call's name in its conversation; null for a null identifier. A null conversation is one of its own."""
    return F.when(F.col(call_id).isNotNull(), F.to_json(F.struct(F.col("conv_id").cast("string").alias("c"), F.col(call_id).cast("string").alias("i"))))


def depths(calls: DataFrame) -> DataFrame:
    """(key, depth) of (key, up): 0 for a call without a known parent, else one more than the parent's; null on a cycle.

    Keys that occur more than once count once, with the least parent. Null keys get no row. Calls that have reached a
    root are only looked up, not joined again.
    """
    nodes = calls.filter("key is not null").groupBy(F.col("key").alias("id")).agg(F.min("up").alias("up"))
    known = nodes.select(F.col("id").alias("up"), F.lit(True).alias("there"))
    rooted = nodes.filter("up is null").select("id", "up", F.lit(0).cast("long").alias("depth"))
    held = nodes.filter("up is not null").join(known, "up", "left").select(
        "id", F.when(F.col("there"), F.col("up")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"))
    nodes = stage_table(rooted.unionByName(held), "call-depths")
    total, open_ = nodes.agg(F.count(F.lit(1)), F.count("up")).first()
    rounds = 0
    while open_ and 2 ** rounds <= 2 * total:
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("top"), F.col("depth").alias("more"))
        moved = nodes.filter("up is not null").join(above, "up").select("id", F.col("top").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        nodes = stage_table(nodes.filter("up is null").unionByName(moved), "call-depths")
        open_ = nodes.filter("up is not null").count()
        rounds += 1
    return nodes.select(F.col("id").alias("key"), F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def violations(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Sorted list of what is wrong with the arguments: unknown tool, not an object, missing or mistyped fields.

    ``schemas``: tool to field to (kind, required). Fields outside the schema are allowed. Its size is that of the
    given declaration and does not grow with the data.
    """
    value = F.try_parse_json(arguments)
    not_object = ~F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    checks = []
    for tool, fields in sorted(schemas.items()):
        for field, (kind, required) in sorted(fields.items()):
            here = F.try_variant_get(value, f"$.{field}", "variant")
            missing = F.coalesce(here.isNull() | F.is_variant_null(here), F.lit(True))
            wrong = F.when(missing, F.lit(f"missing:{field}") if required else F.lit(None).cast("string")) \
                .when(~F.schema_of_variant(here).rlike(KINDS[kind]), F.lit(f"type:{field}"))
            checks.append(F.when(name == tool, wrong))
    known = F.coalesce(name.isin(*schemas), F.lit(False))
    return (F.when(~known, F.array(F.lit("unknown tool"))).when(not_object, F.array(F.lit("not an object")))
            .otherwise(F.array_sort(F.array_compact(F.array(*checks)))))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per call with its result, depth, problems and canonical JSON.

    calls: conv_id, call_id, name, arguments (JSON text), parent_id; results: conv_id, call_id, content. Identifiers are
    names within a conversation: calls link with results and parents of their own one only. A call without a
    result has a null one; of several results of a call the least content is taken (repeated rows change nothing).
    Results without a call are left out. Null identifiers link with nothing. Arguments that are not JSON are kept as
    a JSON string. ``depth`` orders a conversation: a call comes after every call it builds on; null marks a cycle.
    """
    content = results.select(call_key("call_id").alias("key"), "content").filter("key is not null").groupBy("key").agg(F.min("content").alias("content"))
    calls = calls.select("conv_id", "call_id", "name", "arguments", "parent_id", call_key("call_id").alias("key"))
    order = depths(calls.select("key", call_key("parent_id").alias("up")))
    rows = calls.join(content, "key", "left").join(order, "key", "left")
    args = F.coalesce(canonical(F.col("arguments")), F.to_json(F.to_variant_object(F.struct(F.col("arguments").alias("text")))))
    quote = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    text = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(quote(c))
    line = F.concat(F.lit('{"arguments":'), args, F.lit(',"id":'), text(F.col("call_id")), F.lit(',"name":'),
                    text(F.col("name")), F.lit(',"result":'), text(F.col("content")), F.lit("}"))
    problems = violations(F.col("name"), F.col("arguments"), schemas)
    return rows.select("conv_id", "call_id", "depth", "name", F.array_join(problems, ",").alias("problems"), line.alias("json"))
