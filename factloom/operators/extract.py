"""Deterministic extraction: rows of business tables as mentions, relations and assertions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import ident
from factloom.functions.text import norm, predicate


def entity(prefix: str, key: str):
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def order_facts(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """subject, predicate, object, value, qualifiers, source_row of every order line: who purchased what,
    what the order affects, who took part, and when it was. One join on the order's key."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    period = F.concat(F.lit('{"period":"'), F.date_format("o_orderdate", "yyyy-MM"), F.lit('"}'))
    joined = lineitem.select("l_orderkey", "l_partkey", "l_linenumber").join(orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    none = F.lit(None).cast("string")
    c, p, o = entity("C", "o_custkey"), entity("P", "l_partkey"), entity("O", "o_orderkey")
    row = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))

    def fact(s, name, obj, value, qualifiers):
        return F.struct(s.alias("subject"), F.lit(name).alias("predicate"), obj.alias("object"), value.alias("value"), qualifiers.alias("qualifiers"))

    facts = F.array(
        fact(c, "purchased", p, none, period),
        fact(o, "affects", p, none, F.lit("{}")),
        fact(o, "has_participant", c, none, F.lit("{}")),
        fact(o, "event_time", none, day, F.lit("{}")),
    )
    return joined.select(row.alias("source_row"), F.explode(facts).alias("f")).select("f.*", "source_row")


def attribute_facts(df: DataFrame, prefix: str, key: str, fields: list[str]) -> DataFrame:
    """subject, predicate, value, qualifiers: an ``attribute`` fact for each non-null field."""
    cells = F.array(*[F.struct(F.lit(f).alias("a"), F.col(f).cast("string").alias("v")) for f in fields])
    rows = df.select(entity(prefix, key).alias("subject"), F.explode(cells).alias("c")).filter("c.v is not null")
    return rows.select("subject", F.lit("attribute").alias("predicate"), F.col("c.v").alias("value"), F.concat(F.lit('{"attribute":"'), F.col("c.a"), F.lit('"}')).alias("qualifiers"))


def with_fact_ids(facts: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("subject", "predicate", "object", "value", "qualifiers")]
    return facts.withColumn("fact_id", ident("fact", *parts))


def resolve_endpoints(relations: DataFrame, mentions: DataFrame) -> DataFrame:
    """Relations (unit_id, subject, predicate, object as labels) with mention ids: a label is a mention's
    local id, or else the name or alias of exactly one mention of the unit. Relations with an end that
    isn't, and those from a mention to itself, keep a warning instead."""
    local = mentions.select("unit_id", F.col("local_id").alias("label"), "mention_id").dropDuplicates(["unit_id", "label"])
    labels = mentions.select("unit_id", "mention_id", F.explode(F.concat(F.array("local_id", "name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("l"))
    labels = labels.withColumn("key", norm(F.col("l"))).filter("key <> ''").groupBy("unit_id", "key").agg(F.count_distinct("mention_id").alias("k"), F.min("mention_id").alias("m")).filter("k = 1")
    out = relations.withColumn("predicate", predicate(F.col("predicate")))
    for end in ("subject", "object"):
        a = local.select("unit_id", F.col("label").alias(end), F.col("mention_id").alias("_a"))
        b = labels.select("unit_id", F.col("key").alias("_key"), F.col("m").alias("_b"))
        out = out.join(a, ["unit_id", end], "left").withColumn("_key", norm(F.col(end))).join(b, ["unit_id", "_key"], "left")
        out = out.withColumn(f"{end}_id", F.coalesce("_a", "_b")).drop("_a", "_b", "_key")
    bad = F.when(F.col("subject_id").isNull(), "unresolved_subject").when(F.col("object_id").isNull(), "unresolved_object").when(F.col("subject_id") == F.col("object_id"), "self_relation")
    return out.withColumn("warning", bad)


def accept(responses: DataFrame, tasks: DataFrame, done: DataFrame, fingerprint: str) -> DataFrame:
    """The responses to take: of this run, to a known task that isn't done, the first of several. The rest
    are ignored, so a replay changes nothing. responses: task_id, fingerprint, seq, ..."""
    from pyspark.sql import Window

    now = responses.filter(F.col("fingerprint") == fingerprint).join(tasks.select("task_id"), "task_id", "left_semi").join(done.select("task_id"), "task_id", "left_anti")
    w = Window.partitionBy("task_id").orderBy("seq")
    return now.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def pending(units: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return units.join(done.select(key).distinct(), key, "left_anti")
