"""The state of a run: preparing units, checking and accepting responses, alignment rounds, gates.

Tables stand for the run's state; each step reads tables and gives new ones, so a step that is repeated
gives the same rows. Columns that an operator doesn't name are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.ids import ident
from factloom.functions.text import business_codes, norm
from factloom.operators.graph import TYPES

#: Fixed values.
LITERAL_PREDICATES = ("attribute", "observed_value", "event_time", "recorded_time")
OVERLAY_NOTE = "Only interpret the free-text cells below; structured fields are already handled deterministically."
STRINGS = "array<string>"


# ---------------------------------------------------------------- units and evidence


def readable_units(units: DataFrame, documents: DataFrame) -> DataFrame:
    """The units with content whose document is part of the corpus."""
    corpus = documents.filter("role = 'corpus'").select("document_id")
    return units.filter("trim(content) <> ''").join(corpus, "document_id", "left_semi")


def pending_order(units: DataFrame, done: DataFrame) -> DataFrame:
    """The units that aren't done with their turn: by priority, the highest first, then document, place and
    id; the units of the first one's document come before all others. units: unit_id, document_id, place,
    priority."""
    left = units.join(done.select("unit_id"), "unit_id", "left_anti")
    key = lambda c: F.struct(-F.col("priority"), "document_id", "place", F.col("unit_id").alias("u")) if c else None
    lead = left.agg(F.min_by("document_id", key(True)).alias("_lead"))  # one row
    both = left.crossJoin(F.broadcast(lead))
    own = both.select(F.when(F.col("document_id") == F.col("_lead"), 0).otherwise(1).alias("later"), *left.columns)
    return own.orderBy("later", F.desc("priority"), "document_id", "place", "unit_id")


def with_sources(evidence: DataFrame, documents: DataFrame) -> DataFrame:
    """Evidence with the path and hash of its document."""
    return evidence.join(documents.select("document_id", F.col("path").alias("source"), F.col("sha256").alias("file_sha256")), "document_id", "left")


def valid_references(evidence: DataFrame, units: DataFrame) -> DataFrame:
    """Evidence with only those assets, cells and shapes that its unit has (arrays on both sides); a kind
    that is left without any becomes text."""
    kinds = ("assets", "cells", "shapes")
    have = units.select("unit_id", *[F.col(k).alias(f"_{k}") for k in kinds])
    df = evidence.join(have, "unit_id", "left")
    none = F.array().cast(STRINGS)
    kept = {k: F.array_intersect(F.coalesce(k, none), F.coalesce(f"_{k}", none)) for k in kinds}
    df = df.withColumns(kept).drop(*[f"_{k}" for k in kinds])
    visual = (F.col("kind") == "visual") & (F.size("assets") + F.size("shapes") > 0)
    return df.withColumn("kind", F.when(visual, "visual").otherwise("text"))


def prepared(units: DataFrame, alias_units: DataFrame, cells: DataFrame) -> DataFrame:
    """unit_id, mode, action of every unit that isn't done: an alias table and a structural unit are done
    without a model, a sheet by rules where they find facts, with its free text left to the model as an
    overlay; all others go to the model. units: unit_id, mode, done; alias_units: unit_id; cells: unit_id,
    n_facts, n_overlay of the sheets."""
    df = units.filter("not coalesce(done, false)").join(alias_units.select("unit_id", F.lit(True).alias("_alias")), "unit_id", "left").join(cells, "unit_id", "left")
    sheet, overlay, facts = F.col("mode") == "xlsx_rule_or_fallback", F.coalesce("n_overlay", F.lit(0)) > 0, F.coalesce("n_facts", F.lit(0)) > 0
    mode = F.when(F.col("_alias"), "deterministic_alias_table").when(sheet & overlay, "xlsx_semantic_overlay").when(sheet & facts, "deterministic_xlsx").otherwise(F.col("mode"))
    action = F.when(F.col("_alias") | (F.col("mode") == "auto_no_facts") | (sheet & ~overlay & facts), "auto").when(sheet & overlay & facts, "model_with_prefill").otherwise("model")
    return df.select("unit_id", mode.alias("mode"), action.alias("action"))


def overlay_text(rows: DataFrame) -> DataFrame:
    """unit_id, content: a sheet's free-text cells with their row's context, as Markdown for the model. rows:
    unit_id, sheet, row, context and semantic (arrays of coordinate, header, raw)."""
    cell = lambda c, sep: F.concat(c["coordinate"], F.lit(" "), c["header"], F.lit(sep), c["raw"])
    context = F.when(F.size("context") > 0, F.concat(F.lit("Context: "), F.array_join(F.transform(F.slice("context", 1, 10), lambda c: cell(c, "=")), "; ")))
    lines = F.concat(F.array(F.lit(""), F.concat(F.lit("## Row "), F.col("row").cast("string"))), F.array_compact(F.array(context)), F.transform("semantic", lambda c: cell(c, ": ")))
    own = rows.groupBy("unit_id", "sheet").agg(F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row", lines.alias("l")))), lambda x: x["l"])), "\n").alias("_rows"))
    return own.select("unit_id", F.concat(F.lit("# Sheet: "), F.coalesce("sheet", F.lit("")), F.lit("\n\n" + OVERLAY_NOTE + "\n"), "_rows").alias("content"))


# ---------------------------------------------------------------- responses


def merged_prefill(prefill: DataFrame, supplied: DataFrame) -> DataFrame:
    """The items of both for units that were answered (unit_id, kind, local_id, ...): a mention whose local
    id the prefill has is the prefill's; everything else adds up."""
    answered = prefill.join(supplied.select("unit_id").distinct(), "unit_id", "left_semi")
    known = answered.filter("kind = 'mention'").select("unit_id", "kind", "local_id")
    return answered.unionByName(supplied.join(known, ["unit_id", "kind", "local_id"], "left_anti"))


def checked_mentions(raw: DataFrame) -> DataFrame:
    """Mentions of a response (task_id, pos, local_id, type, name, aliases, alias_declared): those of a known
    type and with a name get a mention_id, others a warning. A local id that the task has used before gets
    its place as a suffix; without one it is the place."""
    name = F.trim(F.coalesce("name", F.lit("")))
    ok = F.coalesce(F.col("type").isin(*TYPES), F.lit(False)) & (name != "")
    df = raw.withColumns({"name": name, "warning": F.when(~ok, "skipped_invalid_mention")})
    given = F.when(F.coalesce("local_id", F.lit("")) != "", F.col("local_id")).otherwise(F.concat(F.lit("m"), (F.col("pos") + 1).cast("string")))
    df = df.withColumn("local_id", F.when(ok, given))
    before = F.row_number().over(Window.partitionBy("task_id", "local_id").orderBy("pos"))
    again = F.concat("local_id", F.lit("_"), (F.col("pos") + 1).cast("string"))
    df = df.withColumn("local_id", F.when(ok & (before > 1), again).otherwise(F.col("local_id")))
    aliases = F.filter(F.transform(F.coalesce("aliases", F.array().cast(STRINGS)), F.trim), lambda a: a != "")
    return df.withColumns({"aliases": aliases, "alias_declared": F.coalesce("alias_declared", F.lit(False)), "mention_id": F.when(ok, ident("m", F.col("task_id"), F.col("local_id")))})


def checked_assertions(raw: DataFrame) -> DataFrame:
    """Literal facts of a response (task_id, subject_id, predicate, attribute, value, qualifiers): a predicate
    that isn't known becomes the attribute's name; a subject or value that is missing gives a warning."""
    said = F.trim(F.coalesce("predicate", F.lit("")))
    said = F.when(said == "", "attribute").otherwise(said)
    known = said.isin(*LITERAL_PREDICATES)
    told = F.coalesce(F.try_element_at("qualifiers", F.lit("attribute")), F.lit(""))
    fallback = F.when(F.coalesce("attribute", F.lit("")) != "", F.col("attribute")).when(said != "attribute", said).otherwise("value")
    needs = (~known | (said == "attribute")) & (told == "")
    none = F.create_map().cast("map<string,string>")
    qualifiers = F.map_filter(F.coalesce("qualifiers", none), lambda k, v: k != "attribute")
    named = F.map_concat(qualifiers, F.create_map(F.lit("attribute"), fallback))
    bad = F.when(F.col("subject_id").isNull() | F.col("value").isNull(), "skipped_unresolved_assertion")
    return raw.withColumns({"qualifiers": F.when(needs, named).otherwise(F.coalesce("qualifiers", none)), "predicate": F.when(known, said).otherwise("attribute"), "warning": bad})


def reviews(tasks: DataFrame, items: DataFrame) -> DataFrame:
    """task_id, status: facts where a task has any item, else what it says (no_facts, or facts). tasks:
    task_id, status; items: task_id of the mentions, relations and assertions that were kept."""
    has = items.select("task_id").distinct().withColumn("_has", F.lit(True))
    status = F.when(F.col("_has") | (F.coalesce("status", F.lit("")) != "no_facts"), "facts").otherwise("no_facts")
    return tasks.join(has, "task_id", "left").select("task_id", status.alias("status"))


# ---------------------------------------------------------------- alignment


def repaired_identity(mentions: DataFrame) -> DataFrame:
    """Mentions whose aliases are declared where their evidence holds the name and all of them, and whose
    inline codes are those that they own. mentions: mention_id, type, name, aliases, alias_declared,
    evidence (text), identifiers (array of scope, value)."""
    text, none = norm(F.col("evidence")), F.array().cast(STRINGS)
    labels = F.concat(F.array("name"), F.coalesce("aliases", none))
    told = F.forall(labels, lambda x: F.contains(text, norm(x))) & (F.size(F.coalesce("aliases", none)) > 0)
    scope = F.concat(F.lit("inline_"), F.lower("type"), F.lit("_code"))
    inline = [f"inline_{t.lower()}_code" for t in TYPES]
    owned = F.array_sort(F.array_distinct(F.flatten(F.transform(labels, lambda x: business_codes(x, F.col("evidence"))))))
    kind = "array<struct<scope:string,value:string>>"
    have = F.coalesce("identifiers", F.array().cast(kind))
    df = mentions.withColumn("_owned", owned)
    kept = F.filter(have, lambda i: ~norm(i["scope"]).isin(*inline) | F.exists(F.col("_owned"), lambda c: norm(c) == norm(i["value"])))
    df = df.withColumn("_kept", kept)
    new = F.filter(F.col("_owned"), lambda c: ~F.exists(F.col("_kept"), lambda i: (norm(i["scope"]) == norm(scope)) & (norm(i["value"]) == norm(c))))
    every = F.concat("_kept", F.transform(new, lambda c: F.struct(scope.alias("scope"), c.alias("value"))))
    return df.withColumns({"identifiers": every, "alias_declared": F.coalesce("alias_declared", F.lit(False)) | told}).drop("_owned", "_kept")


def joined_status(source: Column, target: Column) -> Column:
    """The status of a cluster that another has joined: records stay records, and anything else is looked
    at again."""
    record = (source == "record") | (target == "record")
    later = F.when(target == "record", "record").when((source == "uncertain") | (target == "uncertain"), "uncertain").otherwise(target)
    return F.when(record, later).otherwise("active")


def round_tasks(clusters: DataFrame, candidates: DataFrame, fingerprint: str, round_: int) -> dict[str, DataFrame]:
    """One round over a frozen snapshot: ``tasks`` (task_id, cluster_id, candidates) of the active and uncertain
    clusters that have candidates, ``statuses`` of all clusters, and ``stopped``, one row. Clusters without
    candidates wait; where no task is left the active ones are resolved and the rounds end. clusters:
    cluster_id, status; candidates: cluster_id, candidate, rank."""
    open_ = clusters.filter("status in ('active', 'uncertain')")
    found = candidates.join(open_.select("cluster_id"), "cluster_id", "left_semi").groupBy("cluster_id")
    found = found.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate"))), lambda x: x["candidate"]).alias("candidates"))
    parts = F.concat(F.array(F.lit(fingerprint), F.lit(str(round_)), F.col("cluster_id")), "candidates")
    task_id = F.concat(F.lit("align_"), F.substring(F.sha2(F.to_json(parts), 256), 1, 20))
    tasks = found.select(task_id.alias("task_id"), "cluster_id", "candidates")
    stopped = tasks.agg((F.count("*") == 0).alias("stopped"))  # one row
    status = F.when(F.col("stopped") & (F.col("status") == "active"), "resolved").otherwise(F.col("status"))
    statuses = clusters.crossJoin(F.broadcast(stopped)).select("cluster_id", status.alias("status"))
    return {"tasks": tasks, "statuses": statuses, "stopped": stopped}


def reset_alignment(fingerprint: Column, resets: Column) -> Column:
    """The fingerprint of a run whose alignment starts anew on the same extraction: older tables keep theirs."""
    return ident("run", fingerprint, F.lit("alignment"), resets.cast("string"))


# ---------------------------------------------------------------- gates


def completeness(documents: DataFrame, units: DataFrame, extractions: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: parse_failures, pending_units, open_clusters and complete, which a build needs unless it is
    partial."""
    failed = documents.agg(F.count_if(F.col("parse_status") == "failed").alias("parse_failures"))
    waiting = units.join(extractions.select("unit_id").distinct(), "unit_id", "left_anti").agg(F.count("*").alias("pending_units"))
    still = clusters.agg(F.count_if(F.col("status").isin("pending", "active", "uncertain")).alias("open_clusters"))
    row = failed.crossJoin(waiting).crossJoin(still)  # one row each
    return row.withColumn("complete", (F.col("parse_failures") == 0) & (F.col("pending_units") == 0) & (F.col("open_clusters") == 0))


def validated(gate: DataFrame, checks: DataFrame, graph_fingerprint: str | None, fingerprint: str, require_complete: bool = False) -> DataFrame:
    """check, level, n of a built graph's ``checks`` (check, level, n) with a stale fingerprint and, if asked
    for, an unfinished run as errors; a graph that isn't there is a warning. It is valid without errors."""
    built = F.lit(graph_fingerprint is not None)
    state = [
        ("not_built", "warning", F.lit(graph_fingerprint is None)),
        ("stale_fingerprint", "error", F.lit(graph_fingerprint is not None and graph_fingerprint != fingerprint)),
        ("incomplete", "error" if require_complete else "warning", ~F.col("complete") | ~built),
    ]
    rows = [gate.select(F.lit(c).alias("check"), F.lit(level).alias("level"), hit.cast("long").alias("n")) for c, level, hit in state]
    return reduce(DataFrame.unionByName, rows, checks.select("check", "level", F.col("n").cast("long").alias("n")))
