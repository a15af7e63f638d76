"""Tables inside units: header inference, free-text overlays, alias tables, continued tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import header_role, markdown_rows, norm, ontology_type
from factloom.operators.search import bm25_scan

#: Measure words of second header rows, and headers of free text.
MEASURES = ("单价", "数量", "金额", "率", "日期")
FREE_TEXT = ("备注", "原因", "说明", "内容", "影响", "结论", "风险", "反馈")
ALIGNABLE = ("Product", "AITool", "Actor", "DataAsset", "Version")
CONTEXT_CELLS = 10


def sheet_headers(cells: DataFrame) -> DataFrame:
    """sheet, col, header, depth from the first two rows (sheet, row, col, raw): the second row joins the
    header if it is mostly text and fills a blank of the first or names a measure."""
    raw = F.trim(F.coalesce("raw", F.lit("")))
    c = cells.filter("row <= 2").select("sheet", "row", "col", raw.alias("raw")).filter("raw <> ''")
    number = F.col("raw").rlike(r"^[-+]?[0-9]+(?:\.[0-9]+)?%?$") | F.col("raw").rlike("^20[0-9]{2}[-/.年]")
    first = c.filter("row = 1").select("sheet", "col", F.lit(True).alias("_there"))
    second = c.filter("row = 2").join(first, ["sheet", "col"], "left")
    measure = F.lit(False)
    for m in MEASURES:
        measure = measure | F.contains("raw", F.lit(m))
    n = second.groupBy("sheet").agg(F.count("*").alias("n"), F.count_if(number).alias("numbers"), F.max(F.col("_there").isNull() | measure).alias("more"))
    two = n.filter((F.col("numbers") <= F.greatest(F.lit(1), F.floor(F.col("n") / 3))) & F.col("more")).select("sheet", F.lit(2).alias("depth"))
    rows = c.join(two, "sheet", "left").withColumn("depth", F.coalesce("depth", F.lit(1))).filter("row <= depth")
    parts = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("row", "raw"))), lambda x: x["raw"]))
    return rows.groupBy("sheet", "col", "depth").agg(F.array_join(parts, "/").alias("header"))


def free_text_overlay(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """sheet, row, semantic, context: rows with text in a free-text column, that text by header, and up to
    ten other cells. Header rows are left out."""
    free = F.lit(False)
    for t in FREE_TEXT:
        free = free | F.contains("header", F.lit(t))
    body = cells.join(F.broadcast(headers), ["sheet", "col"]).filter((F.col("row") > F.col("depth")) & (F.trim("raw") != "")).withColumn("free", free)
    cell = F.struct("col", F.concat("header", F.lit("="), F.trim("raw")).alias("t"))
    ordered = lambda when: F.transform(F.array_sort(F.collect_list(F.when(when, cell))), lambda x: x["t"])
    rows = body.groupBy("sheet", "row").agg(ordered(F.col("free")).alias("semantic"), F.slice(ordered(~F.col("free")), 1, CONTEXT_CELLS).alias("context"))
    return rows.filter(F.size("semantic") > 0)


def alias_mentions(units: DataFrame) -> DataFrame:
    """unit_id, local_id, type, name, aliases of units (unit_id, content, section) that are alias tables:
    one canonical column and an alias column or two columns of names. A row without a sure type, of its
    own or of its table, leaves the whole table out."""
    t = units.select("unit_id", F.coalesce("section", F.lit("")).alias("section"), markdown_rows(F.col("content")).alias("rows")).filter(F.size("rows") > 1)
    t = t.withColumn("head", F.element_at("rows", 1)).withColumn("roles", F.transform("head", header_role))
    at = lambda *names: F.filter(F.transform("roles", lambda r, i: F.when(r.isin(*names), i)), lambda i: i.isNotNull())
    t = t.withColumns({"canon": at("canonical"), "alias": at("alias"), "others": at("alias", "name_like"), "types": at("type")})
    t = t.filter((F.size("canon") == 1) & ((F.size("alias") > 0) | (F.size("others") > 1)))
    t = t.withColumn("table_type", ontology_type(F.concat_ws(" ", "section", F.array_join("head", " "))))
    rows = t.select("*", F.posexplode("rows").alias("i", "cells")).filter((F.col("i") > 0) & (F.size("cells") == F.size("head")))
    name = F.trim(F.get("cells", F.col("canon")[0]))
    row_type = F.when(F.size("types") == 1, ontology_type(F.get("cells", F.col("types")[0])))
    rows = rows.withColumns({"name": name, "type": F.coalesce(row_type, F.col("table_type"))}).filter("name <> ''")
    values = F.array_distinct(F.filter(F.transform("others", lambda i: F.trim(F.get("cells", i))), lambda v: (v != "") & (norm(v) != norm(F.col("name")))))
    sure = F.min(F.coalesce(F.col("type").isin(*ALIGNABLE), F.lit(False))).over(Window.partitionBy("unit_id"))
    rows = rows.withColumn("aliases", values).withColumn("_sure", sure).filter(F.col("_sure") & (F.size("aliases") > 0))
    return rows.select("unit_id", F.concat(F.lit("alias_"), F.col("i").cast("string")).alias("local_id"), "type", "name", "aliases")


def table_roots(tables: DataFrame, slack: float = 4.0, rounds: int = 20) -> DataFrame:
    """unit_id, root of tables (unit_id, doc, page, inherited, header, left, right, bottom): a table that
    inherits its schema follows the lowest table of that page with the same header and width; pointers
    double each round."""
    key = F.transform("header", norm)
    t = tables.withColumn("_h", F.array_join(key, "|"))
    up = t.select(F.col("unit_id").alias("parent"), F.col("doc").alias("_d"), F.col("page").alias("_p"), F.col("_h").alias("_k"), F.col("left").alias("_l"), F.col("right").alias("_r"), F.col("bottom").alias("_b"))
    near = (F.abs(F.col("left") - F.col("_l")) <= slack) & (F.abs(F.col("right") - F.col("_r")) <= slack)
    fits = (F.col("doc") == F.col("_d")) & (F.col("inherited") == F.col("_p")) & (F.col("_h") == F.col("_k")) & (F.col("unit_id") != F.col("parent")) & near
    w = Window.partitionBy("unit_id").orderBy(F.desc("_b"), "parent")
    links = t.join(up, fits).withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("unit_id", "parent")
    root = t.select("unit_id").join(links, "unit_id", "left").select("unit_id", F.coalesce("parent", "unit_id").alias("root"))
    for _ in range(rounds):
        jump = root.select(F.col("unit_id").alias("root"), F.col("root").alias("next"))
        new = root.join(jump, "root").select("unit_id", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("_moved"))
        moved = not new.filter("_moved").isEmpty()
        root = new.select("unit_id", "root")
        if not moved:
            break
    return root


def reconstruct(questions: DataFrame, tables: DataFrame, named: float = 40.0) -> DataFrame:
    """qid, unit_id, header, n_rows, score: all parts of each question's best table. questions: qid, text;
    tables also have content and n_rows. The part of a question before a second request counts; a table
    whose text holds a name that the question gives before 表 gains ``named``."""
    roots = table_roots(tables)
    text = F.concat_ws(" ", F.array_join(F.array_repeat(F.array_join("header", " "), 3), " "), F.col("content"))
    parts = tables.join(roots, "unit_id").withColumn("text", text)
    groups = parts.groupBy("root").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "unit_id", "text"))), lambda x: x["text"]), " ").alias("text"))
    primary = F.element_at(F.split("text", "同时|此外|另外"), 1)
    q = questions.select("qid", primary.alias("text"))
    scored = bm25_scan(groups.withColumnRenamed("root", "id"), q)
    stem = F.regexp_extract(F.col("qtext"), "([A-Za-z0-9_一-鿿-]{4,39})表(?=[（(的中，。])", 1)
    stems = q.select("qid", F.col("text").alias("qtext")).select("qid", norm(F.element_at(F.split(stem, "中的|里的|中|的"), -1)).alias("stem")).filter(F.length("stem") >= 4)
    bonus = stems.join(groups, F.contains(norm(groups["text"]), F.col("stem"))).select("qid", F.col("root").alias("id"), F.lit(named).alias("score"))
    total = scored.select("qid", "id", "score").unionByName(bonus).groupBy("qid", "id").agg(F.round(F.sum("score"), 6).alias("score"))
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.desc("id"))
    best = total.withColumn("_n", F.row_number().over(w)).filter("_n = 1 and score > 0").select("qid", F.col("id").alias("root"), "score")
    return best.join(parts, "root").select("qid", "unit_id", "header", "n_rows", "score")


