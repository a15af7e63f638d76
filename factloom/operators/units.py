"""Document units: routing, chunking, batching, geometry of page words, and continued tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import ALIAS_CUES, EVENT_CUES, METRIC_CUES, RELATION_CUES, cue_count, date_count, id_like_count


def route(units: DataFrame, vocabulary: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """unit_id, mode, priority, score and signals of units (unit_id, content; optional kind, format,
    n_assets, hidden). The vocabulary has cues for relation, metric, event and alias."""
    cues = {"relation": RELATION_CUES, "metric": METRIC_CUES, "event": EVENT_CUES, "alias": ALIAS_CUES} | (vocabulary or {})
    have = units.columns
    text = F.coalesce(F.col("content"), F.lit(""))
    kind = F.coalesce(F.col("kind"), F.lit("")) if "kind" in have else F.lit("")
    fmt = F.coalesce(F.col("format"), F.lit("")) if "format" in have else F.lit("")
    hidden = F.coalesce(F.col("hidden"), F.lit(False)) if "hidden" in have else F.lit(False)
    assets = F.coalesce(F.col("n_assets"), F.lit(0)) if "n_assets" in have else F.lit(0)
    table = kind.isin("xlsx_cells", "pdf_table", "pptx_shapes") & (F.contains(text, F.lit("|")) | (kind == "xlsx_cells"))
    visual = (assets > 0) & fmt.isin("png", "jpg", "jpeg", "webp")
    lines = F.filter(F.transform(F.split(text, "\n"), F.trim), lambda s: (s != "") & ~s.startswith("#"))
    df = units.select(
        "unit_id",
        *[cue_count(text, c).alias(n) for n, c in cues.items()],
        id_like_count(text).alias("id_like"),
        date_count(text).alias("dates"),
        F.size(lines).alias("lines"),
        F.length(F.trim(text)).alias("chars"),
        table.alias("table_like"),
        visual.alias("visual"),
        hidden.alias("hidden"),
        (kind == "xlsx_cells").alias("cells"),
    )
    flag = lambda c, n: F.when(F.col(c), n).otherwise(0)
    score = flag("visual", 3) + flag("table_like", 2) + F.least(F.col("relation"), F.lit(3)) + F.least(F.col("metric"), F.lit(2)) + F.least(F.col("event"), F.lit(2))
    score = score + F.least(F.col("alias") * 2, F.lit(4)) + F.least(F.col("id_like"), F.lit(2)) + F.least(F.col("dates"), F.lit(1)) + flag("hidden", 2)
    bare = (F.col("chars") < 90) & ~F.col("table_like") & ~F.col("visual") & (F.col("relation") + F.col("metric") + F.col("event") + F.col("alias") + F.col("id_like") == 0) & (F.col("lines") <= 2)
    mode, priority = F.lit(None).cast("string"), F.lit(None).cast("int")
    table_of = (("auto_no_facts", bare, None), ("llm_visual", F.col("visual"), 100), ("xlsx_rule_or_fallback", F.col("cells"), 80), ("llm_structured", F.col("table_like"), 70), ("llm_semantic", F.col("score") >= 5, 60), ("llm_batch", F.lit(True), 20))
    for name, when, base in reversed(table_of):
        mode = F.when(when, name).otherwise(mode)
        priority = F.when(when, F.lit(0) if base is None else F.col("score") + base).otherwise(priority)
    return df.withColumn("score", score).withColumn("mode", mode).withColumn("priority", priority.cast("int"))


#: What a text is cut at, from coarse to fine; the first keeps its blank lines as pieces of their own.
CUTS = (r"(\n\s*\n)", r"(?<=\n)", r"(?<=[。！？.!?])")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def split_text(text: str, budget: int) -> list[str]:
    """Chunks of about ``budget`` characters. Pieces are added to the running chunk, which closes before one
    that would exceed the budget; a piece that is longer by itself goes in by its own pieces, so paragraphs
    are cut at lines and lines at sentences, but for table rows. A text without content is one empty chunk."""
    out: list[str] = []
    now: list[str] = []

    def add(piece: str, finer: tuple[str, ...]) -> None:
        if sum(map(len, now)) + len(piece) > budget and (done := "".join(now).strip()):
            out.append(done)
            now.clear()
        if len(piece) > budget and finer and not (len(finer) == 1 and piece.lstrip().startswith("|")):
            for part in filter(None, re.split(finer[0], piece)):
                add(part, finer[1:])
        else:
            now[:] = ["".join(now), piece]

    for block in filter(None, re.split(CUTS[0], CONTROL.sub("", re.sub(r"\r\n?", "\n", text)))):
        add(block, CUTS[1:])
    if last := "".join(now).strip():
        out.append(last)
    return out or [""]


def chunks(docs: DataFrame, budget: int = 12_000, key: str = "doc_id") -> DataFrame:
    """key, chunk, content, size of every chunk of every text, in one pass."""
    kind = docs.schema[key].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            rows = [(i, n, c) for i, t in enumerate(b.column(1).to_pylist()) for n, c in enumerate(split_text(t or "", budget))]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string())], names=[key, "chunk", "content"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, chunk int, content string").withColumn("size", F.length("content"))


def batches(items: DataFrame, by: str, order: list[str], size: Column, budget: int, most: int) -> DataFrame:
    """by, order, size, batch: in order, a batch closes when the next item would exceed ``budget`` or ``most``.

    Each group of ``by``, a document or a sheet, streams by in order; a task remembers one batch's totals.
    """
    rows = items.select(by, *order, size.cast("long").alias("size"))
    at = len(order) + 1

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, n, total, batch = None, False, 0, 0, 0
        for b in found:
            out = []
            for g, s in zip(b.column(0).to_pylist(), b.column(at).to_pylist(), strict=True):
                if not begun or g != now:
                    now, begun, n, total, batch = g, True, 0, 0, 0
                if n and (n >= most or total + s > budget):
                    n, total, batch = 0, 0, batch + 1
                n, total = n + 1, total + s
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*b.schema.names, "batch"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", batch long"
    return rows.repartition(by).sortWithinPartitions(by, *order, "size").mapInArrow(run, schema)


def header_columns(words: DataFrame, gap: float = 8.0, boxes: DataFrame | None = None) -> DataFrame:
    """page, col, left, right, header: words of a header (page, x0, x1, text) clustered where the gap to all
    words before is at most ``gap``; midpoints between clusters are the borders, the outer ones those of the
    table (boxes: page, x0, x1) or open. Clusters without a letter or digit go; a header of fewer than two
    words or clusters is none."""
    w = Window.partitionBy("page").orderBy("x0", "x1", "text")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    col = F.sum(F.when(F.col("x0") - F.col("_reach") > gap, 1).otherwise(0)).over(w)
    parts = words.withColumn("_reach", reach).withColumn("col", col).withColumn("_words", F.count("*").over(Window.partitionBy("page"))).filter("_words > 1")
    own = F.array_sort(F.collect_list(F.struct("x0", "x1", "text")))
    start = F.struct(F.lit("").alias("t"), F.lit(None).cast("double").alias("x"))

    def add(a: Column, word: Column) -> Column:
        apart = (word["x0"] - a["x"] > 2.5) & a["t"].rlike("[A-Za-z0-9]$") & word["text"].rlike("^[A-Za-z0-9]")
        return F.struct(F.concat(a["t"], F.when(apart, " ").otherwise(""), word["text"]).alias("t"), word["x1"].cast("double").alias("x"))

    cols = parts.groupBy("page", "col").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.aggregate(own, start, add)["t"].alias("header"))
    v = Window.partitionBy("page").orderBy("x0")
    cols = cols.filter(F.col("header").rlike("[A-Za-z0-9一-鿿]")).withColumn("_n", F.count("*").over(Window.partitionBy("page"))).filter("_n > 1")
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    if boxes is not None:
        cols = cols.join(boxes.select("page", F.col("x0").alias("_low"), F.col("x1").alias("_high")), "page", "left")
        low, high = F.coalesce("_low", low), F.coalesce("_high", high)
    left = F.coalesce((F.lag("x1").over(v) + F.col("x0")) / 2, low)
    right = F.coalesce((F.col("x1") + F.lead("x0").over(v)) / 2, high)
    return cols.select("page", (F.row_number().over(v) - 1).cast("int").alias("col"), left.alias("left"), right.alias("right"), "header")


def band_words(words: DataFrame, columns: DataFrame) -> DataFrame:
    """words with the column whose band holds their centre."""
    x = (F.col("x0") + F.col("x1")) / 2
    return words.join(columns.select(F.col("page").alias("_p"), "col", "left", "right"), (F.col("page") == F.col("_p")) & (x >= F.col("left")) & (x < F.col("right"))).drop("_p", "left", "right")


def merge_words(words: DataFrame, keys: list[str], drop: float = 3.0, gap: float = 2.5) -> DataFrame:
    """keys, content: words in reading order; a new line where the top moves by more than ``drop``, a blank
    only between ASCII letters or digits further apart than ``gap``."""
    w = Window.partitionBy(*keys).orderBy("top", "x0")
    last, end, top = F.lag("text").over(w), F.lag("x1").over(w), F.lag("top").over(w)
    ascii_ = last.rlike("[A-Za-z0-9]$") & F.col("text").rlike("^[A-Za-z0-9]")
    joint = F.when(last.isNull(), "").when(F.abs(F.col("top") - top) > drop, "\n").when(ascii_ & (F.col("x0") - end > gap), " ").otherwise("")
    parts = words.withColumn("_j", joint)
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("top", "x0", "_j", "text"))), lambda t: F.concat(t["_j"], t["text"])), "").alias("content"))


def continued_tables(tables: DataFrame, span: float = 18.0) -> DataFrame:
    """tables (doc, page, table, top, bottom, left, right, height, header) with inherited_from: the page
    before, if this is the first table of its page in its top 15 %, that page's last ends below 80 %, and
    both span the same width."""
    w = Window.partitionBy("doc", "page").orderBy("table")
    t = tables.withColumn("_n", F.row_number().over(w)).withColumn("_last", F.row_number().over(w.orderBy(F.desc("table"))) == 1)
    before = t.filter("_last").select(F.col("doc").alias("_d"), (F.col("page") + 1).alias("_p"), F.col("bottom").alias("_b"), F.col("left").alias("_l"), F.col("right").alias("_r"), F.col("height").alias("_h"))
    j = t.join(before, (F.col("doc") == F.col("_d")) & (F.col("page") == F.col("_p")), "left")
    ok = (F.col("_n") == 1) & (F.col("top") <= 0.15 * F.col("height")) & (F.col("_b") >= 0.8 * F.col("_h")) & (F.abs(F.col("left") - F.col("_l")) <= span) & (F.abs(F.col("right") - F.col("_r")) <= span)
    return j.withColumn("inherited_from", F.when(ok, F.col("page") - 1)).select(*tables.columns, "inherited_from")
