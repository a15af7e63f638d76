"""The queries over the star schema, documents, pages and conversations, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.functions.ids import ident
from factloom.operators import align, build, entries, extract, graph, protocol, retrieve, search, tables, units
from factloom.plans import context, planner
from factloom.sources import sinks
from factloom.sources.scratch import kept
from factloom.streaming import intake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives its rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(rows: list[tuple], columns: str) -> str:
    """Rows as an SQL table for both engines."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({columns}))"


# ---------------------------------------------------------------- search

WORDS = r"regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+(?:[_.+\-/][a-z0-9]+)*')"
TOKENS = f"list_filter({WORDS}, lambda t: length(t) > 1 AND t NOT IN ('sheet', 'slide'))"
BM25_SQL = f"""
 toks AS (SELECT doc_id, unnest(CASE WHEN len({TOKENS}) = 0 THEN ['__empty__'] ELSE {TOKENS} END) AS term FROM docs),
 post AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL),
 lens AS (SELECT doc_id, sum(tf) AS dl FROM post GROUP BY ALL),
 stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM lens),
 dfs AS (SELECT term, count(*) AS df FROM post GROUP BY ALL),
 qt AS (SELECT qid, unnest({TOKENS}) AS term FROM qs),
 qm AS (SELECT qid, term, count(*) AS times FROM qt GROUP BY ALL),
 scored AS (SELECT qid, doc_id, round(sum(times * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / greatest(avgdl, 1e-9)))), 6) AS score
   FROM post JOIN qm USING (term) JOIN dfs USING (term) JOIN lens USING (doc_id) CROSS JOIN stats GROUP BY ALL)"""


def scored_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25_scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text"), "doc_id")


@query(f"""WITH docs AS (SELECT doc_id, text FROM documents), qs AS (SELECT item_id AS qid, text FROM benchmark), {BM25_SQL}
SELECT qid, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 10""")
def raw_bm25_topk(spark, sf_dir):
    return search.top(scored_benchmark(spark, sf_dir), 10, "doc_id").withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH toks AS (SELECT doc_id, unnest({TOKENS}) AS term FROM documents)
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM toks GROUP BY term""")
def token_document_frequency(spark, sf_dir):
    post = search.postings(table(spark, sf_dir, "documents"), "doc_id").filter("term <> '__empty__'")
    return post.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@query(f"""WITH docs AS (SELECT doc_id, text FROM documents),
 parts AS (SELECT item_id, 0 AS i, 2.2 AS weight, text FROM benchmark UNION ALL SELECT item_id, 1, 0.7, substr(text, 1, 60) FROM benchmark),
 qs AS (SELECT item_id * 2 + i AS qid, text FROM parts), {BM25_SQL},
 ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS r FROM scored),
 fused AS (SELECT qid // 2 AS item, doc_id, round(sum(CASE WHEN qid % 2 = 0 THEN 2.2 ELSE 0.7 END / (60 + r)), 8) AS score FROM ranked WHERE r <= 30 GROUP BY ALL),
 kinds AS (SELECT f.*, lang, source, row_number() OVER (PARTITION BY item, lang, source ORDER BY score DESC, doc_id) AS seen FROM fused f JOIN documents USING (doc_id)),
 own AS (SELECT *, row_number() OVER (PARTITION BY item, lang ORDER BY CASE WHEN seen = 1 THEN 0 ELSE 1 END, score DESC, doc_id) AS o FROM kinds),
 n AS (SELECT item, count(DISTINCT lang) AS k FROM kinds GROUP BY ALL),
 fin AS (SELECT own.*, row_number() OVER (PARTITION BY item ORDER BY CASE WHEN o <= greatest(1, 8 // k) THEN 0 ELSE 1 END, score DESC, doc_id) AS rank FROM own JOIN n USING (item))
SELECT item AS qid, doc_id, score, lang, source, rank FROM fin WHERE rank <= 8""")
def raw_weighted_rrf_quota(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    whole = bench.select((F.col("item_id") * 2).alias("qid"), "text")
    part = bench.select((F.col("item_id") * 2 + 1).alias("qid"), F.substr("text", F.lit(1), F.lit(60)).alias("text"))
    ranked = search.top(search.bm25_scan(docs, whole.unionByName(part), "doc_id"), 30, "doc_id")
    weight = F.when(F.col("qid") % 2 == 0, 2.2).otherwise(0.7)
    fused = search.reciprocal_ranks(ranked.select(F.floor(F.col("qid") / 2).alias("qid"), "doc_id", "rank", weight.alias("weight")), key="doc_id")
    out = search.format_quota(fused.join(docs.select("doc_id", "lang", "source"), "doc_id"), 8, "lang", "source", "doc_id")
    return out.select("qid", "doc_id", "score", "lang", "source", F.col("rank").cast("long").alias("rank"))


@query("""WITH a AS (SELECT p_type AS qid, p_partkey AS id, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS r FROM part),
 b AS (SELECT p_type AS qid, p_partkey AS id, row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS r FROM part)
SELECT qid, id, round(sum(w / (60 + r)), 8) AS score FROM (SELECT qid, id, r, 1.0 AS w FROM a WHERE r <= 50 UNION ALL SELECT qid, id, r, 1.6 FROM b WHERE r <= 50) GROUP BY ALL""")
def rrf_fusion(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_type").alias("qid"), F.col("p_partkey").alias("id"), "p_retailprice", "p_size")
    a = search.top(part, 50, score="p_retailprice").select("qid", "id", "rank", F.lit(1.0).alias("weight"))
    b = search.top(part, 50, score="p_size").select("qid", "id", "rank", F.lit(1.6).alias("weight"))
    return search.reciprocal_ranks(a.unionByName(b))


@query("""WITH d AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders),
 c AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS m FROM d WHERE n <= 2)
SELECT o_orderpriority AS qid, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM c WHERE m <= 14""")
def fact_family_cap(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("qid"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return search.capped(o, ["o_custkey", "o_orderstatus"], 2, 14, "o_orderkey", "o_totalprice")


@query("""SELECT b.item_id AS qid, d.doc_id, 12 + length(regexp_replace(replace(lower(b.text), 'ß', 'ss'), '\\s+', '', 'g')) AS score
FROM benchmark b JOIN documents d ON contains(regexp_replace(replace(lower(d.text), 'ß', 'ss'), '\\s+', '', 'g'), regexp_replace(replace(lower(b.text), 'ß', 'ss'), '\\s+', '', 'g'))""")
def entity_linking(spark, sf_dir):
    return linked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("label")))


def linked(docs, bench, anchor: int = 16):
    # labels meet texts under the label's first characters, which any text that contains it has
    labels = bench.filter("label is not null").select("qid", T.norm(F.col("label")).alias("n")).withColumn("anchor", F.substring("n", 1, anchor))
    texts = docs.filter("text is not null").select("doc_id", T.norm(F.col("text")).alias("t"))
    anchors = docs.sparkSession.sparkContext.broadcast({r["anchor"] for r in labels.select("anchor").distinct().collect()})

    def meet(found):
        known = anchors.value
        sizes = {len(x) for x in known}
        for b in found:
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                hits = [x for n in sizes for x in known.intersection(t[j : j + n] for j in range(len(t) - n + 1))]
                if hits:
                    row = b.slice(i, 1).take([0] * len(hits))
                    yield pa.RecordBatch.from_arrays([row.column(0), row.column(1), pa.array(hits, pa.string())], names=["doc_id", "t", "anchor"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    pairs = texts.mapInArrow(meet, f"doc_id {kind}, t string, anchor string").join(labels, "anchor")
    return pairs.filter(F.contains("t", "n")).select("qid", "doc_id", (12 + F.length("n")).cast("long").alias("score"))


# ---------------------------------------------------------------- units and routing

CUES = {"relation": ("the ", "of "), "metric": ("%", "|"), "event": ("on ",), "alias": ("and ",)}
COUNT = lambda cue: f"(length(low) - length(replace(low, '{cue}', ''))) // {len(cue)}"
ROUTED = f"""WITH d AS (SELECT doc_id, text, replace(lower(text), 'ß', 'ss') AS low FROM documents),
 s AS (SELECT doc_id, {COUNT('the ')} + {COUNT('of ')} AS relation, {COUNT('%')} + {COUNT('|')} AS metric, {COUNT('on ')} AS event, {COUNT('and ')} AS alias,
   len(regexp_extract_all(text, '\\b[A-Z]{{1,6}}[0-9]{{1,8}}\\b')) + len(regexp_extract_all(text, '\\b[A-Z]{{2,12}}[-_][A-Z0-9][A-Z0-9_-]{{1,24}}\\b')) AS id_like,
   len(regexp_extract_all(text, '\\b20[0-9]{{2}}(?:[-/.年][0-9]{{1,2}})?(?:[-/.月][0-9]{{1,2}})?')) AS dates,
   len(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(x, '#'))) AS lines, length(trim(text)) AS chars FROM d),
 r AS (SELECT *, least(relation, 3) + least(metric, 2) + least(event, 2) + least(alias * 2, 4) + least(id_like, 2) + least(dates, 1) AS score FROM s),
 m AS (SELECT *, CASE WHEN chars < 90 AND relation + metric + event + alias + id_like = 0 AND lines <= 2 THEN 'auto_no_facts' WHEN score >= 5 THEN 'llm_semantic' ELSE 'llm_batch' END AS mode FROM r)"""


def routed(spark, sf_dir):
    return units.route(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"), F.col("text").alias("content")), CUES)


@query(ROUTED + " SELECT doc_id AS unit_id, mode, score, CASE mode WHEN 'auto_no_facts' THEN 0 WHEN 'llm_semantic' THEN 60 + score ELSE 20 + score END AS priority FROM m")
def unit_routing(spark, sf_dir):
    return routed(spark, sf_dir).select("unit_id", "mode", F.col("score").cast("long").alias("score"), F.col("priority").cast("long").alias("priority"))


@query(ROUTED + " SELECT mode, count(*) AS n FROM m GROUP BY mode")
def routing_histogram(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("mode").agg(F.count("*").alias("n"))


@query()
def unit_chunks(spark, sf_dir):
    return units.chunks(table(spark, sf_dir, "documents"), 2000).select("doc_id", "chunk", "size", F.sha2("content", 256).alias("digest"))


@query("SELECT doc_id, source FROM documents WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def role_scan_pending(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("lang <> 'en'").select("doc_id", "source")
    return extract.pending(docs, table(spark, sf_dir, "labels"), "doc_id")


BATCH = """WITH RECURSIVE o AS (SELECT source, doc_id, least(length(text), 14000) AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
 f AS (SELECT source, doc_id, s, i, 1 AS n, s AS t, 0 AS b FROM o WHERE i = 1
  UNION ALL SELECT o.source, o.doc_id, o.s, o.i, CASE WHEN f.n >= 5 OR f.t + o.s > 14000 THEN 1 ELSE f.n + 1 END, CASE WHEN f.n >= 5 OR f.t + o.s > 14000 THEN o.s ELSE f.t + o.s END,
   CASE WHEN f.n >= 5 OR f.t + o.s > 14000 THEN f.b + 1 ELSE f.b END FROM f JOIN o ON o.source = f.source AND o.i = f.i + 1)
SELECT source, doc_id, s AS size, b AS batch FROM f"""


@query(BATCH.replace("AS s,", "::BIGINT AS s,").replace("0 AS b", "0::BIGINT AS b"))
def batch_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return units.batches(docs, "source", ["doc_id"], F.least(F.length("text"), F.lit(14000)), 14000, 5)


@query("""SELECT page_id, count(*) AS n_lines, sum(length(l))::BIGINT AS chars FROM (SELECT page_id, unnest(list_filter(list_transform(string_split(regexp_replace(html, '<[^>]*>', chr(10), 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '')) AS l FROM pages) GROUP BY page_id""")
def page_text_units(spark, sf_dir):
    text = F.regexp_replace("html", "<[^>]*>", "\n")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != "")
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(lines).alias("line"))
    return rows.groupBy("page_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("chars"))


PIPED = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: regexp_matches(x, '^\\|.*\\|$'))"
TABLES = [(1, "| a | b |\n| --- | :---: |\n| 1<br>2 | x |\nnot a row\n|  | y |"), (2, "plain"), (3, "|one|\n|---|\n|two|")]


@query(f"""WITH t AS {values(TABLES, 'doc_id, text')}, r AS (SELECT doc_id, unnest({PIPED}) AS line, generate_subscripts({PIPED}, 1) AS i FROM t),
 c AS (SELECT doc_id, i, list_transform(string_split(substr(line, 2, length(line) - 2), '|'), lambda x: trim(regexp_replace(x, '(?i)<br\\s*/?>', ' ', 'g'))) AS cells FROM r)
SELECT doc_id, array_to_string(cells, '/') AS cells, len(cells) AS n FROM c WHERE len(list_filter(cells, lambda x: NOT regexp_matches(x, '^:?-{{3,}}:?$'))) > 0""")
def page_table_rows(spark, sf_dir):
    df = spark.sql(f"SELECT * FROM {values([(i, t) for i, t in TABLES], 'doc_id, text')}".replace("\n", "\\n"))
    rows = df.select(F.col("doc_id"), F.explode(T.markdown_rows(F.col("text"))).alias("cells"))
    return rows.select("doc_id", F.array_join("cells", "/").alias("cells"), F.size("cells").cast("long").alias("n"))


# ---------------------------------------------------------------- structured entries

CELLS = """(SELECT 'customers:' || c_custkey || ':' || f AS entry_id, 'customers' AS sheet, c_custkey AS row, f AS field, v AS value FROM
 (SELECT c_custkey, unnest(['c_name', 'c_mktsegment', 'c_nationkey']) AS f, unnest([c_name, c_mktsegment, c_nationkey::VARCHAR]) AS v FROM customer)
 UNION ALL SELECT 'orders:' || o_orderkey || ':' || f, 'orders', o_orderkey, f, v FROM
 (SELECT o_orderkey, unnest(['o_orderstatus', 'o_orderpriority']) AS f, unnest([o_orderstatus, o_orderpriority]) AS v FROM orders))"""


def cells(spark, sf_dir):
    a = entries.unpivot(table(spark, sf_dir, "customer"), "customers", "c_custkey", ["c_name", "c_mktsegment", "c_nationkey"])
    return a.unionByName(entries.unpivot(table(spark, sf_dir, "orders"), "orders", "o_orderkey", ["o_orderstatus", "o_orderpriority"])).drop("kind")


@query(f"SELECT * FROM {CELLS}")
def structured_entries(spark, sf_dir):
    return cells(spark, sf_dir)


@query(f"""WITH s AS (SELECT *, count(*) OVER (PARTITION BY lower(regexp_replace(value, '\\s+', '', 'g'))) AS repeat_count FROM {CELLS} WHERE sheet = 'orders' AND field = 'o_orderpriority')
SELECT *, round(least(length(value) / 40.0, 1.5) + CASE WHEN regexp_matches(value, '[0-9]|→') THEN 1.6 ELSE 0.0 END - greatest(0, repeat_count - 1)::DOUBLE, 6) AS salience FROM s""")
def structured_exhaustive(spark, sf_dir):
    return entries.exhaustive(cells(spark, sf_dir), ["orders"], ["o_orderpriority"], True)


@query(f"""WITH p AS (SELECT *, count(*) OVER (PARTITION BY lower(regexp_replace(value, '\\s+', '', 'g'))) AS repeat_count FROM {CELLS}),
 s AS (SELECT *, round(9.0 + least(length(value) / 40.0, 1.5) + CASE WHEN regexp_matches(value, '[0-9]|→') THEN 0.4 ELSE 0.0 END - greatest(0, repeat_count - 1)::DOUBLE, 6) AS score FROM p WHERE sheet = 'customers' AND field = 'c_name')
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, sheet, row, entry_id) AS rank FROM s) WHERE rank <= 30""")
def structured_ranked(spark, sf_dir):
    out = entries.ranked(cells(spark, sf_dir), None, ["customers"], ["c_name"], expected=10, column_requested=True)
    return out.withColumn("rank", F.col("rank").cast("long"))


@query(f"SELECT *, 0::BIGINT AS repeat_count, 0.0::DOUBLE AS salience FROM {CELLS} WHERE false")
def unknown_column_empty(spark, sf_dir):
    return entries.exhaustive(cells(spark, sf_dir), ["orders"], [], True)


@query(f"""WITH h AS (SELECT sheet, row, max(length(value)) AS score FROM {CELLS} WHERE field = 'o_orderpriority' GROUP BY ALL),
 b AS (SELECT * FROM h ORDER BY score DESC, sheet, row LIMIT 24)
SELECT c.sheet, c.row, b.score, string_agg(field || '=' || value, '; ' ORDER BY field, value) AS cells FROM {CELLS} c JOIN b USING (sheet, row) GROUP BY ALL""")
def row_companions(spark, sf_dir):
    c = cells(spark, sf_dir)
    hits = c.filter("field = 'o_orderpriority'").select("sheet", "row", F.length("value").cast("long").alias("score"))
    return entries.companions(c, hits)


HINTS = [(1, "Excel处理备注"), (2, "备注"), (3, "不存在"), (4, "订单备注列")]
NAMES = [("备注",), ("处理备注",), ("价格",)]


@query(f"""WITH c AS {values(HINTS, 'qid, candidate')}, n AS {values(NAMES, 'name')},
 p AS (SELECT qid, name, length(name) AS l, max(length(name)) OVER (PARTITION BY qid) AS m FROM c JOIN n ON suffix(lower(candidate), lower(name)))
SELECT qid, min(name) AS hint FROM p WHERE l = m GROUP BY qid HAVING count(DISTINCT name) = 1""")
def schema_hints(spark, sf_dir):
    return entries.resolve_hint(spark.sql(f"SELECT * FROM {values(HINTS, 'qid, candidate')}"), spark.sql(f"SELECT * FROM {values(NAMES, 'name')}"))


# ---------------------------------------------------------------- extraction and graph build

ORDER_FACTS = """(SELECT unnest([{s: 'C' || o_custkey, p: 'purchased', o: 'P' || l_partkey, v: NULL, q: '{"period":"' || strftime(o_orderdate, '%Y-%m') || '"}'},
  {s: 'O' || o_orderkey, p: 'affects', o: 'P' || l_partkey, v: NULL, q: '{}'}, {s: 'O' || o_orderkey, p: 'has_participant', o: 'C' || o_custkey, v: NULL, q: '{}'},
  {s: 'O' || o_orderkey, p: 'event_time', o: NULL, v: strftime(o_orderdate, '%Y-%m-%d'), q: '{}'}]) AS f, l_orderkey || '-' || l_linenumber AS source_row FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def facts_of(spark, sf_dir):
    return extract.order_facts(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


@query(f"SELECT f.s AS subject, f.p AS predicate, f.o AS object, f.v AS value, f.q AS qualifiers, source_row FROM {ORDER_FACTS}")
def order_facts(spark, sf_dir):
    return facts_of(spark, sf_dir)


@query("""SELECT 'P' || p_partkey AS subject, 'attribute' AS predicate, v AS value, '{"attribute":"' || a || '"}' AS qualifiers FROM
 (SELECT p_partkey, unnest(['p_brand', 'p_type', 'p_size']) AS a, unnest([p_brand, p_type, p_size::VARCHAR]) AS v FROM part) WHERE v IS NOT NULL""")
def attribute_facts(spark, sf_dir):
    return extract.attribute_facts(table(spark, sf_dir, "part"), "P", "p_partkey", ["p_brand", "p_type", "p_size"])


def ident_sql(prefix: str, *cols: str) -> str:
    return f"""'{prefix}_' || substr(sha256('["' || {" || '\",\"' || ".join(cols)} || '"]'), 1, 20)"""


@query(f"""SELECT 'nation' AS kind, n_nationkey::BIGINT AS key, {ident_sql('m', "'nation'", 'n_name')} AS id FROM nation
UNION ALL SELECT 'part', p_partkey, {ident_sql('m', "'part'", 'p_partkey::VARCHAR', 'p_name')} FROM part""")
def content_ids(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("long").alias("key"), ident("m", F.lit("nation"), F.col("n_name")).alias("id"))
    p = table(spark, sf_dir, "part")
    return n.unionByName(p.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("key"), ident("m", F.lit("part"), F.col("p_partkey").cast("string"), F.col("p_name")).alias("id")))


def deduped(spark, sf_dir):
    f = facts_of(spark, sf_dir).filter("object is not null")
    return graph.dedup_facts(
        f.select("subject", "predicate", F.col("object").alias("object_key"), "qualifiers", F.lit("asserted").alias("origin"), F.lit(None).cast("string").alias("task_id"), F.col("source_row").alias("evidence_id"), F.col("object").alias("claim"))
    )


@query(f"""SELECT f.s AS subject, f.p AS predicate, f.o AS object, f.q AS qualifiers, count(DISTINCT source_row) AS n_evidence, min(source_row) AS first_evidence FROM {ORDER_FACTS} WHERE f.o IS NOT NULL GROUP BY ALL""")
def fact_dedup(spark, sf_dir):
    d = deduped(spark, sf_dir)
    return d.select("subject", "predicate", F.col("object_key").alias("object"), "qualifiers", F.size("evidence_ids").cast("long").alias("n_evidence"), F.array_min("evidence_ids").alias("first_evidence"))


@query(f"""SELECT f.s AS source, f.o AS target, f.p AS predicate, count(DISTINCT f.q) AS n_facts, CASE WHEN count(DISTINCT f.q) <= 1 THEN min(f.q) END AS qualifiers,
 CASE WHEN count(DISTINCT f.q) > 1 THEN 'fact_level' END AS qualifier_mode FROM {ORDER_FACTS} WHERE f.o IS NOT NULL GROUP BY ALL""")
def edge_projection(spark, sf_dir):
    e = graph.edges_of(deduped(spark, sf_dir))
    return e.select("source", "target", "predicate", F.size("fact_ids").cast("long").alias("n_facts"), "qualifiers", "qualifier_mode")


@query("""SELECT user_id, event_type, ts::DATE::VARCHAR AS day, count(DISTINCT value) AS n_values, count(*) AS n_claims, min(value) AS low, max(value) AS high FROM events GROUP BY ALL HAVING count(DISTINCT value) > 1""")
def metric_conflicts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    return graph.conflicts(e, ["user_id", "event_type", "day"], "value")


@query("""SELECT user_id, event_type, count(DISTINCT ts::DATE) AS n_scopes, count(*) AS n_observations FROM events GROUP BY ALL HAVING count(DISTINCT ts::DATE) > 1""")
def scope_comparison(spark, sf_dir):
    return graph.scope_comparisons(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["user_id", "event_type"], "day")


@query("""WITH n AS (SELECT p_brand AS entity_id, p_name AS name, count(*) AS n FROM part GROUP BY ALL)
SELECT entity_id, name FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, length(name) DESC, name) AS r FROM n) WHERE r = 1""")
def node_display_name(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return graph.display_names(p.select(F.col("p_brand").alias("entity_id"), F.col("p_name").alias("name"), F.lit(False).alias("has_identifier"), F.lit(False).alias("alias_declared")))


@query(f"""WITH f AS (SELECT DISTINCT f.s AS s, f.p AS p, f.o AS o, f.q AS q FROM {ORDER_FACTS} WHERE f.o IS NOT NULL),
 lost AS (SELECT 'P' || p_partkey AS id FROM part WHERE p_size = 7)
SELECT * FROM (VALUES ('duplicate_node', 'error', 0::BIGINT), ('duplicate_fact', 'error', 0), ('duplicate_edge', 'error', 0), ('duplicate_evidence', 'error', 0), ('dangling_subject', 'error', 0), ('edge_without_fact', 'error', 0), ('missing_evidence', 'warning', 0), ('unprojected_fact', 'warning', 0)) AS v("check", level, n)
UNION ALL SELECT 'dangling_object', 'error', count(*) FROM f WHERE o IN (SELECT id FROM lost)
UNION ALL SELECT 'dangling_source', 'error', 0 UNION ALL SELECT 'dangling_target', 'error', count(*) FROM (SELECT DISTINCT s, p, o FROM f WHERE o IN (SELECT id FROM lost))""")
def graph_integrity(spark, sf_dir):
    # a damaged graph: the nodes of the parts of one size are missing; facts and edges are made once
    facts = kept(deduped(spark, sf_dir).withColumn("object", F.col("object_key")), "facts")
    edges = kept(graph.edges_of(facts), "edges")
    node = lambda t, prefix, key, which="true": table(spark, sf_dir, t).filter(which).select(extract.entity(prefix, key).alias("id"))
    nodes = node("part", "P", "p_partkey", "p_size <> 7").unionByName(node("orders", "O", "o_orderkey")).unionByName(node("customer", "C", "c_custkey"))
    evidence = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("evidence_id")).distinct()
    return graph.integrity(nodes, facts, edges, evidence)


# ---------------------------------------------------------------- alignment


def part_mentions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("mention_id"), F.lit("Product").alias("type"), F.col("p_name").alias("name"), F.col("p_type").alias("variant"), F.col("p_brand").alias("brand"))


@query("""SELECT 'stable_name:Product:' || regexp_replace(lower(p_name), '\\s+', '', 'g') AS bucket, count(*) AS n, min(lpad(p_partkey::VARCHAR, 9, '0')) AS first FROM part GROUP BY ALL HAVING count(*) > 1""")
def stable_name_buckets(spark, sf_dir):
    return align.name_buckets(part_mentions(spark, sf_dir)).select("bucket", F.size("mentions").cast("long").alias("n"), F.col("mentions")[0].alias("first"))


@query("""WITH m AS (SELECT lpad(p_partkey::VARCHAR, 9, '0') AS id, regexp_replace(lower(p_name), '\\s+', '', 'g') AS k, p_type FROM part),
 g AS (SELECT *, count(*) OVER (PARTITION BY k) AS n, min(id) OVER (PARTITION BY k) AS lead FROM m),
 l AS (SELECT g.*, (SELECT p_type FROM m WHERE m.id = g.lead) AS lt FROM g)
SELECT id AS mention_id, CASE WHEN n > 1 AND p_type = lt THEN lead ELSE id END AS entity_id FROM l""")
def alias_closure(spark, sf_dir):
    m = part_mentions(spark, sf_dir)
    none = F.lit(None).cast("string")
    facts = m.select("mention_id", "type", "variant", none.alias("id_scope"), none.alias("id_value"), none.alias("event_date"))
    return align.guarded_merge(align.name_buckets(m), facts)


@query("""WITH m AS (SELECT lpad(p_partkey::VARCHAR, 9, '0') AS id, regexp_replace(lower(p_name), '\\s+', '', 'g') AS k, list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]{2,}')) AS t FROM part),
 e AS (SELECT id, k, unnest(t) AS tok FROM m),
 p AS (SELECT a.id AS a, b.id AS b, a.k AS ka, b.k AS kb, count(*) AS shared FROM e a JOIN e b USING (tok) WHERE a.id <> b.id GROUP BY ALL),
 f AS (SELECT * FROM p WHERE shared >= 2 OR (least(length(ka), length(kb)) >= 4 AND (contains(ka, kb) OR contains(kb, ka)))),
 r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, kb, b) AS rank, count(*) OVER (PARTITION BY a) AS candidates FROM f)
SELECT a, b, shared, rank, candidates, candidates > 5 AS truncated FROM r WHERE rank <= 5""")
def candidate_pairs(spark, sf_dir):
    return align.candidate_pairs(part_mentions(spark, sf_dir)).withColumn("rank", F.col("rank").cast("long"))


@query("""SELECT lpad(a.p_partkey::VARCHAR, 9, '0') AS a, lpad(b.p_partkey::VARCHAR, 9, '0') AS b, CASE WHEN a.p_type <> b.p_type THEN 'variant' ELSE 'identifier' END AS reason
FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE a.p_type <> b.p_type OR a.p_brand <> b.p_brand""")
def conflict_pairs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = lambda x: F.struct(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), F.lit("Product").alias("type"), F.col("p_type").alias("variant"), F.lit("brand").alias("id_scope"), F.col("p_brand").alias("id_value"), F.lit(None).cast("string").alias("event_date")).alias(x)
    pairs = p.select("p_name", "p_size", s("a")).join(p.select("p_name", "p_size", s("b")), ["p_name", "p_size"]).filter("a.id < b.id")
    return pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), align.conflict_reason().alias("reason")).filter("reason is not null")


# ---------------------------------------------------------------- graph search

GEO = """nodes_e AS (SELECT 'N' || n_nationkey AS source, 'R' || n_regionkey AS target, 'located_in' AS predicate FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, 'belongs_to' FROM customer UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, 'supplies_from' FROM supplier),
 edges AS (SELECT *, source || '>' || target AS edge_id FROM nodes_e)"""


def geo_edges(spark, sf_dir):
    e = lambda t, a, k, b, j, p: table(spark, sf_dir, t).select(extract.entity(a, k).alias("source"), extract.entity(b, j).alias("target"), F.lit(p).alias("predicate"))
    all_ = e("nation", "N", "n_nationkey", "R", "n_regionkey", "located_in").unionByName(e("customer", "C", "c_custkey", "N", "c_nationkey", "belongs_to")).unionByName(e("supplier", "S", "s_suppkey", "N", "s_nationkey", "supplies_from"))
    return all_.withColumn("edge_id", F.concat("source", F.lit(">"), "target"))


def hop_sql(i: int) -> str:
    return f"""x{i} AS (SELECT qid, nodes, es, score, dst, edge_id, step, row_number() OVER (PARTITION BY qid, nodes, es ORDER BY step DESC, edge_id, dst) AS r FROM s{i} JOIN steps ON steps.src = s{i}.nodes[-1] WHERE NOT list_contains(nodes, dst)),
 y{i} AS (SELECT qid, list_append(nodes, dst) AS nodes, list_append(es, edge_id) AS es, round(score + step - 0.35, 6) AS score FROM x{i} WHERE r <= 8),
 z{i} AS (SELECT *, row_number() OVER (PARTITION BY qid, nodes[-1] ORDER BY score DESC, nodes, es) AS r FROM y{i}),
 s{i + 1} AS (SELECT qid, nodes, es, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, nodes, es) AS q FROM z{i} WHERE r <= 3) WHERE q <= 20)"""


@query(f"""WITH {GEO}, adj AS (SELECT source AS src, target AS dst, edge_id, predicate FROM edges UNION ALL SELECT target, source, edge_id, predicate FROM edges),
 deg AS (SELECT src AS dst, count(*) AS degree FROM adj GROUP BY ALL),
 steps AS (SELECT src, dst, edge_id, round(1.25 * CASE predicate WHEN 'located_in' THEN 2.0 WHEN 'belongs_to' THEN 1.3 ELSE 0.4 END - 0.12 * ln(1 + degree), 6) AS step FROM adj JOIN deg USING (dst)),
 s1 AS (SELECT s_suppkey AS qid, ['S' || s_suppkey] AS nodes, []::VARCHAR[] AS es, round((10 + s_suppkey) * 0.15, 6) AS score FROM supplier),
 {hop_sql(1)}, {hop_sql(2)}, {hop_sql(3)},
 every AS (SELECT * FROM y1 UNION ALL SELECT * FROM y2 UNION ALL SELECT * FROM y3),
 f AS (SELECT *, row_number() OVER (PARTITION BY qid, es ORDER BY score DESC, nodes) AS r FROM every),
 g AS (SELECT qid, nodes, es, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, len(es), nodes, es) AS rank FROM f WHERE r = 1)
SELECT qid, rank, array_to_string(nodes, '/') AS nodes, score FROM g WHERE rank <= 6""")
def beam_paths(spark, sf_dir):
    weight = F.when(F.col("predicate") == "located_in", 2.0).when(F.col("predicate") == "belongs_to", 1.3).otherwise(0.4)
    seeds = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("qid"), extract.entity("S", "s_suppkey").alias("node"), (10.0 + F.col("s_suppkey")).alias("score"))
    out = graph.beam_paths(graph.adjacency(geo_edges(spark, sf_dir)), seeds, 1.25 * weight - 0.12 * F.log1p(F.col("degree").cast("double")))
    return out.select("qid", F.col("rank").cast("long").alias("rank"), F.array_join("nodes", "/").alias("nodes"), "score")


@query("""WITH t AS (SELECT p_partkey AS qid FROM part), e0 AS (SELECT DISTINCT qid, l_orderkey AS event FROM t JOIN lineitem ON l_partkey = qid),
 led AS (SELECT o_orderkey AS src, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS dst FROM orders),
 links AS (SELECT src, dst FROM led WHERE dst IS NOT NULL UNION ALL SELECT dst, src FROM led WHERE dst IS NOT NULL),
 e1 AS (SELECT DISTINCT qid, dst AS event FROM e0 JOIN links ON src = event EXCEPT SELECT qid, event FROM e0),
 e2 AS ((SELECT DISTINCT qid, dst AS event FROM e1 JOIN links ON src = event) EXCEPT (SELECT qid, event FROM e0 UNION SELECT qid, event FROM e1))
SELECT 'P' || qid AS qid, 'O' || event AS event, d AS depth FROM (SELECT *, 0 AS d FROM e0 UNION ALL SELECT *, 1 FROM e1 UNION ALL SELECT *, 2 FROM e2)""")
def event_components(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    affects = li.select(extract.entity("O", "l_orderkey").alias("source"), extract.entity("P", "l_partkey").alias("target"), F.lit("affects").alias("predicate")).distinct()
    follows = o.select(extract.entity("O", "o_orderkey").alias("source"), F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("n"), F.lit("reported_cause").alias("predicate")).filter("n is not null")
    edges = affects.unionByName(follows.select("source", extract.entity("O", "n").alias("target"), "predicate")).withColumn("edge_id", F.concat("source", F.lit(">"), "target"))
    nodes = o.select(extract.entity("O", "o_orderkey").alias("id"), F.lit("Event").alias("type"))
    targets = table(spark, sf_dir, "part").select(extract.entity("P", "p_partkey").alias("qid"), extract.entity("P", "p_partkey").alias("node"))
    return graph.event_neighbourhood(graph.adjacency(edges), nodes, targets)


@query("""SELECT user_id, event_id, strftime(ts, '%Y-%m-%d') AS day, event_type, r AS place FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE event_type IN ('error', 'purchase') AND month(ts) = 1 AND year(ts) = 2024) WHERE r <= 8""")
def timeline_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "purchase")).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    ints = lambda *xs: F.array(*map(F.lit, xs)).cast("array<int>")
    kept = e.filter(graph.in_period(F.array("day"), ints(2024), ints(1), ints()))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return kept.withColumn("place", F.row_number().over(w).cast("long")).filter("place <= 8").select("user_id", "event_id", "day", "event_type", "place")


# ---------------------------------------------------------------- planning, packing, protocol

QUESTIONS = [
    (1, "为什么2026年第二季度收入下降，按时间线列出原因"),
    (2, "pdf和word里同一产品的名称有哪些"),
    (3, "系统版本是多少"),
    (4, "还原续表的表头并逐列对应"),
    (5, "比较2025年4月和5月的续费变化"),
    (6, "收入最高的产品 top 3 个"),
    (7, "停售导致了什么影响"),
    (8, "列出订单明细工作表中全部6条备注"),
]
CUE_SQL = lambda name: "(" + " OR ".join(f"contains(low, '{x}')" for x in planner.CUES[name]) + ")"
FORMAT_SQL = "list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(f'contains(low, {chr(39)}{x}{chr(39)})' for x in cues)} THEN '{f}' END" for f, cues in planner.FORMATS.items()) + "], lambda x: x IS NOT NULL)"


@query(f"""WITH q AS (SELECT qid, question, lower(question) AS low FROM {values(QUESTIONS, 'qid, question')}),
 f AS (SELECT *, {CUE_SQL('causal')} AS causal, {CUE_SQL('list_all')} AS list_all, {CUE_SQL('comparison')} AS comparison, {CUE_SQL('rank')} AS rnk, {CUE_SQL('timeline')} AS timeline,
   {CUE_SQL('table_part')} AND {CUE_SQL('table_act')} AS recon, {CUE_SQL('identity')} AS ident, len({FORMAT_SQL}) AS n_formats,
   regexp_matches(regexp_replace(low, '列出', '', 'g'), 'sheet|工作表|字段|单元格|表格|page|页面|第?[0-9]+页|slide|幻灯片|[a-z0-9_一-鿿-]{{1,18}}列') AS st FROM q),
 g AS (SELECT *, st OR recon AS structured, n_formats >= 2 AND ident AND NOT (timeline AND causal) AS ident2, qid = 8 AS hinted FROM f)
SELECT qid, causal, list_all, comparison, rnk AS rank, timeline, recon AS table_reconstruction, structured, n_formats, CASE WHEN structured AND list_all AND hinted THEN 'exhaustive' ELSE 'ranked' END AS retrieval_mode,
 CASE WHEN ident2 THEN 'cross_format_identity' WHEN structured AND list_all AND hinted THEN 'structured_enumeration' WHEN timeline AND causal THEN 'causal' WHEN structured THEN 'structured_lookup' WHEN causal THEN 'causal'
  WHEN comparison THEN 'comparison' WHEN rnk THEN 'rank' ELSE 'factual' END AS intent,
 coalesce(array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(question, '(20[0-9]{{2}})年'), lambda x: substr(x, 1, 4)))), ','), '') AS years,
 try_cast(regexp_extract(question, '([0-9]{{1,3}}) *(条|个|项|种)', 1) AS INT) AS expected_count FROM g""")
def question_plan(spark, sf_dir):
    q = spark.sql(f"SELECT * FROM {values(QUESTIONS, 'qid, question')}")
    hints = spark.sql("SELECT 8 AS qid, array('订单明细') AS sheet_hints, array('备注') AS column_hints, true AS column_requested")
    p = planner.plan(q, hints)
    return p.select("qid", "causal", "list_all", "comparison", "rank", "timeline", "table_reconstruction", "structured", F.size("formats").cast("long").alias("n_formats"), "retrieval_mode", "intent", F.array_join(F.col("years").cast("array<string>"), ",").alias("years"), "expected_count")


@query(f"""WITH q AS (SELECT qid, lower(question) AS low FROM {values(QUESTIONS, 'qid, question')}), f AS (SELECT *, {CUE_SQL('causal')} AS causal, qid = 2 AS ident FROM q)
SELECT qid, p AS predicate, w AS weight FROM (SELECT qid, unnest([{', '.join(f"{{p: '{p}', w: CASE " + (f"WHEN causal THEN {planner.CAUSAL_WEIGHTS[p]} " if p in planner.CAUSAL_WEIGHTS else '') + f"WHEN ({' OR '.join(f'contains(low, {chr(39)}{x}{chr(39)})' for x in words)}) AND NOT ident THEN 2.0 END::DOUBLE}}" for p, words in planner.RELATION_TERMS.items())}], recursive := true) FROM f) WHERE w IS NOT NULL""")
def relation_weights(spark, sf_dir):
    return planner.relation_weights(planner.plan(spark.sql(f"SELECT * FROM {values(QUESTIONS, 'qid, question')}")))


BLOCKS = "(SELECT source AS qid, doc_id AS pos, least(length(text), 1500)::BIGINT AS size FROM documents)"


def blocks(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("qid"), F.col("doc_id").alias("pos"), F.least(F.length("text"), F.lit(1500)).cast("long").alias("size"))


@query(f"SELECT * FROM (SELECT *, (sum(size + 2) OVER (PARTITION BY qid ORDER BY pos))::BIGINT AS total FROM {BLOCKS}) WHERE total <= 18000")
def context_pack_break(spark, sf_dir):
    return context.pack_break(blocks(spark, sf_dir), 18_000)


@query(f"""WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY pos) AS i FROM {BLOCKS}),
 f AS (SELECT qid, pos, i, size + 2 <= 18000 AS ok, CASE WHEN size + 2 <= 18000 THEN size + 2 ELSE 0 END AS total FROM o WHERE i = 1
  UNION ALL SELECT o.qid, o.pos, o.i, f.total + 2 + o.size <= 18000, CASE WHEN f.total + 2 + o.size <= 18000 THEN f.total + 2 + o.size ELSE f.total END FROM f JOIN o ON o.qid = f.qid AND o.i = f.i + 1)
SELECT qid, pos, ok AS included, total FROM f""")
def context_pack_skip(spark, sf_dir):
    return context.pack_skip(blocks(spark, sf_dir), 18_000)


@query("""SELECT event_type AS stage, count(*) AS calls, round(avg(value), 6) AS mean_s, round(quantile_cont(value, 0.95), 6) AS p95_s, round(max(value), 6) AS max_s FROM events GROUP BY ALL""")
def call_metrics(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("calls"), F.round(F.avg("value"), 6).alias("mean_s"), F.round(F.percentile("value", 0.95), 6).alias("p95_s"), F.round(F.max("value"), 6).alias("max_s"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders WHERE o_orderstatus <> 'P') WHERE r = 1""")
def latest_valid_run(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").withColumn("r", F.row_number().over(w)).filter("r = 1").select("o_custkey", "o_orderkey")


@query("""WITH r AS (SELECT conv_id AS task_id, turn AS seq, role, CASE WHEN turn % 5 = 4 THEN 'old' ELSE 'run' END AS fp FROM conversations)
SELECT task_id, seq, role FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY seq) AS n FROM r WHERE fp = 'run' AND role <> 'user' AND task_id % 3 <> 0) WHERE n = 1""")
def role_wave_accept(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("task_id"), F.col("turn").alias("seq"), "role", F.when(F.col("turn") % 5 == 4, "old").otherwise("run").alias("fingerprint"))
    tasks = c.select("task_id").distinct()
    return extract.accept(c.filter("role <> 'user'"), tasks, tasks.filter("task_id % 3 = 0"), "run").select("task_id", "seq", "role")


# ---------------------------------------------------------------- scalars

NUMBERS = [(1, "约1,250.50", "收入(万元)"), (2, "35%", "转化"), (3, "无", "收入"), (4, "1200", "调用万次"), (5, "-7元", ""), (6, "3千元", "x")]


@query(f"""WITH n AS {values(NUMBERS, 'id, raw, header')}, m AS (SELECT *, regexp_extract(regexp_replace(replace(raw, ',', ''), '^(约|≈|~)', ''), '[-+]?[0-9]+(\\.[0-9]+)?') AS number, header || ' ' || raw AS b FROM n)
SELECT id, number, CASE WHEN contains(b, '%') THEN '%' WHEN contains(b, '万元') THEN '万元' WHEN contains(b, '千元') THEN '千元' WHEN contains(b, '元') THEN '元' WHEN contains(b, '万次') THEN '万次' WHEN contains(b, '次') THEN '次' ELSE '' END AS unit FROM m WHERE number <> ''""")
def typed_numbers(spark, sf_dir):
    df = spark.sql(f"SELECT * FROM {values(NUMBERS, 'id, raw, header')}").withColumn("n", T.typed_number(F.col("raw"), F.col("header")))
    return df.filter("n is not null").select("id", "n.number", "n.unit")


@query("SELECT * FROM (VALUES (1, '12505000', '元'), (2, '0.35', '比例'), (4, '12000000', '次'), (5, '-7', '元'), (6, '3000', '元')) AS v(id, number, unit)")
def normalized_values(spark, sf_dir):
    n = typed_numbers(spark, sf_dir).withColumn("s", T.scaled(F.col("number"), F.col("unit")))
    return n.select("id", "s.number", "s.unit")


LITERALS = [(1, "2026-04"), (2, "2026年4月8日"), (3, "AC-47"), (4, "1~3"), (5, "是"), (6, "text"), (7, ""), (8, "2026年")]


@query(f"""WITH l AS {values(LITERALS, 'id, raw')} SELECT id, CASE WHEN raw = '' THEN 'text' WHEN regexp_matches(raw, '^20[0-9]{{2}}([-/.年][0-9]{{1,2}})?([-/.月][0-9]{{1,2}})?日?$') THEN CASE WHEN regexp_matches(raw, '日|[-/.][0-9]{{1,2}}$') THEN 'date' ELSE 'period' END
 WHEN regexp_matches(raw, '^[A-Za-z]{{1,12}}[-_][A-Za-z0-9][A-Za-z0-9_-]{{1,40}}$') THEN 'identifier' WHEN regexp_matches(raw, '→|~|～|至|到') AND regexp_matches(raw, '[0-9]') THEN 'range' WHEN lower(raw) IN ('true','false','是','否','有','无') THEN 'boolean' ELSE 'text' END AS kind FROM l""")
def literal_kinds(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(LITERALS, 'id, raw')}").select("id", T.literal_kind(F.col("raw")).alias("kind"))


QUOTES = [(1, "The **red** box", "red** box"), (2, "The **red** box", "the red box"), (3, "a | b", "ab"), (4, "abc", "xyz"), (5, "a<br>b", "ab")]


@query(f"""WITH q AS {values(QUOTES, 'id, source, quote')}, n AS (SELECT *, lower(regexp_replace(regexp_replace(source, '(?i)<br\\s*/?>', '', 'g'), '[\\s|`*_]+', '', 'g')) AS ns, lower(regexp_replace(quote, '[\\s|`*_]+', '', 'g')) AS nq FROM q)
SELECT id, CASE WHEN contains(source, quote) THEN 'exact' WHEN nq <> '' AND contains(ns, nq) THEN 'normalized' ELSE 'locator_only' END AS mode FROM n""")
def evidence_match(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(QUOTES, 'id, source, quote')}").select("id", T.match_mode(F.col("source"), F.col("quote")).alias("mode"))


PREDICATES = [(1, "Causes"), (2, "used-by"), (3, ""), (4, "lives in"), (5, "replaces")]


@query(f"SELECT id, CASE lower(replace(replace(p, '-', '_'), ' ', '_')) WHEN 'causes' THEN 'reported_cause' WHEN 'used_by' THEN 'uses' WHEN 'replaces' THEN 'replaced_by' WHEN '' THEN 'related_to' ELSE lower(replace(replace(p, '-', '_'), ' ', '_')) END AS predicate FROM {values(PREDICATES, 'id, p')}")
def predicate_names(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(PREDICATES, 'id, p')}").select("id", T.predicate(F.col("p")).alias("predicate"))


PHRASES = [(1, "ai", "the AI tool"), (2, "ai", "maintain"), (3, "订单", "我的订单表"), (4, "", "x"), (5, "a.b", "see A.B now")]


@query(f"""SELECT id, CASE WHEN p = '' THEN false WHEN regexp_matches(p, '^[a-z0-9_.+\\-/]+$') THEN regexp_matches(regexp_replace(lower(t), '\\s+', '', 'g'), '(^|[^a-z0-9])' || replace(p, '.', '\\.') || '($|[^a-z0-9])') ELSE contains(t, p) END AS found FROM {values(PHRASES, 'id, p, t')}""")
def phrase_predicate(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(PHRASES, 'id, p, t')}").select("id", T.phrase_in(F.col("p"), F.col("t")).alias("found"))


NAMED = [(1, "Atlas v2.1"), (2, "Atlas"), (3, "Box_V3"), (4, "v2")]


@query(f"SELECT id, regexp_extract(name, '^(.+?)[\\s_-]*[vV]([0-9]+(?:\\.[0-9]+)*)$', 1) AS base, regexp_extract(name, '^(.+?)[\\s_-]*[vV]([0-9]+(?:\\.[0-9]+)*)$', 2) AS version FROM {values(NAMED, 'id, name')} WHERE regexp_matches(name, '^.+?[\\s_-]*[vV][0-9]+(\\.[0-9]+)*$')")
def version_names(spark, sf_dir):
    df = spark.sql(f"SELECT * FROM {values(NAMED, 'id, name')}").withColumn("v", T.version_of(F.col("name")))
    return df.filter("v is not null").select("id", "v.base", "v.version")


HEADERS = [(1, "标准名称"), (2, "别名"), (3, "客服系统名称"), (4, "产品编号名称"), (5, "实体类型"), (6, "数量"), (7, "Display Name")]


@query("SELECT * FROM (VALUES (1, 'canonical'), (2, 'alias'), (3, 'name_like'), (4, 'other'), (5, 'type'), (6, 'other'), (7, 'alias')) AS v(id, role)")
def header_roles(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(HEADERS, 'id, h')}").select("id", T.header_role(F.col("h")).alias("role"))


ONTOLOGY = [(1, "产品"), (2, "数据集"), (3, "产品版本"), (4, "团队成员"), (5, "其他")]


@query("SELECT * FROM (VALUES (1, 'Product'), (2, 'DataAsset'), (3, NULL), (4, 'Actor'), (5, NULL)) AS v(id, type)")
def ontology_types(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(ONTOLOGY, 'id, x')}").select("id", T.ontology_type(F.col("x")).alias("type"))


CODES = [(1, "Atlas(AC-47)", "Atlas(AC-47)"), (2, "Atlas, AC-47", "代码 AC-47"), (3, "RV-2031-0412 review", "编号: RV-2031-0412"), (4, "Atlas v2", "编号 v2"), (5, "Atlas(AC-47)", "no code"), (6, "Atlas(AC-470)", "AC-47")]


@query("SELECT * FROM (VALUES (1, 'AC-47'), (2, 'AC-47'), (3, 'RV-2031-0412'), (4, ''), (5, ''), (6, '')) AS v(id, codes)")
def owned_codes(spark, sf_dir):
    return spark.sql(f"SELECT * FROM {values(CODES, 'id, l, e')}").select("id", F.array_join(T.business_codes(F.col("l"), F.col("e")), ",").alias("codes"))


PDF_WORDS = [(1, 10.0, 30.0, "Name"), (1, 34.0, 50.0, "long"), (1, 80.0, 100.0, "Price"), (1, 140.0, 160.0, "Note"), (2, 5.0, 20.0, "One")]


@query("SELECT * FROM (VALUES (1, 0, 'Name long'), (1, 1, 'Price'), (1, 2, 'Note')) AS v(page, col, header)")
def pdf_header_columns(spark, sf_dir):
    return units.header_columns(spark.sql(f"SELECT * FROM {values(PDF_WORDS, 'page, x0, x1, text')}")).select("page", "col", "header")


PDF_TABLES = [("d", 7, 1, 400.0, 700.0, 50.0, 500.0, 800.0), ("d", 8, 1, 60.0, 300.0, 52.0, 498.0, 800.0), ("d", 9, 1, 300.0, 500.0, 50.0, 500.0, 800.0), ("e", 8, 1, 60.0, 300.0, 50.0, 500.0, 800.0)]


@query("SELECT * FROM (VALUES ('d', 7, NULL), ('d', 8, 7), ('d', 9, NULL), ('e', 8, NULL)) AS v(doc, page, inherited_from)")
def pdf_table_continuation(spark, sf_dir):
    t = spark.sql(f"SELECT * FROM {values(PDF_TABLES, 'doc, page, table, top, bottom, left, right, height')}")
    return units.continued_tables(t).select("doc", "page", "inherited_from")


# ---------------------------------------------------------------- tables in units

SHEET = [("s", 1, "A", "订单"), ("s", 1, "C", "备注"), ("s", 2, "A", "编号"), ("s", 2, "B", "数量"), ("s", 3, "A", "O-1"), ("s", 3, "B", "5"), ("s", 3, "C", "客户要求升级"), ("s", 4, "A", "O-2"), ("s", 4, "C", " "), ("t", 1, "A", "Name"), ("t", 2, "A", "12")]


@query("SELECT * FROM (VALUES ('s', 'A', '订单/编号', 2), ('s', 'B', '数量', 2), ('s', 'C', '备注', 2), ('t', 'A', 'Name', 1)) AS v(sheet, col, header, depth)")
def header_inference(spark, sf_dir):
    return tables.sheet_headers(spark.sql(f"SELECT * FROM {values(SHEET, 'sheet, row, col, raw')}"))


@query("SELECT * FROM (VALUES ('s', 3, '备注=客户要求升级', '订单/编号=O-1;数量=5')) AS v(sheet, row, semantic, context)")
def semantic_overlay(spark, sf_dir):
    cells_ = spark.sql(f"SELECT * FROM {values(SHEET, 'sheet, row, col, raw')}")
    out = tables.free_text_overlay(cells_, tables.sheet_headers(cells_))
    return out.select("sheet", "row", F.array_join("semantic", ";").alias("semantic"), F.array_join("context", ";").alias("context"))


ALIAS_UNITS = [
    ("u1", "产品", "| 标准名称 | 别名 | 移动端名称 |\\n| --- | --- | --- |\\n| Atlas | AT | Atlas M |\\n| Box | box | |"),
    ("u2", "", "| 标准名称 | 别名 |\\n| Foo | F |"),
    ("u3", "", "| 标准名称 | 别名 | 实体类型 |\\n| Foo | F | 数据集 |"),
    ("u4", "产品", "| 名称 | 数量 |\\n| Foo | 1 |"),
]


@query("SELECT * FROM (VALUES ('u1', 'alias_1', 'Product', 'Atlas', 'AT,Atlas M'), ('u3', 'alias_1', 'DataAsset', 'Foo', 'F')) AS v(unit_id, local_id, type, name, aliases)")
def alias_table_mentions(spark, sf_dir):
    df = spark.sql(f"SELECT * FROM {values(ALIAS_UNITS, 'unit_id, section, content')}")
    return tables.alias_mentions(df).withColumn("aliases", F.array_join("aliases", ","))


PARTS = [
    ("a", "d", 31, None, "工具/产品/说明", 50.0, 500.0, 700.0, "头一 产品对照", 1),
    ("b", "d", 32, 31, "工具/产品/说明", 52.0, 498.0, 600.0, "续 二 三", 2),
    ("c", "d", 33, 32, "工具/产品/说明", 50.0, 500.0, 300.0, "续 四", 1),
    ("x", "d", 41, None, "日期/金额", 50.0, 500.0, 700.0, "其他", 5),
    ("y", "e", 32, 31, "工具/产品/说明", 50.0, 500.0, 700.0, "别的文档", 1),
]


def part_tables(spark):
    df = spark.sql(f"SELECT * FROM {values(PARTS, 'unit_id, doc, page, inherited, header, left, right, bottom, content, n_rows')}")
    return df.withColumn("header", F.split("header", "/"))


@query("SELECT * FROM (VALUES ('a', 'a'), ('b', 'a'), ('c', 'a'), ('x', 'x'), ('y', 'y')) AS v(unit_id, root)")
def table_groups(spark, sf_dir):
    return tables.table_roots(part_tables(spark))


@query("SELECT * FROM (VALUES (1, 'a', 3, 1), (1, 'b', 3, 2), (1, 'c', 3, 1)) AS v(qid, unit_id, n_columns, n_rows)")
def table_reconstruction(spark, sf_dir):
    q = spark.sql("SELECT 1 AS qid, '还原工具产品对照表的续表，同时说明日期金额' AS text")
    out = tables.reconstruct(q, part_tables(spark))
    return out.select("qid", "unit_id", F.size("header").alias("n_columns"), "n_rows")


# ---------------------------------------------------------------- graph build

VERSIONED = [("m1", "ExampleTool", "AITool"), ("m2", "ExampleTool v2.0", "AITool"), ("m3", "ExampleTool v3", "Product"), ("m4", "ExampleTool v4", "AITool"), ("m5", "Other v1", "AITool")]
VERSION_RELATIONS = [("m2", "version_of", "m1"), ("m3", "uses", "m1"), ("m4", "unheard_of", "m1")]


@query("SELECT * FROM (VALUES ('m1', 'AITool', NULL, NULL), ('m2', 'Version', '2.0', 'ExampleTool'), ('m3', 'Product', NULL, NULL), ('m4', 'AITool', NULL, NULL), ('m5', 'AITool', NULL, NULL)) AS v(mention_id, type, version, parent_name)")
def version_repair(spark, sf_dir):
    m = spark.sql(f"SELECT * FROM {values(VERSIONED, 'mention_id, name, type')}")
    return build.repair_versions(m, spark.sql(f"SELECT * FROM {values(VERSION_RELATIONS, 'subject, predicate, object')}"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, ts::DATE AS day FROM events), f AS (SELECT user_id, event_type, day, min(event_id) AS first FROM e GROUP BY ALL)
SELECT event_id AS mention_id, CASE WHEN event_type = 'error' THEN event_id ELSE first END AS entity_id FROM e JOIN f USING (user_id, event_type, day)""")
def observation_coalescing(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    sample = F.when(F.col("event_type") == "error", "unknown").otherwise("all")
    scope = F.create_map(F.lit("period"), F.to_date("ts").cast("string"), F.lit("sample_scope"), sample, F.lit("metric_definition"), F.lit("value"))
    o = e.select(F.col("event_id").alias("mention_id"), F.array(F.col("user_id")).alias("parents"), F.col("event_type").alias("metric"), scope.alias("qualifiers"), F.lit(1).alias("n_values"), F.lit("").alias("unit"), F.lit("").alias("currency"))
    return build.coalesce_observations(o, e.select(F.col("event_id").alias("mention_id"), F.col("event_id").alias("entity_id")))


@query("""SELECT p_brand AS entity_id, count(DISTINCT p_name) AS n_names, least(8, count(DISTINCT p_name)) AS n_kept, least(6, count(DISTINCT p_type)) AS n_categories FROM part GROUP BY ALL""")
def entity_profiles(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    m = p.select(F.col("p_partkey").alias("mention_id"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("identifier"), F.create_map(F.lit("category"), F.col("p_type"), F.lit("colour"), F.lit("x")).alias("attributes"))
    out = build.profiles(m, p.select(F.col("p_partkey").alias("mention_id"), F.col("p_brand").alias("entity_id")))
    n = p.groupBy(F.col("p_brand").alias("entity_id")).agg(F.count_distinct("p_name").alias("n_names"))
    return out.join(n, "entity_id").select("entity_id", "n_names", F.size("names").cast("long").alias("n_kept"), F.size(F.col("attributes")["category"]).cast("long").alias("n_categories"))


@query("""WITH r AS (SELECT DISTINCT 'C' || o_custkey AS s, 'P' || l_partkey AS o FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'nodes' AS part, (SELECT count(*) FROM customer) + (SELECT count(DISTINCT p_brand) FROM part) AS n
UNION ALL SELECT 'edges', count(*) FROM (SELECT DISTINCT s, p_brand FROM r JOIN part ON o = 'P' || p_partkey)
UNION ALL SELECT 'facts', (SELECT count(*) FROM (SELECT DISTINCT s, p_brand FROM r JOIN part ON o = 'P' || p_partkey)) + (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part))""")
def graph_build(spark, sf_dir):
    # parts of one brand are one entity
    c = table(spark, sf_dir, "customer").select(extract.entity("C", "c_custkey").alias("mention_id"), F.lit("Actor").alias("type"), F.col("c_name").alias("name"))
    p = table(spark, sf_dir, "part")
    m = c.unionByName(p.select(extract.entity("P", "p_partkey").alias("mention_id"), F.lit("Product").alias("type"), F.col("p_name").alias("name")))
    m = m.select("*", F.array().cast("array<string>").alias("aliases"), F.lit(False).alias("has_identifier"), F.lit(False).alias("alias_declared"))
    mapping = c.select("mention_id", F.col("mention_id").alias("entity_id")).unionByName(p.select(extract.entity("P", "p_partkey").alias("mention_id"), F.col("p_brand").alias("entity_id")))
    f = facts_of(spark, sf_dir).filter("predicate = 'purchased'").join(c.select(F.col("mention_id").alias("subject")), "subject", "left_semi")
    none = F.lit(None).cast("string").alias("task_id")
    relations = f.select("subject", "predicate", "object", F.lit("{}").alias("qualifiers"), F.col("source_row").alias("evidence_id"), none)
    a = extract.attribute_facts(p, "P", "p_partkey", ["p_type"]).select("subject", "predicate", "value", "qualifiers", F.col("subject").alias("evidence_id"), none)
    g = build.build(m, relations, a, mapping)
    count = lambda k: g[k].agg(F.count("*").alias("n")).select(F.lit(k).alias("part"), "n")
    return count("nodes").unionByName(count("edges")).unionByName(count("facts"))


@query("""WITH h AS (SELECT o_orderpriority AS qid, o_orderkey, 'C' || o_custkey AS subject, o_totalprice AS score, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders),
 l AS (SELECT DISTINCT o_orderpriority AS qid, 'C7' AS node, 5 AS length FROM orders),
 s AS (SELECT qid, node, (12 + max(length))::DOUBLE AS s FROM l GROUP BY ALL UNION ALL SELECT qid, subject, 2.0 / rank + 0.2 * score FROM h WHERE rank <= 12
  UNION ALL SELECT qid, subject, 1.0 / rank FROM h WHERE rank <= 8),
 t AS (SELECT qid, node, round(sum(s), 6) AS score FROM s GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, node) AS rank FROM t) WHERE rank <= 18""")
def entity_candidates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("qid"), "o_orderkey", extract.entity("C", "o_custkey").alias("subject"), F.col("o_totalprice").alias("score"))
    hits = search.top(o, 12, "o_orderkey").withColumn("object", F.lit(None).cast("string"))
    labels = o.select("qid").distinct().select("qid", F.lit("C7").alias("node"), F.lit(5).alias("length"))
    raw = hits.select("qid", "rank", F.col("o_orderkey").alias("unit_id"))
    out = build.entity_candidates(labels, hits, raw, hits.select(F.col("o_orderkey").alias("unit_id"), F.col("subject").alias("node")))
    return out.withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH s AS (SELECT entry_id, value, length(value) AS salience FROM {CELLS} WHERE sheet = 'customers' AND field = 'c_mktsegment'),
 f AS (SELECT value, max(salience) AS s, min(entry_id) AS e FROM s GROUP BY ALL)
SELECT 1 AS qid, '列出 ' || string_agg(value, ' ' ORDER BY s DESC, e) AS text FROM (SELECT * FROM f ORDER BY s DESC, e LIMIT 3)""")
def exhaustive_augmentation(spark, sf_dir):
    hits = cells(spark, sf_dir).filter("sheet = 'customers' and field = 'c_mktsegment'").select(F.lit(1).alias("qid"), "entry_id", "value", F.length("value").cast("double").alias("salience"))
    return build.augmented_questions(spark.sql("SELECT 1 AS qid, '列出' AS question, 3 AS expected_count"), hits)


@query("""SELECT 'entity_alignment' AS kind, 'C' || c_custkey AS id FROM customer WHERE c_custkey % 50 = 3 UNION ALL
SELECT 'unreviewed_unit', 'U' || doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'parse_failure', 'D' || page_id FROM pages WHERE page_id % 40 = 0""")
def unresolved_items(spark, sf_dir):
    status = table(spark, sf_dir, "customer").select(extract.entity("C", "c_custkey").alias("cluster_id"), F.when(F.col("c_custkey") % 50 == 3, "uncertain").otherwise("resolved").alias("status"))
    done = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("reviewed"))
    units_ = table(spark, sf_dir, "documents").join(done, "doc_id", "left").select(extract.entity("U", "doc_id").alias("unit_id"), "reviewed")
    docs = table(spark, sf_dir, "pages").select(extract.entity("D", "page_id").alias("document_id"), F.when(F.col("page_id") % 40 == 0, "failed").otherwise("parsed").alias("parse_status"))
    return build.unresolved(status, spark.createDataFrame([], "id string"), units_, docs)


@query("""SELECT event_type, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL""")
def windowed_events(spark, sf_dir):
    out = intake.windowed_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return out.select("event_type", F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "n", "total")


# ---------------------------------------------------------------- more scalars, coverage and sinks

FILES = [(1, "a.DOCX", "AB12", "one  two", "x|y"), (2, "b/c.xls", "C7", "", "z"), (3, "d.png", "12", "w" * 100, ""), (4, "plain", "A1", " q ", "a\\nb")]


@query(f"""WITH f AS {values([(i, p, c, q, r.replace(chr(92) + 'n', chr(10))) for i, p, c, q, r in FILES], 'id, path, cell, quote, raw')}
SELECT id, CASE lower(regexp_extract(path, '([A-Za-z0-9]+)$', 1)) WHEN 'docx' THEN 'word' WHEN 'xls' THEN 'excel' WHEN 'png' THEN 'image' ELSE lower(regexp_extract(path, '([A-Za-z0-9]+)$', 1)) END AS format,
 regexp_extract(cell, '([A-Z]+)', 1) AS letters, CASE WHEN length(trim(regexp_replace(quote, '\\s+', ' ', 'g'))) <= 96 THEN trim(regexp_replace(quote, '\\s+', ' ', 'g')) ELSE substr(quote, 1, 95) || '…' END AS quote,
 '| ' || replace(replace(raw, '|', '\\|'), chr(10), '<br>') || ' | ' || letters || ' |' AS rendered FROM f""")
def file_scalars(spark, sf_dir):
    df = spark.sql(f"SELECT * FROM {values(FILES, 'id, path, cell, quote, raw')}")
    letters = T.column_letters(F.col("cell"))
    return df.select("id", T.format_name(F.col("path")).alias("format"), letters.alias("letters"), T.short_quote(F.col("quote")).alias("quote"), T.render_row(F.array("raw", letters)).alias("rendered"))


@query('''SELECT * FROM (VALUES (1, 'page=3; row=7'), (2, 'sheet=S; cell=B2'), (3, '{"page":""}')) AS v(id, locator)''')
def locator_texts(spark, sf_dir):
    df = spark.sql("SELECT 1 AS id, map('row', '7', 'page', '3') AS l UNION ALL SELECT 2, map('cell', 'B2', 'sheet', 'S', 'other', 'x') UNION ALL SELECT 3, map('page', '')")
    return df.select("id", T.locator_text(F.col("l")).alias("locator"))


@query(f"""WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY pos) AS i FROM {BLOCKS}),
 f AS (SELECT qid, i, size + 2 <= 9000 AS ok, CASE WHEN size + 2 <= 9000 THEN size + 2 ELSE 0 END AS total FROM o WHERE i = 1
  UNION ALL SELECT o.qid, o.i, f.total + 2 + o.size <= 9000, CASE WHEN f.total + 2 + o.size <= 9000 THEN f.total + 2 + o.size ELSE f.total END FROM f JOIN o ON o.qid = f.qid AND o.i = f.i + 1)
SELECT qid, count(*) AS total_blocks, count(*) FILTER (WHERE ok) AS included_blocks, count(*) FILTER (WHERE NOT ok) AS omitted_blocks FROM f GROUP BY qid""")
def context_coverage(spark, sf_dir):
    return context.coverage(context.pack_skip(blocks(spark, sf_dir), 9000))


@query("""SELECT source AS document_id, length('# ' || source || chr(10) || chr(10) || string_agg('<!-- unit ' || doc_id || ' at ' || lpad(doc_id::VARCHAR, 9, '0') || ' -->' || chr(10) || chr(10) || text, chr(10) || chr(10))) AS chars FROM documents GROUP BY source""")
def enriched_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    u = d.select(F.col("source").alias("document_id"), F.col("doc_id").cast("string").alias("unit_id"), F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("locator"), F.col("text").alias("content"))
    out = sinks.enriched_markdown(u, d.select(F.col("source").alias("document_id"), F.col("source").alias("path")).distinct())
    return out.select("document_id", F.length("markdown").cast("long").alias("chars"))


@query("""SELECT s.s_suppkey AS work_dir FROM supplier s WHERE s.s_suppkey % 3 = 1 AND s.s_acctbal = (SELECT max(s_acctbal) FROM supplier WHERE s_suppkey % 3 = 1) ORDER BY s_suppkey LIMIT 1""")
def run_selection(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    backend = F.when(F.col("s_suppkey") % 3 == 1, "native").otherwise("other")
    runs = s.select(F.col("s_suppkey").alias("work_dir"), (F.col("s_acctbal") * 100).alias("mtime_ns"), backend.alias("backend"), F.lit("f").alias("fingerprint_graph"), F.lit("f").alias("fingerprint_units"), F.lit(True).alias("complete"), F.lit(False).alias("archived"))
    return sinks.latest_run(runs, "second").select("work_dir")


@query("""WITH e AS (SELECT event_type AS qid, event_id, value FROM events)
SELECT a.event_id AS id, CASE WHEN a.qid = 'error' AND b.qid = 'purchase' THEN true WHEN a.qid = 'click' THEN NULL ELSE false END AS fits FROM e a JOIN e b ON b.event_id = a.event_id + 1""")
def relation_types(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    pairs = e.join(e.select((F.col("event_id") - 1).alias("event_id"), F.col("event_type").alias("next")), "event_id")
    p = F.when(F.col("event_type") == "click", "custom").otherwise("uses")
    s = F.when(F.col("event_type") == "error", "Actor").otherwise("Event")
    o = F.when(F.col("next") == "purchase", "AITool").otherwise("Event")
    return pairs.select(F.col("event_id").alias("id"), graph.relation_fits(p, s, o).alias("fits"))


# ---------------------------------------------------------------- a run's state


@query("""SELECT (SELECT count(*) FROM pages WHERE length(html) < 200) AS parse_failures, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS pending_units,
 (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS open_clusters, false AS complete""")
def run_gate(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.when(F.length("html") < 200, "failed").otherwise("parsed").alias("parse_status"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"))
    clusters = table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") < 0, "uncertain").otherwise("resolved").alias("status"))
    return protocol.completeness(pages, docs, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("unit_id")), clusters)


@query("""SELECT 'stale_fingerprint' AS "check", 'error' AS level, 1::BIGINT AS n UNION ALL SELECT 'not_built', 'warning', 0 UNION ALL SELECT 'incomplete', 'error', 1
UNION ALL SELECT 'duplicate_part', 'error', (SELECT count(*) FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1))""")
def run_validation(spark, sf_dir):
    names = table(spark, sf_dir, "part").groupBy("p_name").count().filter("count > 1").agg(F.count("*").alias("n"))
    return protocol.validated(run_gate(spark, sf_dir), names.select(F.lit("duplicate_part").alias("check"), F.lit("error").alias("level"), "n"), "a", "b", True)


@query("""SELECT doc_id AS unit_id, CASE WHEN l.doc_id IS NOT NULL AND toxic > 0 THEN 'deterministic_alias_table' WHEN lang = 'de' AND n_chars > 2000 THEN 'xlsx_semantic_overlay' WHEN lang = 'de' THEN 'deterministic_xlsx' WHEN lang = 'fr' THEN 'auto_no_facts' ELSE 'llm_batch' END AS mode,
 CASE WHEN toxic > 0 OR lang = 'fr' OR (lang = 'de' AND n_chars <= 2000) THEN 'auto' WHEN lang = 'de' THEN 'model_with_prefill' ELSE 'model' END AS action
FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY ALL) l USING (doc_id)""")
def prepare_router(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    mode = F.when(F.col("lang") == "de", "xlsx_rule_or_fallback").when(F.col("lang") == "fr", "auto_no_facts").otherwise("llm_batch")
    u = d.select(F.col("doc_id").alias("unit_id"), mode.alias("mode"), F.lit(False).alias("done"))
    cells_ = d.filter("lang = 'de'").select(F.col("doc_id").alias("unit_id"), F.lit(3).alias("n_facts"), F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("n_overlay"))
    return protocol.prepared(u, table(spark, sf_dir, "labels").filter("toxic > 0").select(F.col("doc_id").alias("unit_id")).distinct(), cells_)


@query("""WITH r AS (SELECT conv_id AS task_id, turn AS pos, CASE role WHEN 'user' THEN 'Actor' WHEN 'assistant' THEN 'AITool' ELSE role END AS type, role AS lid, trim(substr(text, 1, 12), ' ') AS name FROM conversations),
 k AS (SELECT *, type IN ('Product', 'AITool', 'Actor', 'DataAsset', 'Version', 'Event', 'Observation') AND name <> '' AS ok FROM r),
 n AS (SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY task_id, CASE WHEN ok THEN lid END ORDER BY pos) END AS i FROM k)
SELECT task_id, pos, type, name, CASE WHEN i > 1 THEN lid || '_' || (pos + 1) WHEN ok THEN lid END AS local_id, CASE WHEN NOT ok THEN 'skipped_invalid_mention' END AS warning FROM n""")
def response_mentions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "Actor").when(F.col("role") == "assistant", "AITool").otherwise(F.col("role"))
    none = F.lit(None).cast("array<string>").alias("aliases")
    raw = c.select(F.col("conv_id").alias("task_id"), F.col("turn").alias("pos"), F.col("role").alias("local_id"), kind.alias("type"), F.substr("text", F.lit(1), F.lit(12)).alias("name"), none, F.lit(None).cast("boolean").alias("alias_declared"))
    raw = raw.withColumn("task_id", F.col("task_id").cast("string"))
    out = protocol.checked_mentions(raw).select(F.col("task_id").cast("long").alias("task_id"), "pos", "type", "name", "local_id", "warning")
    return out


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN 'observed_value' ELSE 'attribute' END AS predicate, CASE WHEN event_type <> 'view' THEN event_type END AS attribute, CASE WHEN value < 1 THEN 'skipped_unresolved_assertion' END AS warning FROM events""")
def response_assertions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    said = F.when(F.col("event_type") == "view", "observed_value").otherwise(F.col("event_type"))
    raw = e.select("event_id", F.col("user_id").cast("string").alias("subject_id"), said.alias("predicate"), F.lit(None).cast("string").alias("attribute"), F.when(F.col("value") >= 1, F.col("value").cast("string")).alias("value"), F.lit(None).cast("map<string,string>").alias("qualifiers"))
    return protocol.checked_assertions(raw).select("event_id", "predicate", F.try_element_at("qualifiers", F.lit("attribute")).alias("attribute"), "warning")


@query("""WITH p AS (SELECT o_custkey AS unit_id, 'mention' AS kind, o_orderstatus AS local_id, 'host' AS origin FROM orders WHERE o_orderpriority = '1-URGENT'),
 s AS (SELECT o_custkey AS unit_id, CASE WHEN o_totalprice > 100000 THEN 'mention' ELSE 'relation' END AS kind, o_orderstatus AS local_id, 'model' AS origin FROM orders WHERE o_orderpriority = '2-HIGH')
SELECT unit_id, kind, local_id, origin, count(*) AS n FROM (SELECT * FROM p WHERE unit_id IN (SELECT unit_id FROM s) UNION ALL SELECT * FROM s WHERE kind <> 'mention' OR (unit_id, local_id) NOT IN (SELECT unit_id, local_id FROM p)) GROUP BY ALL""")
def prefill_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("unit_id"), F.when((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_totalprice") > 100000), "mention").otherwise("relation").alias("kind"), F.col("o_orderstatus").alias("local_id"), "o_orderpriority")
    side = lambda p, name: o.filter(F.col("o_orderpriority") == p).select("unit_id", "kind", "local_id", F.lit(name).alias("origin"))
    return protocol.merged_prefill(side("1-URGENT", "host"), side("2-HIGH", "model")).groupBy("unit_id", "kind", "local_id", "origin").agg(F.count("*").alias("n"))


@query("""SELECT 'U' || n_nationkey AS unit_id, '# Sheet: ' || n_name || chr(10) || chr(10) || 'Only interpret the free-text cells below; structured fields are already handled deterministically.' || chr(10) ||
 string_agg(chr(10) || '## Row ' || c_custkey || chr(10) || 'Context: A' || c_custkey || ' name=' || c_name || chr(10) || 'B' || c_custkey || ' note: ' || c_mktsegment, chr(10) ORDER BY c_custkey) AS content
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""")
def overlay_rendering(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    cell = lambda letter, header, raw: F.array(F.struct(F.concat(F.lit(letter), F.col("c_custkey").cast("string")).alias("coordinate"), F.lit(header).alias("header"), F.col(raw).alias("raw")))
    rows = c.select(extract.entity("U", "n_nationkey").alias("unit_id"), F.col("n_name").alias("sheet"), F.col("c_custkey").alias("row"), cell("A", "name", "c_name").alias("context"), cell("B", "note", "c_mktsegment").alias("semantic"))
    return protocol.overlay_text(rows)


@query("""SELECT p_partkey AS mention_id, p_size > 25 AS alias_declared, CASE WHEN p_size > 25 THEN 'AC-' || p_partkey END AS code, 1 + (p_size > 25)::INT AS n_identifiers FROM part""")
def identity_repair(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    code = F.concat(F.lit("AC-"), F.col("p_partkey").cast("string"))
    name = F.concat("p_name", F.lit("("), code, F.lit(")"))
    told = F.when(F.col("p_size") > 25, F.concat(name, F.lit(" / "), "p_brand")).otherwise("p_brand")
    have = F.array(F.struct(F.lit("erp").alias("scope"), F.col("p_brand").alias("value")), F.struct(F.lit("inline_product_code").alias("scope"), F.lit("ZZ-1").alias("value")))
    m = p.select(F.col("p_partkey").alias("mention_id"), F.lit("Product").alias("type"), name.alias("name"), F.array("p_brand").alias("aliases"), F.lit(False).alias("alias_declared"), told.alias("evidence"), have.alias("identifiers"))
    inline = F.filter("identifiers", lambda i: i["scope"] == "inline_product_code")
    return protocol.repaired_identity(m).select("mention_id", "alias_declared", F.get(inline, F.lit(0))["value"].alias("code"), F.size("identifiers").alias("n_identifiers"))


@query("""SELECT a.c_mktsegment AS source, b.c_mktsegment AS target, count(*) AS n, min(CASE WHEN a.s = 'record' OR b.s = 'record' THEN CASE WHEN b.s = 'record' THEN 'record' WHEN a.s = 'uncertain' OR b.s = 'uncertain' THEN 'uncertain' ELSE b.s END ELSE 'active' END) AS status
FROM (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'record' WHEN 'AUTOMOBILE' THEN 'uncertain' WHEN 'MACHINERY' THEN 'resolved' ELSE 'active' END AS s FROM customer) a
JOIN (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'record' WHEN 'AUTOMOBILE' THEN 'uncertain' WHEN 'MACHINERY' THEN 'resolved' ELSE 'active' END AS s FROM customer) b ON b.c_custkey = a.c_custkey + 1 GROUP BY ALL""")
def cluster_statuses(spark, sf_dir):
    s = F.when(F.col("c_mktsegment") == "BUILDING", "record").when(F.col("c_mktsegment") == "AUTOMOBILE", "uncertain").when(F.col("c_mktsegment") == "MACHINERY", "resolved").otherwise("active")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", s.alias("s"))
    pairs = c.select("c_custkey", F.col("c_mktsegment").alias("source"), F.col("s").alias("a")).join(c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_mktsegment").alias("target"), F.col("s").alias("b")), "c_custkey")
    return pairs.groupBy("source", "target").agg(F.count("*").alias("n"), F.min(protocol.joined_status(F.col("a"), F.col("b"))).alias("status"))


@query("""WITH c AS (SELECT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')),
 r AS (SELECT DISTINCT o_custkey, l_partkey FROM c), g AS (SELECT o_custkey, list_transform(list_sort(list(l_partkey)), lambda x: 'P' || x) AS cand FROM r GROUP BY ALL)
SELECT 'align_' || substr(sha256('["run","1","C' || o_custkey || '","' || array_to_string(cand, '","') || '"]'), 1, 20) AS task_id, 'C' || o_custkey AS cluster_id, len(cand) AS n FROM g""")
def alignment_round(spark, sf_dir):
    status = F.when(F.col("c_mktsegment") == "BUILDING", "active").when(F.col("c_mktsegment") == "AUTOMOBILE", "uncertain").otherwise("resolved")
    clusters = table(spark, sf_dir, "customer").select(extract.entity("C", "c_custkey").alias("cluster_id"), status.alias("status"))
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    cand = li.select(extract.entity("C", "o_custkey").alias("cluster_id"), extract.entity("P", "l_partkey").alias("candidate"), F.col("l_partkey").alias("rank")).distinct()
    return protocol.round_tasks(clusters, cand, "run", 1)["tasks"].select("task_id", "cluster_id", F.size("candidates").cast("long").alias("n"))


@query("""WITH u AS (SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), lead_ AS (SELECT source AS s FROM u ORDER BY n_chars DESC, source, doc_id LIMIT 1)
SELECT doc_id AS unit_id, (source <> s)::INT AS later, row_number() OVER (ORDER BY (source <> s)::INT, n_chars DESC, source, doc_id) AS turn FROM u, lead_""")
def pending_turns(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_id"), F.col("source").alias("document_id"), F.lit("").alias("place"), F.col("n_chars").alias("priority"))
    out = protocol.pending_order(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("unit_id")))
    w = Window.orderBy("later", F.desc("priority"), "document_id", "place", "unit_id")
    return out.withColumn("turn", F.row_number().over(w).cast("long")).select("unit_id", "later", "turn")


@query("""SELECT l_orderkey, l_linenumber, 'C' || o_custkey AS source, o_orderstatus AS file_sha256 FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""")
def evidence_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), extract.entity("C", "o_custkey").alias("path"), F.col("o_orderstatus").alias("sha256"))
    ev = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), "l_linenumber")
    return protocol.with_sources(ev, docs).select(F.col("document_id").alias("l_orderkey"), "l_linenumber", "source", "file_sha256")


@query("""SELECT p_partkey AS unit_id, CASE WHEN p_size > 10 THEN 'visual' ELSE 'text' END AS kind, (p_size > 10)::INT AS n_assets, 1 AS n_cells FROM part""")
def evidence_references(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    none = F.array().cast("array<string>")
    ev = p.select(F.col("p_partkey").alias("unit_id"), F.lit("visual").alias("kind"), F.array("p_brand").alias("assets"), F.array("p_name", F.lit("A1")).alias("cells"), none.alias("shapes"))
    have = p.select(F.col("p_partkey").alias("unit_id"), F.when(F.col("p_size") > 10, F.array("p_brand")).otherwise(none).alias("assets"), F.array(F.lit("A1")).alias("cells"), F.array(F.lit("s")).alias("shapes"))
    return protocol.valid_references(ev, have).select("unit_id", "kind", F.size("assets").alias("n_assets"), F.size("cells").alias("n_cells"))


@query("SELECT doc_id FROM documents WHERE lang <> 'de' AND trim(text, ' ') <> ''")
def readable_units(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    docs = d.select(F.col("doc_id").alias("document_id"), F.when(F.col("lang") == "de", "questions").otherwise("corpus").alias("role"))
    return protocol.readable_units(d.select("doc_id", F.col("doc_id").alias("document_id"), F.col("text").alias("content")), docs).select("doc_id")


@query("""SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN p_type ELSE '{"number":"' || CASE WHEN p_size > 20 THEN p_size * 10000 ELSE p_size END || '","unit":"' || CASE WHEN p_size > 20 THEN '元' ELSE '个' END || '","currency":null}' END AS key FROM part""")
def value_keys(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    number = F.when(F.col("p_size") <= 40, F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    unit = F.when(F.col("p_size") > 20, "万元").otherwise("个")
    return p.select(F.col("p_partkey").alias("id"), T.value_key(number, unit, F.lit(None).cast("string"), F.col("p_type")).alias("key"))


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b, CASE WHEN lower(a.p_type) <> lower(b.p_type) THEN 'different_variant' WHEN a.p_brand <> b.p_brand THEN 'different_scoped_id' END AS reason
FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey""")
def hard_conflicts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    own = F.struct(F.lit("Product").alias("type"), F.create_map(F.lit("variant"), "p_type").alias("attributes"), F.create_map(F.lit("brand"), F.array("p_brand")).alias("identifiers"))
    side = lambda x: p.select("p_name", "p_size", F.col("p_partkey").alias(f"k{x}"), own.alias(x))
    pairs = side("x").join(side("y"), ["p_name", "p_size"]).filter("kx < ky")
    return pairs.select(F.col("kx").alias("a"), F.col("ky").alias("b"), align.hard_conflict("x", "y").alias("reason"))


@query("""WITH m AS (SELECT 'C' || c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'AUTOMOBILE' ELSE c_name END AS name, c_mktsegment AS alias, c_acctbal > 9000 AS told FROM customer),
 t AS (SELECT id, lower(unnest([name, alias])) AS k FROM m WHERE told), n AS (SELECT id, regexp_replace(lower(name), '\\s+', '', 'g') AS k FROM m)
SELECT 'alias:Actor:' || k AS bucket, count(DISTINCT id) AS n FROM (SELECT id, regexp_replace(k, '\\s+', '', 'g') AS k FROM t UNION ALL SELECT id, k FROM n WHERE k IN (SELECT regexp_replace(k, '\\s+', '', 'g') FROM t)) GROUP BY ALL HAVING count(DISTINCT id) > 1""")
def declared_aliases(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    m = c.select(extract.entity("C", "c_custkey").alias("mention_id"), F.lit("Actor").alias("type"), F.when(F.col("c_acctbal") < 0, "AUTOMOBILE").otherwise(F.col("c_name")).alias("name"), F.array("c_mktsegment").alias("aliases"), (F.col("c_acctbal") > 9000).alias("alias_declared"))
    return align.declared_alias_buckets(m).select("bucket", F.size("mentions").cast("long").alias("n"))


@query("""SELECT 'record_key:Event:' || o_orderpriority || ':' || regexp_replace(lower(o_orderstatus), '\\s+', '', 'g') AS bucket, count(*) AS n FROM orders WHERE o_totalprice > 50000 GROUP BY o_orderpriority, o_orderstatus HAVING count(*) > 1""")
def record_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    m = o.select(extract.entity("O", "o_orderkey").alias("mention_id"), F.lit("Event").alias("type"), F.col("o_orderstatus").alias("name"), F.when(F.col("o_totalprice") > 50000, F.col("o_orderpriority")).alias("record_scope"))
    return align.record_key_buckets(m).select("bucket", F.size("mentions").cast("long").alias("n"))


# ---------------------------------------------------------------- retrieval for a batch of questions

FORMATS = ("pdf", "word", "excel", "ppt", "image")


def evidence_store(spark, sf_dir) -> retrieve.Store:
    """Documents as units, regions, nations, suppliers and parts as a graph, customers as a sheet."""
    t = lambda name: table(spark, sf_dir, name)
    none = F.array().cast("array<string>")
    node = lambda df, prefix, key, kind, name, alias=none: df.select(extract.entity(prefix, key).alias("id"), F.lit(kind).alias("type"), F.col(name).alias("name"), alias.alias("aliases"), none.alias("identifiers"))
    nodes = reduce(
        DataFrame.unionByName,
        (
            node(t("region"), "R", "r_regionkey", "DataAsset", "r_name"),
            node(t("nation"), "N", "n_nationkey", "Product", "n_name"),
            node(t("supplier"), "S", "s_suppkey", "Actor", "s_name"),
            node(t("part"), "P", "p_partkey", "AITool", "p_name", F.array("p_brand")),
        ),
    )
    link = lambda df, a, k, p, b, j, unit: df.select(extract.entity(a, k).alias("subject"), F.lit(p).alias("predicate"), extract.entity(b, j).alias("object"), F.lit(None).cast("string").alias("value"), F.create_map().cast("map<string,string>").alias("qualifiers"), F.concat(F.lit("U"), F.col(unit).cast("string")).alias("unit_id"))
    relations = link(t("nation"), "N", "n_nationkey", "depends_on", "R", "n_regionkey", "n_nationkey").unionByName(link(t("supplier"), "S", "s_suppkey", "uses", "N", "s_nationkey", "s_suppkey"))
    p = t("part")
    said = p.select(extract.entity("P", "p_partkey").alias("subject"), F.lit("attribute").alias("predicate"), F.lit(None).cast("string").alias("object"), F.col("p_type").alias("value"), F.create_map(F.lit("attribute"), F.lit("type")).alias("qualifiers"), extract.entity("U", "p_partkey").alias("unit_id"))
    facts = relations.unionByName(said).withColumn("fact_id", ident("fact", F.col("subject"), F.col("predicate"), F.coalesce("object", "value")))
    facts = facts.withColumn("evidence_ids", F.array(F.concat(F.lit("ev_"), "fact_id")))
    evidence = facts.select(F.col("evidence_ids")[0].alias("evidence_id"), "unit_id", F.col("unit_id").alias("source"), F.lit("").alias("locator"))
    edges = facts.filter("object is not null").select(ident("edge", F.col("subject"), F.col("predicate"), F.col("object")).alias("edge_id"), F.col("subject").alias("source"), F.col("object").alias("target"), "predicate", F.array("fact_id").alias("fact_ids"))
    d = t("documents")
    kind = F.element_at(F.array(*map(F.lit, FORMATS)), (F.pmod(F.xxhash64("source"), F.lit(len(FORMATS))) + 1).cast("int"))
    units_ = d.select(extract.entity("U", "doc_id").alias("unit_id"), F.col("text").alias("content"), "source", kind.alias("format"), F.col("lang").alias("place"))
    sheet = entries.unpivot(t("customer"), "customer", "c_custkey", ["c_name", "c_mktsegment"])
    sheet = sheet.withColumns({"unit_id": F.lit("U0"), "source": F.lit("customer")})
    return retrieve.Store(nodes, facts.drop("unit_id"), edges, evidence, units_, sheet)


def asked(spark, sf_dir) -> DataFrame:
    """The benchmark's passages as questions, and questions about the graph and the sheet."""
    more = [(-1, "“customer”工作表的c_mktsegment列，列出5条"), (-2, "PDF 和 Word 中 FRANCE 的名称分别叫什么"), (-3, "为什么 GERMANY, EUROPE, 的时间线变化"), (-4, "Supplier#000000003, GERMANY")]
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("qid"), F.col("text").alias("question")).unionByName(spark.createDataFrame(more, "qid long, question string"))


@query()
def retrieve_batch(spark, sf_dir):
    out = retrieve.retrieve(asked(spark, sf_dir), evidence_store(spark, sf_dir))
    count = lambda k: out[k].groupBy("qid").agg(F.count("*").alias(f"n_{k}"))
    df = out["plans"].select("qid", "intent", "retrieval_mode")
    for k in ("structured", "facts", "candidates", "timeline", "paths", "units"):
        df = df.join(count(k), "qid", "left")
    return df.join(out["context"].select("qid", "context", "blocks", "omitted"), "qid").fillna(0)


@query(f"""WITH facts AS (SELECT 'S' || s_suppkey AS s, 'uses' AS p, 'N' || n_nationkey AS o, s_name || ' uses ' || n_name AS text FROM supplier JOIN nation ON s_nationkey = n_nationkey),
 docs AS (SELECT {ident_sql('fact', 's', 'p', 'o')} AS doc_id, text, o FROM facts),
 qs AS (SELECT n_nationkey AS qid, n_name || ' 2024' AS text FROM nation), {BM25_SQL},
 pool AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS r FROM scored),
 hit AS (SELECT p.qid, p.doc_id, p.score AS base, round(p.score + 0.4, 6) AS score
  FROM pool p WHERE r <= 56),
 cut AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY base DESC, doc_id) AS n FROM hit)
SELECT qid, doc_id AS fact_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM cut WHERE n <= 14""")
def fact_retrieval(spark, sf_dir):
    store = evidence_store(spark, sf_dir)
    facts = store.facts.filter("predicate = 'uses'")
    store = replace(store, facts=facts).indexed()
    q = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("qid"), F.concat("n_name", F.lit(" 2024")).alias("text"))
    none = F.array().cast("array<int>")
    plans = q.select("qid", F.array(F.lower("text")).alias("keywords"), F.create_map(F.lit("uses"), F.lit(0.4)).alias("weights"), none.alias("years"), none.alias("months"), none.alias("quarters"), F.lit(False).alias("timeline"))
    return retrieve.fact_hits(store, q, plans).select("qid", "fact_id", "score", F.col("rank").cast("long").alias("rank"))
