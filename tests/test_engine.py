"""Operators on small tables with known results."""

from pyspark.sql import functions as F

from factloom.functions import text as T
from factloom.operators import align, entries, extract, graph, search, units
from factloom.plans import context, planner


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_search_tokens_of_cjk_runs(spark):
    df = spark.createDataFrame([("订单AI-2工具 x",)], "t string")
    assert df.select(T.tokens(F.col("t"))).first()[0] == ["ai-2", "订单", "订单", "工具", "工具"]
    assert df.select(T.alignment_tokens(F.col("t"))).first()[0] == ["ai", "工具", "订单"]


def test_bm25_counts_empty_texts_and_repeated_terms(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, ""), (3, "alpha alpha")], "id int, text string")
    q = spark.createDataFrame([(1, "alpha alpha")], "qid int, text string")
    scan = rows(search.bm25_scan(docs, q).select("id", "score"))
    assert scan == rows(search.bm25(search.postings(docs), q).select("id", "score"))
    once = dict(rows(search.bm25_scan(docs, q.withColumn("text", F.lit("alpha"))).select("id", "score")))
    assert [i for i, _ in scan] == [1, 3] and abs(dict(scan)[3] - 2 * once[3]) < 2e-6


def test_guarded_merge_is_not_plain_closure(spark):
    m = [("1", "Product", "x"), ("2", "Product", None), ("3", "Product", "y"), ("4", "Actor", None)]
    mentions = spark.createDataFrame([(a, b, c, None, None, None) for a, b, c in m], "mention_id string, type string, variant string, id_scope string, id_value string, event_date string")
    buckets = spark.createDataFrame([("a", ["1", "2"]), ("b", ["2", "3"]), ("c", ["3", "4"])], "bucket string, mentions array<string>")
    assert rows(align.guarded_merge(buckets, mentions)) == [("1", "1"), ("2", "1"), ("3", "3"), ("4", "4")]
    forbidden = spark.createDataFrame([("2", "1")], "a string, b string")
    assert rows(align.guarded_merge(buckets, mentions, forbidden)) == [("1", "1"), ("2", "2"), ("3", "2"), ("4", "4")]


def test_identifier_and_alias_buckets(spark):
    ids = spark.createDataFrame([("1", "Product", "erp", "A1"), ("2", "Product", "erp", "a1"), ("3", "Product", "crm", "A1")], "mention_id string, type string, scope string, value string")
    assert [r[1] for r in rows(align.identifier_buckets(ids))] == [["1", "2"]]
    m = spark.createDataFrame([("1", "Product", "A", ["B"]), ("2", "Product", "b", ["a"]), ("3", "Product", "A", [])], "mention_id string, type string, name string, aliases array<string>")
    assert [r[1] for r in rows(align.alias_buckets(m))] == [["1", "2"]]


def test_decisions(spark):
    clusters = spark.createDataFrame([(c,) for c in "abcd"], "cluster_id string")
    decisions = spark.createDataFrame([("a", "b"), ("b", "NEW_ENTITY"), ("c", "zzz"), ("d", "c")], "cluster_id string, choice string")
    conflicts = spark.createDataFrame([("c", "d")], "a string, b string")
    merges, status = align.apply_decisions(clusters, decisions, conflicts, 1)
    assert rows(merges) == [("a", "b")]
    assert rows(status) == [("a", "active", 1), ("b", "resolved", 1), ("c", "uncertain", 1), ("d", "uncertain", 1)]


def test_endpoints(spark):
    mentions = spark.createDataFrame([("u", "m1", "a", "Atlas", ["AT"]), ("u", "m2", "b", "Box", []), ("u", "m3", "c", "Box", [])], "unit_id string, mention_id string, local_id string, name string, aliases array<string>")
    rel = spark.createDataFrame([("u", "a", "uses", "b"), ("u", "at ", "causes", "c"), ("u", "a", "uses", "box"), ("u", None, "uses", "b"), ("u", "a", "uses", "Atlas")], "unit_id string, subject string, predicate string, object string")
    got = sorted((r["subject_id"] or "", r["predicate"], r["object_id"] or "", r["warning"] or "") for r in extract.resolve_endpoints(rel, mentions).collect())
    assert got == [("", "uses", "m2", "unresolved_subject"), ("m1", "reported_cause", "m3", ""), ("m1", "uses", "", "unresolved_object"), ("m1", "uses", "m1", "self_relation"), ("m1", "uses", "m2", "")]


def test_facts_of_unknown_scope_stay_apart(spark):
    f = [("s", "p", "o", "{}", "asserted", None, "e1", "1"), ("s", "p", "o", "{}", "asserted", None, "e2", "2"), ("s", "p", "o", "{}", "asserted", "t1", "e3", "1"), ("s", "p", "o", "{}", "asserted", "t2", "e4", "1")]
    d = graph.dedup_facts(spark.createDataFrame(f, "subject string, predicate string, object_key string, qualifiers string, origin string, task_id string, evidence_id string, claim string"))
    assert sorted(len(r["evidence_ids"]) for r in d.collect()) == [1, 1, 2] and d.select("fact_id").distinct().count() == 3


def test_events_do_not_leak_through_participants(spark):
    e = [("E1", "P", "affects"), ("E1", "A", "has_participant"), ("E2", "A", "has_participant"), ("E2", "E1", "linked_to"), ("E3", "E1", "reported_cause")]
    edges = spark.createDataFrame(e, "source string, target string, predicate string").withColumn("edge_id", F.concat("source", "target"))
    nodes = spark.createDataFrame([(x, "Event") for x in ("E1", "E2", "E3")] + [("P", "Product"), ("A", "Actor")], "id string, type string")
    targets = spark.createDataFrame([(1, "P")], "qid int, node string")
    assert rows(graph.event_neighbourhood(graph.adjacency(edges), nodes, targets)) == [(1, "E1", 0), (1, "E3", 1)]


def test_periods_and_dates(spark):
    df = spark.createDataFrame([("2026年4月8日, 2025-12",)], "t string").select(T.iso_dates(F.col("t")).alias("d"))
    assert df.first()[0] == ["2026-04-08", "2025-12"]
    ints = lambda *x: F.array(*map(F.lit, x)).cast("array<int>")
    assert df.select(graph.in_period(F.col("d"), ints(2026), ints(), ints(2)), graph.in_period(F.col("d"), ints(2026), ints(12), ints())).first() == (True, False)


def test_relation_types(spark):
    df = spark.createDataFrame([("uses", "Actor", "AITool"), ("uses", "Event", "AITool"), ("other", "Event", "Event")], "p string, s string, o string")
    assert [r[0] for r in df.select(graph.relation_fits(F.col("p"), F.col("s"), F.col("o"))).collect()] == [True, False, None]


def test_routing_of_tables_images_and_bare_units(spark):
    u = [("a", "# Title", "", "md", 0), ("b", "", "", "png", 1), ("c", "| a |", "xlsx_cells", "xlsx", 0), ("d", "| a |", "pdf_table", "pdf", 0), ("e", "收入影响导致升级 2026年4月 AB12 原因", "", "md", 0), ("f", "x" * 100, "", "md", 0)]
    got = {r["unit_id"]: (r["mode"], r["priority"]) for r in units.route(spark.createDataFrame(u, "unit_id string, content string, kind string, format string, n_assets int")).collect()}
    assert got["a"] == ("auto_no_facts", 0) and got["b"] == ("llm_visual", 103) and got["c"] == ("xlsx_rule_or_fallback", 82) and got["d"] == ("llm_structured", 72)
    assert got["e"][0] == "llm_semantic" and got["f"] == ("llm_batch", 20)


def test_page_words(spark):
    w = spark.createDataFrame([(1, 10.0, 30.0, 10.0, "Na"), (1, 31.0, 50.0, 10.0, "me"), (1, 80.0, 99.0, 10.0, "x"), (1, 12.0, 20.0, 20.0, "b"), (1, 24.0, 30.0, 20.0, "c")], "page int, x0 double, x1 double, top double, text string")
    columns = units.header_columns(w.filter("top = 10"))
    assert rows(columns.select("col", "header")) == [(0, "Name"), (1, "x")]  # a blank needs a gap over 2.5
    merged = units.merge_words(units.band_words(w, columns), ["page", "col"])
    assert rows(merged) == [(1, 0, "Name\nb c"), (1, 1, "x")]


def test_scope_and_repeats(spark):
    e = spark.createDataFrame([(f"e{i}", "s", i, "f", v) for i, v in enumerate(["same", "same", "发布 1", " "])], "entry_id string, sheet string, row long, field string, value string")
    got = {r["entry_id"]: (r["repeat_count"], round(r["salience"], 3)) for r in entries.exhaustive(e, ["S"], ["f"]).collect()}
    assert got == {"e0": (2, -0.9), "e1": (2, -0.9), "e2": (1, 1.7)}


def test_context_is_within_budget(spark):
    b = spark.createDataFrame([(1, "QUESTION", 1, "q" * 10), (1, "RAW", 1, "r" * 5000), (1, "FACT", 1, "f" * 100), (1, "PATH", 1, "p" * 3000)], "qid int, kind string, rank int, text string")
    r = context.assemble(b, 1600).first()
    assert len(r["context"]) <= 1600 and r["omitted"] == 1 and "f" * 100 in r["context"] and "…" in r["context"]


def test_plan_of_unknown_column_stays_ranked(spark):
    q = spark.createDataFrame([(1, "列出订单工作表的“价格”列全部"), (2, "第二季度 Q3 2026")], "qid int, question string")
    hints = spark.createDataFrame([(1, ["订单"], [], True)], "qid int, sheet_hints array<string>, column_hints array<string>, column_requested boolean")
    p = {r["qid"]: r for r in planner.plan(q, hints).collect()}
    assert p[1]["retrieval_mode"] == "ranked" and p[1]["intent"] == "structured_lookup" and p[2]["quarters"] == [2, 3] and p[2]["years"] == [2026]
    score = spark.createDataFrame([("Q2 2026-04",)], "t string").select(planner.time_score(F.col("t"), *[F.array(F.lit(x)) for x in (2026, 4, 2)])).first()[0]
    assert round(score, 6) == 2.6


def test_accept_is_idempotent(spark):
    r = spark.createDataFrame([("t1", "run", 2), ("t1", "run", 1), ("t2", "old", 1), ("t9", "run", 1), ("t3", "run", 1)], "task_id string, fingerprint string, seq long")
    tasks = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "task_id string")
    done = spark.createDataFrame([("t3",)], "task_id string")
    first = extract.accept(r, tasks, done, "run")
    assert rows(first) == [("t1", "run", 1)]
    assert extract.accept(r, tasks, done.unionByName(first.select("task_id")), "run").count() == 0
