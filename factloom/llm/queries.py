"""The queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import ctw, decontaminate, line_dedup, metric_join, orc_tokens, packing, quality, token_counts, toxicity, urls
from factloom.llm.common import read_table, scratch_path


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = orc_tokens.write_tokens(docs, scratch_path(spark, "tokens"), tokenizer("word_bpe_49k.json"), end_id=1)
    return orc_tokens.token_digest(spark, path, docs.schema["doc_id"].dataType.simpleString())


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(read_table(spark, sf_dir, "documents")).drop("t")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents"))


def op7_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(read_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)


def op9_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_orc_tokens": op2_orc_tokens,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_context_tree_weighting": op7_context_tree_weighting,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_toxicity_severity": op9_toxicity_severity,
    "op10_url_filters": op10_url_filters,
}

STOP = ", ".join(sorted({f"'{w}'" for line in quality.STOP_WORDS.values() for w in line.split()}))


def rule_sql() -> str:
    out = ["true"]
    for r in quality.RULES:
        out += [f"{r.top} + {r.slack} >= {r.least} * {r.bottom}"] if r.least is not None else []
        out += [f"{r.top} <= {r.most} * {r.bottom}"] if r.most is not None else []
    return " AND ".join(out)


ORACLE_SQL: dict[str, str] = {
    "op5_ngram_jaccard_join": r"""WITH RECURSIVE d AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
   lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
 w AS (SELECT doc_id, len(ws) AS m, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
 f AS (SELECT doc_id, m, i, concat_ws(' ', w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p) AS g FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
 s AS (SELECT DISTINCT doc_id, g FROM f WHERE i = 1 OR i <= m - 4), c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 n AS (SELECT doc_id, coalesce(n, 0) AS n FROM d LEFT JOIN c USING (doc_id)),
 links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
   GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
 reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, n AS n_shingles, low AS component_id FROM n JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) ON a = doc_id""",
    "op6_quality_rules": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
 g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4])) AS g FROM w WHERE len(ws) > 4),
 r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
 c AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM r, range(5) AS x(j) GROUP BY doc_id),
 m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_capitals,
   len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(list_filter(ws, lambda x: x IN ({STOP}))) AS n_stop_words, len(list_filter(ws, lambda x, i: i > 1 AND x = ws[i - 1])) AS n_echoes, len(ls) AS n_lines FROM w LEFT JOIN c USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND ({rule_sql()}) AS kept FROM m""",
}
