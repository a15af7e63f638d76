"""Scalar text functions as column expressions.

Case folding is lower() with the one letter that folds to two. Of the compatibility forms the full-width
ones of ASCII and the wide blank are folded everywhere; ``nfkc`` (an Arrow function) folds all.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The vocabularies that routing, planning and extraction share with their users' data.
RELATION_CUES = ("依赖", "使用", "购买", "替代", "合并", "升级", "影响", "导致", "原因", "归因", "depends", "uses", "purchased", "replace", "merge", "upgrade", "affect", "cause")
METRIC_CUES = ("收入", "续费", "转化", "评分", "价格", "费用", "成本", "金额", "用户数", "调用", "ltv", "arpu", "%")
EVENT_CUES = ("变更", "调整", "升级", "停售", "上线", "发布", "修复", "故障", "实验", "评审", "风险", "回退")
ALIAS_CUES = ("又称", "别名", "简称", "称呼", "同一", "alias")
STOP_WORDS = (
    "为什么 为何 原因 怎么 如何 什么 哪些 哪个 是否 请 说明 分析 的 了 在 是 和 与 对 从 到 有 一个 分别 相关 问题 "
    "sheet 工作表 表格 列 字段 页面 页 slide 幻灯片"
).split()
PREDICATE_ALIASES = {
    "cause": "reported_cause",
    "causes": "reported_cause",
    "caused_by": "reported_cause",
    "contributes_to": "affects",
    "influences": "affects",
    "impacts": "affects",
    "depends": "depends_on",
    "depends_on": "depends_on",
    "replaces": "replaced_by",
    "merged_to": "merged_into",
    "upgrade_to": "upgraded_to",
    "used_by": "uses",
    "purchase": "purchased",
    "buys": "purchased",
}
UNIT_SCALES = {"万次": ("次", "10000"), "万元": ("元", "10000"), "千元": ("元", "1000"), "%": ("比例", "0.01")}
ONTOLOGY_CUES = {
    "Version": ("版本", "version", "release"),
    "DataAsset": ("数据资产", "数据集", "数据源", "报表", "文档", "dataset", "data asset", "report", "document"),
    "Actor": ("客户", "用户", "人员", "成员", "组织", "团队", "customer", "user", "person", "organization", "team"),
    "AITool": ("ai工具", "智能工具", "模型工具", "ai tool", "model tool"),
    "Product": ("产品", "商品", "服务", "应用", "插件", "product", "service", "application", "app", "plugin"),
}
HEADER_CUES = {
    "canonical": ("标准名称", "规范名称", "统一名称", "主名称", "canonical", "standard name", "primary name"),
    "alias": ("别名", "别称", "曾用名", "简称", "称呼", "显示名", "alias", "aka", "alternate name", "alternative name", "display name"),
    "name_like": ("名称", "name", "label"),
    "metadata": ("类型", "类别", "编号", "id", "代码", "code", "日期", "时间", "状态", "备注", "说明", "负责人"),
    "type": ("实体类型", "对象类型", "entity type", "object type"),
}
WORD = r"[a-z0-9]+(?:[_.+\-/][a-z0-9]+)*"
CJK = r"[一-鿿]+"
SALIENT_RANKED = r"[0-9]|→|变|增|降|影响|风险|原因|归因|升级|替代|合并"
SALIENT_EXHAUSTIVE = SALIENT_RANKED + r"|并入|投诉|异常|停售|发布|修复"


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which has no built-in."""
    return s.str.normalize("NFKC")


WIDE, NARROW = "".join(chr(0xFEE0 + i) for i in range(33, 127)) + "\u3000", "".join(map(chr, range(33, 127))) + " "


def narrow(c: Column) -> Column:
    """Full-width forms as ASCII; texts of ASCII alone, which are told by their size, pass as they are."""
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, WIDE, NARROW))


def fold(c: Column) -> Column:
    return F.replace(F.lower(narrow(F.coalesce(c, F.lit("")))), F.lit("ß"), F.lit("ss"))


def norm(c: Column) -> Column:
    """Without white space, case folded; null is empty."""
    return fold(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\u3000]+", ""))


def clean(c: Column) -> Column:
    """Without control characters but tabs and line feeds; one kind of line end."""
    return F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def grams(run: Column, n: int) -> Column:
    return F.when(F.length(run) < n, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.length(run) - (n - 1)), lambda i: F.substr(run, i, F.lit(n))))


def tokens(c: Column) -> Column:
    """Search tokens with repetition: ASCII words, and of each CJK run itself (to 8), its pairs, and its
    triples (to 12); stop words and single characters go."""
    text = fold(c)
    none = F.array().cast("array<string>")

    def parts(run: Column) -> Column:
        whole = F.when(F.length(run) <= 8, F.array(run)).otherwise(none)
        return F.concat(whole, grams(run, 2), F.when(F.length(run) <= 12, grams(run, 3)).otherwise(none))

    cjk = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(CJK), F.lit(0)), parts))
    cjk = F.when(text.rlike(CJK), cjk).otherwise(none)
    every = F.concat(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), cjk)
    return F.filter(every, lambda t: (F.length(t) > 1) & ~t.isin(*STOP_WORDS))


def alignment_tokens(c: Column) -> Column:
    """A set of ASCII words of two characters or more and CJK pairs."""
    text = norm_keep_spaces(c)
    cjk = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(CJK), F.lit(0)), lambda r: grams(r, 2)))
    return F.array_sort(F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit(r"[a-z0-9]{2,}"), F.lit(0)), cjk)))


def norm_keep_spaces(c: Column) -> Column:
    return fold(F.trim(c))


def quoted(text: str) -> str:
    """A literal inside a regular expression."""
    return r"\Q" + text + r"\E"


def cue_count(c: Column, cues) -> Column:
    """Non-overlapping occurrences of each cue, summed."""
    return reduce(lambda a, b: a + b, [F.regexp_count(fold(c), F.lit(quoted(x.lower()))) for x in cues])


def has_any(c: Column, cues) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(fold(c), F.lit(x.lower())) for x in cues])


def id_like_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\b[A-Z]{1,6}[0-9]{1,8}\b")) + F.regexp_count(c, F.lit(r"\b[A-Z]{2,12}[-_][A-Z0-9][A-Z0-9_-]{1,24}\b"))


def date_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\b20[0-9]{2}(?:[-/.年][0-9]{1,2})?(?:[-/.月][0-9]{1,2})?"))


def phrase_in(phrase: Column, text: Column) -> Column:
    """A phrase of ASCII word characters needs a boundary on both sides, any other is a substring."""
    p, t = norm(phrase), norm(text)
    edge = F.concat(F.lit(r"(?<![a-z0-9])\Q"), p, F.lit(r"\E(?![a-z0-9])"))
    return F.when(p == "", F.lit(False)).when(p.rlike(r"^[a-z0-9_.+\-/]+$"), F.regexp_like(t, edge)).otherwise(F.contains(t, p))


def typed_number(raw: Column, header: Column) -> Column:
    """struct(raw, number, unit) of the first number; null without one. The unit follows from header and text."""
    text = F.trim(raw)
    cleaned = F.regexp_replace(F.regexp_replace(text, "[,，]", ""), "^(约|≈|~)", "")
    number = F.regexp_extract(cleaned, r"[-+]?[0-9]+(?:\.[0-9]+)?", 0)
    both = F.concat(header, F.lit(" "), text)
    has = lambda *xs: reduce(lambda a, b: a | b, [F.contains(both, F.lit(x)) for x in xs])
    unit = F.when(has("%", "百分"), "%").when(has("万元", "(万)", "（万）"), "万元")
    for u in ("千元", "元", "万次", "次"):
        unit = unit.when(has(u), u)
    return F.when(number != "", F.struct(text.alias("raw"), number.alias("number"), unit.otherwise("").alias("unit")))


def decimal_text(c: Column) -> Column:
    """A plain decimal without trailing zeros; null if it is no number."""
    text = c.try_cast("decimal(38,18)").cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)


def scaled(number: Column, unit: Column) -> Column:
    """struct(number, unit) with units scaled to their base; other units as they are."""
    value = number.try_cast("decimal(30,8)")
    out = F.struct(decimal_text(number).alias("number"), unit.alias("unit"))
    for u, (base, scale) in UNIT_SCALES.items():
        out = F.when(unit == u, F.struct(decimal_text((value * F.lit(scale).cast("decimal(7,2)")).cast("string")).alias("number"), F.lit(base).alias("unit"))).otherwise(out)
    return out


def value_key(number: Column, unit: Column, currency: Column, raw: Column) -> Column:
    """What makes two values equal: the scaled number with its unit and currency as JSON, else the text."""
    value = scaled(number, unit)
    keyed = F.to_json(F.struct(value["number"].alias("number"), value["unit"].alias("unit"), currency.alias("currency")), {"ignoreNullFields": "false"})
    return F.when(value["number"].isNotNull(), keyed).otherwise(raw)


def literal_kind(raw: Column) -> Column:
    t = F.trim(F.coalesce(raw, F.lit("")))
    dated = t.rlike(r"^20[0-9]{2}(?:[-/.年][0-9]{1,2})?(?:[-/.月][0-9]{1,2})?日?$")
    return (
        F.when(t == "", "text")
        .when(dated & t.rlike(r"日|[-/.][0-9]{1,2}$"), "date")
        .when(dated, "period")
        .when(t.rlike(r"^[A-Za-z]{1,12}[-_][A-Za-z0-9][A-Za-z0-9_-]{1,40}$"), "identifier")
        .when(t.rlike("→|~|～|至|到") & t.rlike("[0-9]"), "range")
        .when(F.lower(t).isin("true", "false", "是", "否", "有", "无"), "boolean")
        .otherwise("text")
    )


def evidence_norm(c: Column) -> Column:
    return fold(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)<br\s*/?>", ""), r"(?U)[\s|`*_]+", ""))


def match_mode(source: Column, quote: Column) -> Column:
    q = evidence_norm(quote)
    return F.when(F.contains(source, quote), "exact").when((q != "") & F.contains(evidence_norm(source), q), "normalized").otherwise("locator_only")


def predicate(c: Column) -> Column:
    key = F.translate(F.lower(F.trim(F.coalesce(c, F.lit("")))), "- ", "__")
    known = F.create_map(*[F.lit(x) for kv in PREDICATE_ALIASES.items() for x in kv])
    return F.when(key == "", "related_to").otherwise(F.coalesce(known[key], key))


def version_of(c: Column) -> Column:
    """struct(base, version) of names like ``X v2.1``; null for others."""
    pattern = r"^(.+?)[\s_-]*[vV]([0-9]+(?:\.[0-9]+)*)$"
    return F.when(c.rlike(pattern), F.struct(F.regexp_extract(c, pattern, 1).alias("base"), F.regexp_extract(c, pattern, 2).alias("version")))


def header_role(c: Column) -> Column:
    out = F.when(has_any(c, HEADER_CUES["canonical"]), "canonical").when(has_any(c, HEADER_CUES["alias"]), "alias")
    out = out.when(has_any(c, HEADER_CUES["name_like"]) & ~has_any(c, HEADER_CUES["metadata"]), "name_like")
    return out.when(has_any(c, HEADER_CUES["type"]), "type").otherwise("other")


def ontology_type(c: Column) -> Column:
    """The one type whose cues occur; null if none or several do."""
    hits = F.array_compact(F.array(*[F.when(has_any(c, cues), F.lit(t)) for t, cues in ONTOLOGY_CUES.items()]))
    return F.when(F.size(hits) == 1, hits[0])


def business_codes(label: Column, evidence: Column) -> Column:
    """Codes that a label owns: in brackets in it, or after a code cue in the evidence; with a letter and a
    digit, no version, and standing alone in the evidence."""
    code = r"[A-Za-z0-9][A-Za-z0-9_-]*"
    inside = F.regexp_extract_all(label, F.lit(rf"[(（]\s*({code})\s*[)）]"), F.lit(1))
    cued = F.regexp_extract_all(evidence, F.lit(rf"(?i)(?:编号|代码|code|id|no\.)\s*[:：]?\s*({code})"), F.lit(1))
    owned = F.concat(inside, F.filter(cued, lambda x: F.contains(label, x)))
    alone = lambda x: F.regexp_like(evidence, F.concat(F.lit(r"(?<![A-Za-z0-9_-])\Q"), x, F.lit(r"\E(?![A-Za-z0-9_-])")))
    return F.array_sort(F.array_distinct(F.filter(owned, lambda x: x.rlike("[A-Za-z]") & x.rlike("[0-9]") & ~x.rlike(r"^[vV][0-9.]+$") & alone(x))))


def short_quote(c: Column, limit: int = 96) -> Column:
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(F.substr(t, F.lit(1), F.lit(limit - 1))), F.lit("…")))


def format_name(c: Column) -> Column:
    ext = F.lower(F.regexp_extract(c, r"([A-Za-z0-9]+)$", 1))
    return F.when(ext.isin("doc", "docx"), "word").when(ext.isin("xls", "xlsx"), "excel").when(ext.isin("ppt", "pptx"), "ppt").when(ext.isin("png", "jpg", "jpeg", "webp"), "image").otherwise(ext)


def column_letters(cell: Column) -> Column:
    return F.regexp_extract(cell, "([A-Z]+)", 1)


def iso_dates(c: Column) -> Column:
    """All dates with year and month, and a day if there is one, as ISO prefixes."""
    pattern = r"(?<![0-9])20[0-9]{2}[-/年](?:1[0-2]|0?[1-9])(?![0-9])(?:[-/月](?:3[01]|[12][0-9]|0?[1-9])(?![0-9]))?"
    part = lambda x, i: F.element_at(F.split(x, "[-/年月]"), i)
    two = lambda x: F.lpad(x, 2, "0")
    iso = lambda x: F.concat_ws("-", part(x, 1), two(part(x, 2)), F.when(F.size(F.split(x, "[-/年月]")) > 2, two(part(x, 3))))
    return F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), iso)


def markdown_rows(c: Column) -> Column:
    """The cells of every table row of a Markdown text, without rows of dashes, colons and blanks."""
    lines = F.filter(F.transform(F.split(c, "\n"), F.trim), lambda s: s.rlike(r"^\|.*\|$"))
    cells = F.transform(lines, lambda s: F.transform(F.split(F.regexp_replace(s, r"^\|+|\|+$", ""), r"\|"), lambda x: F.trim(F.regexp_replace(x, r"(?i)<br\s*/?>", " "))))
    return F.filter(cells, lambda row: ~F.forall(row, lambda x: x.rlike(r"^[:\-\s]*$")))


def render_row(cells: Column) -> Column:
    """A Markdown table row: pipes escaped, line ends as breaks."""
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda x: F.replace(F.replace(x, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))), " | "), F.lit(" |"))


def locator_text(locator: Column, keys: tuple[str, ...] = ("page", "section", "sheet", "row", "row_start", "row_end", "cell", "cells", "cell_range", "slide", "table", "shape_ids", "image")) -> Column:
    """``k=v; `` of the map's known keys that aren't empty, in order; without any the map as JSON."""
    known = F.concat_ws("; ", *[F.when(F.coalesce(locator[k], F.lit("")) != "", F.concat(F.lit(k + "="), locator[k])) for k in keys])
    return F.when(known != "", known).otherwise(F.to_json(locator))


def salience(value: Column, repeats: Column, exhaustive: bool) -> Column:
    signal = F.when(value.rlike(SALIENT_EXHAUSTIVE if exhaustive else SALIENT_RANKED), 1.6 if exhaustive else 0.4).otherwise(0.0)
    return F.least(F.length(value) / 40.0, F.lit(1.5)) + signal - F.greatest(F.lit(0), repeats - 1).cast("double")
