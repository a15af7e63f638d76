"""Quality rules: a threshold table compiled into one projection, without user functions.

Every rule bounds a ratio of counts that one ``select`` computes from the text; the table is a
parameter. A document is kept when no base rule fails and every ratio lies within its bounds.

Defined cases: a null or empty text has no words, all counts 0, and fails the base rule; null ids and
repeated rows are judged row by row, and a ratio that equals its bound passes; a very long text is counted
as a whole, in arrays of a few times its size; an empty table gives an empty table; other columns are
ignored by ``quality_report`` and returned unchanged by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import SPACES, boxed, unboxed


@dataclass(frozen=True)
class Rule:
    """``top / bottom`` must lie between ``least`` and ``most``; ``slack`` more of the top count for the
    least, so that short texts don't fail by chance. A bottom of 0 passes."""

    name: str
    top: str
    bottom: str
    least: float | None = None
    most: float | None = None
    slack: int = 0


#: The most frequent function words of the languages in the corpus.
STOP_WORDS = {
    "en": "the of and to in is that it with for a as on are this be by from",
    "fr": "de la le et les des en un une du que est pour qui par dans sur",
    "de": "der die und in den von zu das mit sich des ist im dem ein eine",
    "es": "de la que el en y los del se las por un para con una su al",
}

RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.04, None, slack=1),
    Rule("capital_ratio", "n_capitals", "n_words", None, 2.0),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("echo_ratio", "n_echoes", "n_words", None, 0.2),
)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, k: int = 5) -> Column:
    """How many words lie in a window of ``k`` that the text holds twice or more. Windows meet by
    sorting, so the cost is n log n however often they repeat."""
    n = F.size(words)

    def covered(at: Column) -> Column:
        nexts = F.slice(at, F.lit(2), F.size(at))
        gaps = F.zip_with(at, nexts, lambda a, b: F.least(F.coalesce(b - a, F.lit(k)), F.lit(k)))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def positions(pairs: Column) -> Column:
        """Of the pairs (hash, position), sorted: those whose neighbour has the same hash."""
        same = lambda i, j: F.coalesce(F.get(pairs, i)["h"] == F.get(pairs, j)["h"], F.lit(False))
        flagged = F.transform(pairs, lambda p, i: F.when(same(i, i - 1) | same(i, i + 1), p["i"]))
        return F.array_sort(F.filter(flagged, lambda x: x.isNotNull()))

    def slow(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(let(pairs, positions), covered)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(slow(hashes))

    starts = F.sequence(F.lit(0), n - k)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.when(n < k, F.lit(0)).otherwise(let(hashes, count))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_quality`` of all counts that rules may use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda c, chars: F.translate(c, chars, "")
    stop = sorted({w for line in STOP_WORDS.values() for w in line.split()})

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
            F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("long").alias("n_echoes"),
        )

    def lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    spoken = F.filter(F.split(text, "\n"), lambda s: without(s, SPACES) != "")
    w, s = let(words, counts), let(spoken, lines)
    return (
        docs.withColumn("_w", w)
        .withColumn("_s", s)
        .withColumn(
            "_quality",
            F.struct(
                F.col("_w.n_words"),
                F.length(without(text, SPACES)).cast("long").alias("word_chars"),
                (F.length(text) - F.length(without(text, "#*$%&|<>"))).cast("long").alias("n_symbols"),
                F.regexp_count(text, F.lit("[A-ZÀ-ÖØ-Þ]")).cast("long").alias("n_capitals"),
                F.col("_s.n_dup_lines"),
                F.col("_w.n_repeat_words"),
                F.col("_w.n_stop_words"),
                F.col("_w.n_echoes"),
                F.col("_s.n_lines"),
            ),
        )
        .drop("_w", "_s")
    )


def passes(rules: tuple[Rule, ...] = RULES, at: str = "_quality") -> Column:
    """The threshold table as one boolean expression."""
    out = F.lit(True)
    for r in rules:
        top, bottom = F.col(f"{at}.{r.top}"), F.col(f"{at}.{r.bottom}")
        if r.least is not None:
            out = out & (top + r.slack >= r.least * bottom)
        if r.most is not None:
            out = out & (top <= r.most * bottom)
    return out


def base_failed(at: str = "_quality") -> Column:
    n, repeated = F.col(f"{at}.n_words"), F.col(f"{at}.n_repeat_words")
    return (n < 10) | (100 * repeated > 20 * n)


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts, base_failed and kept, a row for each row of ``docs``."""
    return measured(docs.select("doc_id", "text")).select(
        "doc_id",
        *[f"_quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_capitals", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_echoes", "n_lines")],
        base_failed().alias("base_failed"),
        (~base_failed() & passes(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""
    return unboxed(measured(boxed(docs, "text")).filter(~base_failed() & passes(rules)), docs)
