"""Token counts: each distinct pre-token is counted once, and documents add up what theirs have.

1. Every task counts its pre-tokens; merged, they are the table of distinct pre-tokens with their
   frequency, and the tokenizer counts the pieces of each once.
2. The most frequent pre-tokens (at most ``HEAD``, whatever the input) go to every task: a hot one
   joins where its documents are and is never shuffled.
3. Each document adds up its frequent pre-tokens at once; its others, with their frequency in it, join
   the table by a shuffle, and their sum returns to the document. No ids are made.

Defined cases: a null or empty text has 0 bytes and tokens; null ids stay null, repeated rows are
counted row by row; texts that tie in all counts stay rows of their own; a very long text is split as a
whole, in memory of a few times its size; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import cut, lean, small_batches, texts_of
from factloom.llm.tokens import encoder

#: Frequent pre-tokens that every task holds: about 100 bytes each.
HEAD = 400_000
#: Distinct pre-tokens that a task gathers before it passes them on.
GATHER = 1_500_000
#: The split that byte-level BPE files of this kind build in (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters alone are split by the pattern; on some others its letters and numbers differ
#: from the library's, which then splits the text itself. A test compares both on every one of these.
SAFE = regex.compile("[\0-\u0557\u058d-\u088e\u0890-\u0c5b\u0cdd-\u208e\u20a0-\ua7cd\ua7f2-\uab6b\uab6e-\ud7ff\ue000-\uffff\U0001f000-\U0001faff]*")
OVER = 512


class Splitter:
    """Pre-tokens of a text: special strings are one each, what stands between them is split by the pattern
    or, beyond ``SAFE``, by the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        kind = told["pre_tokenizer"] or {}
        if told["normalizer"] or kind.get("type") != "ByteLevel" or not kind.get("use_regex") or kind.get("add_prefix_space"):
            raise ValueError("a byte-level tokenizer file with its built-in split is needed")
        names = [a["content"] for a in told["added_tokens"]]
        self.first = names[0][0] if len(names) == 1 else ""
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.names, self.fast, self.safe = names, regex.compile(PATTERN).findall, SAFE.fullmatch
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def find(self, text: str) -> list[str]:
        if text.isascii() or self.safe(text):
            return self.fast(text)
        return [text[a:z] for _, (a, z) in self.cut(text)]

    def __call__(self, text: str) -> list[str]:
        if not any(n in text for n in self.names):
            return self.find(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self.find(part)
        return out


def distinct_pretokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """pretoken, n (its frequency in all texts)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Splitter(tokenizer), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pretoken", "n"])

        for b in found:
            for t in texts_of(b):
                if t:
                    seen.update(split(t))
            if len(seen) > GATHER:
                yield told()
                seen.clear()
        if seen:
            yield told()

    rows = docs.select("text").mapInArrow(lean(run), "pretoken string, n long")
    return rows.groupBy("pretoken").agg(F.sum("n").alias("n"))


def counted_pieces(pretokens: DataFrame, tokenizer: str) -> DataFrame:
    """pretoken, n, pieces: the tokenizer sees each row's pre-token once."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in found:
            pieces = [len(x) // 4 for x in enc.plain(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pieces, pa.int32())], names=["pretoken", "n", "pieces"])

    return pretokens.select("pretoken", "n").mapInArrow(lean(run), "pretoken string, n long, pieces int")


def head_of(pieces: DataFrame, most: int) -> tuple[dict[str, int], float]:
    """The most frequent pre-tokens, ``most`` at most, and the frequency from which all are among them."""
    step = F.floor(F.log2("n") * 16).cast("int")  # at most 1024 values
    by_step = sorted(((r["step"], r["count"]) for r in pieces.groupBy(step.alias("step")).count().collect()), reverse=True)
    total, least = 0, None
    for s, n in by_step:
        if total + n > most:
            break
        total, least = total + n, s
    if least is None:
        return {}, float("inf")
    found = pieces.filter(step >= least).select("pretoken", "pieces").toArrow()
    return dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True)), least


def count_tokens(docs: DataFrame, tokenizer: str, head: int = HEAD, over: int = OVER) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``over``), a row for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = cut(counted_pieces(distinct_pretokens(docs, tokenizer), tokenizer), "pieces")
    known, least = head_of(pieces, head)
    shared = spark.sparkContext.broadcast(known)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, get = Splitter(tokenizer), shared.value.get
        for b in found:
            sums, tails, sizes = [], [], []
            for t in texts_of(b):
                n, tail = 0, []
                for w, c in Counter(split(t)).items() if t else ():
                    p = get(w)
                    if p is None:
                        tail.append({"pretoken": w, "c": c})
                    else:
                        n += p * c
                sums.append(n)
                tails.append(tail)
                sizes.append(len(t.encode()) if t else 0)
            kinds = pa.list_(pa.struct([("pretoken", pa.string()), ("c", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(tails, kinds)], names=["doc_id", "n_bytes", "n", "tail"])

    rows = docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n_bytes long, n long, tail array<struct<pretoken:string,c:int>>")
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "token-tails")
    step = F.floor(F.log2("n") * 16).cast("int")
    rare = pieces.filter(step < least).select("pretoken", "pieces") if least != float("inf") else pieces.select("pretoken", "pieces")
    tails = rows.select("row", F.explode("tail").alias("t")).select("row", "t.pretoken", "t.c")
    sums = tails.join(rare, "pretoken").groupBy("row").agg(F.sum(F.col("c") * F.col("pieces")).alias("more"))
    n = (F.col("n") + F.coalesce(F.col("more"), F.lit(0))).cast("long")
    return rows.select("row", "doc_id", "n_bytes", "n").join(sums, "row", "left").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > over).alias("over_limit"))
