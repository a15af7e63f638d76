"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades come from the labels: 0 not toxic, 1 toxic, 2 toxic and of low quality. One weight per feature is
shared by all thresholds: P(grade > k) = sigmoid(score - threshold k). The expected severity is the sum
of these over k. Features are a text's distinct words, how the longer ones begin, its runs of one symbol,
and in tenths its shares of symbols, of repeated words and of words equal to the one before.

The model is fitted from a bounded sample of labelled rows, the ``TRAIN_ROWS`` ids of the lowest hash (of
an id's rows the text of the lowest hash). Spark counts the sample's features by grade; those whose odds
differ at some threshold by ``LEAST_Z`` standard errors, to either side, get a weight, and the driver
receives no others. Every document is scored on its whole text.

Defined cases: a null or empty text has no features; rows without an id or a label aren't fitted on, of
several labels of an id the highest grade counts; without two grades in the labels all severities are 0;
repeated rows are scored row by row, and equal texts tie; a very long text is scored as a whole, in memory
of a few times its size; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import cut, lean, small_batches, texts_of

TRAIN_ROWS = 20_000
#: Labelled documents that a feature needs to be weighed.
LEAST_DOCS = 5
#: Standard errors by which a feature's log odds must differ.
LEAST_Z = 3.5
GRADES = 3

#: ASCII characters that aren't letters or digits part words.
PARTING = bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))
#: Bytes of a longer word's beginning that count as a feature too: forms of a word share it.
STEMS = (5, 7)
RUNS = re.compile(rb"([!-/:-@\[-`{-~])\1\1+")
SYMBOLS = bytes(set(range(33, 127)) - {i for i in range(128) if chr(i).isalnum()} - set(b".,;:!?'\"()-"))


def features(text: str | None) -> set[bytes]:
    """The distinct words, beginnings (marked by a blank) and the marks of a text's shape (led by one)."""
    raw = text.lower().encode() if text else b""
    parts = raw.translate(PARTING).split()
    words = set(parts)
    out = set(words)
    for n in STEMS:
        out |= {w[:n] + b" " for w in words if len(w) > n}
    if parts:
        n = len(parts)
        shares = {
            b"symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
            b"repeated": n - len(words),
            b"echoes": sum(map(bytes.__eq__, parts, parts[1:])),
        }
        out |= {b" %s %d" % (name, min(9, 10 * k // n)) for name, k in shares.items()}
        out |= {b" run " + m for m in set(RUNS.findall(raw))}
    return out


def hashes(text: str | None) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in features(text)]


def sample_of(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """grade and the feature hashes (words) of at most ``rows`` labelled documents."""
    graded = labels.filter("doc_id is not null and toxic is not null and quality is not null")
    grade = F.when(F.col("toxic") <= 0, 0).when(F.col("quality") > 0, 1).otherwise(2).cast("int")
    graded = graded.groupBy("doc_id").agg(F.max(grade).alias("grade"))
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            words = [hashes(t) for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.int64()))], names=["grade", "words"])

    ours = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids
    ours = ours.groupBy("doc_id").agg(F.max("grade").alias("grade"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return cut(ours.select("grade", "text").mapInArrow(lean(run), "grade int, words array<long>"), "graded")


def select_words(sample: DataFrame, grades: int) -> np.ndarray:
    """The features whose odds differ at some threshold, sorted."""
    above = [F.count_if(F.col("grade") > k) for k in range(grades - 1)]
    total, *over = sample.agg(F.count("*"), *above).first()
    counts = sample.select("grade", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), *[x.alias(f"n{k}") for k, x in enumerate(above)])
    tells = F.lit(False)
    for k, pos in enumerate(over):
        hit, miss = F.col(f"n{k}") + 0.5, F.col("n") - F.col(f"n{k}") + 0.5
        z = (F.log(hit / (pos + 1)) - F.log(miss / (total - pos + 1))) / F.sqrt(1 / hit + 1 / miss)
        tells = tells | (F.abs(z) >= LEAST_Z)
    found = counts.filter((F.col("n") >= LEAST_DOCS) & tells).select("word").toArrow()
    return np.sort(found.column(0).to_numpy())


def held_words(sample: DataFrame, words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each sampled document the places of its features in ``words``, and the grades."""
    shared = sample.sparkSession.sparkContext.broadcast(words)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(shared.value.tolist())}
        for b in found:
            places = [sorted(known[w] for w in ws if w in known) for ws in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(places, pa.list_(pa.int32()))], names=["grade", "places"])

    found = sample.mapInArrow(lean(run), "grade int, places array<int>").toArrow().combine_chunks()
    if not found.num_rows:
        return [], np.zeros(0, int)
    places = found.column(1).combine_chunks()
    flat, ends = places.values.to_numpy(), places.offsets.to_numpy()
    return [flat[a:z] for a, z in zip(ends, ends[1:], strict=False)], found.column(0).to_numpy()


def fit(rows: list[np.ndarray], grade: np.ndarray, size: int, grades: int = GRADES, rounds: int = 400, rate: float = 0.1, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray] | None:
    """(weights, thresholds) of the largest penalised likelihood, by Adam; none without two grades or
    features. rows: the places of each document's features, below ``size``."""
    if len(np.unique(grade > 0)) < 2 or not size:
        return None
    order = np.lexsort((grade, [len(r) for r in rows]))  # one order, however the rows came
    rows, grade = [rows[i] for i in order], grade[order]
    at, who, n = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows)
    share = np.array([(grade > k).mean() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    first, gaps = -np.log(share[0] / (1 - share[0])), np.zeros(grades - 2)
    params = np.concatenate([np.zeros(size), [first], gaps])  # gaps: logs of the threshold differences
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, theta = params[:size], np.cumsum(np.concatenate([params[size : size + 1], np.exp(params[size + 1 :])]))
        score = np.bincount(who, w[at], n)
        above = 1 / (1 + np.exp(-(score[:, None] - theta[None, :]).clip(-30, 30)))
        edge = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
        p = np.maximum(edge[np.arange(n), grade] - edge[np.arange(n), grade + 1], 1e-9)
        slope = np.concatenate([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))], 1)
        up, down = slope[np.arange(n), grade] / p, slope[np.arange(n), grade + 1] / p
        gscore = (up - down) / n
        gtheta = np.zeros(grades + 1)
        np.add.at(gtheta, grade, -up / n)
        np.add.at(gtheta, grade + 1, down / n)
        gtheta = gtheta[1:grades]
        tail = np.cumsum(gtheta[::-1])[::-1]  # a gap moves all thresholds from its own on
        g = np.concatenate([np.bincount(at, gscore[who], size) - penalty / n * w, tail[:1], tail[1:] * np.exp(params[size + 1 :])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return params[:size], np.cumsum(np.concatenate([params[size : size + 1], np.exp(params[size + 1 :])]))


def severity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, severity (expected grade), grade (thresholds that are more likely passed than not) and
    toxic (grade of 1 or more), a row for each row of ``docs``."""
    small_batches(docs.sparkSession)
    sample = sample_of(docs, labels, train_rows)
    words = select_words(sample, GRADES)
    model = fit(*held_words(sample, words), len(words))
    known = dict(zip(words.tolist(), model[0].tolist(), strict=True)) if model else {}
    theta = model[1] if model else np.full(GRADES - 1, np.inf)
    shared = docs.sparkSession.sparkContext.broadcast((known, theta))  # features of the sample that tell grades apart
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, theta = shared.value
        seen: dict[bytes, float] = {}
        for b in found:
            scores = []
            for t in texts_of(b):
                words = features(t)
                for w in words.difference(seen):
                    seen[w] = weights.get(xxhash.xxh3_64_intdigest(w) - (1 << 63), 0.0)
                scores.append(sum(sorted(filter(None, map(seen.__getitem__, words)))))
                if len(seen) > 500_000:
                    seen = {}
            above = np.isfinite(theta) / (1 + np.exp(-(np.array(scores)[:, None] - theta[None, :]).clip(-700, 700)))
            grade = (above > 0.5).sum(1)
            arrays = [b.column(0), pa.array(above.sum(1)), pa.array(grade, pa.int32()), pa.array(grade > 0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "severity", "grade", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, severity double, grade int, toxic boolean")
