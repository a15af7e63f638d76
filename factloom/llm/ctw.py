"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions. Each decision (the bits before it in its byte) has a context tree over
the ``DEPTH`` bytes before; every node holds a Krichevsky-Trofimov estimate of the bits seen there, and
weights it half against its children's product, so all depths are mixed by how well they code the
training texts. The probability of a byte after a context depends on those ``DEPTH`` + 1 bytes alone:

1. Tasks count the (DEPTH + 1)-grams of all texts; summed, they are the gram table, which holds every one.
2. Dealt by the ``TOP`` nearest context bytes, tasks weigh the nodes from ``TOP`` bytes down; the driver weighs
   the few above them, which have at most ``TOP`` - 1 bytes, and tasks mix both into the score of every gram.
3. Tasks add up the logarithms of each text: the ``GRAMS`` most frequent grams are held, the rest joined.

Texts are lower-cased (A-Z), preceded by ``DEPTH`` zero bytes and closed by one. ``base_score`` is the
smoothed word unigram; its word counts join per-document frequencies, the most frequent ones at once.

Defined cases: a null or empty text is its end alone; a null id counts as empty for the split; repeated
rows count and are scored row by row, equal texts alike; a very long text is one piece of about 8 bytes a
byte and a few copies of that; without training texts all bytes have probability 1/256; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import MAPPED_MOST, cut, lean, small_batches, texts_of

DEPTH = 5
#: Frequent grams that every task holds, 32 bytes each; the others are joined.
GRAMS = 2_000_000
#: Nearest context bytes by which the gram table is dealt.
TOP = 2
#: Frequent words that every task holds.
HEAD = 300_000
#: Words that a task gathers before it passes them on.
GATHER = 500_000
#: Bytes that are scored at once.
CHUNK = 2_000_000
SYMBOL = 9  # bits of a context symbol


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


# ---------------------------------------------------------------- words


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over the training texts; the row without a word counts their ends."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, ends = Counter(), 0

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

        for b in found:
            for i, t in zip(b.column(0).to_pylist(), texts_of(b), strict=True):
                if not held_out(i):
                    seen.update((t or "").encode().lower().split())
                    ends += 1
            if len(seen) > GATHER:
                yield told()
                seen.clear()
        if ends:
            yield told()
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([ends], pa.int64())], names=["word", "c"])

    rows = docs.select("doc_id", "text").mapInArrow(lean(run, MAPPED_MOST), "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def step_of(column: str):
    return F.floor(F.log2(column) * 16).cast("int")  # at most 1024 values


def least_step(df: DataFrame, column: str, most: int) -> int:
    """The lowest step of a count from which at most ``most`` rows are left."""
    total, least = 0, 1 << 20
    for r in df.groupBy(step_of(column).alias("s")).count().orderBy(F.desc("s")).collect():
        if total + r["count"] > most:
            break
        total, least = total + r["count"], r["s"]
    return least


# ---------------------------------------------------------------- grams


def gram_keys(texts: list[str | None], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all positions of all texts, nearest context byte first, and where each text starts."""
    pad = b"\0" * depth
    raw = [(t or "").encode().lower() + b"\0" for t in texts]
    flat = np.frombuffer(pad + pad.join(raw), np.uint8)
    n = len(flat) - depth
    key = np.zeros(n, np.int64)
    for back in range(1, depth + 1):
        key <<= SYMBOL
        key |= flat[depth - back : depth - back + n]
    key <<= 8
    key |= flat[depth:]
    lengths = np.array([len(r) for r in raw])
    ends = np.cumsum(lengths + depth) - depth
    keep = np.ones(n, bool)
    keep[(ends[:-1, None] + np.arange(depth)[None, :]).ravel()] = False  # the zeros between texts
    return key[keep], np.cumsum(lengths) - lengths


def groups_of(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def gram_counts(docs: DataFrame, depth: int) -> DataFrame:
    """gram, n, m: how often training texts and all texts have it."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []  # sorted grams and their counts, merged when they are many
        for b in found:
            texts, out = texts_of(b), [held_out(i) for i in b.column(0).to_pylist()]
            for a, z in groups_of(texts, CHUNK):
                key, starts = gram_keys(texts[a:z], depth)
                lengths = np.diff(np.append(starts, len(key)))
                train = np.repeat(~np.array(out[a:z], bool), lengths)
                grams, at = np.unique(key, return_inverse=True)
                parts.append((grams, np.bincount(at, train, len(grams)).astype(np.int64), np.bincount(at, minlength=len(grams))))
                if sum(len(x[0]) for x in parts) > 4 * GATHER:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > 2 * GATHER:
                        yield told(*parts.pop())
        if parts:
            yield told(*merged(parts))

    def told(grams: np.ndarray, n: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n), pa.array(m)], names=["gram", "n", "m"])

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        keys, n, m = map(np.concatenate, zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")  # runs that are sorted already
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[first], np.add.reduceat(n[order], first), np.add.reduceat(m[order], first)

    rows = docs.select("doc_id", "text").mapInArrow(lean(run, MAPPED_MOST), "gram long, n long, m long")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


# ---------------------------------------------------------------- the weighted tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps up."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1.0)


def weighted_bits(grams: np.ndarray, n: np.ndarray, depth: int, top: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each bit of the last byte: an order of the grams and, in it, their nodes of ``top`` bytes (led by a
    one and the bits before), whether the bit is one, and its probability by those nodes' trees; then the
    nodes' first places, zeros, ones and log weights. All grams of such a node must be there."""
    context, byte = grams >> 8, grams & 255
    for bit in range(8):
        prefix = 1 << bit | byte >> 8 - bit  # the bits of the byte before this one
        order = np.argsort(prefix << SYMBOL * depth | context, kind="stable")
        count, one = n[order].astype(float), (byte[order] >> 7 - bit & 1).astype(bool)
        path = (prefix << SYMBOL * depth | context)[order]
        chance = None
        below: tuple[np.ndarray, np.ndarray] | None = None  # the deeper nodes: first rows, log weights
        for d in range(depth, top - 1, -1):
            node = path >> SYMBOL * (depth - d)
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            ones = np.add.reduceat(np.where(one, count, 0.0), first)
            zeros = np.add.reduceat(np.where(one, 0.0, count), first)
            own = log_kt(zeros, ones)
            sizes = np.diff(np.append(first, len(path)))
            kt = np.where(one, np.repeat((ones + 0.5) / (zeros + ones + 1), sizes), np.repeat((zeros + 0.5) / (zeros + ones + 1), sizes))
            if below is None:
                chance, weight = kt, own
            else:
                children = np.add.reduceat(below[1], np.searchsorted(below[0], first))
                share = np.repeat(own_share(own, children), sizes)
                chance = share * kt + (1 - share) * chance
                weight = np.logaddexp(own, children) - math.log(2)
            below = (first, weight)
        yield order, node, one, chance, first, zeros, ones, weight


def own_share(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(children - own, -700, 700)))


def weighted_log10(grams: np.ndarray, n: np.ndarray, depth: int, top: int = 0, above: list[tuple[np.ndarray, np.ndarray]] = ()) -> np.ndarray:
    """The log10 probability that the weighted tree gives to each gram's last byte after its context;
    ``above`` has the shares and probabilities of a one of the nodes of 0 to ``top`` - 1 bytes."""
    out = np.zeros(len(grams))
    for order, node, one, chance, *_ in weighted_bits(grams, n, depth, top):
        for d in range(top - 1, -1, -1):
            share, ones = (x[node >> SYMBOL * (top - d)] for x in above[d])
            chance = share * np.where(one, ones, 1 - ones) + (1 - share) * chance
        out[order] += np.log10(chance)
    return out


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """gram, m, score: the log10 probability of its last byte after its context."""
    spark, top = grams.sparkSession, min(TOP, depth)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-grams.count() // GATHER))
    dealt = grams.repartition(parts, F.shiftright("gram", 8 + SYMBOL * (depth - top)))

    def whole(found: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
        rows = pa.Table.from_batches(found) if (found := list(found)) else pa.table({c: pa.array([], pa.int64()) for c in "gnm"})
        return [c.to_numpy() for c in rows.columns]

    def parents(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, _ = whole(found)
        if len(keys):
            for _, node, _, _, first, *sums in weighted_bits(keys, n, depth, top):
                up, at = np.unique(node[first] >> SYMBOL, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(up), *(pa.array(np.bincount(at, x, len(up))) for x in sums)], names=["node", "zeros", "ones", "children"])

    above: list[tuple[np.ndarray, np.ndarray]] = []
    if top:
        sums = dealt.mapInArrow(lean(parents, MAPPED_MOST), "node long, zeros double, ones double, children double").groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("children"))
        node, zeros, ones, children = (c.to_numpy() for c in sums.toArrow().columns)  # at most 255 x 256 ** (top - 1)
        for d in range(top - 1, -1, -1):
            own = log_kt(zeros, ones)
            level = np.zeros((2, 256 << SYMBOL * d))
            level[:, node] = own_share(own, children), (ones + 0.5) / (zeros + ones + 1)
            above.insert(0, (level[0], level[1]))
            weight = np.logaddexp(own, children) - math.log(2)
            node, at = np.unique(node >> SYMBOL, return_inverse=True)
            zeros, ones, children = (np.bincount(at, x, len(node)) for x in (zeros, ones, weight))
    shared = spark.sparkContext.broadcast(above)

    def scores(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, m = whole(found)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(m), pa.array(weighted_log10(keys, n, depth, top, shared.value))], names=["gram", "m", "score"])

    return dealt.mapInArrow(lean(scores, MAPPED_MOST), "gram long, m long, score double")


class Table:
    """Grams and their scores in an open hash table of numpy arrays."""

    def __init__(self, grams: np.ndarray, scores: np.ndarray):
        self.grams, self.scores = grams, scores
        self.bits = max(10, int(len(grams) * 2 - 1).bit_length())
        self.slots = None

    def build(self) -> None:
        slots = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(self.grams), dtype=np.int32), self.home(self.grams)
        while len(left):
            free = slots[at] < 0
            slots[at[free]] = left[free]  # of several the last stays
            lost = slots[at] != left
            left, at = left[lost], (at[lost] + 1) & ((1 << self.bits) - 1)
        self.slots = slots

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that aren't there."""
        if self.slots is None:
            self.build()
        at = self.home(keys)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & (self.grams[found] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = self.slots[at[open_]]
            open_ = open_[(found[open_] >= 0) & (self.grams[found[open_]] != keys[open_])]
        return found

    def score(self, keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
        """For texts that start there: the sum of the scores, and the grams that the table lacks, counted."""
        if not len(self.grams):
            found = np.full(len(keys), -1)
        else:
            found = self.find(keys)
        sums = np.add.reduceat(np.append(self.scores, 0.0)[found], starts)  # -1 is the zero at the end
        lost = np.flatnonzero(found < 0)
        text = np.searchsorted(starts, lost, "right") - 1
        order = np.lexsort((keys[lost], text))
        text, gram = text[order], keys[lost][order]
        first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])][: len(gram)])
        pairs = pa.StructArray.from_arrays([pa.array(gram[first]), pa.array(np.diff(np.append(first, len(gram))))], names=["gram", "k"])
        ends = np.searchsorted(text[first], np.arange(len(starts) + 1))
        return sums, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def score_texts(docs: DataFrame, depth: int = DEPTH, most: int = GRAMS, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte (the
    code length over n_bytes, the end included), a row for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    words = cut(word_counts(docs), "word-counts")
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = (words.filter("word is null").first() or {"c": 0})["c"]
    words = words.filter("word is not null")
    least = least_step(words, "c", head)
    found = words.filter(step_of("c") >= least).toArrow()
    known = dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True))
    bottom = total + 0.1 * (distinct + 1)
    grams = cut(gram_scores(cut(gram_counts(docs, depth), "grams"), depth), "gram-scores")
    least_gram = least_step(grams, "m", most)
    found = grams.filter(step_of("m") >= least_gram).toArrow()
    table = Table(found.column(0).to_numpy(), found.column(2).to_numpy())
    del found
    shared = spark.sparkContext.broadcast((known, table))  # at most head words and most grams

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value
        logs = {c: math.log10((c + 0.1) / bottom) for c in set(known.values()) | {ends}}
        for big in found:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                texts = texts_of(b)
                base, seen, words_, times, ends_, counts, sizes = [], [], [], [], [0], [], []
                for t in texts:
                    raw = (t or "").encode()
                    parts = raw.lower().split()
                    score, hits = logs[ends], int(ends > 0)
                    for w, k in Counter(parts).items():
                        c = known.get(w)
                        if c is None:
                            words_.append(w)
                            times.append(k)
                        else:
                            score += k * logs[c]
                            hits += k
                    base.append(score)
                    seen.append(hits)
                    ends_.append(len(words_))
                    counts.append(len(parts) + 1)
                    sizes.append(len(raw) + 1)
                scored = [table.score(*gram_keys(texts[a:z], depth)) for a, z in groups_of(texts, CHUNK)]
                scores, lost = np.concatenate([x for x, _ in scored]), pa.concat_arrays([x for _, x in scored])
                out = [held_out(i) for i in b.column(0).to_pylist()]
                pairs = pa.StructArray.from_arrays([pa.array(words_, pa.binary()), pa.array(times, pa.int32())], names=["word", "k"])
                tails = pa.ListArray.from_arrays(pa.array(ends_, pa.int32()), pairs)
                arrays = [b.column(0), pa.array(out, pa.bool_()), pa.array(counts, pa.int64()), pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(scores), pa.array(sizes, pa.int64()), tails, lost]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes", "tail", "lost"])

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long, tail array<struct<word:binary,k:int>>, lost array<struct<gram:long,k:long>>"
    rows = cut(docs.select("doc_id", "text").mapInArrow(lean(run, MAPPED_MOST), schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = words.filter(step_of("c") < least)
    c = F.coalesce(F.col("c"), F.lit(0))
    tails = rows.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.k").join(rare, "word", "left")
    sums = tails.groupBy("row").agg(F.sum(F.col("k") * F.log10((c + 0.1) / F.lit(bottom))).alias("more"), F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("hits"))
    lost = rows.select("row", F.explode("lost").alias("l")).select("row", "l.gram", "l.k").join(grams.filter(step_of("m") < least_gram), "gram")
    rest = lost.groupBy("row").agg(F.sum(F.col("k") * F.col("score")).alias("rest"))
    rows = rows.drop("tail", "lost").join(rest, "row", "left").withColumn("score", F.col("score") + F.coalesce("rest", F.lit(0.0)))
    return rows.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("hits", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
        "n_bytes",
        (F.col("score") / (-math.log10(2) * F.col("n_bytes"))).alias("bits_per_byte"),
    )
