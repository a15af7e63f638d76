"""Benchmark decontamination: SimHash windows of the items' sizes, multi-index Hamming search, exact check.

Items and documents are runs of 5-word shingles. For every size that an item has, each window of that
many shingles in a document gets a 64-bit SimHash. A window whose fingerprint is within ``RADIUS`` of an
item's differs by at most ``RADIUS // BLOCKS`` bits in one of ``BLOCKS`` blocks. Per size and block the items
are sorted by their block's value, and a window looks up all values that near to its own, which finds all such
pairs. Those are verified exactly: the weighted Jaccard similarity, a shingle's weight being how often it
occurs, must be 0.8 or more. Windows of which too few shingles stand in items of their size to reach that
similarity aren't fingerprinted, so the cost follows the candidates.

Items are sent to the tasks in blocks of about ``ITEM_SHINGLES`` shingles; each block goes over all
documents, so any number of items works; of several, a block's result is written before the next begins.

Defined cases: an item of fewer than five words is one shingle of all its words, one without words
leaks nowhere; a document shorter than an item is one window; repeated items and rows are judged row by
row; of equally similar windows the first counts; a very long text is hashed as a whole, in memory of a few
times its size; null ids stay null; empty tables give no leak; other columns are ignored by ``leaks`` and
returned by ``drop_leaking``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from factloom.llm.common import boxed, cut, lean, shingle_hashes, small_batches, texts_of, unboxed, word_hashes, words_of

SHINGLE = 5
RADIUS = 15
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
ITEM_SHINGLES = 1_000_000
#: Windows that are looked up at once.
TOGETHER = 500

#: A byte's bits in eight byte-wide lanes.
LANES = np.array([sum((i >> k & 1) << 8 * k for k in range(8)) for i in range(256)], np.uint64)
NEAR = np.array([sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), n)], np.int64)


def fingerprints(h: np.ndarray, size: int) -> np.ndarray:
    """The SimHash of every window of ``size`` shingle hashes: a bit is set where more than half have it."""
    n = len(h) - size + 1
    if size > 255:  # lanes of a byte would overflow
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
        sums = np.cumsum(np.vstack([np.zeros((1, 64), np.int32), bits]), axis=0)
        return np.packbits(2 * (sums[size:] - sums[:-size]) > size, axis=1, bitorder="little").view(np.uint64)[:, 0]
    sums = np.zeros((len(h) + 1, 8), np.uint64)
    np.cumsum(LANES[h.view(np.uint8).reshape(-1, 8)], axis=0, out=sums[1:])
    counts = sums[size:] - sums[:-size]  # exact: the sums of a window fit their lanes
    over = np.uint64(0x0101010101010101 * (128 - (size // 2 + 1)))
    high = ((counts + over) >> np.uint64(7)) & np.uint64(0x0101010101010101)
    rows = (high * np.uint64(0x0102040810204080)) >> np.uint64(56)
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out |= rows[:, k] << np.uint64(8 * k)
    return out


def block_of(prints: np.ndarray, b: int) -> np.ndarray:
    return (prints >> np.uint64(b * BLOCK_BITS)).astype(np.int64) & ((1 << BLOCK_BITS) - 1)


class Items:
    """A block of items, indexed for the tasks; ``last`` tells that no other follows."""

    def __init__(self, rows: list[tuple[int, str]], last: bool):
        self.last = last
        self.ids, self.runs, groups = [], [], defaultdict(list)
        for item, text in rows:
            words = word_hashes(words_of(text))
            if len(words):
                run = shingle_hashes(words, SHINGLE)
                groups[min(SHINGLE, len(words)), len(run)].append(len(self.runs))
                self.ids.append(item)
                self.runs.append(run)
        #: (words of a shingle, size) -> items, their fingerprints, and per block their order and sorted values
        self.sizes = {}
        for key, own in groups.items():
            prints = np.array([fingerprints(self.runs[i], key[1])[0] for i in own], np.uint64)
            values = [block_of(prints, b) for b in range(BLOCKS)]
            orders = [np.argsort(v, kind="stable") for v in values]
            self.sizes[key] = (np.array(own), prints, [(o, v[o]) for o, v in zip(orders, values, strict=True)])
        #: words of a shingle -> the sizes, the items' shingles, and of each the sizes that have it
        self.shingles = {}
        for k in {s[0] for s in groups}:
            keys = [s for s in groups if s[0] == k]
            every = [np.unique(np.concatenate([self.runs[i] for i in groups[s]])) for s in keys]
            flat, which = np.concatenate(every), np.repeat(np.arange(len(keys)), [len(x) for x in every])
            order = np.lexsort((which, flat))
            known, first = np.unique(flat[order], return_index=True)
            self.shingles[k] = (keys, known, np.append(first, len(flat)), which[order])
        self.counts = [dict(zip(*(x.tolist() for x in np.unique(r, return_counts=True)), strict=True)) for r in self.runs]

    def near(self, key: tuple[int, int], found: np.ndarray) -> np.ndarray:
        """(window, item) of the fingerprints ``found`` and those of a size that agree in some block but for
        ``RADIUS // BLOCKS`` bits, each pair once."""
        pairs = []
        for b, (order, values) in enumerate(self.sizes[key][2]):
            look = block_of(found, b)[:, None] ^ NEAR[None, :]
            low, high = np.searchsorted(values, look, "left"), np.searchsorted(values, look, "right")
            hits = (high - low).ravel()
            at = np.repeat(low.ravel() - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
            pairs.append(np.stack([np.repeat(np.repeat(np.arange(len(found)), len(NEAR)), hits), order[at]], 1))
        return np.unique(np.concatenate(pairs), axis=0)

    def similarity(self, window: np.ndarray, item: int) -> float:
        own = self.counts[item]
        values, counts = np.unique(window, return_counts=True)
        both = sum(min(c, own.get(v, 0)) for v, c in zip(values.tolist(), counts.tolist(), strict=True))
        return both / (len(window) + len(self.runs[item]) - both)

    def leaks(self, text: str | None, least: float) -> Iterator[tuple]:
        """(item id, first word, words, similarity, distance) of the best window for each leaking item."""
        words = word_hashes(words_of(text))
        for k, (keys, known, first, which) in self.shingles.items():
            if len(words) < k:
                continue
            run = shingle_hashes(words, k)
            at = np.minimum(np.searchsorted(known, run), len(known) - 1)
            places = np.flatnonzero(known[at] == run)
            if not len(places):
                continue
            counts = first[at[places] + 1] - first[at[places]]
            group = which[np.repeat(first[at[places]] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
            places = np.repeat(places, counts)
            for g in np.unique(group).tolist():
                key = keys[g]
                own, prints, _ = self.sizes[key]
                size = min(key[1], len(run))
                enough = least * (size + key[1]) / (1 + least) - 1e-9
                mine = places[group == g]
                if len(mine) < enough:
                    continue
                inside = np.r_[0, np.cumsum(np.bincount(mine, minlength=len(run)))]
                may = np.flatnonzero(inside[size:] - inside[:-size] >= enough)
                if not len(may):
                    continue
                found = fingerprints(run[may[0] : may[-1] + size], size)[may - may[0]]
                best: dict[int, tuple] = {}
                for a in range(0, len(may), TOGETHER):
                    some = found[a : a + TOGETHER]
                    pairs = self.near(key, some)
                    apart = np.bitwise_count(some[pairs[:, 0]] ^ prints[pairs[:, 1]])
                    for (i, j), d in zip(pairs[apart <= RADIUS].tolist(), apart[apart <= RADIUS].tolist(), strict=True):
                        s = int(may[a + i])
                        similar = self.similarity(run[s : s + size], own[j])
                        if similar >= least and (j not in best or (-similar, s) < best[j][:2]):
                            best[j] = (-similar, s, d)
                for j, (similar, s, d) in best.items():
                    yield self.ids[own[j]], s, size + k - 1, -similar, d


def item_blocks(bench: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, in a fixed order."""
    small_batches(bench.sparkSession)
    rows: list[tuple[int, str]] = []
    size = 0
    for r in bench.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += len(words_of(r["text"]))
        if size >= ITEM_SHINGLES:
            yield Items(rows, False)
            rows, size = [], 0
    if rows:
        yield Items(rows, True)


def leaks(docs: DataFrame, bench: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity, distance: a row for each document and item that
    it holds, with the most similar window (the first of equals)."""
    spark = docs.sparkSession
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((docs, "doc_id"), (bench, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start_word int, n_words int, similarity double, distance int"
    item_type = to_arrow_type(bench.schema["item_id"].dataType)
    out = spark.createDataFrame([], schema)
    for block in item_blocks(bench):
        shared = spark.sparkContext.broadcast(block)

        def run(found: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in found:
                rows = [(i, *x) for i, t in enumerate(texts_of(b)) for x in shared.value.leaks(t, least)]
                if rows:
                    who, item, start, n, similar, apart = map(list, zip(*rows, strict=True))
                    arrays = [b.column(0).take(pa.array(who)), pa.array(item, item_type), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(similar), pa.array(apart, pa.int32())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "start_word", "n_words", "similarity", "distance"])

        part = docs.select("doc_id", "text").mapInArrow(lean(run), schema)
        if not block.last:
            part = cut(part, "leaks")
            shared.destroy()
        out = out.unionByName(part)
    return out


def drop_leaking(docs: DataFrame, bench: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged."""
    rows = boxed(docs, "text")
    for block in item_blocks(bench):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(found: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in found:
                clean = [next(shared.value.leaks(t, least), None) is None for t in texts_of(b)]
                yield b.filter(pa.array(clean, pa.bool_()))

        rows = rows.mapInArrow(lean(run), rows.schema)
        if not block.last:
            rows = cut(rows, "clean")
            shared.destroy()
    return unboxed(rows, docs)
