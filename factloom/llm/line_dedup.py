"""Line dedup by a segment-partition edit join.

Two lines are copies when they are equal, or when both have at least ``SHORTEST`` characters and their
edit distance is at most ``TAU``. Classes are the connected components of that relation; the first line
of a class, by document id and place, stays.

1. A line of length L is split into TAU + 1 even segments. One edit touches one segment, so a line
   within TAU edits holds one of them unchanged, at a place that the lengths bound: each line probes the
   segments of lengths L - TAU to L at those places only. Keys are hashes of (length, segment, text).
2. Lines that meet under a key are in one region; regions are closed under meeting, so no copy is
   outside. Only stars are made of a key's lines, never all pairs.
3. Each region is joined in memory with the same segments, and pairs that aren't connected yet are
   verified by banded bit-parallel edit distance. Regions over ``LEAF`` characters are dealt out in
   blocks whose pairs join apart, which loses no pair.

Defined cases: lines without a word are neither compared nor dropped; a null or empty text has none; a very
long line is compared as a whole, its probes are some twenty however long it is;
rows that repeat both id and text are one document and get the same result; rows without an id come
last when the first of a class is chosen; an empty table gives an empty table; other columns, whatever
their names, are ignored by ``line_classes`` and returned by ``dedup_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import bitmap_of, boxed, cut, lean, may_hold, small_batches, texts_of, unboxed
from factloom.llm.components import Forest, connected_components

TAU = 2
SHORTEST = 30
#: Names of lines that a task remembers, about 100 bytes each; it may pass a line on again after that.
KEEP = 300_000
#: Characters of a region that one task joins.
LEAF = 20_000_000


def name_of(line: str) -> bytes:
    """128 bits that name a line: lines of one name are equal."""
    return xxhash.xxh3_128_digest(line.encode())


def mark_of(line: str) -> int:
    """64 bits under which a line looks for others; lines that share them by chance only share a region."""
    return xxhash.xxh3_64_intdigest(line.encode()) - (1 << 63)


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """The lines with a word, with their places."""
    return [(i, s) for i, s in enumerate(text.split("\n")) if s.strip(" \t\x0b\x0c\r")] if text else []


def segments(length: int, tau: int) -> list[tuple[int, int]]:
    """(start, length) of the tau + 1 even segments of a line."""
    short, longer = divmod(length, tau + 1)
    out, at = [], 0
    for i in range(tau + 1):
        n = short + (i >= tau + 1 - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, tau: int, shortest: int) -> list[tuple[int, int, int, int, bool]]:
    """(indexed length, segment, start, size, whether a line of this length also has it as a segment) of
    every substring to look up: a match of segment i has at most i edits before it and tau - i after."""
    out = []
    for other in range(max(shortest, length - tau), length + 1):
        shift = length - other
        for i, (at, n) in enumerate(segments(other, tau)):
            low = max(0, at - i, at + shift - (tau - i))
            high = min(length - n, at + i, at + shift + (tau - i))
            out += [(other, i, p, n, not shift and p == at) for p in range(low, high + 1)]
    return out


def within(a: str, b: str, tau: int) -> bool:
    """Whether the edit distance is at most tau. What both ends share is cut off; the rest goes through
    bit vectors of the 2 tau + 1 diagonals around the main one."""
    if abs(len(a) - len(b)) > tau:
        return False
    a, b = stripped(a, b)
    if not a or not b:
        return max(len(a), len(b)) <= tau
    width = 2 * tau + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + tau)  # room for rows above the first
    # bit k: row j - tau + k of column j; differences of each row to the row above it
    plus = full & ~((1 << (tau + 1)) - 1)
    minus = (1 << (tau + 1)) - 1
    score = 0  # of the cell on the main diagonal, bit tau
    for j, c in enumerate(b):
        plus, minus = (plus >> 1) | top, minus >> 1
        same = (places.get(c, 0) >> j) & full
        zero = ((((same & plus) + plus) ^ plus) | same | minus) & full
        right_plus = (minus | ~(zero | plus)) & full
        right_minus = zero & plus
        score += not zero >> tau & 1
        if score > 2 * tau:
            return False
        right_plus = (right_plus << 1 | 1) & full
        plus = ((right_minus << 1) | ~(zero | right_plus)) & full
        minus = zero & right_plus
    step = 1 if len(a) > len(b) else -1
    for k in range(tau + 1, tau + 1 + len(a) - len(b)) if step > 0 else range(tau, tau - (len(b) - len(a)), -1):
        score += step * ((plus >> k & 1) - (minus >> k & 1))
    return score <= tau


def stripped(a: str, b: str) -> tuple[str, str]:
    """Both without their longest common prefix and then suffix, found by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        x, y = a[len(a) - mid : len(a) - low], b[len(b) - mid : len(b) - low]
        low, high = (mid, high) if x == y else (low, mid - 1)
    return a[: len(a) - low], b[: len(b) - low]


def join_lines(lines: list[str], tau: int, shortest: int) -> list[int]:
    """For each line the smallest index in its class; exact."""
    forest = Forest()
    index: dict[tuple, list[int]] = {}
    order = sorted(range(len(lines)), key=lambda i: (len(lines[i]), i))
    shapes: dict[int, list] = {}
    for i in order:
        s = lines[i]
        if len(s) not in shapes:
            shapes[len(s)] = probes(len(s), tau, shortest)
        own, met = [], set()
        for length, seg, at, n, indexed in shapes[len(s)]:
            key = (length, seg, s[at : at + n])
            if indexed:
                own.append(key)
            for j in index.get(key, ()):
                if j not in met:
                    met.add(j)
                    if forest.find(i) != forest.find(j) and within(lines[j], s, tau):
                        forest.union(i, j)
        for key in own:
            index.setdefault(key, []).append(i)
    return [forest.find(i) for i in range(len(lines))]


def line_rows(docs: DataFrame) -> DataFrame:
    """doc_id, t (the text's hash), line (place), name: a row for each line with a word."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            who, place, name = [], [], []
            for i, t in enumerate(texts_of(b)):
                for at, s in lines_of(t):
                    who.append(i)
                    place.append(at)
                    name.append(name_of(s))
            rows = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(place, pa.int32()), pa.array(name, pa.binary())], names=["doc_id", "t", "line", "name"])

    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(lean(run), f"doc_id {kind}, t long, line int, name binary")


def segment_keys(docs: DataFrame, tau: int, shortest: int) -> DataFrame:
    """key, mark: the substrings of every long line; the last bit of key tells its own segments."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        shapes: dict[int, list] = {}
        digest = xxhash.xxh3_64_intdigest
        for b in found:
            keys, marks, counts = [], [], []
            for t in texts_of(b):
                for _, s in lines_of(t):
                    if len(s) < shortest or (k := mark_of(s)) in seen:
                        continue
                    seen.add(k)
                    if len(s) not in shapes:
                        if len(shapes) > 5000:
                            shapes.clear()
                        shapes[len(s)] = [(at, at + n, length * (tau + 1) + seg, indexed) for length, seg, at, n, indexed in probes(len(s), tau, shortest)]
                    found_ = [digest(s[x:z], seed) & ~1 | own for x, z, seed, own in shapes[len(s)]]
                    keys += found_
                    marks.append(k)
                    counts.append(len(found_))
            if len(seen) > KEEP:
                seen.clear()
            if keys:
                key = np.array(keys, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(np.array(marks, np.int64), counts))], names=["key", "mark"])

    return docs.select("text").mapInArrow(lean(run), "key long, mark long")


def meeting_lines(keys: DataFrame) -> DataFrame:
    """(a, b): marks of lines that meet under a key, each with the smallest that has it as a segment."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leader = None, 0  # the key of the row before, and its leader
        for b in found:
            if not b.num_rows:
                continue
            key, mark = b.column(0).to_numpy(), b.column(1).to_numpy()
            own, key = key & 1 == 1, key >> 1
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            # sorted by (key, own first, mark): a group is led by its first row if that has the key as a segment
            lead = np.where(own[first], mark[first], -1)
            led = own[first]
            if key[0] == last:
                lead[0], led[0] = (leader, True) if leader is not None else (-1, False)
            last, leader = key[-1], lead[-1] if led[-1] else None
            sizes = np.diff(np.append(first, len(key)))
            lead, led = np.repeat(lead, sizes), np.repeat(led, sizes)
            keep = np.flatnonzero(led & (lead != mark))
            if len(keep):
                pairs = np.unique(np.stack([mark[keep], lead[keep]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    own = F.col("key").bitwiseAND(1)
    dealt = keys.repartition(F.shiftright("key", 1)).sortWithinPartitions(F.shiftright("key", 1), own.desc(), "mark")
    return dealt.mapInArrow(lean(run), "a long, b long")


def region_lines(docs: DataFrame, wanted: np.ndarray, shortest: int) -> DataFrame:
    """mark, name, s: the long lines whose mark the bitmap may hold, about once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in found:
            if len(seen) > KEEP:
                seen.clear()
            lines = [s for t in texts_of(b) for _, s in lines_of(t) if len(s) >= shortest]
            marks = np.array([mark_of(s) for s in lines], np.int64)
            hits = np.flatnonzero(may_hold(shared.value, marks)).tolist() if lines else []
            out = {k: i for i in hits if (k := name_of(lines[i])) not in seen}
            seen.update(out)
            if out:
                arrays = [pa.array(marks[list(out.values())]), pa.array(list(out), pa.binary()), pa.array([lines[i] for i in out.values()], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["mark", "name", "s"])

    return docs.select("text").mapInArrow(lean(run), "mark long, name binary, s string")


def region_links(lines: DataFrame, tau: int, shortest: int) -> DataFrame:
    """(a, b): names, stars of the copies inside each region; lines: region, name, s."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, own = None, {}

        def told() -> pa.RecordBatch:
            names = sorted(own)
            root = join_lines([own[k] for k in names], tau, shortest)
            hits = [i for i, r in enumerate(root) if r != i]
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i in hits], pa.binary()), pa.array([names[root[i]] for i in hits], pa.binary())], names=["a", "b"])

        for b in found:
            for r, k, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r != region:
                    if len(own) > 1:
                        yield told()
                    region, own = r, {}
                own[k] = s
        if len(own) > 1:
            yield told()

    return lines.repartition("region").sortWithinPartitions("region").select("region", "name", "s").mapInArrow(lean(run), "a binary, b binary")


def near_copies(docs: DataFrame, tau: int, shortest: int, leaf: int) -> DataFrame:
    """(node, root) of the names of lines with a near copy."""
    met = connected_components(meeting_lines(segment_keys(docs, tau, shortest)))
    ours = met.select(F.col("node").alias("mark"), F.col("root").alias("region"))
    ours = cut(ours.unionByName(met.select(F.col("root").alias("mark"), F.col("root").alias("region")).distinct()), "line-regions")
    lines = region_lines(docs, bitmap_of(ours, "mark"), shortest).join(ours, "mark").dropDuplicates(["name"])
    lines = cut(lines.select("region", "name", "s"), "region-lines")
    sizes = lines.groupBy("region").agg(F.sum(F.length("s")).alias("n"))
    blocks = F.greatest(F.lit(1), F.ceil(2 * F.col("n") / leaf)).cast("long")
    dealt = lines.join(sizes.select("region", F.when(F.col("n") <= leaf, F.lit(1)).otherwise(blocks).cast("long").alias("k")), "region")
    block = F.pmod(F.xxhash64("name"), F.col("k"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda j: F.concat_ws("x", F.col("region"), F.least(block, j), F.greatest(block, j)))
    return connected_components(region_links(dealt.select(F.explode(pairs).alias("region"), "name", "s"), tau, shortest))


def line_classes(docs: DataFrame, tau: int = TAU, shortest: int = SHORTEST, leaf: int = LEAF) -> DataFrame:
    """doc_id, t, line, first_doc, first_line, kept: a row for each line with a word. The class is named
    by its first line; kept tells that line."""
    small_batches(docs.sparkSession)
    rows = cut(line_rows(docs), "lines")
    roots = near_copies(docs, tau, shortest, leaf).select(F.col("node").alias("name"), "root")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "line").alias("at")
    firsts = rows.groupBy("name").agg(F.min(at).alias("at")).join(roots, "name", "left")
    firsts = cut(firsts.select("name", F.coalesce("root", "name").alias("root"), "at"), "line-firsts")
    lows = firsts.groupBy("root").agg(F.min("at").alias("low"))
    named = firsts.join(lows, "root").select("name", "low")
    kept = F.col("doc_id").eqNullSafe(F.col("low.doc_id")) & (F.col("t") == F.col("low.t")) & (F.col("line") == F.col("low.line"))
    return rows.join(named, "name").select("doc_id", "t", "line", F.col("low.doc_id").alias("first_doc"), F.col("low.line").alias("first_line"), kept.alias("kept"))


def dedup_lines(docs: DataFrame, tau: int = TAU, shortest: int = SHORTEST, leaf: int = LEAF) -> DataFrame:
    """``docs`` without the lines that aren't kept. Documents of which no line is left go; those without
    a dropped line are unchanged."""
    gone = line_classes(docs, tau, shortest, leaf).groupBy("doc_id", "t").agg(F.collect_set(F.when(~F.col("kept"), F.col("line"))).alias("_gone"), F.count_if("kept").alias("_left"))
    gone = gone.filter(F.size("_gone") > 0).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "_gone", "_left")
    full = boxed(docs, "doc_id", "text").withColumn("_x", F.xxhash64("text"))
    full = full.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_x") == F.col("_t")), "left").filter("_left is null or _left > 0")
    lines = F.filter(F.transform(F.split("text", "\n"), lambda s, i: F.when(~F.array_contains(F.col("_gone"), i), s)), lambda s: s.isNotNull())
    changed = F.col("_gone").isNotNull()
    new = {"text": F.when(changed, F.array_join(lines, "\n")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(new["text"])).otherwise(F.col("box.n_chars")).cast(docs.schema["n_chars"].dataType)
    return unboxed(full, docs, **new)
