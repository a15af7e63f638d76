"""Best-fit packing by linear grouping.

Only lengths decide how documents share sequences, so the plan is made from the histogram of lengths
(at most ``capacity`` numbers, whatever the input):

1. Large lengths are split in order into groups of equal cardinality and rounded up to their group's
   largest, which leaves few sizes.
2. For the few sizes the configurations that fill a sequence are optimised: a linear program solved by
   column generation, rounded down, and the rest by best fit.
3. Actual lengths replace the rounded ones, run by run.
4. What is left over and small goes, longest first, where it fits best, or opens new sequences.
5. The sequences that are filled least are dissolved, several shares of them in turn, and their lengths packed
   again in that way. The plan with the fewest sequences stays; dissolving all is best fit alone, so no plan
   needs more.

The plan is a table of runs: the documents of one length with ranks a to b go to consecutive sequences
at one offset. Each task looks up its documents' ranks in it; ranks come from counts by task and length.

Defined cases: a null or empty text has the end id alone; repeated rows and null ids are packed row by
row; pieces of one length tie, and take their places in the order of tasks and rows; an empty table gives
an empty table; other columns are ignored; only documents longer than the capacity are cut, their first
piece being the shorter one; a very long text is encoded as a whole, in memory of a few times its size.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import cut, lean, release, small_batches, texts_of
from factloom.llm.tokens import encoder, forget

CAPACITY = 1024
#: Lengths of at least this share of the capacity are large.
LARGE = 1 / 3
GROUPS = 128
#: Shares of the sequences that are dissolved and packed again.
DISSOLVED = (0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0)
#: Plain words whose ids a worker keeps.
WORDS = 900_000

#: A bin type: how many sequences, and the lengths in each, in order.
Bins = list[tuple[int, list[int]]]


def best_fit(items: list[tuple[int, int]], capacity: int, bins: Bins) -> Bins:
    """Put (length, count) items, longest first, into the fullest bins that take them, many at a time."""
    rooms: dict[int, Bins] = defaultdict(list)
    for m, own in bins:
        rooms[capacity - sum(own)].append((m, own))
    keys = sorted(r for r in rooms if rooms[r])
    for length, count in sorted(items, reverse=True):
        while count:
            at = bisect.bisect_left(keys, length)
            if at == len(keys):
                if capacity not in rooms or not rooms[capacity]:
                    bisect.insort(keys, capacity)
                rooms[capacity].append((-(-count // (capacity // length)), []))
                continue
            room = keys[at]
            m, own = rooms[room].pop()
            fit = room // length  # a bin with much room takes many of them
            k = 1 if count < fit else fit if room == capacity else 1
            used = min(m, count // k)
            if used < m:
                rooms[room].append((m - used, own))
            if not rooms[room]:
                keys.pop(at)
            count -= used * k
            left = room - k * length
            if not rooms[left]:
                bisect.insort(keys, left)
            rooms[left].append((used, own + [length] * k))
    return [b for r in rooms.values() for b in r if b[1]]


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration of sizes, each any number of times."""
    best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.flatnonzero(sizes <= room)
        if len(fits):
            gain = best[room - sizes[fits]] + values[fits]
            i = int(np.argmax(gain))
            if gain[i] > best[room] + 1e-12:
                best[room], take[room] = gain[i], fits[i]
    out, room = np.zeros(len(sizes), int), capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            out[take[room]] += 1
            room -= sizes[take[room]]
    return float(best[capacity]), out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[float, np.ndarray]]:
    """Minimise the number of sequences that hold ``demand`` of ``sizes``: a linear program over all
    configurations, by column generation from a basis of one size each."""
    s, d = np.array(sizes), np.array(demand, float)
    columns = np.diag(capacity // s).astype(float)
    x = d / np.diag(columns)
    for _ in range(rounds):
        duals = np.linalg.solve(columns.T, np.ones(len(s)))
        value, new = knapsack(s, np.maximum(duals, 0), capacity)
        if value <= 1 + 1e-7:
            break
        along = np.linalg.solve(columns, new.astype(float))
        ratios = np.where(along > 1e-9, x / np.where(along > 1e-9, along, 1), np.inf)
        out = int(np.argmin(ratios))
        x = np.maximum(x - ratios[out] * along, 0)
        columns[:, out], x[out] = new, ratios[out]
    return [(float(a), columns[:, i].astype(int)) for i, a in enumerate(x) if a > 1e-9]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> Bins:
    """Bins that hold exactly the lengths of the histogram."""
    full = [(histogram[capacity], [capacity])] if histogram.get(capacity) else []
    big = sorted((n, c) for n, c in histogram.items() if capacity * large <= n < capacity and c)
    small = [(n, c) for n, c in histogram.items() if 0 < n < capacity * large and c]
    if not big:
        return full + best_fit(small, capacity, [])
    # 1. groups: every length goes to the group in which its last item falls
    total, seen, sizes, members = sum(c for _, c in big), 0, [], []
    for n, c in big:
        seen += c
        g = min(groups - 1, (seen - 1) * groups // total)
        if not sizes or g != last:
            sizes.append(n)
            members.append([])
        sizes[-1], last = n, g
        members[-1].append((n, c))
    demand = [sum(c for _, c in m) for m in members]
    # 2. configurations of rounded sizes
    whole: Bins = []
    left = list(demand)
    for amount, config in configurations(sizes, demand, capacity):
        m = min([int(amount + 1e-6), *(left[i] // k for i, k in enumerate(config) if k)])
        if m > 0 and config.any():
            whole.append((m, [i for i, k in enumerate(config) for _ in range(k)]))
            left = [a - m * k for a, k in zip(left, config, strict=True)]
    # 3. actual lengths, the longest first, take the places of their group
    runs = [[list(x) for x in m] for m in members]
    bins: Bins = list(full)
    for m, own in sorted(whole, key=lambda b: sorted(b[1])):
        while m:
            need = defaultdict(int)
            for g in own:
                need[g] += 1
            step = min([m, *(max(1, runs[g][-1][1] // k) for g, k in need.items())])
            lengths = []
            for g, k in need.items():
                for _ in range(k):
                    if runs[g][-1][1] < step:
                        step = 1 if not lengths else step
                    lengths.append(runs[g][-1][0])
                    runs[g][-1][1] -= step
                    if not runs[g][-1][1]:
                        runs[g].pop()
            bins.append((step, lengths))
            m -= step
    # 4. what is left and small
    rest = [(n, c) for m in runs for n, c in m]
    # 5. the best share
    plans = [dissolved(bins, share, rest + small, capacity) for share in DISSOLVED]
    return sorted(min(plans, key=lambda p: sum(m for m, _ in p)), key=lambda b: (sorted(b[1], reverse=True), b[0]))


def dissolved(bins: Bins, share: float, more: list[tuple[int, int]], capacity: int) -> Bins:
    """The bins but for the given share, those filled least, whose lengths are packed again with ``more``."""
    bins = sorted(bins, key=lambda b: (sum(b[1]), sorted(b[1]), b[0]))
    out = -int(-share * sum(m for m, _ in bins))
    items, kept = defaultdict(int), []
    for m, own in bins:
        k = min(m, out)
        out -= k
        for n in own:
            items[n] += k
        if k < m:
            kept.append((m - k, list(own)))
    for n, c in more:
        items[n] += c
    return best_fit([(n, c) for n, c in items.items() if c], capacity, kept)


def slots(bins: Bins) -> dict[int, list[tuple[int, int, int]]]:
    """For each length: (first rank, first sequence, offset) of its runs, by rank."""
    out, taken, sequence = defaultdict(list), defaultdict(int), 0
    for m, own in bins:
        offset = 0
        for n in own:
            out[n].append((taken[n], sequence, offset))
            taken[n] += m
            offset += n
        sequence += m
    return out


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, words: int = WORDS) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, and for ranking the task's number
    (task) and the piece's rank among those of its length in the task (rank)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, ranks, task = encoder(tokenizer, words), np.uint32(end_id).tobytes(), defaultdict(int), TaskContext.get().partitionId()
        for big in found:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                who, cols = [], [[], [], [], [], []]
                for i, ids in enumerate(enc.encode(texts_of(b))):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    a = piece = 0
                    while a < n:
                        z = first + piece * capacity
                        for col, v in zip(cols, (piece, a, z - a, zlib.crc32(ids[4 * a : 4 * z]), ranks[z - a]), strict=True):
                            col.append(v)
                        ranks[z - a] += 1
                        who.append(i)
                        a, piece = z, piece + 1
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                arrays = [b.column(0).take(pa.array(who, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array([task] * len(who), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "rank", "task"])
            if words < WORDS:
                release()
        if words < WORDS:
            forget()

    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, rank long, task long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, groups: int = GROUPS, words: int = WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece. With fewer words
    than ``WORDS`` a worker also forgets them after each task, as a job with other steps needs."""
    spark = docs.sparkSession
    pieces = cut(cut_pieces(docs, tokenizer, end_id, capacity, words), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    found = slots(plan(histogram, capacity, groups))
    lookup = {n: tuple(np.array(c, np.int64) for c in zip(*runs, strict=True)) for n, runs in found.items()}
    shared = spark.sparkContext.broadcast(lookup)  # a few runs for each length
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(part):
                    first, sequence, offset = runs[int(length[part[0]])]
                    at = np.searchsorted(first, rank[part], "right") - 1
                    seq[part], off[part] = sequence[at] + rank[part] - first[at], offset[at]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    ranked = pieces.join(starts, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(lean(place), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
