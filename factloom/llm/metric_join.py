"""N-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows.

Documents are sets of 5-word shingles; two are linked when 100 * intersection >= 80 * union, that is at
Jaccard distance 0.2 or less. Equal sets are one point.

1. Points at distance 1 from all others look alike to any pivot, so the first regions come from shared
   shingles. Shingles are ordered, those that many documents hold last; linked points share one among
   the first n - ceil(0.8 n) + 1 of each. Points that share such a shingle, at sizes that allow a link,
   are in one region, and regions are closed under that relation: no link leaves a region.
2. Inside a region pivots are chosen, distances to them computed, and points go to the Voronoi cell of
   their nearest pivot. The triangle inequality bounds who may be linked across a border: a point is
   copied into the cell of pivot q when d(x, q) <= d(x, nearest) + 0.4, and points at 0.8 or more from
   all pivots form a cell of their own, with copies of those at 0.6 or more. A pivot's own links follow
   from its distances; cells join recursively, with pivots of their own. Points that are already
   connected aren't compared. Where windows copy more than cells save, all points become pivots in turn.
3. Regions of more than ``LEAF`` shingles are first split by the same step over the cluster, with all
   their pivots in a table of bounded size; where that no longer shrinks them, their blocks join pairwise.
4. Links are stars inside cells; their components are computed over the cluster.

Defined cases: a null text or one without words has an empty set and is linked with nothing, not even
with another such; repeated rows and rows without an id share the component of their text; component_id
is the smallest id that isn't null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import bitmap_of, boxed, cut, lean, long_list, may_hold, shingle_hashes, small_batches, texts_of, unboxed, word_hashes, words_of
from factloom.llm.components import Forest, connected_components

#: Shingles of a region that one task joins: 8 bytes each, a few copies.
LEAF = 4_000_000
#: Shingles of all pivots of one round of distributed splits.
PIVOT_SHINGLES = 1_000_000
#: Frequent shingles whose order every task knows: 9 bytes each.
FREQUENT = 1_000_000
DEPTH = 4
PIVOTS = 16
#: Texts that a task remembers, about 200 bytes each; it may pass one on again after that.
KEEP = 100_000
#: Shingles that a task gathers before it passes them on.
GATHER = 3_000_000
#: Points that share a shingle and are paired; more make a star.
TOGETHER = 64
#: Points that no pivot tells apart and that all become pivots; more meet under shingles first.
DENSE = 512
#: Pairs that are compared at once.
TRIED = 20_000
#: Shingles that are looked up among those of the pivots at once.
LOOKED_UP = 200_000
#: Words of 64 shingles each that all pairs of a dense set are compared by first; words of bits held at once.
NARROW, BITS = 16, 8 << 20


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * common >= 80 * (a + b - common)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles as sorted hashes."""
    return np.unique(shingle_hashes(word_hashes(words_of(text)))).view(np.int64)


def point_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    d = xxhash.xxh3_128_digest(found.tobytes())
    return tuple(np.frombuffer(d, np.int64).tolist())


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns, t (the text's hash) and the text."""
    return docs.select(*columns, F.xxhash64("text").alias("t"), "text")


# ---------------------------------------------------------------- candidates


def frequent_shingles(docs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several tasks hold often, sorted, and the magnitude of their frequency; ``most`` at
    most. They only set the order of shingles: any order gives the same links."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, size = set(), [], 0

        def told() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            h, n = h[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n, pa.int64())], names=["h", "n"])

        for b in found:
            for k, t in zip(b.column(0).to_pylist(), texts_of(b), strict=True):
                if t and k not in seen:
                    seen.add(k)
                    parts.append(shingle_set(t))
                    size += len(parts[-1])
                if size > GATHER:
                    yield told()
                    parts, size = [], 0
            if len(seen) > KEEP:
                seen.clear()
        if parts:
            yield told()

    rows = keyed(docs).mapInArrow(lean(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n >= 8")
    rows = cut(rows.select("h", F.floor(F.log2("n")).cast("int").alias("step")), "frequent")
    total, least = 0, 64
    for r in rows.groupBy("step").count().orderBy(F.desc("step")).collect():  # at most 64 rows
        if total + r["count"] > most:
            break
        total, least = total + r["count"], r["step"]
    found = rows.filter(F.col("step") >= least).toArrow()
    h, step = found.column(0).to_numpy(), found.column(1).to_numpy().astype(np.int8)
    order = np.argsort(h)
    return h[order], step[order]


def prefix_of(found: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles in the common order: any two linked sets share one of these."""
    h, step = frequent
    n = len(found)
    size = n - (80 * n + 99) // 100 + 1
    if not len(h):
        return found[:size]
    at = np.minimum(np.searchsorted(h, found), len(h) - 1)
    rank = np.where(h[at] == found, step[at], 0)
    return found[np.lexsort((found, rank))[:size]]


def point_rows(docs: DataFrame, shared) -> DataFrame:
    """A row per document: doc_id, n, f1, f2 (the set's name; null if empty), t (the text's), prefix
    (only on the first row of a text in each task)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        for b in found:
            out, prefixes = [], []
            for k, t in zip(b.column(1).to_pylist(), texts_of(b), strict=True):
                if k in known:
                    out.append(known[k])
                    prefixes.append(None)
                    continue
                s = shingle_set(t)
                row = (len(s), *point_key(s), k) if len(s) else (0, None, None, k)
                out.append(row)
                prefixes.append(prefix_of(s, shared.value) if len(s) else None)
                if len(known) > KEEP:
                    known.clear()
                known[k] = row
            cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
            sizes = [0 if p is None else len(p) for p in prefixes]
            flat = np.concatenate([p for p in prefixes if p is not None] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, long_list(flat, np.cumsum([0, *sizes]), pa.int64())], names=["doc_id", "n", "f1", "f2", "t", "prefix"])

    return keyed(docs, "doc_id").mapInArrow(lean(run), f"doc_id {kind}, n long, f1 long, f2 long, t long, prefix array<long>")


def candidate_edges(rows: DataFrame) -> DataFrame:
    """(a, b): points that may be linked. Points are named by f1; a clash only makes a region larger.

    Points that share a prefix shingle with at most ``TOGETHER`` others pair up, and a pair stays if its
    common prefix shingles and all that may follow them suffice for a link. A shingle that more points
    have makes a star of each run of sizes in which each allows a link with the next.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.zeros(0, np.int64)] * 3  # of the last group: its rows, or of a frequent shingle its leader
        frequent = False
        for b in found:
            h, n, k = (np.concatenate([x, c.to_numpy()]) for x, c in zip(carry, b.columns, strict=True))
            fresh = np.r_[True, (h[1:] != h[:-1]) | (k[1:] != k[:-1])]
            h, n, k = h[fresh], n[fresh], k[fresh]
            last = int(np.searchsorted(h, h[-1]))  # rows are sorted by (h, n, k)
            frequent, before = len(h) - last > TOGETHER or (frequent and not last), frequent
            if frequent:
                leader = yield from linked_up(h, n, k, before)
                carry = [h[-1:], n[-1:], np.array([leader])]
            else:
                yield from linked_up(h[:last], n[:last], k[:last], before)
                carry = [h[last:], n[last:], k[last:]]
        yield from linked_up(*carry, frequent)

    def linked_up(h: np.ndarray, n: np.ndarray, k: np.ndarray, before: bool) -> Iterator[pa.RecordBatch]:
        """The pairs and stars of whole groups; ``before`` tells that the first one's shingle is frequent."""
        if not len(h):
            return None
        first = np.r_[True, h[1:] != h[:-1]]
        group = np.cumsum(first) - 1
        sizes = np.bincount(group)
        hot = (sizes[group] > TOGETHER) | (before & (group == 0))
        # stars
        leads = first | np.r_[True, 100 * n[:-1] < 80 * n[1:]]
        leader = np.maximum.accumulate(np.where(leads, np.arange(len(h)), 0))
        at = np.flatnonzero(hot & (k != k[leader]))
        yield from told(np.stack([k[at], k[leader[at]]], 1), np.stack([n[at], n[leader[at]]], 1), True)
        # pairs
        kept = np.flatnonzero(~hot & (sizes[group] > 1))
        end, n, k, group = k[leader[-1]], n[kept], k[kept], group[kept]
        names, counts = [], []
        for apart in range(1, TOGETHER):
            i = np.flatnonzero((group[apart:] == group[:-apart]) & (100 * n[:-apart] >= 80 * n[apart:]))
            if not len(i):
                break
            low, high = np.minimum(k[i], k[i + apart]), np.maximum(k[i], k[i + apart])
            names.append(np.stack([low, high], 1))
            counts.append(np.stack([np.where(low == k[i], n[i], n[i + apart]), np.where(low == k[i], n[i + apart], n[i])], 1))
        if names:
            yield from told(np.concatenate(names), np.concatenate(counts), False)
        return end

    def told(pairs: np.ndarray, n: np.ndarray, hot: bool) -> Iterator[pa.RecordBatch]:
        if len(pairs):
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs, n = pairs[order], n[order]
            first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]).any(1)])
            c = np.diff(np.append(first, len(pairs)))
            pairs, n = pairs[first], n[first]
            for i in range(0, len(first), 100_000):
                z = slice(i, i + 100_000)
                arrays = [pa.array(x.astype(np.int64)) for x in (pairs[z, 0], pairs[z, 1], n[z, 0], n[z, 1], c[z])]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([hot] * len(arrays[0]))], names=["a", "b", "na", "nb", "c", "hot"])

    prefix = rows.filter("n > 0").select(F.explode("prefix").alias("h"), "n", F.col("f1").alias("k"))
    dealt = prefix.repartition("h").sortWithinPartitions("h", "n", "k")
    pairs = dealt.mapInArrow(lean(run), "a long, b long, na long, nb long, c long, hot boolean")
    pairs = pairs.groupBy("a", "b").agg(F.min("na").alias("na"), F.min("nb").alias("nb"), F.sum("c").alias("c"), F.max("hot").alias("hot"))
    least = F.ceil(80 * (F.col("na") + F.col("nb")) / 180 - 1e-9)
    rest = F.greatest(*[F.ceil(80 * F.col(x) / 100) - 1 for x in ("na", "nb")])
    return pairs.filter(F.col("hot") | (F.col("c") >= least - rest)).select("a", "b")


def region_points(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """t, n, f1, f2 and the whole set of the texts that the bitmap may hold, once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in found:
            if len(seen) > KEEP:
                seen.clear()
            keys = b.column(0).to_numpy()
            out = []
            for t, k, hit in zip(texts_of(b), keys.tolist(), may_hold(shared.value, keys).tolist(), strict=True):
                if hit and k not in seen:
                    seen.add(k)
                    s = shingle_set(t)
                    if len(s):
                        out.append((k, len(s), *point_key(s), s))
            if out:
                cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
                sets = long_list(np.concatenate([r[4] for r in out]), np.cumsum([0, *(r[1] for r in out)]), pa.int64())
                yield pa.RecordBatch.from_arrays([*cols, sets], names=["t", "n", "f1", "f2", "s"])

    return keyed(docs).mapInArrow(lean(run), "t long, n long, f1 long, f2 long, s array<long>")


# ---------------------------------------------------------------- inside a region


class Region:
    """The points of a region in memory: their sets in one array."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets])
        self.flat = np.concatenate(sets)
        self.starts = np.cumsum(np.r_[0, self.n[:-1]])
        self.root = np.arange(len(sets))

    def set_of(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i] : self.starts[i] + self.n[i]]

    def common(self, pivots: list[np.ndarray], members: np.ndarray) -> np.ndarray:
        """Intersection sizes, members by pivots, by one look-up in the pivots' merged shingles; some
        members at a time, as every shingle stands in memory once for each pivot that holds it."""
        out = []
        for own in np.split(members, np.flatnonzero(np.diff(np.cumsum(self.n[members]) // LOOKED_UP)) + 1):
            lengths = self.n[own]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(self.starts[own], lengths)
            out.append(overlaps(self.flat[at], np.repeat(np.arange(len(own)), lengths), len(own), pivots))
        return np.concatenate(out)

    def merge(self, pairs: np.ndarray) -> None:
        ends = self.root[pairs]
        ends = ends[ends[:, 0] != ends[:, 1]]
        forest = Forest()
        for both in np.unique(ends[:, 0] * len(self.root) + ends[:, 1]).tolist():
            forest.union(*divmod(both, len(self.root)))
        if forest.up:
            to = np.arange(len(self.root))
            for x in forest.up:
                to[x] = forest.find(x)
            self.root = to[self.root]


def overlaps(flat: np.ndarray, who: np.ndarray, n: int, pivots: list[np.ndarray]) -> np.ndarray:
    """How many of each owner's values each pivot holds."""
    merged = np.concatenate(pivots)
    owner = np.repeat(np.arange(len(pivots)), [len(p) for p in pivots])
    order = np.argsort(merged, kind="stable")
    merged, owner = merged[order], owner[order]
    low, high = np.searchsorted(merged, flat, "left"), np.searchsorted(merged, flat, "right")
    hits = high - low
    rows = np.repeat(who, hits)
    ends = np.cumsum(hits)
    at = np.arange(len(rows)) - np.repeat(ends - hits, hits) + np.repeat(low, hits)
    return np.bincount(rows * len(pivots) + owner[at], minlength=n * len(pivots)).reshape(n, len(pivots))


def distances(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1 - common / (n[:, None] + m[None, :] - common)


def cells(d: np.ndarray) -> list[np.ndarray]:
    """By distances to pivots, the points of each cell: one per pivot, then the far cell. Any two points
    within 0.2 of each other meet in the home cell of either."""
    near, slack = d.min(1), 1e-9
    out = []
    for q in range(d.shape[1]):
        home = (d.argmin(1) == q) & (near < 0.8)
        copies = (d[:, q] <= near + 0.4 + slack) & (d[:, q] < 1)
        out.append(np.flatnonzero(home | copies) if home.any() else np.zeros(0, int))
    far = near >= 0.8
    out.append(np.flatnonzero(near >= 0.6 - slack) if far.any() else np.zeros(0, int))
    return out


def join_region(sets: list[np.ndarray], most: int = PIVOTS, dense: int = DENSE) -> np.ndarray:
    """For each point, the smallest index that links reach; exact.

    The square root of its points, ``most`` at most, are a cell's pivots. They are taken outside the
    largest component, as two of its points need no look. A pivot's links are known from its distances,
    so it leaves; the others go to the cells and join there in the same way. Where windows would copy more
    than cells save, pivots go on leaving until none is left outside the largest component; more than
    ``dense`` such points meet under their rare shingles instead.
    """
    region = Region(sets)
    todo = [np.arange(len(sets))]
    while todo:
        members = todo.pop()
        if (d := pivot_step(region, members, most)) is None:
            continue
        members, d = members[d[0]], d[1]
        parts = cells(d) if len(members) else []
        if sum(len(p) ** 2 for p in parts) <= 0.5 * len(members) ** 2:
            todo += [members[p] for p in parts if len(p) > 1]
        elif len(members) <= dense:
            todo.append(members)
        else:
            by_prefix(region, members)
    return region.root


def pivot_step(region: Region, members: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Choose pivots and link them; which members are left, and their distances to the pivots. None where
    all are connected."""
    roots = region.root[members]
    values, counts = np.unique(roots, return_counts=True)
    if len(values) < 2:
        return None
    outside = np.flatnonzero(roots != values[counts.argmax()])
    k = min(most, len(outside), math.isqrt(len(members)))
    at = outside[np.linspace(0, len(outside) - 1, k).astype(int)]
    chosen = members[at]
    c = region.common([region.set_of(i) for i in chosen], members)
    n, m = region.n[members], region.n[chosen]
    hits = np.argwhere(linked(c, n[:, None], m[None, :]))
    region.merge(np.stack([members[hits[:, 0]], chosen[hits[:, 1]]], 1))
    left = np.ones(len(members), bool)
    left[at] = False
    return left, distances(c, n, m)[left]


def by_prefix(region: Region, members: np.ndarray) -> None:
    """Points that no pivot tells apart: they meet under the first shingles in the order of how many of
    them hold each. Pairs under rare ones are compared if their common ones can suffice; of the points under
    a frequent one all pairs are, and all pairs at once where the frequent ones would make as many."""
    n = region.n[members]
    who = np.repeat(np.arange(len(members)), n)
    flat = np.concatenate([region.set_of(i) for i in members])
    _, at, df = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((at, df[at], who))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    size = n - (80 * n + 99) // 100 + 1
    first = place < size[who]  # rows are by point, so places are ranks in its order
    shingle, point = at[order][first], who[order][first]
    order = np.lexsort((n[point], shingle))
    shingle, point = shingle[order], point[order]
    group = np.cumsum(np.r_[True, shingle[1:] != shingle[:-1]]) - 1
    counts = np.bincount(group)
    hot = counts[group] > TOGETHER
    if (counts[counts > TOGETHER] ** 2).sum() >= len(members) ** 2:
        return by_bits(region, members)
    ends = np.cumsum(counts)
    for g in np.flatnonzero(counts > TOGETHER):
        by_bits(region, members[point[ends[g] - counts[g] : ends[g]]])
    prefixes = np.bincount(point, minlength=len(members))
    point, group = point[~hot], group[~hot]
    found = []
    for apart in range(1, TOGETHER):
        i = np.flatnonzero(group[apart:] == group[:-apart])
        if not len(i):
            break
        i = i[100 * n[point[i]] >= 80 * n[point[i + apart]]]
        found.append(np.sort(np.stack([point[i], point[i + apart]], 1), 1))
    if not found:
        return
    pairs, c = np.unique(np.concatenate(found), axis=0, return_counts=True)
    a, b = n[pairs[:, 0]], n[pairs[:, 1]]
    # one of two points has its whole prefix before the end of the other's: what is common lies in both
    # prefixes, under rare shingles or frequent ones, or after that prefix
    seen = np.bincount(point, minlength=len(members))
    extra = np.minimum((prefixes - seen)[pairs[:, 0]], (prefixes - seen)[pairs[:, 1]])
    rest = np.maximum(a - size[pairs[:, 0]], b - size[pairs[:, 1]])
    pairs = pairs[180 * (c + extra + rest) >= 80 * (a + b)]
    starts, ids = np.cumsum(n) - n, at  # shingles as small numbers, ascending within a point
    while len(pairs):
        now, pairs = pairs[:TRIED], pairs[TRIED:]
        both = pair_overlaps(ids, starts, n, now)
        hits = now[linked(both, n[now[:, 0]], n[now[:, 1]])]
        region.merge(members[hits])
        roots = region.root[members]
        pairs = pairs[roots[pairs[:, 0]] != roots[pairs[:, 1]]]


def by_bits(region: Region, members: np.ndarray) -> None:
    """Link all pairs of the members; each is compared once, and only while its points aren't connected.

    The shingles that most of them hold are bits: ``NARROW`` words of these, and how many other shared
    shingles a point has, rule out most pairs. The rest is counted by all words and, of what stands in none,
    by the shingles themselves. Points of the largest component only take part as partners of others.
    """
    members = members[np.argsort(region.n[members], kind="stable")]
    n, size = region.n[members], len(members)
    who = np.repeat(np.arange(size), n)
    _, ids, df = np.unique(np.concatenate([region.set_of(i) for i in members]), return_inverse=True, return_counts=True)
    place = np.empty(len(df), np.int64)
    place[np.argsort(-df, kind="stable")] = np.arange(len(df))
    shared = df[ids] > 1
    width = min(-(-int((df > 1).sum()) // 64), max(NARROW, BITS // size))
    bits = np.zeros((width, size), np.uint64)
    at = place[ids]
    held = shared & (at < 64 * width)
    np.bitwise_or.at(bits.reshape(-1), (at[held] >> 6) * size + who[held], np.uint64(1) << (at[held] & 63).astype(np.uint64))
    beyond = np.bincount(who[shared & ~held], minlength=size)
    rest = np.bincount(who[shared & (at >= 64 * NARROW)], minlength=size)
    starts, some = np.cumsum(n) - n, max(1, min(TRIED, (1 << 20) // max(width, 1)))

    def settled(pairs: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Link the pairs that have enough in common; those whose points aren't connected then."""
        region.merge(members[pairs[linked(c, n[pairs[:, 0]], n[pairs[:, 1]])]])
        ends = region.root[members[pairs]]
        return pairs[ends[:, 0] != ends[:, 1]], c[ends[:, 0] != ends[:, 1]]

    roots = region.root[members]
    values, counts = np.unique(roots, return_counts=True)
    inside = int(np.argmax(roots == values[counts.argmax()]))
    left = np.ones(size, bool)  # points whose turn hasn't come
    turns = np.flatnonzero(roots != roots[inside])
    while len(turns):
        block = turns[: max(1, (1 << 18) // size)]
        turns = turns[len(block) :]
        roots = region.root[members]
        block = block[roots[block] != roots[inside]]
        if not len(block):
            continue
        low, high = np.searchsorted(100 * n, 80 * n[block[0]]), np.searchsorted(80 * n, 100 * n[block[-1]], "right")
        others = low + np.flatnonzero(left[low:high])
        left[block] = False
        c = np.zeros((len(block), len(others)), np.int64)
        for w in bits[:NARROW]:
            c += np.bitwise_count(w[block][:, None] & w[others][None, :])
        most = 180 * (c + np.minimum(rest[block][:, None], rest[others][None, :]))
        i, j = np.nonzero((most >= 80 * (n[block][:, None] + n[others][None, :])) & (roots[block][:, None] != roots[others][None, :]))
        pairs, c = np.stack([block[i], others[j]], 1), c[i, j]
        pairs, c = settled(pairs, c)
        while len(pairs) and rest.any():
            now, both, pairs, c = pairs[:some], c[:some], pairs[some:], c[some:]
            both = both + np.bitwise_count(bits[NARROW:, now[:, 0]] & bits[NARROW:, now[:, 1]]).sum(0, dtype=np.int64)
            now, both = settled(now, both)
            now = now[180 * (both + beyond[now].min(1)) >= 80 * n[now].sum(1)]
            if len(now) and beyond.any():
                settled(now, pair_overlaps(ids, starts, n, now))
            still = region.root[members[pairs]]
            still = still[:, 0] != still[:, 1]
            pairs, c = pairs[still], c[still]


def pair_overlaps(ids: np.ndarray, starts: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """How many numbers both points of each pair hold; a point's are ascending."""

    def keys(points: np.ndarray) -> np.ndarray:
        sizes = n[points]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(starts[points], sizes)
        return np.repeat(np.arange(len(points)), sizes) * (int(ids.max()) + 1) + ids[at]

    x, y = keys(pairs[:, 0]), keys(pairs[:, 1])
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    return np.bincount(y[x[at] == y] // (int(ids.max()) + 1), minlength=len(pairs))


# ---------------------------------------------------------------- over the cluster

POINT = "region string, cid long, n long, s array<long>"


def leaf_links(points: DataFrame) -> DataFrame:
    """(a, b): stars of linked points inside each region; a task holds one region at a time."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, cids, sets = None, [], []

        def told() -> pa.RecordBatch:
            first = {c: i for i, c in reversed(list(enumerate(cids)))}  # copies of a point are one
            own = sorted(first)
            root = join_region([sets[first[c]] for c in own])
            hits = np.flatnonzero(root != np.arange(len(own)))
            a, b = np.array(own, np.int64)[hits], np.array(own, np.int64)[root[hits]]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in found:
            flat, ends = batch.column(3).values.to_numpy(), batch.column(3).offsets.to_pylist()
            for r, c, x, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends, ends[1:], strict=False):
                if r != name:
                    if len(cids) > 1:
                        yield told()
                    name, cids, sets = r, [], []
                cids.append(c)
                sets.append(flat[x:z])
        if len(cids) > 1:
            yield told()

    return points.repartition("region").sortWithinPartitions("region").select("region", "cid", "n", "s").mapInArrow(lean(run), "a long, b long")


def split_regions(points: DataFrame, large: list[tuple[str, int]], leaf: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """One step for some large regions: the points of their cells, and the links to their pivots."""
    spark = points.sparkSession
    names = [r for r, _ in large]
    ours = points.filter(F.col("region").isin(names))
    share = max(1, PIVOT_SHINGLES // len(large))
    order = F.xxhash64("cid", F.lit(depth))

    w = Window.partitionBy("region").orderBy("order", "cid")
    ranked = ours.select("region", "cid", "n", order.alias("order")).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= PIVOTS)
    ranked = ranked.withColumn("sum", F.sum("n").over(w)).filter((F.col("sum") <= share) | (F.col("rank") <= 2))
    chosen = ours.join(ranked.select("region", "cid"), ["region", "cid"], "left_semi").dropDuplicates(["region", "cid"]).toArrow()
    pivots: dict[str, list] = {}
    for r, c, s in zip(chosen.column("region").to_pylist(), chosen.column("cid").to_pylist(), chosen.column("s").to_pylist(), strict=True):
        pivots.setdefault(r, []).append((c, np.array(s, np.int64)))
    shared = spark.sparkContext.broadcast(pivots)  # at most PIVOT_SHINGLES, and two points a region

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            regions, cids = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy()
            flat, ends = b.column(3).values.to_numpy(), b.column(3).offsets.to_numpy()
            n = np.diff(ends)
            rows, to, link_a, link_b = [], [], [], []
            for r in set(regions.tolist()):
                own, mine = np.flatnonzero(regions == r), shared.value[r]
                who = np.repeat(np.arange(len(own)), n[own])
                at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in own])
                c = overlaps(flat[at], who, len(own), [s for _, s in mine])
                m = np.array([len(s) for _, s in mine])
                for i, j in np.argwhere(linked(c, n[own][:, None], m[None, :])).tolist():
                    link_a.append(cids[own[i]])
                    link_b.append(mine[j][0])
                for q, part in enumerate(cell_members(distances(c, n[own], m))):
                    rows += own[part].tolist()
                    to += [f"{r}/{q}"] * len(part)
            kinds = b.select(["cid", "n", "s"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.string()), *kinds.columns, pa.nulls(len(to), pa.int64())], names=["region", "cid", "n", "s", "b"])
            if link_a:
                k = len(link_a)
                yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.string()), pa.array(link_a, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int64())), pa.array(link_b, pa.int64())], names=["region", "cid", "n", "s", "b"])

    out = cut(ours.select("region", "cid", "n", "s").mapInArrow(lean(run), POINT + ", b long"), "split")
    return out.filter("region is not null").select("region", "cid", "n", "s"), out.filter("region is null").select(F.col("cid").alias("a"), "b")


def cell_members(d: np.ndarray) -> list[np.ndarray]:
    """``cells`` for a share of the points: a cell's home points may be elsewhere, so it is never left out."""
    near, slack = d.min(1), 1e-9
    out = [np.flatnonzero((d[:, q] <= near + 0.4 + slack) & (d[:, q] < 1)) for q in range(d.shape[1])]
    return [*out, np.flatnonzero(near >= 0.6 - slack)]


def block_links(points: DataFrame, large: list[tuple[str, int]], leaf: int) -> DataFrame:
    """Regions that no split shrinks: points go to blocks by hash, and each pair of blocks is a region."""
    size = F.create_map(*[F.lit(x) for r, s in large for x in (r, 2 * s // leaf + 1)])
    ours = points.filter(F.col("region").isin([r for r, _ in large])).withColumn("k", size[F.col("region")])
    block = F.pmod(F.xxhash64("cid"), F.col("k"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda j: F.concat_ws("x", F.col("region"), F.least(block, j), F.greatest(block, j)))
    return leaf_links(ours.select(F.explode(pairs).alias("region"), "cid", "n", "s"))


def link_points(points: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(a, b): links whose components are those of all linked points; points: POINT."""
    parts, together = [], PIVOT_SHINGLES // 10_000
    for depth in range(DEPTH + 1):
        sizes = points.groupBy("region").agg(F.sum("n").alias("n"))
        big = cut(sizes.filter(F.col("n") > leaf), "large-regions")
        is_big = F.broadcast(big.select("region")) if big.count() <= 10_000 else big.select("region")
        parts.append(leaf_links(points.join(is_big, "region", "left_anti")))
        if big.isEmpty():
            break
        groups, again = big.orderBy("region").toLocalIterator(), []
        batch: list[tuple[str, int]] = []
        for r in [*groups, None]:
            if r is not None:
                batch.append((r["region"], r["n"]))
            if batch and (r is None or len(batch) == together):
                if depth == DEPTH:
                    parts.append(block_links(points, batch, leaf))
                else:
                    cells_, links = split_regions(points, batch, leaf, depth)
                    parts.append(links)
                    parent = F.regexp_replace("region", "/[0-9]+$", "")
                    grown = {r["p"]: r["n"] for r in cells_.groupBy(parent.alias("p")).agg(F.sum("n").alias("n")).collect()}  # a row per region of the batch
                    dense = [(r, n) for r, n in batch if grown.get(r, 0) > 2 * n]
                    if dense:  # copies outgrow what splitting saves
                        parts.append(block_links(points, dense, leaf))
                    again.append(cells_.filter(~parent.isin([r for r, _ in dense])) if dense else cells_)
                batch = []
        if depth == DEPTH:
            break
        points = again[0]
        for p in again[1:]:
            points = points.unionByName(p)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def labelled_points(docs: DataFrame, leaf: int, frequent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, n, f1, f2, t) and the components (f1, f2, root) of their points."""
    spark = docs.sparkSession
    small_batches(spark)
    order = spark.sparkContext.broadcast(frequent_shingles(docs, frequent))
    rows = cut(point_rows(docs, order), "points")
    regions = cut(connected_components(candidate_edges(rows)), "regions")
    points = rows.filter("n > 0").groupBy("f1", "f2").agg(F.min("t").alias("t"))
    points = cut(points.withColumn("cid", F.monotonically_increasing_id()), "point-names")
    named = regions.select(F.col("node").alias("f1"), F.col("root").alias("region"))
    named = named.unionByName(regions.select(F.col("root").alias("f1"), F.col("root").alias("region")).distinct())
    ours = cut(points.join(named, "f1").select("f1", "f2", "cid", "t", F.col("region").cast("string").alias("region")), "region-points")
    found = region_points(docs, bitmap_of(ours, "t"))
    found = found.join(ours.select("t", "f1", "f2", "region", "cid"), ["t", "f1", "f2"]).select("region", "cid", "n", "s")
    links = link_points(cut(found, "region-sets"), leaf)
    roots = connected_components(links).select(F.col("node").alias("cid"), "root")
    labelled = points.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    return rows.drop("prefix"), cut(labelled.select("f1", "f2", "root"), "labelled")


def jaccard_components(docs: DataFrame, leaf: int = LEAF, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each row of ``docs``."""
    rows, labelled = labelled_points(docs, leaf, frequent)
    lows = rows.filter("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("low")).join(labelled, ["f1", "f2"])
    lows = cut(lows, "lows")
    classes = lows.join(lows.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("f1", "f2", "component_id")
    full = rows.filter("n > 0").select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2"])
    full = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, leaf: int = LEAF, frequent: int = FREQUENT) -> DataFrame:
    """One row of each component of ``docs``: that of the smallest id (a null id comes last; of equal ids
    the text with the smallest hash, of equal rows one), and all rows without words."""
    rows, labelled = labelled_points(docs, leaf, frequent)
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    lows = rows.filter("n > 0").groupBy("f1", "f2").agg(F.min(at).alias("at")).join(labelled, ["f1", "f2"])
    kept = lows.groupBy("root").agg(F.min("at").alias("at")).select(F.col("at.doc_id").alias("_id"), F.col("at.t").alias("_k"), F.lit(True).alias("_one"))
    empty = rows.filter("n = 0").select(F.col("doc_id").alias("_id"), F.col("t").alias("_k"), F.lit(False).alias("_one")).distinct()
    full = boxed(docs, "doc_id", "text").withColumn("_t", F.xxhash64("text")).join(kept.unionByName(empty), F.col("_t").eqNullSafe(F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    first = F.row_number().over(Window.partitionBy("_t", "doc_id").orderBy("_t"))
    return unboxed(full.withColumn("_n", first).filter("not _one or _n = 1"), docs)
