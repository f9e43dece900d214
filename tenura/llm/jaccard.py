"""Exact Jaccard join of word-shingle sets, in the metric space of the Jaccard distance.

1. Equal sets are one class; its smallest id stands for it.
2. Random texts lie at distance 1 from any pivot text, where windows of twice the
   threshold would copy each text to each region. So the first regions come from
   buckets of shingles: of H + 1 buckets, two sets that differ in at most H shingles
   agree in one. Short sets, whose buckets would hold a shingle or none, have pairs of
   shingles of their prefixes in place of buckets. Sets that agree in a key meet, and what hangs together is a
   cluster; all links lie inside clusters. Few common shingles tie ever more unrelated texts
   together as a corpus grows, so the sets of a large cluster meet again by buckets of other hashes.
3. A cluster is joined by pivots. Each set goes to the region of its nearest pivot and,
   by the triangle inequality, to each region whose pivot is at most twice the
   threshold farther away; regions are joined in the same way until they are small, and
   small ones exactly. Sets that are linked already are not compared again. A cluster
   that one task should not hold is split by its pivots over many tasks first, and a
   region that pivots can't split is compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema, let_go, same, set_apart, text_batches
from tenura.llm.components import Forest, components
from tenura.llm.shingles import mix, shingle_sets
from tenura.session import settle

#: Bytes of text that are hashed at a time.
BATCH = 2_000_000
#: Differing shingles below which sets go by prefixes.
SHORT = 8
#: Small regions are compared directly.
LEAF_SETS = 512
PIVOTS = 8
#: Shingles that one task may hold of a cluster.
TASK_SHINGLES = 4_000_000
#: Sets in a block where pivots don't help.
BLOCK_SETS = 8192
#: Clusters of more sets meet again, at most so often.
LARGE_SETS = 4096
TURNS = 4
#: Bucket keys that a task chains before they are shuffled.
CHAINED = 1_000_000
#: Bits of a digest and of a key that are shuffled: zero bytes beside each other compress away. Rows that agree by chance only add to a cluster.
CLASS = (1 << 32) - 1
KEY_BITS = -(1 << 16)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link where 100 * intersection >= ``percent`` * union."""

    words: int = 3
    percent: int = 90

    def differing(self, largest: int) -> int:
        """Most shingles that only one of two linked sets has, if neither is larger than ``largest``."""
        return (100 - self.percent) * 2 * largest // (100 + self.percent)

    def slack(self, h: int) -> tuple[int, int]:
        """Spare buckets and stretches for at most ``h`` differing shingles.

        With a lower similarity buckets are smaller, and more of them are weak.
        """
        if h < 4:
            return 0, 1
        return (2, 1) if self.percent >= 87 else (4 + h // 5, 1 + 6 * h // 100)

    def largest_partner(self, size: np.ndarray) -> np.ndarray:
        return size * 100 // self.percent

    def classes(self, largest: int) -> np.ndarray:
        """Lower ends of size classes; a partner is in the same class or in the next."""
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, -(-edges[-1] * max(125, -(-10000 // self.percent)) // 100)))
        return np.array(edges)


    def overlap(self, size: np.ndarray | int) -> np.ndarray | int:
        """Least shingles that a set of ``size`` shares with a linked one."""
        return -(-self.percent * size // 100)

    def short(self) -> int:
        """Largest set that goes by its prefix: linked sets as short differ in under ``SHORT`` shingles."""
        if not 50 < self.percent < 100:
            return 0  # two shingles in common are not certain, or only equal sets are linked
        size = 1
        while self.differing((size + 1) * 100 // self.percent) < SHORT:
            size += 1
        return size


# --- signatures: which sets may be linked ------------------------------------------


@lru_cache(maxsize=256)
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def prefix_keys(spread: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of the pairs of a short set's first shingles in the order of their hashes.

    A linked set shares o shingles at least. The first two that both have come, in this set of n,
    before the last o - 2 of them, so among its first n - o + 2, and so in the other's: the
    pair is a key of both. Each key stands for two shingles, so one common phrase ties nothing together.
    """
    first = np.sort(spread)[: len(spread) - rule.overlap(len(spread)) + 2]
    a, b = _pairs(len(first))
    with np.errstate(over="ignore"):
        return mix(first[a] * np.uint64(0xD1342543DE82EF95) + first[b], 23)


def bucket_keys(sets: list[np.ndarray], rule: Rule, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A key per set, size class and bucket, and the set's number. Each turn has other buckets and prefixes.

    Sets in a class have m = H + 1 + spare buckets, so two linked sets agree in
    spare + 1 buckets at least, and if they agree in a full one (of two shingles or
    more), its key is with both. Else they agree in weak ones only, of one shingle or
    none, whose keys would tie texts together that share a common shingle. A set with
    at most ``spare`` weak buckets can't be in that case. Of others, a set with at most
    spare - B empty buckets agrees in B + 1 buckets of one shingle, so in two of them in
    one of B stretches of buckets: keys of two such buckets of a stretch stand for
    them. Only sets with still more empty buckets give the keys of weak ones, too.
    Short sets give the keys of their prefixes instead, and so do sets that a short one may be linked with, beside their own.
    """
    short = rule.short()
    sizes = np.array([len(s) for s in sets], np.int64)
    keys, owners = [], []
    if not sizes.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edges = rule.classes(int(rule.largest_partner(sizes.max())) + 1)
    home = np.searchsorted(edges, sizes, "right") - 1
    reach = np.searchsorted(edges, rule.largest_partner(sizes), "right") - 1
    for i, s in enumerate(sets):
        if not len(s):
            continue
        spread = mix(s, 3 + 64 * turn)
        if rule.overlap(len(s)) <= short:
            if rule.differing(int(rule.largest_partner(len(s)))):
                key = prefix_keys(spread, rule)
                keys.append(key)
                owners.append(np.full(len(key), i))
            if len(s) <= short:
                continue
        for c in range(home[i], reach[i] + 1):
            h = rule.differing(int(edges[c + 1]) - 1)
            if not h:
                continue  # only equal sets are linked here
            spare, stretches = rule.slack(h)
            m = h + 1 + spare
            bucket = (spread % np.uint64(m)).astype(np.int64)
            content = np.zeros(m, np.uint64)
            with np.errstate(over="ignore"):
                np.add.at(content, bucket, spread)
                key = mix(content + np.arange(m, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), int(c) + 100)
            count = np.bincount(bucket, minlength=m)
            full = count > 1
            given = [key[full]]
            if m - full.sum() > spare:
                one = np.flatnonzero(count == 1)
                stretch = one * stretches // m
                for gap in range(1, len(one)):
                    together = stretch[gap:] == stretch[:-gap]
                    if not together.any():
                        break
                    with np.errstate(over="ignore"):
                        given.append(mix(key[one[:-gap][together]] * np.uint64(0xD1342543DE82EF95) + key[one[gap:][together]], 17))
                if m - full.sum() - len(one) > spare - stretches:
                    given.append(key[~full])
            key = np.concatenate(given)
            keys.append(key)
            owners.append(np.full(len(key), i))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _digests(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Two 64-bit digests of each set."""
    out = ([], [])
    with np.errstate(over="ignore"):
        for s in sets:
            for k in (0, 1):
                out[k].append(int(mix(s, 7 + k).sum(dtype=np.uint64).astype(np.int64)))
    return out


def document_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, s1, s2 and weight (shingles, or eighths of the text's bytes if those are more) of every row, written once."""
    columns = "doc_id long, n_shingles long, s1 long, s2 long, weight long"
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text", BATCH):
            sets = shingle_sets(frame.column("text"), rule.words)
            s1, s2 = _digests(sets)
            sizes = [len(s) for s in sets]
            weights = [max(n, b // 8) for n, b in zip(sizes, pc.fill_null(pc.binary_length(frame.column("text")), 0).to_pylist(), strict=True)]
            arrays = [frame.column("doc_id"), *[pa.array(x, pa.int64()) for x in (sizes, s1, s2, weights)]]
            yield pa.RecordBatch.from_arrays(arrays, schema=shape)

    return settle(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, columns))


def chained(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer rows of key and id that tie the same ids together: one per key, and two per link of a chain of ids.

    The ids that agree in keys here hang on the smallest of each key. What hangs together
    becomes one chain, and a key of its own for each link of it.
    """
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    start = ids[first][np.cumsum(first) - 1]
    more = ids != start
    forest = Forest()
    for a, b in set(zip(start[more].tolist(), ids[more].tolist(), strict=True)):
        forest.unite(a, b)
    members = sorted((forest.root(x), x) for x in {*forest.parent, *forest.parent.values()})
    links = [(x, y) for (p, x), (q, y) in zip(members, members[1:], strict=False) if p == q]
    a, b = (np.array([link[i] for link in links], np.int64) for i in (0, 1))
    with np.errstate(over="ignore"):
        own = mix(mix(a.astype(np.uint64), 41) + b.astype(np.uint64), 42).astype(np.int64)
    return np.concatenate([keys[first], own, own]), np.concatenate([ids[first], a, b])


_KEY = "key long, doc_id long"


def _reduced(given: Iterator[tuple[np.ndarray, np.ndarray]], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Keys and ids, chained so many at a time that a key of very many sets leaves a task once per ``CHAINED`` keys."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        keys, ids = chained(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(keys & np.int64(KEY_BITS)), pa.array(ids)], schema=shape)

    for keys, ids in given:
        if len(keys):
            held.append((keys.astype(np.int64), ids))
            size += len(keys)
        if size >= CHAINED:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _met(rows: DataFrame) -> DataFrame:
    """a, b: the ids of a key as a chain."""
    before = F.lag("doc_id").over(Window.partitionBy("key").orderBy("doc_id"))
    return rows.select(before.alias("a"), F.col("doc_id").alias("b"), "key").filter("a is not null and a < b").select("a", "b")


def meeting_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """a, b: chains of sets, by the ``CLASS`` bits of their first digests, that agree in a bucket. Copies don't meet."""
    shape = arrow_schema(_KEY)

    def given(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        done: set[tuple[int, int]] = set()
        for frame in text_batches(frames, "text", BATCH):
            sets = shingle_sets(frame.column("text"), rule.words)
            digests = list(zip(*_digests(sets), strict=True))
            # copies within a task would only repeat each other's keys
            new = []
            for i, d in enumerate(digests):
                if d not in done:
                    done.add(d)
                    new.append(i)
            if len(done) > 1_000_000:
                done.clear()
            keys, owners = bucket_keys([sets[i] for i in new], rule)
            yield keys, np.array([digests[i][0] & CLASS for i in new], np.int64)[owners]

    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")
    return _met(rows.mapInArrow(lambda frames: _reduced(given(frames), shape), _KEY))


def meeting_again(members: DataFrame, rule: Rule, turn: int) -> DataFrame:
    """a, b: chains of ids of a region whose sets agree in a bucket of this turn."""
    shape = arrow_schema(_KEY)

    def given(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for frame in text_batches(frames, "shingles"):
            ids, sets = _decoded(frame)
            keys, owners = bucket_keys(sets, rule, turn)
            region = frame.column("region").to_numpy().astype(np.uint64)
            with np.errstate(over="ignore"):
                yield mix(keys + mix(region, 51)[owners], 52), np.array(ids, np.int64)[owners]

    rows = members.select("region", "doc_id", "shingles")
    return _met(rows.mapInArrow(lambda frames: _reduced(given(frames), shape), _KEY))


def refined(members: DataFrame, rule: Rule, most: int) -> DataFrame:
    """``members`` with large regions taken apart.

    Linked sets agree in a bucket by any hashes, unrelated ones that share a few common
    shingles seldom do so again. Sets that meet nobody any more have no link and leave; a
    region that hardly gets smaller stays as it is.
    """
    kept: list[DataFrame] = []
    for turn in range(1, TURNS + 1):
        sizes = _sizes(members).filter((F.col("sets") > LARGE_SETS) | (F.col("weight") > most))
        large = settle(sizes.select("region", F.col("sets").alias("before")))
        if not large.head(1):
            break
        work = members.join(large, "region")
        roots = components(meeting_again(work, rule, turn).distinct()).select(F.col("node").alias("doc_id"), F.col("root").alias("part"))
        parts = settle(work.join(roots.hint("merge"), "doc_id").select(F.col("part").alias("region"), "doc_id", "n", "shingles", "before"))
        sizes = parts.groupBy("region").agg(F.count(F.lit(1)).alias("now"), F.max("before").alias("before"))
        firm = settle(sizes.filter("now > 0.9 * before").select("region"))
        parts = parts.drop("before")
        kept += [members.join(large, "region", "left_anti"), parts.join(firm, "region", "left_semi")]
        members = parts.join(firm, "region", "left_anti")
    for more in kept:
        members = members.unionByName(more)
    return members


# --- inside a cluster ---------------------------------------------------------------


class Sets:
    """Sets of a cluster, their sizes, and what is linked so far."""

    def __init__(self, sets: list[np.ndarray], rule: Rule):
        self.sets, self.rule = sets, rule
        self.size = np.array([len(s) for s in sets], np.int64)
        self.all = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.forest = Forest()

    def linked(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * both >= self.rule.percent * (a + b - both)

    def with_one(self, p: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Shingles that each member shares with one set."""
        data = self.all if len(members) == len(self.sets) else np.concatenate([self.sets[i] for i in members])
        at = np.searchsorted(p, data)
        at[at == len(p)] = 0
        hit = np.concatenate([[0], np.cumsum(p[at] == data)])
        ends = np.cumsum(self.size[members])
        return hit[ends] - hit[ends - self.size[members]]

    def roots(self, members: np.ndarray) -> np.ndarray:
        return np.array([self.forest.root(int(i)) for i in members], np.int64)

    def compare(self, rows: np.ndarray, columns: np.ndarray) -> None:
        """Links every linked pair of the two groups that isn't linked already."""
        left, right = self.roots(rows), self.roots(columns)
        if len(np.unique(np.concatenate([left, right]))) < 2:
            return
        group = np.concatenate([rows, columns])
        data = np.concatenate([self.sets[i] for i in group])
        owner = np.repeat(np.arange(len(group)), self.size[group])
        names, column = np.unique(data, return_inverse=True)
        counts = np.bincount(column)
        shared = np.zeros((len(rows), len(columns)), np.float32)
        side = owner < len(rows)
        often = np.flatnonzero(counts > 8)
        for a in range(0, len(often), 2048):
            place = np.full(len(names), -1)
            part = often[a : a + 2048]
            place[part] = np.arange(len(part))
            at = place[column]
            x = np.zeros((len(rows), len(part)), np.float32)
            y = np.zeros((len(columns), len(part)), np.float32)
            x[owner[side & (at >= 0)], at[side & (at >= 0)]] = 1
            y[owner[~side & (at >= 0)] - len(rows), at[~side & (at >= 0)]] = 1
            shared += x @ y.T
        seldom = (counts[column] <= 8) & (counts[column] > 1)
        order = np.argsort(column[seldom], kind="stable")
        c, o = column[seldom][order], owner[seldom][order]
        for gap in range(1, 8):  # pairs of one shingle's holders, by their distance in its list
            near = c[gap:] == c[:-gap]
            p, q = o[:-gap][near], o[gap:][near]
            cross = (p < len(rows)) & (q >= len(rows))
            np.add.at(shared, (p[cross], q[cross] - len(rows)), 1)
        hit = self.linked(shared.astype(np.int64), self.size[rows][:, None], self.size[columns][None, :]) & (left[:, None] != right[None, :])
        for i, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
            self.forest.unite(int(rows[i]), int(columns[j]))

    def join(self, members: np.ndarray, depth: int = 0) -> None:
        """Links all linked pairs among the members."""
        if len(np.unique(self.roots(members))) < 2:
            return
        if len(members) > LEAF_SETS:
            regions = self.regions(members)
            if max(map(len, regions)) <= 0.8 * len(members):
                for region in regions:
                    self.join(region, depth + 1)
                return
        blocks = [members[i : i + LEAF_SETS] for i in range(0, len(members), LEAF_SETS)]
        for i, a in enumerate(blocks):
            for b in blocks[i:]:
                self.compare(a, b)

    def regions(self, members: np.ndarray) -> list[np.ndarray]:
        """Voronoi regions of pivots far from each other, with windows of twice the threshold."""
        distances, pivot = [], int(members[0])
        farthest = np.full(len(members), np.inf)
        for _ in range(PIVOTS):
            both = self.with_one(self.sets[pivot], members)
            union = self.size[members] + self.size[pivot] - both
            for i in members[self.linked(both, self.size[members], self.size[pivot])].tolist():
                self.forest.unite(pivot, i)
            distances.append(1 - both / np.maximum(union, 1))
            farthest = np.minimum(farthest, distances[-1])
            if farthest.max() <= 0:
                break
            pivot = int(members[int(farthest.argmax())])
        window = 2 * (1 - self.rule.percent / 100) + 1e-9
        near = np.stack(distances)
        return [members[row <= near.min(axis=0) + window] for row in near]


def cluster_links(ids: list[int], sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links that join the linked ids of a cluster; repeated ids are linked by themselves."""
    held = Sets(sets, rule)
    held.join(np.flatnonzero(held.size > 0))
    return [(ids[i], ids[held.forest.root(i)]) for i in range(len(ids)) if held.forest.root(i) != i]


# --- clusters over tasks ---------------------------------------------------------------

_MEMBER = "region long, doc_id long, n long, shingles binary"
_LINK = "a long, b long"


def _decoded(table: pa.Table | pa.RecordBatch) -> tuple[list[int], list[np.ndarray]]:
    return table.column("doc_id").to_pylist(), [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]


def joined(members: DataFrame, rule: Rule) -> DataFrame:
    """Links of regions that a task may hold."""
    shape = arrow_schema(_LINK)

    def task(table: pa.Table) -> pa.Table:
        ids, sets = _decoded(table.sort_by([("doc_id", "ascending")]))
        links = cluster_links(ids, sets, rule)
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=shape)

    return members.groupBy("region").applyInArrow(task, _LINK)


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("region").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("sets"))


def split_large(members: DataFrame, rule: Rule, most: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Splits regions of more than ``most`` shingles by pivots over many tasks.

    Returns the regions small enough to join, those that pivots can't split, and the
    links with pivots found on the way. Where to go is decided by ids and sizes; the shingles follow only
    into regions that are open, and a region that pivots can't split stays whole, once.
    """
    links: list[DataFrame] = []
    stuck: list[DataFrame] = []
    small: list[DataFrame] = []
    for turn in range(8):
        sizes = settle(_sizes(members))
        large = sizes.filter(F.col("weight") > most).select("region", "weight", "sets")
        if not large.head(1):
            small.append(members)
            members = None
            break
        small.append(members.join(large, "region", "left_anti"))
        work = settle(members.join(large, "region"))
        order = Window.partitionBy("region").orderBy(F.xxhash64(F.lit(turn), "doc_id"), "doc_id")
        picked = work.select("region", "doc_id").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= PIVOTS)
        # members of a region go to as many tasks as its size asks for; its few pivots go to each
        salts = F.ceil(F.col("weight") / most).cast("long") + 1
        spread = work.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts))
        centres = settle(work.join(picked, ["region", "doc_id"]))
        pivots = centres.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        window = 2 * (1 - rule.percent / 100) + 1e-9
        columns = "region long, doc_id long, n long, parent long, a long"
        shape = arrow_schema(columns)

        def assign(left: pa.Table, right: pa.Table) -> pa.Table:
            ids, sets = _decoded(left)
            names, centres = _decoded(right.sort_by([("r", "ascending")]))
            held = Sets(sets, rule)
            group = np.arange(len(sets))
            near, ball = [], np.full(len(sets), -1)
            for k, centre in enumerate(centres):
                both = held.with_one(centre, group)
                near.append(1 - both / np.maximum(held.size[group] + len(centre) - both, 1))
                ball[(ball < 0) & held.linked(both, held.size[group], np.int64(len(centre)))] = k
            near = np.stack(near)
            hit, member = np.nonzero(near <= near.min(axis=0) + window)
            parent = left.column("region")[0].as_py() if len(left) else 0
            regions = mix(np.array([parent], np.int64).astype(np.uint64) + hit.astype(np.uint64), 31 + turn).astype(np.int64)
            return pa.table([
                pa.array(regions), pa.array([ids[i] for i in member], pa.int64()), pa.array(held.size[member]), pa.array(np.full(len(member), parent)),
                pa.array([names[ball[i]] if ball[i] >= 0 else None for i in member], pa.int64()),
            ], schema=shape)

        moved = settle(
            spread.groupBy("region", "salt").cogroup(pivots.groupBy("region", "salt")).applyInArrow(assign, columns)
        )
        links.append(moved.filter("a is not null").select("a", F.col("doc_id").alias("b")))
        # a region in which all hang on one pivot has nothing left to find
        child = moved.groupBy("region", "parent").agg(
            F.sum("n").alias("now"), F.count(F.lit(1)).alias("held"), F.count("a").alias("tied"), F.min("a").alias("low"), F.max("a").alias("high")
        )
        child = child.join(large.select(F.col("region").alias("parent"), "sets"), "parent")
        open_ = settle(child.filter("not (tied = held and low = high)").withColumn("same", F.col("held") > 0.8 * F.col("sets")))
        whole = settle(open_.filter(F.col("same") & (F.col("now") > most)).select(F.col("parent").alias("region")).distinct())
        stuck.append(work.join(whole, "region", "left_semi").select("region", "doc_id", "n", "shingles"))
        going = moved.select("region", "parent", "doc_id").distinct().join(open_.select("region", "parent"), ["region", "parent"])
        going = going.join(whole.withColumnRenamed("region", "parent"), "parent", "left_anti")
        texts = work.select(F.col("region").alias("parent"), "doc_id", "n", "shingles")
        members = settle(texts.join(going.hint("merge"), ["parent", "doc_id"]).select("region", "doc_id", "n", "shingles"))
    if members is not None:
        stuck.append(members)
    empty = small[0].limit(0)
    stuck_all = empty
    for s in stuck:
        stuck_all = stuck_all.unionByName(s)
    small_all = small[0]
    for s in small[1:]:
        small_all = small_all.unionByName(s)
    return small_all, stuck_all, links


def blockwise(members: DataFrame, rule: Rule, most: int = TASK_SHINGLES) -> DataFrame:
    """Links of regions that pivots can't split: blocks of bounded size against blocks, each pair of blocks a task.

    Each set is copied once per block of its region, so blocks are as large as a task may hold two of.
    """
    shape = arrow_schema(_LINK)
    blocks = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, 2 * F.col("weight") / most)).cast("long")
    sizes = _sizes(members).select("region", blocks.alias("blocks"))
    placed = members.join(sizes, "region").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks"))
    last = F.col("blocks") - 1
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    met = placed.withColumn("pair", F.explode(pairs)).select("region", "pair.i", "pair.j", "block", "doc_id", "n", "shingles")

    def task(table: pa.Table) -> pa.Table:
        ids, sets = _decoded(table)
        held = Sets(sets, rule)
        block = np.array(table.column("block").to_pylist())
        low = table.column("i")[0].as_py()
        rows, columns = np.flatnonzero(block == low), np.flatnonzero(block != low)
        for a in range(0, len(rows), LEAF_SETS):
            other = columns if len(columns) else rows
            for b in range(0, len(other), LEAF_SETS):
                held.compare(rows[a : a + LEAF_SETS], other[b : b + LEAF_SETS])
        links = [(ids[i], ids[held.forest.root(i)]) for i in range(len(ids)) if held.forest.root(i) != i]
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=shape)

    return met.groupBy("region", "i", "j").applyInArrow(task, _LINK)


def joined_texts(docs: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """Links of clusters that a task may hold. Their texts travel, which compress; shingles don't."""
    shape = arrow_schema(_LINK)

    def task(table: pa.Table) -> pa.Table:
        ids, sets = [], []
        for frame in text_batches(table.sort_by([("doc_id", "ascending")]).to_batches(), "text", BATCH):
            ids += frame.column("doc_id").to_pylist()
            sets += shingle_sets(frame.column("text"), rule.words)
        links = cluster_links(ids, sets, rule)
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=shape)

    return _member_texts(docs, clusters).groupBy("region").applyInArrow(task, _LINK)


def _member_texts(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """region, doc_id, text of clustered ids, which grow with the corpus: the same shuffle join at every size."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(clusters.hint("merge"), "doc_id").select("region", "doc_id", "text")


def member_sets(docs: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """The sets of clustered ids: region, doc_id, n, shingles. Texts meet their ids, one row each."""
    columns = _MEMBER
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text", BATCH):
            sets = shingle_sets(frame.column("text"), rule.words)
            yield pa.RecordBatch.from_arrays([
                frame.column("region"), frame.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ], schema=shape)

    return _member_texts(docs, clusters).mapInArrow(task, columns)


def linked_documents(docs: DataFrame, rule: Rule | None = None, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Words are what stands between white space (space and code points 9 to 13), A-Z
    lower-cased. Two rows are linked by the rule; the component is the smallest id
    reachable by links. A text without words has no shingles and no link. A null id has
    no link and a null component. Rows that repeat an id are one node, each with its own
    count. An empty table gives no row; other columns are not read.
    """
    rule = rule or Rule()
    known = document_sets(docs, rule)
    filled = known.filter("n_shingles > 0 and doc_id is not null")
    classes = settle(filled.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    key = ["s1", "s2", "n_shingles"]
    copies = settle(filled.join(classes.filter("copies > 1").select(*key, "first"), key).select("doc_id", "first").filter("doc_id > first").distinct())
    # the first id stands for a class
    names = classes.select(F.col("s1").bitwiseAND(F.lit(CLASS)).alias("a"), F.col("first").alias("fa"))
    a, b = names, names.toDF("b", "fb")
    edges = settle(meeting_sets(docs, rule).distinct().join(a, "a").join(b, "b").select(F.col("fa").alias("a"), F.col("fb").alias("b")).filter("a <> b"))
    clusters = components(edges).select(F.col("node").alias("doc_id"), F.col("root").alias("region"))
    weights = clusters.join(filled.select("doc_id", "weight"), "doc_id").groupBy("region").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("sets"))
    large = settle(weights.filter((F.col("sets") > LARGE_SETS) | (F.col("weight") > task_shingles)).select("region"))
    let_go(docs.sparkSession)
    found = joined_texts(docs, clusters.join(large, "region", "left_anti"), rule)
    if large.head(1):
        members = settle(member_sets(docs, clusters.join(large, "region", "left_semi"), rule))
        let_go(docs.sparkSession)
        small, stuck, links = split_large(refined(members, rule, task_shingles), rule, task_shingles)
        found = found.unionByName(joined(small, rule)).unionByName(blockwise(stuck, rule, task_shingles))
        for more in links:
            found = found.unionByName(more)
    graph = settle(found.unionByName(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))))
    nodes = components(graph)
    roots = nodes.select(F.col("node").alias("_node"), "root")
    return known.join(roots, same(known["doc_id"], F.col("_node")), "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def first_of_groups(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """The rows of ``docs`` that stand for their groups of linked texts: those with the smallest id.

    Texts without words and rows without an id stay. Of rows that repeat an id one stays.
    Other columns may have any name.
    """
    names, docs = docs.columns, set_apart(docs, ["__first"])
    found = linked_documents(docs, rule)
    firsts = found.filter("doc_id is not null and component_id = doc_id").select(F.col("doc_id").alias("__first")).distinct()
    known = docs.filter("doc_id is not null")
    kept = known.join(firsts, known["doc_id"] == F.col("__first"), "left_semi")
    if known.groupBy("doc_id").count().filter("count > 1").head(1):
        kept = kept.dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id is null")).toDF(*names)
