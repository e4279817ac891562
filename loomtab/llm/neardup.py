"""Near-duplicate detection by a chosen-path set similarity join.

A document's set is its distinct five-word shingles (`textops.shingles`). Documents are linked when the Jaccard
similarity of their sets is at least 0.75; the classes are the connected components of the links.

1. Every document gets COORDINATES minwise values of its set. Documents with equal sets are one class from here on.
2. Independent trees: a node chooses one or (one time in three) two coordinates and sends each of its members to the
   child that the member's minwise value there names; that is 1 / 0.75 children on average, so a pair at the threshold
   keeps meeting on some path. Nodes of one member end. Small nodes are compared exhaustively. Large nodes are
   thinned (members similar to a leader are tied to it, and leave unless the triangle inequality of the distance lets
   them be linked to an untied member) and branch again; at the last level what is left of a large node is tied
   together. The number of trees follows from the recall wanted of a pair at the threshold.
3. The ties only say what may belong together. Their connected components are groups; in each group links are confirmed
   on the full sets. Groups too large for one task are split first: with shingles ordered from rare to common, linked
   sets share one among their first quarter, so members that share none there part. What is still too large is resolved
   by rounds against batches of leaders: leaders leave, and members linked to one leave too, except those that the
   triangle inequality of the Jaccard distance cannot rule out as partners of the others.

Nothing emits all pairs of a group: a node or group of n members gives at most n - 1 ties or links.

Defined cases: null or empty texts and those without words have the empty set and are linked with nothing; repeated rows
are copies; rows that share a doc_id are one document, of all their texts' links; rows without doc_id are left alone
(component null, kept); an empty table gives no rows; texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, textops
from .components import connected

NUMERATOR, DENOMINATOR = 75, 100
COORDINATES = 64
RECALL, DEPTH = 0.9999, 3
#: Nodes of more members branch, smaller ones are compared exhaustively.
NODE_MAX = 256
#: Estimated similarity from which two members are tied; about 4.6 standard errors below the threshold.
TIE = 0.5
#: In a large node members are tied to one leader from this similarity on: copies of one original are less like each other
#: than like it, and the leader is but one of them. Ties only widen the groups in which links are confirmed.
LARGE_TIE = 0.3
#: Allowance for the errors of two estimated distances, about twice the standard error of each.
SLACK = 0.125
#: Shingles of a group that one task holds (8 bytes each); larger groups are resolved by rounds.
GROUP_SHINGLES = 2_000_000
#: Shingles of a group's leaders in one round, about; a task holds them beside the members of one deal.
LEADER_SHINGLES = 500_000


def trees(recall: float = RECALL, similarity: float = NUMERATOR / DENOMINATOR, depth: int = DEPTH) -> int:
    """Trees after which a pair of this similarity has met with this probability, though each path is `depth` levels long."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - similarity * p) * (1 - similarity * p / 3)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _choices(n: int) -> list[tuple[int, int]]:
    """(tree, coordinate) of the roots."""
    rng = np.random.default_rng(7)
    out = []
    for t in range(n):
        some = rng.choice(COORDINATES, 2, replace=False).tolist()
        out += [(t, c) for c in some[: 1 + (rng.random() < 1 / 3)]]
    return out


def _multipliers() -> np.ndarray:
    rng = np.random.default_rng(11)
    return rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minwise(hashes: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least of the set under each coordinate's permutation of 64-bit values."""
    out = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 4096):
        np.minimum(out, (hashes[None, a : a + 4096] * multipliers[:, None]).min(1), out=out)
    return out


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, signature, nodes); digest, signature and nodes are null for the empty set."""
    common.prepare(docs.sparkSession)
    roots = _choices(trees())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers()
        coordinate = np.array([c for _, c in roots])
        salt = textops.mix(np.array([(t << 8 | c) + 1 for t, c in roots], np.uint64))
        for batch in batches:
            sizes, digests, signatures, nodes = [], [], [], []
            for h in textops.shingles(common.text_bytes(batch.column(1))):
                sizes.append(len(h))
                if not len(h):
                    digests.append(None)
                    signatures.append(None)
                    nodes.append(None)
                    continue
                least = minwise(h, multipliers)
                digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                signatures.append((textops.mix(least) >> np.uint64(56)).astype(np.uint8).tobytes())
                nodes.append(textops.mix(least[coordinate] ^ salt).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "signature", "nodes"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary, nodes array<long>")


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """The edges of a spanning forest of a symmetric boolean matrix."""
    n, out = len(linked), []
    left = np.ones(n, bool)
    for root in range(n):
        if not left[root]:
            continue
        left[root], todo = False, [root]
        while todo and left.any():
            i = todo.pop()
            near = np.flatnonzero(linked[i] & left)
            left[near] = False
            todo += near.tolist()
            out += [(i, j) for j in near.tolist()]
    return out


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Regroup batches sorted by their first column, so that no key is cut; a key's rows are bounded by the caller's plan."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        keys = t.column(0).to_numpy()
        if not len(keys):
            continue
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield t.slice(0, cut).combine_chunks()
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _similarity(equal: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from equal bytes: unequal values share a byte once in 256."""
    return (equal / COORDINATES - 1 / 256) / (1 - 1 / 256)


def _compare_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in runs of (node, id, signature): ties of a spanning forest of each node."""
    for t in _by_key(batches):
        keys, ids, sig = t.column(0).to_numpy(), t.column(1).to_numpy(), _signatures(t.column(2))
        a, b = [], []
        for i, j in _runs(keys):
            if j - i == 2:
                if _similarity((sig[i] == sig[i + 1]).sum()) >= TIE:
                    a.append(ids[i])
                    b.append(ids[i + 1])
            elif j - i > 2:
                own = sig[i:j]
                linked = np.stack([_similarity((own == row).sum(1)) >= TIE for row in own])
                for x, y in _forest(linked):
                    a.append(ids[i + x])
                    b.append(ids[i + y])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, id, signature, leader, leader's signature) with the estimated similarity to the leader."""
    for batch in batches:
        if not batch.num_rows:
            continue
        s = _similarity((_signatures(batch.column(2)) == _signatures(batch.column(4))).sum(1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(s)], ["node", "id", "signature", "leader", "similarity"])


def ties(classes: DataFrame) -> DataFrame:
    """(a, b): pairs of class ids whose components contain every linked pair that met in a tree. classes: (id, signature, nodes)."""
    found: list[DataFrame] = []
    made: list[DataFrame] = []
    level = classes.select(F.explode("nodes").alias("node"), "id", "signature")
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("node").agg(F.count("*").alias("size"), F.min(F.struct("id", "signature")).alias("leader")).where("size > 1")
        crowd = common.stored(level.join(sizes, "node"), f"level{depth}")
        made.append(crowd)
        small = crowd.where(F.col("size") <= NODE_MAX).select("node", "id", "signature")
        width = common.width(level.sparkSession)
        found.append(small.repartition(width, "node").sortWithinPartitions("node", "id").mapInArrow(_compare_small, "a long, b long"))
        large = crowd.where(F.col("size") > NODE_MAX).select("node", "id", "signature", F.col("leader.id").alias("leader"), F.col("leader.signature").alias("of_leader"))
        if not large.take(1):
            break
        if depth == DEPTH:
            found.append(large.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")))
            break
        thinned = common.stored(large.mapInArrow(_thin, "node long, id long, signature binary, leader long, similarity double"), f"thin{depth}")
        made.append(thinned)
        near = F.col("similarity") >= LARGE_TIE
        found.append(thinned.where(near & F.expr("id <> leader")).select(F.col("leader").alias("a"), F.col("id").alias("b")))
        # a tied member is needed further only if an untied one could be linked to it; nodes without untied members are done
        untied = thinned.where(~near).groupBy("node").agg(F.max("similarity").alias("nearest"))
        reach = F.col("nearest") + (1 - NUMERATOR / DENOMINATOR + SLACK)
        level = thinned.join(untied, "node").where(~near | (F.col("similarity") < reach)).select(F.explode(_children()).alias("node"), "id", "signature").where("node is not null")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    out = common.stored(out.distinct(), "ties")
    common.drop(*made)
    return out


def _children():
    """A node's children: one coordinate drawn from the node itself, and a second one time in three."""

    def child(nth: int):
        coordinate = F.pmod(F.xxhash64("node", F.lit(nth)), F.lit(COORDINATES)).cast("int")
        return F.xxhash64("node", coordinate, F.substring("signature", coordinate + 1, F.lit(1)))

    return F.array(child(1), F.when(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(3)) == 0, child(2)))


def _linked(common_size, a, b):
    """100 * intersection >= 75 * union, on whole numbers."""
    return DENOMINATOR * common_size >= NUMERATOR * (a + b - common_size)


def resolve_group(sets: list[np.ndarray]) -> np.ndarray:
    """For each set of a group, the least index of its component under confirmed links.

    Members are visited from one another. Linked sets of a elements share at least 0.75 a, so with rare elements first their first common
    one is among the first a - ceil(0.75 a) + 1 of either (as in `_split`): only unvisited members that share such an element are
    compared, on their whole sets: one by one, or through the postings of all elements where that is less work. Pages that share
    a template but no links do not meet.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    root, left = np.arange(n), np.ones(n, bool)
    _, element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(count, kind="stable")
    rarity = np.empty(len(count), np.int64)
    rarity[order] = np.arange(len(count))
    count = count[order]
    small = np.int32 if max(len(element), n) < 1 << 31 else np.int64  # a task holds several of these arrays
    start = np.concatenate(([0], np.cumsum(sizes)))
    key = np.repeat(np.arange(n) * len(count), sizes) + rarity[element]  # by set, rare elements first
    del element, rarity
    key.sort()
    owner, ranked = (key // len(count)).astype(small), (key % len(count)).astype(small)
    del key
    heads = np.minimum(sizes, sizes - -(-sizes * NUMERATOR // DENOMINATOR) + 1)
    is_head = np.arange(len(ranked)) - start[owner] < heads[owner]

    def postings(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = ranked[of]
        return owner[of][np.argsort(at, kind="stable")], np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(count))))).astype(small)

    rest = listed = n
    posting, bounds = postings(is_head)
    every = ends = None  # of all elements; made only if they are needed
    mine = np.zeros(len(count), bool)
    for first in range(n):
        if not left[first]:
            continue
        left[first], todo, rest = False, [first], rest - 1
        while todo and rest:
            if 2 * rest < listed:  # those that are settled leave the postings
                listed, every = rest, None
                posting, bounds = postings(is_head & left[owner])
            i = todo.pop()
            own = ranked[start[i] : start[i + 1]]
            met = np.unique(posting[_stretches(bounds[own[: heads[i]]], bounds[own[: heads[i]] + 1])])
            met = met[left[met] & (DENOMINATOR * np.minimum(sizes[met], sizes[i]) >= NUMERATOR * np.maximum(sizes[met], sizes[i]))]
            if not len(met):
                continue
            if int(sizes[met].sum()) > n + int(count[own].sum()):
                every, ends = (every, ends) if every is not None else postings(left[owner])
                shared = np.bincount(every[_stretches(ends[own], ends[own + 1])], minlength=n)[met]
            else:
                mine[own] = True
                shared = np.add.reduceat(mine[ranked[_stretches(start[met], start[met + 1])]], np.concatenate(([0], np.cumsum(sizes[met])[:-1])), dtype=np.int64)
                mine[own] = False
            near = met[_linked(shared, sizes[i], sizes[met])]
            left[near], rest = False, rest - len(near)
            root[near] = first
            todo += near.tolist()
    return root


def _stretches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The whole numbers from each a to before its b, one stretch after the other."""
    a, size = a.astype(np.int64), (b - a).astype(np.int64)
    ends = np.cumsum(size)
    return np.repeat(a - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups in runs of (group, id, text): the root of each id."""
    for t in _by_key(batches):
        keys, ids, texts = t.column(0).to_numpy(), t.column(1).to_numpy(), t.column(2).to_pylist()
        out_a, out_b = [], []
        for i, j in _runs(keys):
            sets = textops.shingles([(x or "").encode() for x in texts[i:j]])
            root = resolve_group(sets)
            for k in range(j - i):
                if ids[i + root[k]] != ids[i + k]:
                    out_a.append(ids[i + root[k]])
                    out_b.append(ids[i + k])
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, id, text, row) to (group, id, row, size, element) for each shingle of the set."""
    for batch in batches:
        sets = textops.shingles(common.text_bytes(batch.column(2)))
        sizes = np.array([len(x) for x in sets], np.int64)
        at = np.repeat(np.arange(len(sets)), sizes)
        element = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at)) for c in (0, 1, 3)), pa.array(sizes[at]), pa.array(element)], ["group", "id", "row", "size", "element"])


def _split(large: DataFrame) -> DataFrame:
    """large (group, id, text, n_shingles, row) in new groups that hold every link of the old ones; ids without partners are dropped.

    Linked sets of a and b elements share at least 0.75 a and 0.75 b. So in any one order of the elements, their first
    common one is among the first a - ceil(0.75 a) + 1 of the one set and the like of the other. Rare elements come first,
    so what very many members share counts only for those that have little else.
    """
    elements = common.stored(large.select("group", "id", "text", "row").mapInArrow(_elements, "group long, id long, row long, size long, element long"), "elements")
    often = elements.groupBy("group", "element").agg(F.count("*").alias("n")).where("n > 1")
    shared = common.stored(elements.join(often, ["group", "element"]), "shared")
    # elements of no other member come first of all
    first = F.expr(f"size - (size * {NUMERATOR} + {DENOMINATOR - 1}) div {DENOMINATOR} + 1")
    counts = shared.groupBy("row", "size").agg(F.count("*").alias("common"))
    room = counts.select("row", (first - (F.col("size") - F.col("common"))).alias("room")).where("room > 0")
    place = F.row_number().over(Window.partitionBy("row").orderBy("n", "element"))
    heads = common.stored(shared.join(room, "row").withColumn("place", place).where("place <= room").select("group", "element", "id"), "heads")
    least = heads.groupBy("group", "element").agg(F.min("id").alias("a"))
    parts = connected(heads.join(least, ["group", "element"]).where("a <> id").select("a", F.col("id").alias("b")).distinct())
    common.drop(elements, shared, heads)
    return large.drop("group").join(parts.withColumnRenamed("component", "group"), "id").select("group", "id", "text", "n_shingles")


def _against_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, deal, member, id, text) in runs of group and deal, each with its leaders before its members.

    To rows (a, b) of links; (id, leader, distance) of every member, with the nearest leader it is linked to, or none; and
    (leader, distance) of the nearest member that is not linked to the leader's class.
    """
    names = ["a", "b", "id", "leader", "distance"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if k == "distance" else pa.int64()) for k, c in zip(names, cols, strict=True)], names)

    key, index = None, None
    for batch in batches:
        groups, deals, members, ids = (batch.column(i).to_pylist() for i in range(4))
        out: list[tuple] = []
        for i, own in enumerate(textops.shingles(common.text_bytes(batch.column(4)))):
            if (groups[i], deals[i]) != key:
                if index is not None:
                    out += index.nearest()
                key, index = (groups[i], deals[i]), Leaders(first=deals[i] == 0)
            if len(own):
                out += index.compare(ids[i], own) if members[i] else index.add(ids[i], own)
        yield table(out)
    if index is not None:
        yield table(index.nearest())


class Leaders:
    """The leaders of a group in one round, with their links among themselves, and the postings of their elements."""

    def __init__(self, first: bool):
        self.first = first  # only the first deal lists the links among leaders
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.root: np.ndarray | None = None

    def add(self, number: int, own: np.ndarray) -> list[tuple]:
        self.ids.append(number)
        self.sets.append(own)
        return []

    def _close(self) -> list[tuple]:
        self.root = resolve_group(self.sets)
        self.sizes = np.array([len(x) for x in self.sets])
        owner = np.repeat(np.arange(len(self.sets)), self.sizes)
        self.elements, element = np.unique(np.concatenate(self.sets), return_inverse=True)
        self.posting = owner[np.argsort(element, kind="stable")]
        self.bounds = np.concatenate(([0], np.cumsum(np.bincount(element))))
        self.near = np.full(len(self.sets), np.inf)
        self.sets = []
        if not self.first:
            return []
        return [(self.ids[r], self.ids[k], None, None, None) for k, r in enumerate(self.root.tolist()) if r != k]

    def compare(self, number: int, own: np.ndarray) -> list[tuple]:
        out = self._close() if self.root is None else []
        at = np.searchsorted(self.elements, own)
        at = at[self.elements[np.minimum(at, len(self.elements) - 1)] == own]
        counts = self.bounds[at + 1] - self.bounds[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(at) else 0
        shared = np.bincount(self.posting[np.repeat(self.bounds[at] - ends + counts, counts) + np.arange(total)], minlength=len(self.ids))
        distance = 1 - shared / (len(own) + self.sizes - shared)
        linked = np.flatnonzero(_linked(shared, len(own), self.sizes))
        classes = np.unique(self.root[linked])
        out += [(self.ids[r], number, None, None, None) for r in classes.tolist()]
        apart = ~np.isin(self.root, classes)
        self.near[apart] = np.minimum(self.near[apart], distance[apart])
        best = linked[distance[linked].argmin()] if len(linked) else None
        out.append((None, None, number, None if best is None else self.ids[best], None if best is None else float(distance[best])))
        return out

    def nearest(self) -> list[tuple]:
        out = self._close() if self.root is None else []
        return out + [(None, None, None, self.ids[k], float(d)) for k, d in enumerate(self.near.tolist()) if d < np.inf]


def _by_rounds(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links found in rounds against leaders, and the remainder once its groups are small. large: (group, id, text, n_shingles, total)."""
    spark = large.sparkSession
    links_at, rest_at = common.new_path(spark, "links"), common.new_path(spark, "rest")
    empty = large.limit(0)
    empty.select(F.col("group").alias("a"), F.col("id").alias("b")).write.mode("append").parquet(links_at)
    empty.select("group", "id", "text").write.mode("append").parquet(rest_at)
    held = work = common.stored(large, "rounds")
    nth = 0
    while work.take(1):
        nth += 1
        # leaders are drawn by hash; the least one leads in any case, so each round settles one member of a group at least
        chance = F.pmod(F.xxhash64("id", F.lit(nth)), F.lit(1 << 20)) / (1 << 20)
        least = work.groupBy("group").agg(F.min("id").alias("least"))
        dealt = work.join(least, "group").withColumn("deals", F.ceil(F.col("total") / GROUP_SHINGLES).cast("int"))
        dealt = dealt.withColumn("member", ~((chance < F.lit(LEADER_SHINGLES) / F.col("total")) | F.expr("id = least")))
        to = F.when(F.col("member"), F.array(F.pmod(F.xxhash64("id"), "deals").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("deals") - 1))
        dealt = dealt.select("group", F.explode(to).alias("deal"), "member", "id", "text")
        ordered = dealt.repartition(common.width(spark), "group", "deal").sortWithinPartitions("group", "deal", "member", "id")
        seen = common.stored(ordered.mapInArrow(_against_leaders, "a long, b long, id long, leader long, distance double"), "round")
        seen.where("a is not null").select("a", "b").write.mode("append").parquet(links_at)
        nearest = seen.where("id is null and leader is not null").groupBy("leader").agg(F.min("distance").alias("nearest"))
        slack = 1 - NUMERATOR / DENOMINATOR + 1e-9
        # a linked member is needed further only if one outside its leader's class could be linked to it
        open_ = seen.where("id is not null").join(nearest, "leader", "left").where(F.col("leader").isNull() | (F.col("distance") >= F.col("nearest") - slack)).select("id")
        after = work.drop("total").join(open_, "id", "left_semi")
        totals = after.groupBy("group").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("n")).where("n > 1").drop("n")
        after = common.stored(after.join(totals, "group").select("group", "id", "text", "n_shingles", "total"), "after")
        after.where(F.col("total") <= GROUP_SHINGLES).select("group", "id", "text").write.mode("append").parquet(rest_at)
        work = after.where(F.col("total") > GROUP_SHINGLES)
        common.drop(held, seen)
        held = after
    return spark.read.schema("a long, b long").parquet(links_at), spark.read.schema("group long, id long, text string").parquet(rest_at)


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text)."""
    spark = common.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = common.stored(profiles(docs), "profiles")
    full = every.where("digest is not null and doc_id is not null")
    classes = common.stored(full.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("nodes").alias("nodes")), "classes")
    pairs = ties(classes)
    group_of = connected(pairs).select(F.col("id"), F.col("component").alias("group"))
    sizes = classes.select("id", "n_shingles").join(group_of, "id")
    totals = sizes.groupBy("group").agg(F.sum("n_shingles").alias("total"))
    members = common.stored(sizes.join(totals, "group"), "members")
    texts = docs.join(members, docs.doc_id == members.id).select("group", "id", "text", "n_shingles", "total")
    small = texts.where(F.col("total") <= GROUP_SHINGLES).select("group", "id", "text")
    links = None
    if members.where(F.col("total") > GROUP_SHINGLES).take(1):
        large = texts.where(F.col("total") > GROUP_SHINGLES).select("group", "id", "text", "n_shingles").withColumn("row", F.monotonically_increasing_id())
        parts = common.stored(_split(common.stored(large, "large")), "parts")
        totals = parts.groupBy("group").agg(F.sum("n_shingles").alias("total"))
        parts = parts.join(totals, "group")
        links, rest = _by_rounds(parts.where(F.col("total") > GROUP_SHINGLES))
        small = small.unionByName(parts.where(F.col("total") <= GROUP_SHINGLES).select("group", "id", "text")).unionByName(rest)
    ordered = small.repartition(common.width(spark, docs), "group").sortWithinPartitions("group", "id")
    confirmed = ordered.mapInArrow(_resolve, "a long, b long")
    if links is not None:
        confirmed = confirmed.unionByName(links)
    # rows of one doc_id with different texts are one document
    same = full.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("doc_id")
    own = full.join(same, "doc_id", "left_semi").join(classes.select("digest", "id"), "digest").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    roots = connected(common.stored(confirmed.unionByName(own), "links"))
    of_class = classes.select("digest", "id").join(roots, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    out = every.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the rows that are near-duplicates of a kept one: one row of each component stays, in the columns of docs."""
    found = components(docs.select("doc_id", "text")).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    rest = docs.join(found, docs.doc_id.cast("long") == found["_gone"], "left_anti")
    return rest.where("doc_id is null").unionByName(rest.where("doc_id is not null").dropDuplicates(["doc_id"]))


def op4_chosen_path_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and whether it stays, for every document; cases as the module names them."""
    return components(common.documents(spark, sf_dir, "doc_id", "text"))
