"""Exact Jaccard join of word-shingle sets in a metric space.

Whole unrelated texts are all at distance 1 from every pivot, so no window around one would leave any of them out.
The space is therefore first cut in slices of shingles. Two sets close enough differ in fewer shingles than there are
slices, so they are at distance 0 in one of them: there a pivot's region needs no window, and every set is in just
one region of each slice. Sets that share a region, directly or through others, form a cluster. Within a cluster the true
distances spread. A large cluster is first seen from some pivots: sets close to one are settled, and only what no pivot reaches, and
sets of different pivots, still meet, block by block. Each region or pair of blocks is joined recursively: pivots take the sets nearest to them, sets near a
border are replicated by the triangle inequality, and each part is joined again, until it is small or no pivot splits it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import RowBits, discard, in_batches, landed, numbered_rows, partitions_for, slices, workspace
from fieldspark.llm.components import connected_components
from fieldspark.llm.hashing import mix, salt, shingle_sets

#: Shingles in a block of a large cluster: many small blocks while they are few, larger ones beyond.
BLOCK_SHINGLES, MOST_BLOCK_SHINGLES, FEW_BLOCKS = 1 << 15, 1 << 20, 16
#: Sets in a region of which each pair is counted.
SMALL_REGION = 16
#: Low bits of a region's key that name its size class.
CLASS_BITS = 6
#: Sets compared one by one, and pivots at each level.
LEAF, PIVOTS = 16, 8
_FAMILIES = 3


class Slicing:
    """Cuts of the shingle space by set size, for a least similarity of ``percent`` in a hundred."""

    def __init__(self, percent: int):
        self.percent, self.lows, self.rows = percent, [], []

    def _grow(self, n: int) -> None:
        while not self.rows or self.rows[-1][0] <= n:
            low = self.rows[-1][0] if self.rows else 1
            high = low + 1
            while high < low * 3 // 2 or self._differences(high) == 0:
                high += 1
            most = self._differences(high - 1)
            self.lows.append(low)
            self.rows.append((high, self._partner(high - 1), most, most + 1 + (2 + most // 4 if most else 0)))

    def _partner(self, n: int) -> int:
        return n * 100 // self.percent

    def _differences(self, n: int) -> int:
        """Most shingles in only one of two similar sets, the smaller of size n."""
        return (n + self._partner(n)) * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> Iterator[tuple[int, int, int]]:
        """Size classes of the pairs that a set of size n can be in: number, most differences, slices."""
        self._grow(n)
        for i in range(bisect_right(self.lows, n) - 1, -1, -1):
            _, largest, most, count = self.rows[i]
            if n > largest:
                break
            yield i, most, count

    def keys(self, shingles: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Regions of a set: one for each slice with shingles in each class; and by class how many it surely shares with a similar set.

        If fewer slices hold shingles than can differ, an equal slice may be an empty one. Such a set is cut again by
        another rule, and after the last its empty slices count as well: of two similar sets one would have
        shown the pair already, or both do this.
        """
        out, shared = [], []
        for number, most, count in self.of(len(shingles)):
            named = np.uint64(number % (1 << CLASS_BITS))
            for family in range(_FAMILIES):
                tag = salt(number * _FAMILIES + family)
                at = ((mix(shingles + tag) >> np.uint64(33)) % np.uint64(count)).astype(np.int64)
                order = np.argsort(at, kind="stable")
                filled, first = np.unique(at[order], return_index=True)
                sums = np.add.reduceat(mix(shingles ^ tag)[order], first)
                out.append(_named(mix(sums + salt(-3) * filled.astype(np.uint64) + tag), named))
                if len(filled) > most:
                    shared.append((int(named), len(filled) - most if family == 0 else 0))
                    break
                if family == _FAMILIES - 1:
                    empty = np.setdiff1d(np.arange(count), filled).astype(np.uint64)
                    out.append(_named(mix(salt(-2) * empty + tag), named))
                    shared.append((int(named), 0))
        return (np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)), shared


def _named(keys: np.ndarray, number: np.uint64) -> np.ndarray:
    return keys >> np.uint64(CLASS_BITS) << np.uint64(CLASS_BITS) | number


def shingle_table(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """From ``row, text`` rows ``row, n_shingles, digest, keys, shared``: size and digest of each text's shingle set, and what ``Slicing.keys`` gives."""
    slicing = Slicing(percent)

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, digests = zip(*shingle_sets([(t or "").encode() for t in batch.column("text").to_pylist()], width))
            keys, shared = zip(*[slicing.keys(s) if len(s) else (np.zeros(0, np.int64), []) for s in sets])
            bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(keys)))
            columns = [batch.column("row"), pa.array(np.array([len(s) for s in sets], np.int64)), pa.array(digests, pa.binary()), lists]
            columns.append(pa.array([[{"class": c, "n": n} for c, n in x] for x in shared], pa.list_(pa.struct([("class", pa.int32()), ("n", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_shingles", "digest", "keys", "shared"])

    return in_batches(rows, shingle, "row long, n_shingles long, digest binary, keys array<long>, shared array<struct<class:int,n:int>>")


def region_edges(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """Ties ``a, b`` that join all nodes of equal ``key``, each to the first of its region in a sorted range.

    A region with many nodes spreads over ranges; the first nodes of its ranges are tied by key.
    """
    n = partitions_for(rows.sparkSession)
    ordered = rows.repartitionByRange(n, "key", "node").sortWithinPartitions("key", "node")

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = head = None
        first = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, nodes = batch.column("key").to_numpy(), batch.column("node").to_numpy()
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = keys[0] != key
            at = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
            heads = np.where(at < 0, head if head is not None else 0, nodes[at])
            first = (int(keys[0]), int(nodes[0])) if first is None else first
            key, head = int(keys[-1]), int(heads[-1])
            tied = ~new & (heads != nodes)
            pairs = np.unique(np.stack([heads[tied], nodes[tied]]), axis=1)
            yield _ties(pairs[0], pairs[1], pa.nulls(pairs.shape[1], pa.int64()))
        if first is not None:
            ends = [first] if first == (key, head) else [first, (key, head)]
            heads = [h for _, h in ends]
            yield _ties(heads, heads, pa.array([k for k, _ in ends], pa.int64()))

    ties = landed(in_batches(ordered, tie, "a long, b long, key long"), folder, name)
    ends = ties.where("key is not null").groupBy("key").agg(F.min("a").alias("a"), F.collect_set("b").alias("b"))
    crossing = ends.where(F.size("b") > 1).select("a", F.explode("b").alias("b")).where("a <> b")
    return ties.where("key is null").select("a", "b").union(crossing).distinct()


def _ties(a, b, key) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), key], ["a", "b", "key"])


def region_pairs(rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of nodes that share a small region, a row for each; and the rows ``key, node`` of all larger ones.

    A region at the border of a sorted batch or range counts as larger, in all its parts.
    """
    n = partitions_for(rows.sparkSession)
    ordered = rows.repartitionByRange(n, "key", "node").sortWithinPartitions("key", "node")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, nodes = batch.column("key").to_numpy(), batch.column("node").to_numpy()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sizes = np.diff(np.append(first, len(keys)))
            large = sizes > SMALL_REGION
            large[[0, -1]] = True
            large = np.repeat(large, sizes)
            a, b = [], []
            for apart in range(1, SMALL_REGION):
                same = (keys[apart:] == keys[:-apart]) & ~large[apart:] & (nodes[apart:] != nodes[:-apart])
                a.append(nodes[:-apart][same])
                b.append(nodes[apart:][same])
            a, b = np.concatenate(a), np.concatenate(b)
            yield _ties(a, b, pa.nulls(len(a), pa.int64()))
            yield _ties(nodes[large], nodes[large], pa.array(keys[large]))

    found = landed(in_batches(ordered, pair, "a long, b long, key long"), folder, "pairs")
    return found.where("key is null").select("a", "b"), found.where("key is not null").select("key", F.col("a").alias("node"))


def candidate_edges(rows: DataFrame, folder: str) -> DataFrame:
    """Edges that join whatever can be similar, from rows ``node, keys, shared``.

    A similar set shares at least the number of regions that ``shared`` tells. Leaving aside its large regions, a set
    needs a pair to share the rest of that number of small ones; if no such number is left, the set
    is looked for in its large regions too. Of two similar sets the one with a number left over shows the pair, or both are there.
    """
    pairs, large = region_pairs(rows.select(F.explode("keys").alias("key"), "node"), folder)
    named = large.withColumn("class", F.col("key").bitwiseAND((1 << CLASS_BITS) - 1).cast("int"))
    lost = named.groupBy("node", "class").agg(F.count("*").alias("lost"))
    needs = rows.select("node", F.explode("shared").alias("s")).select("node", "s.class", "s.n").groupBy("node", "class").agg(F.min("n").alias("n"))
    needs = landed(needs.join(lost, ["node", "class"], "left").select("node", "class", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("need")), folder, "needs")
    least = landed(needs.groupBy("node").agg(F.min("need").alias("need")), folder, "least")
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    counted = counted.join(least.select(F.col("node").alias("a"), F.col("need").alias("need_a")), "a")
    counted = counted.join(least.select(F.col("node").alias("b"), F.col("need").alias("need_b")), "b")
    enough = counted.where("n >= need_a and n >= need_b").select("a", "b")
    deep = named.join(needs.where("need <= 0"), ["node", "class"], "left_semi").select("key", "node")
    return enough.union(region_edges(deep, folder, "ties"))


class MetricRegion:
    """Exact join of some sets: ``label`` holds for each the first set that links lead to.

    ``side`` marks the sets of two blocks, of which only pairs across are looked for.
    """

    def __init__(self, sets: list[np.ndarray], percent: int, side: np.ndarray | None = None):
        self.sets, self.percent, self.side = sets, percent, side
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.label = np.arange(len(sets))
        self.most = 1 - percent / 100 + 1e-9
        self.mark = np.zeros(max((int(s[-1]) for s in sets if len(s)), default=0) + 1, bool)
        self._join(np.arange(len(sets)))

    def find(self, i: int) -> int:
        return int(self.label[i])

    def _unite(self, i: int, others: np.ndarray) -> None:
        labels = np.unique(np.append(self.label[others], self.label[i]))
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def _common(self, i: int, others: np.ndarray) -> np.ndarray:
        self.mark[self.sets[i]] = True
        sizes = self.sizes[others]
        hits = np.concatenate([[0], np.cumsum(self.mark[np.concatenate([self.sets[j] for j in others])])])
        stops = np.cumsum(sizes)
        self.mark[self.sets[i]] = False
        return hits[stops] - hits[stops - sizes]

    def _compare(self, i: int, others: np.ndarray) -> np.ndarray:
        """Distances to other sets; close ones are united."""
        common = self._common(i, others)
        union = self.sizes[i] + self.sizes[others] - common
        close = 100 * common >= self.percent * union
        if self.side is not None:
            close &= self.side[others] != self.side[i]
        self._unite(i, others[close])
        return 1 - common / union

    def _join(self, ids: np.ndarray) -> None:
        if len(ids) <= LEAF:
            return self._each(ids, None)
        pivots = ids[np.linspace(0, len(ids) - 1, PIVOTS).astype(int)]
        away = np.stack([self._compare(p, ids) for p in pivots], axis=1)
        inside = away <= away.min(axis=1, keepdims=True) + 2 * self.most
        if inside.sum(axis=0).max() > 0.8 * len(ids):
            return self._each(ids, away)
        for r in range(len(pivots)):
            own = ids[inside[:, r]]
            if len(own) > 1:
                self._join(own)
        return None

    def _each(self, ids: np.ndarray, away: np.ndarray | None) -> None:
        """One set against those after it that size, triangle inequality and links so far leave open."""
        for at, i in enumerate(ids[:-1].tolist()):
            rest = ids[at + 1 :]
            small, large = np.minimum(self.sizes[rest], self.sizes[i]), np.maximum(self.sizes[rest], self.sizes[i])
            open_ = 100 * small >= self.percent * large
            if self.side is not None:
                open_ &= self.side[rest] != self.side[i]
            if away is not None:
                open_ &= (np.abs(away[at + 1 :] - away[at]) <= self.most).all(axis=1)
            rest = rest[open_]
            rest = rest[self.label[rest] != self.label[i]]
            if len(rest):
                self._compare(i, rest)


_TO_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)} | {c: " " for c in "\t\n\v\f\r"})


def text_grams(text: str | None, width: int) -> list[str]:
    """The shingles of a text as texts; of fewer than ``width`` words the whole sequence is one."""
    words = [w for w in (text or "").translate(_TO_LOWER).split(" ") if w]
    return [" ".join(g) for g in zip(*(words[i:] for i in range(width)))] if len(words) >= width else [" ".join(words)] if words else []


def text_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Shingle sets of texts as sorted numbers from one numbering of their shingles: no hashes."""
    numbers: dict[str, int] = {}
    return [np.unique(np.array([numbers.setdefault(g, len(numbers)) for g in text_grams(t, width)], np.int64)) for t in texts]


def _region_links(placed: DataFrame, width: int, percent: int) -> DataFrame:
    """Join each region of ``cluster, i, j`` exactly: ties ``a, b`` of every set to the first that links lead to."""

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
        key, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "node", "block", "text"))):
                if row[:3] != key:
                    if held:
                        yield key, held
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            yield key, held

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cluster, i, j), rows in regions(batches):
            nodes = np.array([r[0] for r in rows], np.int64)
            side = np.array([r[1] for r in rows]) if i != j else None
            region = MetricRegion(text_sets([r[2] for r in rows], width), percent, side)
            roots = nodes[[region.find(k) for k in range(len(nodes))]]
            tied = roots != nodes
            yield pa.RecordBatch.from_arrays([pa.array([cluster] * int(tied.sum()), pa.int64()), pa.array(roots[tied]), pa.array(nodes[tied])], ["cluster", "a", "b"])

    return in_batches(placed, link, "cluster long, a long, b long")


def _coloured(members: DataFrame, large: DataFrame, rows: DataFrame, texts: DataFrame, percent: int, width: int, folder: str) -> DataFrame:
    """Members of large clusters as their pivots see them: ``cluster, node, size, mask, pivots, colour``.

    ``pivots`` are those that the set is similar to (bits of ``mask``). Pivots that share a set belong together; ``colour`` is the mask of
    a set's own, 0 of a set that no pivot reaches. Sets of one colour are in one class, so they need not meet any more. The
    members of a cluster are dealt out in parts, and every part gets the pivots' texts.
    """
    n = partitions_for(members.sparkSession)
    parts = F.ceil(F.col("n") / BLOCK_SHINGLES).cast("int")
    inside = members.join(large.select("cluster", parts.alias("parts")), "cluster")
    chosen = inside.groupBy("cluster", "parts").agg(F.array_distinct(F.array(*[F.min(F.struct(F.xxhash64("node", F.lit(j)), "node"))["node"] for j in range(PIVOTS)])).alias("p"))
    chosen = landed(chosen.select("cluster", "parts", F.posexplode("p").alias("bit", "row")), folder, "pivots")
    pivot_texts = RowBits(chosen, folder, "pivots_mask").maybe(rows.select("row", "text")).join(chosen, "row")
    pivot_texts = pivot_texts.select("cluster", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "bit", F.col("row").alias("node"), F.lit(0).cast("long").alias("size"), "text")
    own = texts.join(inside.hint("shuffle_hash"), "node")
    own = own.select("cluster", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), F.lit(None).cast("int").alias("bit"), "node", "size", "text")
    dealt = pivot_texts.union(own).repartition(n, "cluster", "part").sortWithinPartitions("cluster", "part", F.asc_nulls_last("bit"), "node")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen = None, []
        for batch in batches:
            out = []
            for cluster, part, bit, node, size, text in zip(*(batch.column(c).to_pylist() for c in ("cluster", "part", "bit", "node", "size", "text"))):
                if (cluster, part) != key:
                    key, seen = (cluster, part), []
                grams = set(text_grams(text, width))
                if bit is not None:
                    seen.append((bit, node, grams))
                    continue
                close = []
                for b, p, theirs in seen:
                    common = len(grams & theirs)
                    if 100 * common >= percent * (len(grams) + len(theirs) - common):
                        close.append((b, p))
                out.append((cluster, node, size, sum(1 << b for b, _ in close), [p for _, p in close]))
            columns = zip(*out) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "node", "size", "mask", "pivots"])

    seen = landed(in_batches(dealt, look, "cluster long, node long, size long, mask long, pivots array<long>"), folder, "seen")
    # masks that share a pivot become one: at most as many as there are sets of pivots
    apart = (
        "aggregate(masks, cast(array() AS array<bigint>), (all, m) -> concat(filter(all, a -> (a & m) = 0), "
        "array(aggregate(filter(all, a -> (a & m) <> 0), m, (x, a) -> x | a))))"
    )
    masks = seen.where("mask <> 0").groupBy("cluster").agg(F.collect_set("mask").alias("masks")).select("cluster", F.expr(apart).alias("colours"))
    colour = F.coalesce(F.expr("get(filter(colours, a -> (a & mask) <> 0), 0)"), F.lit(0).cast("long"))
    return seen.join(masks, "cluster", "left").select("cluster", "node", "size", "mask", "pivots", colour.alias("colour"))


def _open_blocks(coloured: DataFrame) -> DataFrame:
    """Where members of large clusters still have to meet: ``node, cluster, block, i, j``.

    The members of a colour, and those of none, are dealt into blocks. Two blocks meet unless they are of one colour; a block of none also
    meets itself.
    """
    few = F.ceil(F.sum("size") / BLOCK_SHINGLES)
    count = F.greatest(F.least(few, F.lit(FEW_BLOCKS)), F.ceil(F.sum("size") / MOST_BLOCK_SHINGLES)).cast("int")
    blocks = coloured.groupBy("cluster", "colour").agg(F.greatest(F.lit(1), count).alias("blocks"))
    # of each cluster the colours in order, and the colour of each of its blocks
    listed = blocks.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("colour", "blocks"))).alias("kinds"))
    of_block = "flatten(transform(kinds, k -> array_repeat(k.colour, k.blocks)))"
    first = "aggregate(filter(kinds, k -> k.colour < colour), 0, (n, k) -> n + k.blocks)"
    own = "get(filter(kinds, k -> k.colour = colour), 0).blocks"
    placed = coloured.join(listed, "cluster").withColumn("colours", F.expr(of_block))
    placed = placed.withColumn("block", F.expr(f"cast({first} + pmod(xxhash64(node), {own}) AS int)"))
    others = "filter(transform(colours, (c, b) -> struct(c AS colour, b AS block)), x -> x.colour <> colour OR colour = 0)"
    met = placed.select("node", "cluster", "block", F.explode(F.expr(others)).alias("other"))
    return met.select("node", "cluster", "block", F.least("block", "other.block").alias("i"), F.greatest("block", "other.block").alias("j"))


def _classes(rows: DataFrame, width: int, percent: int, folder: str) -> DataFrame:
    """Classes of texts, from ``row, text``: ``row, n_shingles, first``, the smallest row that links lead to."""
    spark, n = rows.sparkSession, partitions_for(rows.sparkSession)
    keyed = landed(shingle_table(rows, width, percent), folder, "keyed")
    sets = landed(keyed.drop("keys", "shared"), folder, "sets")
    full = sets.where("n_shingles > 0")
    # equal sets: the smallest row stands for all
    equal = landed(full.groupBy("digest", "n_shingles").agg(F.min("row").alias("node")), folder, "equal")
    copies = full.join(equal, ["digest", "n_shingles"]).where("row <> node").select("row")
    copies = RowBits(landed(copies, folder, "copies"), folder, "copies_mask")
    alone = copies.drop(keyed.where("n_shingles > 0").select("row", "keys", "shared"))
    edges = landed(candidate_edges(alone.select(F.col("row").alias("node"), "keys", "shared"), folder), folder, "edges")
    for name in ("keyed", "pairs", "needs", "least", "ties", "copies"):
        discard(spark, folder, name)
    clusters = landed(connected_components(edges, f"{folder}/clusters").withColumnRenamed("component", "cluster"), folder, "members")
    discard(spark, folder, "clusters")
    sizes = equal.select("node", F.col("n_shingles").alias("size"))
    weighed = landed(clusters.join(sizes, "node"), folder, "weighed")
    large = weighed.groupBy("cluster").agg(F.sum("size").alias("n")).where(F.col("n") > BLOCK_SHINGLES)
    large = landed(large, folder, "large")
    wanted = RowBits(clusters.select(F.col("node").alias("row")), folder, "members_mask")
    texts = wanted.maybe(rows.select("row", "text")).withColumnRenamed("row", "node")
    # a cluster is one region; a large one is first seen from its pivots, then in those pairs of blocks that are still open
    coloured = landed(_coloured(weighed, large, rows, texts, percent, width, folder), folder, "coloured")
    small = weighed.join(large.select("cluster"), "cluster", "left_anti")
    placed = small.select("node", "cluster", F.lit(0).alias("block"), F.lit(0).alias("i"), F.lit(0).alias("j")).union(_open_blocks(coloured))
    placed = landed(placed, folder, "placed")
    meeting = texts.join(placed.hint("shuffle_hash"), "node")
    meeting = meeting.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")
    links = landed(_region_links(meeting, width, percent), folder, "links")
    split = large.select("cluster")
    once = links.join(split, "cluster", "left_anti").select(F.col("b").alias("node"), F.col("a").alias("component"))
    stars = coloured.where("mask <> 0").select(F.get("pivots", F.lit(0)).alias("a"), F.explode(F.concat("pivots", F.array("node"))).alias("b"))
    again = connected_components(links.join(split, "cluster", "left_semi").select("a", "b").union(stars).where("a <> b").distinct(), f"{folder}/split")
    found = once.union(again).groupBy("node").agg(F.min("component").alias("component"))
    named = equal.join(found, "node", "left").select("digest", "n_shingles", F.coalesce("component", "node").alias("first"))
    named = landed(named, folder, "named")
    for name in ("edges", "members", "weighed", "large", "coloured", "placed", "links", "split", "equal"):
        discard(spark, folder, name)
    linked = full.join(named, ["digest", "n_shingles"]).select("row", "n_shingles", "first")
    return linked.union(sets.where("n_shingles = 0").select("row", "n_shingles", F.col("row").alias("first")))


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """Classes of texts linked by Jaccard similarity of their word-shingle sets (``doc_id``, ``text``).

    Words are runs without white space, A-Z in lower case. A set holds the distinct shingles of ``width`` words; with fewer words the
    whole sequence is one; a null text or one without words is linked with nothing. Two sets link when
    100 * intersection >= ``percent`` * union, exactly; sets with one 128-bit digest count as equal. Returns for each row ``doc_id,
    n_shingles, component_id``, the smallest ``doc_id`` that links lead to. Rows with one ``doc_id`` are one node, whatever their
    texts; a row without is linked with nothing and has no component. No rows give no rows; further columns are not read.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "metric_join")
    rows, unique = numbered_rows(docs.select("doc_id", "text"), folder)
    known = rows.where("it.doc_id is not null").select("row", "it.text", F.col("it.doc_id").cast("long").alias("doc_id"))
    classes = _classes(known.select("row", "text"), width, percent, folder)
    if unique:
        return classes.select(F.col("row").alias("doc_id"), "n_shingles", F.col("first").alias("component_id"))
    names = known.select("row", "doc_id")
    classes = classes.join(names, "row").join(names.select(F.col("row").alias("first"), F.col("doc_id").alias("class")), "first")
    classes = landed(classes.select("doc_id", "n_shingles", "class"), folder, "classes")
    # classes that meet in one identifier are one
    met = classes.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z")
    ties = classes.join(met, "doc_id").select("a", F.col("class").alias("b"))
    whole = connected_components(ties, f"{folder}/met")
    classes = classes.join(whole, F.col("class") == F.col("node"), "left")
    out = classes.select("doc_id", "n_shingles", F.coalesce("component", "class").alias("component_id"))
    none = rows.where("it.doc_id is null").select(F.lit(None).cast("long").alias("row"), "it.text")
    sizes = shingle_table(none, width, percent).select(F.col("row").alias("doc_id"), "n_shingles", F.col("row").alias("component_id"))
    return out.union(sizes)


def drop_near(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs``, all columns, of which each class of linked texts keeps one: that with the smallest ``doc_id``.

    Links are those of ``jaccard_components``, but every row is decided on by its own text: rows that share a ``doc_id`` stay if
    their texts are not alike. A row without ``doc_id`` or words stays.
    """
    folder = workspace(docs.sparkSession, "metric_join")
    rows, _ = numbered_rows(docs, folder)
    known = rows.where("it.doc_id is not null").select("row", "it.text")
    gone = landed(_classes(known, width, percent, folder).where("row <> first").select("row"), folder, "gone")
    return RowBits(gone, folder, "gone_mask").drop(rows).select("it.*")
