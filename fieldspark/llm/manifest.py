"""Merkle manifest of a dataset: one root digest that proves every row, and the path from each row up to it.

Rows are leaves, gathered in groups and ordered within them; runs of nodes become parents until one is left, and
the groups' roots become one in the same way. The levels are stored as parent-linked rows: a row names the node that it
leads to and holds the siblings met on the way, several levels in one row, so that a climb through twenty levels takes
three steps. ``climb`` is a recursive query that goes up from every leaf at once, appends those siblings and
folds the digest that is presented for the leaf, which only the right one turns into the root. Digests are stored as bytes
and hashed as hex text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import landed, partitions_for, quoted

#: Most members of a block: the nodes that one group holds while a stretch of levels is built, and the leaves of a shard.
BLOCK = 1024
STEPS = "array<struct<before:binary,after:binary>>"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@dataclass
class Manifest:
    """A built manifest, on tables in the shared folder.

    ``leaves``: ``part, position, id, leaf``, what was kept, and the first ``steps`` with the ``parent`` they lead to.
    ``nodes``: the rows above, ``part, shard, hop, node, parent, steps``, for each shard of ``width`` leaves the path above it.
    ``parts``: a row for each group, ``part, name, size, hops, subroot``. ``hops`` of the top tree and the ``root`` digest.
    """

    folder: str
    width: int
    top: int
    root: bytes | None
    leaves: DataFrame
    nodes: DataFrame
    parts: DataFrame


def digest_of(columns: list[str], instead: dict[str, Column] | None = None) -> Column:
    """SHA-256 in lower-case hex of a row: ``-`` for null, else the UTF-8 byte count, a colon and the value as text."""

    def field(name: str) -> Column:
        value = (instead or {}).get(name, quoted(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(field, columns)), 256)


def numbered(rows: DataFrame, keys: list[str], order: list[str], folder: str, name: str) -> DataFrame:
    """``rows`` with ``position``, from 0 in the order of each key, and ``n``, the rows of the key; nulls come first.

    Sampled ranges are sorted side by side; only the number of rows of a key in each range is summed up.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(partitions_for(spark), *keys, *order).sortWithinPartitions(*keys, *order)
    dealt = landed(dealt.withColumn("at", F.monotonically_increasing_id()), folder, name).withColumn("range", F.shiftright("at", 33))
    shares = dealt.groupBy(*keys, "range").agg(F.min("at").alias("first"), F.count("*").alias("share"))
    earlier, whole = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    shares = shares.withColumn("before", F.coalesce(F.sum("share").over(earlier), F.lit(0))).withColumn("n", F.sum("share").over(whole))
    shares = landed(shares, folder, f"{name}_shares")
    same = [dealt[k].eqNullSafe(shares[k]) for k in keys]
    joined = dealt.join(shares, [*same, dealt["range"] == shares["range"]])
    position = (F.col("at") - F.col("first") + F.col("before")).alias("position")
    return joined.select(*[dealt[c] for c in rows.columns], position, "n")


def _levels(n: str, most: int, fanout: int) -> str:
    """SQL for the struct of ``n``, nodes left, and ``l``, levels built, when at most ``most`` levels are built over n nodes."""
    return (
        f"aggregate(sequence(1, {most}), struct({n} AS n, 0 AS l), (s, i) -> "
        f"if(s.n > 1, struct((s.n + {fanout - 1}) div {fanout} AS n, s.l + 1 AS l), s))"
    )


def _block_levels(members: DataFrame, extra: list[str], most: int, fanout: int) -> DataFrame:
    """Build up to ``most`` levels over nodes ``part, n, position, digest`` and ``extra``, block by block.

    Returns ``part, n, block, left, digest`` of each node and ``steps``: the siblings on its way to the block's root ``up``;
    ``left`` nodes of the part are left there. Parts of one node are done and give no rows.
    """
    width = fanout**most
    blocks = members.where("n > 1").groupBy("part", "n", F.expr(f"position div {width}").alias("block"))
    blocks = blocks.agg(F.sort_array(F.collect_list(F.struct("position", "digest", *extra))).alias("members"))
    blocks = blocks.withColumn("to", F.expr(_levels("n", most, fanout)))
    above = (
        f"transform(sequence(0, cast((size(d) - 1) div {fanout} AS int)), "
        f"r -> sha2(array_join(slice(d, r * {fanout} + 1, {fanout}), ''), 256))"
    )
    tree = (
        "aggregate(sequence(1, to.l), array(transform(members, m -> lower(hex(m.digest)))), "
        f"(t, i) -> concat(t, array(transform(array(element_at(t, -1)), d -> {above})[0])))"
    )
    blocks = blocks.withColumn("tree", F.expr(tree)).withColumn("up", F.expr("unhex(element_at(tree, -1)[0])"))
    place = f"cast(i div cast(pow({fanout}, j) AS int) AS int)"
    siblings = (
        f"transform(sequence(0, to.l - 1), j -> struct("
        f"unhex(array_join(slice(tree[j], {place} - {place} % {fanout} + 1, {place} % {fanout}), '')) AS before, "
        f"unhex(array_join(slice(tree[j], {place} + 2, {fanout} - 1 - {place} % {fanout}), '')) AS after))"
    )
    # the steps are worked out inside the block, so that its tree is not copied to each row
    rows = blocks.select("part", "n", "block", F.col("to.n").alias("left"), "up", F.explode(F.expr(f"transform(members, (m, i) -> struct(m, {siblings} AS steps))")).alias("row"))
    return rows.select("part", "n", "block", "left", "up", "row.m.*", F.col("row.steps").cast(STEPS).alias("steps"))


def _hops(members: DataFrame, extra: list[str], most: int, fanout: int, folder: str, name: str) -> list[DataFrame]:
    """All levels of all parts, ``most`` at a time: a table of ``_block_levels`` for each hop."""
    out, width = [], fanout**most
    left = members.agg(F.max("n")).first()[0] or 0
    while left > 1:
        hop = landed(_block_levels(members, extra, most, fanout), folder, f"{name}_{len(out)}")
        out.append(hop)
        members = hop.where(F.pmod("position", F.lit(width)) == 0).select(
            "part", F.col("left").alias("n"), F.col("block").alias("position"), F.col("up").alias("digest")
        )
        extra, left = [], -(-left // width)
    return out


def build_manifest(
    docs: DataFrame, columns: list[str], group: str, folder: str, id_column: str = "doc_id", keep: dict[str, Column] | None = None, fanout: int = 2
) -> Manifest:
    """Build and store the manifest of ``docs``.

    A leaf is ``digest_of(columns)``. The leaves of a value of ``group`` ascend by ``id_column`` (then by leaf, so that rows equal
    in both are interchangeable); groups ascend by value in UTF-8 bytes; nulls come first and are a group of their own.
    While several nodes remain, each ``fanout`` consecutive ones become the SHA-256 of their hex digests, one after another; the last
    run may hold fewer, even one. ``keep`` names further digests (hex) stored with each leaf. No rows give empty tables. Only the
    columns named are read, whatever else the table holds.
    """
    most = 1
    if fanout < 2:
        raise ValueError("a parent has at least two children")
    while fanout ** (most + 1) <= BLOCK:
        most += 1
    width, keep = fanout**most, keep or {}
    kept = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.select(quoted(group).alias("name"), quoted(id_column).alias("id"), F.unhex(digest_of(columns)).alias("digest"), *[F.unhex(c).alias(k) for c, k in zip(keep.values(), kept)])
    rows = numbered(landed(rows, folder, "rows"), ["name"], ["id", "digest"], folder, "ordered")
    groups = rows.where("position = 0").select("name", F.col("n").alias("size"), F.lit(0).alias("one"))
    names = landed(numbered(groups, ["one"], ["name"], folder, "names").select("name", "size", F.col("position").alias("part")), folder, "groups")
    leaves = rows.join(names, rows["name"].eqNullSafe(names["name"])).select("part", "n", "position", "id", *kept, "digest")
    leaves = landed(leaves, folder, "placed")
    hops = _hops(leaves, ["id", *kept], most, fanout, folder, "hop")
    none = F.lit(None).cast(STEPS)
    climbing = leaves.where("n = 1").select("part", "position", "id", *kept, F.col("digest").alias("leaf"), F.lit(0).alias("hop"), F.col("part").alias("parent"), none.alias("steps"))
    subroots = leaves.where("n = 1").select("part", F.lit(0).alias("hops"), F.col("digest").alias("subroot"))
    if hops:
        first = hops[0].select("part", "position", "id", *kept, F.col("digest").alias("leaf"), F.lit(1).alias("hop"), _parent(), "steps")
        climbing = first.union(climbing)
    for i, hop in enumerate(hops):
        subroots = subroots.union(hop.where("left = 1 and position = 0").select("part", F.lit(i + 1), "up"))
    parts = landed(names.join(subroots, "part"), folder, "parts")
    members = parts.select(F.lit(-1).cast("long").alias("part"), F.lit(parts.count()).cast("long").alias("n"), F.col("part").alias("position"), F.col("subroot").alias("digest"))
    tops = _hops(members, [], most, fanout, folder, "top")
    root = (tops[-1].where("left = 1").select("up") if tops else parts.select("subroot")).first()
    nodes = landed(_dealt(hops, tops, parts, width), folder, "nodes")
    return Manifest(folder, width, len(tops), bytes(root[0]) if root else None, climbing.withColumnsRenamed(dict(zip(kept, keep))), nodes, parts)


def _parent() -> Column:
    """The node that a row leads to: a place in the next level of its part, or the part's place among the subroots."""
    return F.when(F.col("left") == 1, F.col("part")).otherwise(F.col("block")).alias("parent")


def _dealt(hops: list[DataFrame], tops: list[DataFrame], parts: DataFrame, width: int) -> DataFrame:
    """The rows above the first hop, ``part, shard, hop, node, parent, steps``.

    A shard is a stretch of ``width`` leaves. Each has the whole path above it to itself, so the rows near the root are
    repeated for every shard, and a climb never brings more leaves than those of one shard to one key.
    """
    none = F.lit(None).cast("long")
    shards = parts.where("hops < 2").select("part", F.lit(0).cast("long").alias("shard"))
    if len(hops) > 1:
        shards = shards.union(hops[1].select("part", "position"))
    out = [parts.select("part", none.alias("shard"), F.lit(0).alias("hop"), none.alias("node"), none.alias("parent"), F.lit(None).cast(STEPS).alias("steps")).where(F.lit(False))]
    for h, hop in enumerate(hops[1:], 1):
        rows = hop.select("part", F.lit(h).alias("hop"), F.col("position").alias("node"), _parent(), "steps")
        out.append(shards.withColumn("node", F.expr(f"shard div {width ** (h - 1)}")).join(rows, ["part", "node"]))
    for t, top in enumerate(tops):
        rows = top.select(F.col("position").alias("node"), F.col("block").alias("parent"), "steps")
        under = shards.join(parts.select("part", "hops"), "part").withColumn("node", F.expr(f"part div {width ** t}"))
        out.append(under.withColumn("hop", F.col("hops") + t).join(rows, "node"))
    return reduce(DataFrame.union, [x.select("part", "shard", "hop", "node", "parent", "steps") for x in out])


_FOLD = "aggregate({steps}, {start}, (h, s) -> unhex(sha2(concat(lower(hex(s.before)), lower(hex(h)), lower(hex(s.after))), 256)))"
_SIBLINGS = "aggregate({steps}, {start}, (b, s) -> concat(b, s.before, s.after))"

#: The climb of every leaf at once. A row is a leaf on its way: where it stands, what it folded to, the siblings so far.
CLIMB = f"""
    WITH RECURSIVE climb (id, part, shard, hop, last, node, leaf, folded, siblings) AS (
        SELECT l.id, l.part, l.position div {{width}}, l.hop, p.hops + {{top}}, l.parent, l.leaf,
               {_FOLD.format(steps="coalesce(l.steps, array())", start="l.presented")},
               {_SIBLINGS.format(steps="coalesce(l.steps, array())", start="X''")}
        FROM {{leaves}} l JOIN {{parts}} p ON l.part = p.part
        UNION ALL
        SELECT c.id, c.part, c.shard, c.hop + 1, c.last, n.parent, c.leaf,
               {_FOLD.format(steps="n.steps", start="c.folded")},
               {_SIBLINGS.format(steps="n.steps", start="c.siblings")}
        FROM climb c JOIN {{nodes}} n ON n.part = c.part AND n.shard = c.shard AND n.hop = c.hop AND n.node = c.node
        WHERE c.hop < c.last
    )
    SELECT c.id, lower(hex(c.leaf)) AS leaf, lower(hex(p.subroot)) AS subroot, lower(hex(c.siblings)) AS siblings, lower(hex(c.folded)) AS folded_root
    FROM climb c JOIN {{parts}} p ON c.part = p.part WHERE c.hop = c.last
"""


def climb(manifest: Manifest, presented: str = "leaf", siblings: bool = False) -> DataFrame:
    """Go up from every leaf: ``id, leaf, subroot, root, proof_sha256, folded_root, verified``, a row for each row.

    The digest in column ``presented`` of the leaves (the stored leaf by default) is folded with the stored siblings;
    ``verified`` tells whether that gives the root. ``proof_sha256`` is the digest of all siblings, level by level, left to right;
    with ``siblings`` they are returned too. The result is written in the manifest's folder, so the session's limit on
    rows of a recursive query is lifted for this call only.
    """
    spark = manifest.nodes.sparkSession
    leaves = manifest.leaves.withColumn("presented", quoted(presented)) if presented != "presented" else manifest.leaves
    found = spark.sql(CLIMB, leaves=leaves, nodes=manifest.nodes, parts=manifest.parts, width=manifest.width, top=manifest.top)
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    found = found.select(
        "id", "leaf", "subroot", root.alias("root"), F.sha2("siblings", 256).alias("proof_sha256"), "folded_root",
        F.coalesce(F.col("folded_root") == root, F.lit(False)).alias("verified"), "siblings",
    )
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return landed(found if siblings else found.drop("siblings"), manifest.folder, f"climb-{uuid.uuid4().hex}")
    finally:
        spark.conf.set(ROW_LIMIT, before)
