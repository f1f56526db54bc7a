"""Operator 13 — Merkle manifest of a dataset, with an inclusion proof for every row.

Leaves are digests of whole rows.  Per group (source) the leaves stand in id order and every :data:`ARITY` consecutive
nodes become one, level by level, until one node, the subroot, remains; the subroots, in group order, are reduced the
same way to one root.

*Positions* come from distributed prefix sums (:mod:`lakemart.llm.prefix`), so a group may hold any share of the rows.

*Concatenated levels.*  ``ARITY ** LEVELS`` consecutive nodes are one aligned block.  A block keeps each of its levels as
one string of digests joined without separator; the parents of a level are the hashes of its substrings of fixed width
(``ARITY`` digests), and the siblings of node ``j`` are the two substrings that flank it inside its run.  After ``LEVELS`` levels a block is one
node; the nodes of all blocks are the leaves of the next tier, until every group has one node.  A block
therefore holds at most ``ARITY ** LEVELS`` rows, whatever the group's size, and a table of n rows takes log(n) / LEVELS tiers,
each smaller by the block's width.

*Proofs.*  A node's own flanks are followed by those of its block in the next tier, up to the root: the tables of the
tiers are joined from the top down on (group, block).

Built-in SQL functions only; a digest is SHA-256 in lowercase hex and is hashed as that text.

Defined cases: a null value is written ``-`` and never equals an empty one; a null group is a group of its own, before all
others; a null id stands first; rows with the same id are ordered by their leaf digest, equal rows are interchangeable; a
single row is its own subroot and root and has an empty proof; texts of any length are hashed whole; an empty table gives an
empty result; columns that the digest does not name are not part of it, and columns of the input with names of the result are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import materialize
from lakemart.llm.prefix import PART, prefix_sums, range_parts

ARITY = 3
#: Levels that one block holds; its leaves: ARITY ** LEVELS.
LEVELS = 5
_HEX = 64
_FLANKS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def field(value: Column) -> Column:
    """A value as it enters a row's digest: its byte count, a colon, the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: Sequence[str], replaced: dict[str, Column] | None = None) -> Column:
    """Digest of a row's ``columns``, some of them replaced by another value."""
    return digest(*(field((replaced or {}).get(c, F.col(f"`{c}`"))) for c in columns))


def _group_key(group: str) -> Column:
    """A never-null key in the order of the groups: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))


def _indexed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` (``grp``, ``node``, ...) with ``idx`` (place in the group in ``order``) and ``total`` (nodes of the group)."""
    cols = [F.asc_nulls_first(c) for c in order]
    parts = range_parts(nodes.withColumn("one", F.lit(1).cast("long")), [F.col("grp"), *cols], name)
    totals = materialize(parts.groupBy("grp").agg(F.sum("one").alias("total")), name + "-totals")    # one row per group
    return prefix_sums(parts, cols, {"idx": "one"}, group="grp").join(totals, "grp").drop("one", PART)


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long") if b > 1 else a


def _blocks(nodes: DataFrame, arity: int, levels: int, name: str) -> DataFrame:
    """Blocks of ``nodes`` (``grp``, ``idx``, ``node``, ``total``, ``payload``): ``grp``, ``blk``, ``total``, ``rows`` (in place
    order) and ``levels`` (the strings of levels 0, 1, ... of the block; the last one is its top)."""
    width = arity ** levels
    out = (nodes.groupBy("grp", F.expr(f"idx div {width}").alias("blk"))
           .agg(F.first("total").alias("total"), F.array_sort(F.collect_list(F.struct("idx", "node", "payload"))).alias("rows"))
           .withColumn("s0", F.array_join(F.transform("rows", lambda r: r["node"]), "")))
    run = arity * _HEX
    for k in range(levels):
        below = F.col(f"s{k}")
        starts = F.sequence(F.lit(0), F.floor((F.length(below) - 1) / run).cast("int"))
        parents = F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(below, i * run + 1, F.lit(run)), 256)), "")
        # a group of one node at this level is finished
        out = out.withColumn(f"s{k + 1}", F.when(_ceil_div(F.col("total"), arity ** k) > 1, parents))
    strings = F.array_compact(F.array(*(F.col(f"s{k}") for k in range(levels + 1))))
    return materialize(out.select("grp", "blk", "total", "rows", strings.alias("levels")), name)


def _flanked(blocks: DataFrame, arity: int) -> DataFrame:
    """One row per node of the blocks: ``grp``, ``blk``, ``idx``, ``node``, ``payload``, ``flanks``."""
    def flanks(pos: Column) -> Column:
        def of(level: Column, k: Column) -> Column:
            at = F.floor(pos / F.pow(F.lit(arity), k)).cast("int")
            first = F.floor(at / arity).cast("int") * arity
            return F.struct(F.substring(level, first * _HEX + 1, (at - first) * _HEX).alias("left"),
                            F.substring(level, (at + 1) * _HEX + 1, (first + arity - 1 - at) * _HEX).alias("right"))
        # the last level has no parent inside the block
        return F.transform(F.slice("levels", 1, F.size("levels") - 1), of)
    rows = F.transform("rows", lambda r, i: F.struct(r["idx"].alias("idx"), r["node"].alias("node"), r["payload"].alias("payload"), flanks(i).alias("flanks")))
    return blocks.select("grp", "blk", F.inline(rows))


def _reduce(nodes: DataFrame, arity: int, levels: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Leaves (as ``nodes`` of :func:`_blocks`) with ``proof`` (all flanks up to the top), and the tops ``grp``, ``top``."""
    width, tiers = arity ** levels, []
    while True:
        blocks = _blocks(nodes, arity, levels, f"{name}-tier{len(tiers)}")
        tiers.append(blocks)
        tops = blocks.select("grp", F.col("blk").alias("idx"), F.element_at("levels", -1).alias("node"),
                             _ceil_div(F.col("total"), width).alias("total"), F.lit(None).cast("string").alias("payload"))
        if (tops.agg(F.max("total")).first()[0] or 1) == 1:           # one number
            break
        nodes = tops
    above = None
    for blocks in reversed(tiers):
        rows = _flanked(blocks, arity)
        if above is None:
            rows = rows.withColumn("proof", F.col("flanks"))
        else:
            up = above.select("grp", F.col("idx").alias("blk"), F.col("proof").alias("up"))
            rows = rows.join(up, ["grp", "blk"]).withColumn("proof", F.concat("flanks", "up"))
        above = rows.select("grp", "idx", "node", "payload", "proof")
    return above, tops.select("grp", F.col("node").alias("top"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda acc, f: F.sha2(F.concat(f["left"], acc, f["right"]), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof, from the leaf's level up, left to right, as one string."""
    return F.array_join(F.transform(proof, lambda f: F.concat(f["left"], f["right"])), "")


def manifest(rows: DataFrame, order: str, group: str, leaf: Column, extra: dict[str, Column] | None = None,
             arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``rows``: ``order``, the ``extra`` columns, ``leaf``, ``subroot``, ``root`` and ``proof`` (an array of
    the strings of siblings to the left and to the right, from the leaf's level to the root's)."""
    if arity < 2 or levels < 1:
        raise ValueError("a run holds at least two nodes and a block at least one level")
    extra = extra or {}
    payload = F.struct(F.col(f"`{order}`").alias("id"), *(c.alias(k) for k, c in extra.items()))
    # written before the range partitioning samples it: every text is hashed once
    leaves = materialize(rows.select(_group_key(group).alias("grp"), F.col(f"`{order}`").alias("id"), leaf.alias("node"), payload.alias("payload")),
                         "merkle-leaves")
    rooted, subroots = _reduce(_indexed(leaves, ["id", "node"], "merkle").drop("id"), arity, levels, "merkle")
    tops = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("payload"), F.col("top").alias("node"))
    groups, root = _reduce(_indexed(tops, ["payload"], "merkle-groups"), arity, levels, "merkle-groups")
    root = (root.first() or [None, None])[1]                          # one digest
    groups = materialize(groups.select(F.col("payload").alias("grp"), F.col("node").alias("subroot"), F.lit(root).cast("string").alias("root"),
                                       F.col("proof").alias("up")), "merkle-subroots")
    return rooted.join(groups, "grp").select(
        F.col("payload.id").alias(order), *(F.col(f"payload.{k}").alias(k) for k in extra), F.col("node").alias("leaf"),
        "subroot", "root", F.concat("proof", "up").alias("proof"))
