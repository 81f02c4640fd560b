"""Merkle manifest: a hash tree over a table's rows, per group and over the groups.

Concatenated-level strings: the nodes of a group are taken in aligned blocks of ``3 ** BLOCK_LEVELS``
consecutive ones, and a block keeps each of its levels as one string of fixed-width hex digests.
Parents are hashes of three digests' substrings, and a node's siblings are the substrings to its
left and right. A block's last level is one digest; the blocks' digests are the nodes of the next
round, until each group is one block. The groups' roots make a tree of the same kind.

No task holds more than a block, whatever share of the rows one group has: positions come from a
range partition and counts, and blocks are grouped by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import kept, positions

ARITY = 3
#: Levels that a block goes up.
BLOCK_LEVELS = 6
_WIDTH = 64
_PROOF = "array<struct<left: string, right: string>>"


def hashed(*texts: Column) -> Column:
    """H of the documentation: SHA-256 of texts put together, in lower-case hex."""
    return F.sha2(F.concat(*texts), 256)


def field_text(column: Column) -> Column:
    """A value that no other list of values spells alike: ``-`` for null, or bytes, ``:``, value."""
    text = column.cast("string")
    spelled = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(spelled, F.lit("-"))


def leaf(*columns: Column) -> Column:
    return hashed(*[field_text(c) for c in columns])


def group_key(column: Column) -> Column:
    """A group as text that sorts null first, then by bytes; never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def _positions(rows: DataFrame) -> DataFrame:
    """Rows (key, place, digest, row) with their position in the key by place and digest."""
    order = [F.col("place").asc_nulls_first(), F.col("digest").asc()]
    return positions(rows, ["key"], order, "tree-order")


def _levels(digests: Column, n: Column) -> Column:
    """The level strings of a block from its nodes up. A block of many goes up all its levels, since
    others stand beside it; one that is alone until one node remains."""
    run = ARITY * _WIDTH

    def up(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        data = last.cast("binary")  # substrings of bytes do not count characters
        starts = F.sequence(F.lit(0), F.ceil(F.length(data) / run).cast("int") - 1)
        parents = F.transform(
            starts, lambda i: F.sha2(F.substr(data, i * run + 1, F.lit(run)), 256)
        )
        goes_on = (n > ARITY**BLOCK_LEVELS) | (F.length(data) > _WIDTH)
        return F.when(goes_on, F.array_append(levels, F.array_join(parents, ""))).otherwise(levels)

    start = F.array(F.array_join(digests, "")).cast("array<string>")
    rounds = F.sequence(F.lit(1), F.lit(BLOCK_LEVELS))
    return F.aggregate(rounds, start, lambda s, i: F.coalesce(up(s, i), start))


def _trees(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of each round (key, block, nodes, levels), from the leaves to one block per key, of
    nodes (key, idx, n, digest, row)."""
    size = ARITY**BLOCK_LEVELS
    rounds = []
    while True:
        block = F.floor(F.col("idx") / size).alias("block")
        node = F.struct("idx", "digest", "row").alias("node")
        blocks = nodes.select("key", block, "n", node).groupBy("key", "block", "n")
        blocks = blocks.agg(F.array_sort(F.collect_list("node"), _by_position).alias("nodes"))
        levels = _levels(F.transform("nodes", lambda x: x["digest"]), F.col("n"))
        blocks = kept(blocks.withColumn("levels", levels), "tree-blocks")
        rounds.append(blocks)
        if blocks.filter(F.col("n") > size).isEmpty():
            return rounds
        nodes = blocks.select(
            "key",
            F.col("block").alias("idx"),
            F.ceil(F.col("n") / size).alias("n"),
            F.element_at("levels", -1).alias("digest"),
            F.lit(None).cast("boolean").alias("row"),
        )


def _by_position(a: Column, b: Column) -> Column:
    return F.when(a["idx"] < b["idx"], -1).when(a["idx"] > b["idx"], 1).otherwise(0)


def _siblings(levels: Column, at: Column) -> Column:
    """What stands to the left and right of the node ``at`` and those above it, up to the block's
    last level."""

    def step(state: Column, level: Column) -> Column:
        data = level.cast("binary")
        place = state["at"] % ARITY
        first = (state["at"] - place) * _WIDTH
        left = F.substr(data, first + 1, place * _WIDTH)
        right = F.substr(data, first + (place + 1) * _WIDTH + 1, (ARITY - 1 - place) * _WIDTH)
        pair = F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))
        parent = ((state["at"] - place) / ARITY).cast("int")
        return F.struct(parent.alias("at"), F.array_append(state["out"], pair).alias("out")).cast(kind)

    kind = f"struct<at: int, out: {_PROOF}>"
    start = F.struct(at.cast("int").alias("at"), F.array().cast(_PROOF).alias("out")).cast(kind)
    below = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.aggregate(below, start, lambda s, x: F.coalesce(step(s, x), start), lambda s: s["out"])


def _proofs(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Each leaf's (key, digest, row, proof, tops.*), from the top round down.

    ``tops`` (key, above, top) has each key's proof above its root and what else its leaves get.
    """
    above = tops.select("key", F.lit(0).cast("long").alias("block"), "above", "top")
    for i, blocks in reversed(list(enumerate(rounds))):
        size = ARITY**BLOCK_LEVELS
        joined = blocks.join(above, ["key", "block"])
        each = F.transform(
            "nodes",
            lambda x: F.struct(
                x["idx"].alias("idx"),
                x["digest"].alias("digest"),
                x["row"].alias("row"),
                F.concat(_siblings(F.col("levels"), x["idx"] % size), "above").alias("proof"),
            ),
        )
        nodes = joined.select("key", "top", F.explode(each).alias("x"))
        if not i:
            return nodes.select("key", "x.digest", "x.row", "x.proof", "top")
        above = nodes.select("key", F.col("x.idx").alias("block"), F.col("x.proof").alias("above"), "top")


def merkle_manifest(rows: DataFrame) -> DataFrame:
    """The tree over rows (group, place, leaf, row): one row each with ``row``, ``leaf``,
    ``subroot`` (its group's), ``root`` and ``proof``, the siblings (left, right) on each level from
    the leaf to the group's root and from there to the root.

    In a group leaves ascend by ``place`` (null first), then leaf; three nodes in a row become one,
    the last one, two or three too, until one remains. Groups ascend by their UTF-8 bytes, null
    first. A lone leaf is its group's root, and a lone group's root is the root. Repeated rows are
    leaves of their own. No rows give no rows.
    """
    nodes = rows.select(
        group_key(F.col("group")).alias("key"), "place", F.col("leaf").alias("digest"), "row"
    )
    groups = _trees(_positions(nodes))
    subroots = groups[-1].select(
        F.lit("").alias("key"),
        F.col("key").alias("place"),
        F.element_at("levels", -1).alias("digest"),
        F.struct("key").alias("row"),
    )
    whole = _trees(_positions(subroots))
    root = F.struct(F.element_at("levels", -1).alias("root")).alias("top")
    none = F.array().cast(_PROOF).alias("above")
    over = _proofs(whole, whole[-1].select("key", none, root))
    tops = over.select(
        F.col("row.key").alias("key"),
        F.col("proof").alias("above"),
        F.struct(F.col("digest").alias("subroot"), "top.root").alias("top"),
    )
    proofs = _proofs(groups, kept(tops, "tree-tops"))
    return proofs.select(
        "row", F.col("digest").alias("leaf"), "top.subroot", "top.root", "proof"
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, p: F.coalesce(hashed(p["left"], node, p["right"]), node))


def proof_digest(proof: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)
