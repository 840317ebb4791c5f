"""Merkle manifest of a dataset: one digest for all rows, and for each row the proof that it is in it.

Rows are leaves. Within a group (a language) the leaves are numbered 0.. in the
order of their key; every ``fanout`` consecutive nodes become one node until one
remains, the group's subroot. The subroots, in the order of their groups, become
the root likewise.

A node carries the interval [lo, hi] of the leaf ranks that it covers. All else
follows from intervals:

* a node of level k lies in the bucket ``lo div fanout^(k+1)`` of the level above,
  so building a level is one grouping by (group, bucket), of at most
  ``fanout`` nodes each;
* an ancestor is the node of a higher level whose interval contains the node's;
  it is found by an equi-join on (group, bucket) with the containment as
  condition, level by level from the top, so no join compares rows of different
  buckets and a group with most rows is spread over its buckets;
* the siblings are what is left of the parent's interval without the node's own:
  the children that end before it and those that begin after it.

A proof is the list of (left, right) sibling digests, from the leaf's level up
through the subroots to the root. It is attached to the families (a parent with
its children) of the lowest level, an eighth of the leaves, before they are
taken apart: texts and proofs are not shuffled by leaf. Ranks come from a
range-partitioned numbering; the driver sees the number of leaves of the largest
group and nothing else.

Nulls: every null value is ``-`` in a leaf's input, a null group is a group of its
own and comes first, null keys come first. Empty texts are ``0:``. Rows equal in
key are ordered by their digest; exact copies are leaves of their own. An empty
table has no nodes and no proofs. Very long texts are hashed where they are read.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.functions.keys import dense_key
from stellate.llm.common import digest, freeze
from stellate.operators.broadcast import broadcast_if_small

FANOUT = 8
PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """A value as a leaf's input: ``-`` for null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values, each encoded so that no two lists of values look alike."""
    return digest(F.concat(*[encoded(v) for v in values]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def proof_text(path: Column) -> Column:
    """The siblings' digests, level by level from the leaf's, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


@dataclass(frozen=True)
class Tree:
    """The levels of a forest: one tree for each group.

    ``leaves``: g, lo, hi, n (leaves of the group), hash and what they carry.
    ``families[k - 1]``: the nodes of level k with their children.
    """

    leaves: DataFrame
    families: list[DataFrame]
    fanout: int

    def nodes(self) -> DataFrame:
        """Every node: g, level, lo, hi, n, hash."""
        cols = ("g", "lo", "hi", "n", "hash")
        out = self.leaves.select("g", F.lit(0).alias("level"), *cols[1:])
        for k, family in enumerate(self.families, 1):
            out = out.unionByName(family.select("g", F.lit(k).alias("level"), *cols[1:]))
        return out

    def tops(self) -> DataFrame:
        """The node of each group that covers all of its leaves."""
        return self.nodes().where("lo = 0 and hi = n - 1")


def ranked(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add lo = hi = the 0-based rank within ``g`` by ``key`` (nulls first), and n, the rows of the group."""
    # exact copies are told apart by their place, so that many of them can be dealt to many tasks
    placed = freeze(rows, "leaves").withColumn("_place", F.monotonically_increasing_id())
    numbered = dense_key(placed, ["g", *key, "_place"], "_key").drop("_place")
    groups = numbered.groupBy("g").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("n"))
    out = numbered.join(broadcast_if_small(groups), "g")
    return out.withColumn("lo", F.col("_key") - F.col("_first")).withColumn("hi", F.col("lo")).drop("_key", "_first")


def grow(leaves: DataFrame, carried: Sequence[str] = (), fanout: int = FANOUT) -> Tree:
    """The tree of each group over leaves with g, lo, hi, n and hash; the first level keeps what they carry."""
    leaves = freeze(leaves, "ranked")
    largest = leaves.agg(F.max("n")).first()[0] or 0
    families: list[DataFrame] = []
    below, width = leaves, 1
    while width < largest:
        extra = carried if width == 1 else ()
        child = F.struct("lo", "hi", "hash", *extra)
        width *= fanout
        bucket = F.floor(F.col("lo") / F.lit(width)).cast("long")
        # a group of one node is complete and grows no further
        family = (
            below.where(F.col("n") > width // fanout)
            .groupBy("g", "n", bucket.alias("bucket"))
            .agg(F.sort_array(F.collect_list(child)).alias("children"))
            .select(
                "g",
                "n",
                F.col("children")[0]["lo"].alias("lo"),
                F.element_at("children", -1)["hi"].alias("hi"),
                digest(F.array_join(F.transform("children", lambda c: c["hash"]), "")).alias("hash"),
                "children",
            )
        )
        below = freeze(family, "family")
        families.append(below)
    return Tree(leaves, families, fanout)


def _siblings(children: str, own: Column) -> Column:
    """What is left of the parent's interval without the child's own."""

    def digests(keep) -> Column:
        return F.array_join(F.transform(F.filter(children, keep), lambda c: c["hash"]), "")

    return F.struct(
        digests(lambda c: c["hi"] < own["lo"]).alias("left"), digests(lambda c: c["lo"] > own["hi"]).alias("right")
    )


def attach(tree: Tree, tops: DataFrame, carried: Sequence[str] = (), kept: Sequence[str] = ()) -> DataFrame:
    """For each leaf the columns it carries, its hash, ``path`` and the ``kept`` columns of its group's top.

    ``tops`` holds for each top node: g, level, lo, hi, path and ``kept``.
    """
    known = ("g", "lo", "hi", "path", *kept)
    above: DataFrame | None = None
    width = tree.fanout ** len(tree.families)
    for k in range(len(tree.families), 0, -1):
        labelled = tops.where(F.col("level") == k).select(*known)
        labelled = labelled if above is None else labelled.unionByName(above.select(*known))
        bucket = F.floor(F.col("lo") / F.lit(width)).cast("long")
        node = labelled.select(
            "g", bucket.alias("bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", *kept
        )
        inside = (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
        family = tree.families[k - 1].select("g", bucket.alias("bucket"), "lo", "hi", "children")
        families = family.join(node, ["g", "bucket"]).where(inside)
        each = families.select("g", "children", "path", *kept, F.explode("children").alias("own"))
        extra = carried if k == 1 else ()
        above = each.select(
            "g",
            *[F.col("own")[c].alias(c) for c in ("lo", "hi", "hash", *extra)],
            F.concat(F.array(_siblings("children", F.col("own"))), F.col("path")).alias("path"),
            *kept,
        )
        width //= tree.fanout
    # a group of one leaf: the leaf is its top
    alone = tree.leaves.where("n = 1").join(tops.where("level = 0").select("g", "path", *kept), "g")
    out = alone.select("g", "hash", *carried, "path", *kept)
    return out if above is None else out.unionByName(above.select("g", "hash", *carried, "path", *kept))


@dataclass(frozen=True)
class Manifest:
    """``groups``: the trees over the rows; ``roots``: the tree over their subroots."""

    groups: Tree
    roots: Tree
    carried: tuple[str, ...]

    def subroots(self) -> DataFrame:
        """Each group's top node with ``subroot``, ``root`` and the ``path`` from the one to the other."""
        top = self.roots.tops().select(
            "g", "level", "lo", "hi", F.array().cast(PATH).alias("path"), F.col("hash").alias("root")
        )
        part = ("group", "level", "first", "last")
        return attach(self.roots, top, part, ("root",)).select(
            F.col("group").alias("g"),
            "level",
            F.col("first").alias("lo"),
            F.col("last").alias("hi"),
            F.col("hash").alias("subroot"),
            "root",
            "path",
        )

    def proofs(self) -> DataFrame:
        """For each row what it carries, its leaf (``hash``), ``subroot``, ``root`` and ``path``."""
        tops = freeze(self.subroots(), "subroots")
        return attach(self.groups, tops, self.carried, ("subroot", "root")).drop("g")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    key: str = "doc_id",
    extra: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> Manifest:
    """The manifest of ``docs``: leaves over ``columns``, one tree for each ``group``, ordered by ``key``.

    ``extra`` names more columns to carry to the proofs (say, the digest of a
    changed version of the row, to be checked against the proof).
    """
    extra = extra or {}
    # sorts as the groups do in UTF-8, null first, and is never null
    g = F.when(F.col(group).isNull(), F.lit("!")).otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))
    leaves = docs.select(
        g.alias("g"), F.col(key).alias("key"), leaf_digest(*map(F.col, columns)).alias("hash"),
        *[c.alias(name) for name, c in extra.items()],
    )
    carried = ("key", *extra)
    groups = grow(ranked(leaves, ["key", "hash"]), carried, fanout)
    tops = groups.tops().select(
        F.lit("").alias("g"),
        F.col("g").alias("group"),
        "hash",
        "level",
        F.col("lo").alias("first"),
        F.col("hi").alias("last"),
    )
    roots = grow(ranked(tops, ["group"]), ("group", "level", "first", "last"), fanout)
    return Manifest(groups, roots, carried)
