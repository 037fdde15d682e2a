"""Merkle manifest of a table: leaves, one tree per source, one tree of the sources, proofs.

Method (slot pivot): conditional aggregates spread each parent's children into ``fanout`` columns, one
per slot. Concatenating the columns and hashing gives the parent; concatenating them without the own
slot column gives a node's siblings. Everything is DataFrame functions.

* A digest is lower-case hex SHA-256 of the concatenated inputs. A leaf hashes its row's fields, each
  ``-`` if null, else UTF-8 byte count, ``:`` and value.
* A leaf's place in its source comes from a range-partitioned, sorted and stored copy of the narrow
  leaves: a number within the partition plus the rows of the source in earlier partitions. No source is
  ever collected in one task, and a number in the sort key also splits a hot group of equal rows. What
  is looked up per partition and source has at most as many rows as there are partitions plus sources.
* Every level has a sixteenth of the rows of the one below. Children of a parent mostly lie in one
  partition, so partial aggregation does most of the pivot before the shuffle, by (source, parent), whose
  groups have at most ``fanout`` rows.
* Proofs go downwards: each parent's path (what stands left and right of it on every level up to the
  root) is joined to its children, so that only a sixteenth of the paths is shuffled, and a leaf's proof
  is put together after the last join.

Cases: nulls are hashed as ``-``; rows without a source form a tree of their own, the first. Leaves
ascend by id, missing ids first; rows of equal id follow their digests, and equal rows, whose
digests are equal, may stand in any order, which changes no digest and gives them a proof each. A lone
leaf is its source's subroot, a lone subroot the root; their siblings are none, and the proof digest is then
that of the empty text. An empty table gives empty tables. Very long texts are hashed whole. Only the listed
columns are used, and the kept ones returned; working columns avoid their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.llm.common import drop_stored, store

FANOUT = 16
PATH = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat_ws("", *inputs), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(value) for value in values])


def number_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """A stored copy in the given order: ``part`` and ``at``, the place in the part, are added.

    The parts are ranges of the order, ascending. Equal rows are told apart by a number of their own,
    so that no part has to hold all copies of one. ``df`` must be a stored frame, since it is read twice.
    """
    salted = df.withColumn("salt", F.monotonically_increasing_id())
    keys = [*order, "salt"]
    spread = salted.repartitionByRange(*keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    placed = spread.select(*df.columns, number.alias("number"))
    split = placed.select(
        *df.columns,
        F.shiftright("number", 33).alias("part"),
        F.col("number").bitwiseAND((1 << 33) - 1).alias("at"),
    )
    return store(split, name)


def _earlier(*keys: str) -> Window:
    """The rows of earlier parts; at most one row per part stands in a group."""
    return Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)


def _places(leaves: DataFrame) -> DataFrame:
    """Leaves with ``tree`` (rank of their source), ``node`` (place in it) and ``size`` (its leaves)."""
    numbered = number_rows(leaves, ["source_key", "leaf_id", "leaf"], "numbered-leaves")
    runs = store(
        numbered.groupBy("part", "source_key").agg(F.count("*").alias("n"), F.min("at").alias("first")),
        "leaf-runs",
    )
    sizes = store(runs.groupBy("source_key").agg(F.sum("n").alias("size")), "source-sizes")
    sources = number_rows(sizes, ["source_key"], "numbered-sources")
    parts = sources.groupBy("part").agg(F.count("*").alias("n"))
    # One row per part of the ordered sources: as many as shuffle partitions, however many sources.
    before = F.coalesce(F.sum("n").over(_earlier(F.lit(1))), F.lit(0))
    starts = F.broadcast(parts.select("part", before.alias("start")))
    trees = store(
        sources.join(starts, "part").select("source_key", "size", (F.col("start") + F.col("at")).alias("tree")),
        "source-trees",
    )
    before = F.coalesce(F.sum("n").over(_earlier("source_key")), F.lit(0))
    shifts = store(
        runs.select("part", "source_key", (before - F.col("first")).alias("shift")).join(trees, "source_key"),
        "leaf-shifts",
    )
    placed = numbered.join(shifts, ["part", "source_key"])
    node = (F.col("shift") + F.col("at")).alias("node")
    columns = [c for c in leaves.columns if c != "source_key"]
    result = store(placed.select(*columns, "tree", node, "size"), "placed-leaves")
    drop_stored(numbered, runs, sizes, sources, trees, shifts)
    return result


def _slots(fanout: int) -> list[str]:
    return [f"c{slot}" for slot in range(fanout)]


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: children in slot columns, their digest, and how many nodes the level has."""
    slot = F.col("node") % fanout
    pivoted = nodes.where("size > 1").groupBy("tree", F.floor(F.col("node") / fanout).alias("node"))
    spread = pivoted.agg(
        *[F.max(F.when(slot == k, F.col("digest"))).alias(name) for k, name in enumerate(_slots(fanout))],
        F.max("size").alias("below"),
    )
    size = F.ceil(F.col("below") / fanout).alias("size")
    return spread.select("tree", "node", digest(*_slots(fanout)).alias("digest"), size, *_slots(fanout))


def build_levels(nodes: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Stored levels above the nodes (``tree``, ``node``, ``digest``, ``size``), lowest first.

    As many as the largest tree needs; smaller trees end earlier, where ``size`` is 1.
    """
    levels = []
    largest = nodes.agg(F.max("size")).first()[0] or 0
    below = nodes
    while largest > 1:
        below = store(_parents(below, fanout), "merkle-level")
        levels.append(below)
        largest = -(-largest // fanout)
    return levels


def tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree`` and ``digest`` of the last node of every tree."""
    columns = ["tree", "digest"]
    found = nodes.where("size = 1").select(*columns)
    for level in levels:
        found = found.unionByName(level.where("size = 1").select(*columns))
    return found


def _own_step(fanout: int) -> Column:
    """What stands left and right of the own slot among the children of the joined parent."""
    slot = F.col("node") % fanout
    columns = [F.col(f"parent_{name}") for name in _slots(fanout)]
    left = F.concat_ws("", *[F.when(slot > k, column) for k, column in enumerate(columns)])
    right = F.concat_ws("", *[F.when(slot < k, column) for k, column in enumerate(columns)])
    return F.struct(left.alias("left"), right.alias("right"))


def add_paths(nodes: DataFrame, levels: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Nodes with ``path``, from their own level up to the root, and the other columns of ``above``.

    ``above`` has one row per tree: ``tree``, ``path`` (that of the tree's top) and what all nodes of
    the tree are to be given.
    """
    given = [name for name in above.columns if name not in ("tree", "path")]
    parents = None
    for level in [*reversed(levels), nodes]:
        known = level.where("size = 1").join(above, "tree").select(*level.columns, "path", *given)
        if parents is not None:
            renamed = parents.select(
                "tree",
                F.col("node").alias("parent_node"),
                F.col("path").alias("parent_path"),
                *[F.col(name).alias(f"parent_{name}") for name in _slots(fanout)],
                *given,
            )
            children = level.where("size > 1").withColumn("parent_node", F.floor(F.col("node") / fanout))
            path = F.concat(F.array(_own_step(fanout)), F.col("parent_path"))
            below = children.join(renamed, ["tree", "parent_node"])
            known = known.unionByName(below.select(*level.columns, path.alias("path"), *given))
        parents = known
    return parents


def leaves(
    docs: DataFrame,
    columns: Sequence[str],
    id_col: str = "doc_id",
    source_col: str = "source",
    presented: Column | None = None,
) -> DataFrame:
    """``leaf_id``, ``source_key`` and ``leaf`` of every row, and the leaf ``presented`` for checking.

    ``presented`` is a digest over the columns of ``docs``; where it is null, the row's own leaf is meant.
    """
    source = F.col(source_col).cast("string")
    own = leaf(*[F.col(name) for name in columns])
    other = F.lit(None).cast("string") if presented is None else presented
    return docs.select(
        F.col(id_col).alias("leaf_id"),
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("source_key"),
        own.alias("leaf"),
        other.alias("presented"),
    )


@dataclass(frozen=True)
class Manifest:
    """Stored nodes and levels of the trees of all sources, and of the tree over their subroots."""

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    source_levels: list[DataFrame]
    fanout: int

    def root(self) -> DataFrame:
        """One row with the root's ``digest``; none for an empty table."""
        return tops(self.sources, self.source_levels).select("digest")


def build(found: DataFrame, fanout: int = FANOUT) -> Manifest:
    """The manifest over the result of ``leaves``. Runs a few jobs for the places and one per level."""
    placed = _places(store(found, "leaves"))
    nodes = placed.withColumn("digest", F.col("leaf"))
    levels = build_levels(nodes, fanout)
    subroots = store(tops(nodes, levels), "subroots")
    total = subroots.count()
    sources = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("node"), "digest", F.lit(total).cast("long").alias("size")
    )
    return Manifest(nodes, levels, sources, build_levels(sources, fanout), fanout)


def proofs(manifest: Manifest) -> DataFrame:
    """``leaf_id``, ``leaf``, ``presented``, ``subroot``, ``root`` and ``path`` of every leaf."""
    empty = F.lit([]).cast(PATH).alias("path")
    root = tops(manifest.sources, manifest.source_levels)
    above = root.select("tree", empty, F.col("digest").alias("root"))
    sources = add_paths(manifest.sources, manifest.source_levels, above, manifest.fanout)
    subroots = store(
        sources.select(F.col("node").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "source-proofs"
    )
    paths = add_paths(manifest.leaves, manifest.levels, subroots, manifest.fanout)
    return paths.select("leaf_id", "leaf", "presented", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(found: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, found, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def verify(proven: DataFrame) -> DataFrame:
    """Result of ``proofs`` with ``folded_root``, from the presented leaf where there is one, and ``verified``."""
    folded = fold(F.coalesce("presented", "leaf"), F.col("path"))
    return proven.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))
