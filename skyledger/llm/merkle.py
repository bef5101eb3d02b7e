"""Merkle dataset manifest (operator 13).

Every document is a leaf: the SHA-256 of its columns. The leaves of a source, in order of doc_id, are the lowest level of the
source's tree, and the subroots, in order of source, that of the dataset's. A level is a table of (tree, idx, digest) and grows
by sibling-shift self-joins: each node looks up its siblings at computed places (idx XOR 1 for two children, the other slots of
its run for more), and the rows in slot zero, who then know the whole run, emit the parents. The siblings that a node met are
its step of every proof below it, so proofs are handed down again from the subroots to the leaves by one equijoin a level, and
written above the lowest level, so that no plan holds the joins of all levels at once. Levels
shrink by the number of children, so all levels together cost about as much as one and a half times the lowest.

Places come from one sort by ranges: rows are dealt by (tree, doc_id), each range is numbered on its own and moved on by the rows
of its tree in the ranges before. No tree, also not one with a third of all rows, passes through one task. Levels are written
to the shared folder, so that a lost executor costs only its own tasks.

Defined cases: a null in any column is hashed as `-`, so it differs from the empty text; a null source is a tree of its own
and comes first; a null doc_id comes first in its tree; rows with equal ids follow in order of their digests, and equal rows are
leaves of their own; texts of any length are hashed whole; an empty table gives an empty manifest; a tree of one leaf is its own
subroot, and one source alone makes its subroot the root; further columns of any name are not part of a leaf and do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.tables import stage

CHILDREN = 3
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one behind the other, in lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, so that neighbours cannot run into each other; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a document's columns, some of them replaced."""
    return digest(*(field(changed.get(c, F.col(c))) for c in LEAF_COLUMNS))


def siblings(idx: Column, children: int) -> list[Column]:
    """The places of a node's siblings."""
    if children == 2:
        return [idx.bitwiseXOR(F.lit(1))]
    run, slot = F.floor(idx / children) * children, idx % children
    return [(run + (slot + shift) % children).cast("long") for shift in range(1, children)]


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `idx`, the place of each row in its tree from 0, and `size`, the number of rows in the tree."""
    dealt = rows.withColumn("salt", F.monotonically_increasing_id())  # equal rows may go to different ranges
    dealt = dealt.repartitionByRange("tree", *order, "salt").withColumn("part", F.spark_partition_id())
    dealt = stage(dealt, "leaves")  # ranges are drawn once, so both uses see the same ones
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("n"))  # as many rows as trees and ranges together
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(of_tree).alias("size"))
    within = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*[F.col(c).asc_nulls_first() for c in order], "salt"))
    numbered = dealt.withColumn("within", within).join(counts, ["tree", "part"])
    return numbered.withColumn("idx", F.col("before") + F.col("within") - 1).drop("salt", "part", "within", "before")


def with_siblings(nodes: DataFrame, children: int) -> DataFrame:
    """Add what stands before and after each node in its run: `before` and `after`, the digests one behind the other."""
    found = nodes
    for i, place in enumerate(siblings(F.col("idx"), children)):
        other = nodes.select(F.col("tree").alias("t"), F.col("idx").alias(f"idx{i}"), F.col("digest").alias(f"digest{i}"))
        found = found.withColumn("at", place).join(other, (F.col("tree") == F.col("t")) & (F.col("at") == F.col(f"idx{i}")), "left").drop("t", "at")
    met = [F.struct(F.col(f"idx{i}").alias("idx"), F.col(f"digest{i}").alias("digest")) for i in range(max(1, children - 1))]
    met = F.array_sort(F.filter(F.array(*met), lambda s: s["idx"].isNotNull()))
    side = lambda keep: F.array_join(F.transform(F.filter(met, keep), lambda s: s["digest"]), "")
    return found.select(*nodes.columns, side(lambda s: s["idx"] < F.col("idx")).alias("before"), side(lambda s: s["idx"] > F.col("idx")).alias("after"))


def levels(leaves: DataFrame, children: int) -> list[DataFrame]:
    """The levels of all trees at once, lowest first: (tree, idx, size, digest, before, after), size being that of the tree's
    level. A tree ends with the level where it has one node."""
    nodes = leaves.select("tree", "idx", "size", "digest")
    largest = nodes.agg(F.max("size").alias("n")).first()["n"] or 0
    done = [stage(with_siblings(nodes, children), "level")]
    while largest > 1:
        largest = -(-largest // children)
        parent = digest(F.col("digest"), F.col("after"))
        size = F.ceil(F.col("size") / children).cast("long")
        first = done[-1].where("size > 1").where(F.col("idx") % children == 0)
        nodes = first.select("tree", (F.col("idx") / children).cast("long").alias("idx"), size.alias("size"), parent.alias("digest"))
        done.append(stage(with_siblings(nodes, children), "level"))
    return done


def handed_down(built: list[DataFrame], above: DataFrame, children: int) -> DataFrame:
    """(tree, idx, path, subroot, ...) of the lowest level. `above` has one row for each tree: `rest`, the steps that follow
    its subroot, and anything else that all its leaves shall carry."""
    carried = [c for c in above.columns if c not in ("tree", "rest")]
    tops = None
    for height, level in enumerate(built):
        own = level.where("size = 1").select("tree", F.lit(height).alias("height"))
        tops = own if tops is None else tops.union(own)
    tops = stage(tops.join(above, "tree"), "tops")
    paths = None
    for height in reversed(range(len(built))):
        here = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("idx"), F.col("rest").alias("path"), *carried)
        if paths is not None:
            up = paths.select(F.col("tree").alias("t"), F.col("idx").alias("up"), F.col("path").alias("rest"), *carried)
            step = F.array(F.struct("before", "after"))
            nodes = built[height].where("size > 1").withColumn("parent", F.floor(F.col("idx") / children))
            nodes = nodes.join(up, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("up")))
            here = here.union(nodes.select("tree", "idx", F.concat(step, "rest").alias("path"), *carried))
        paths = stage(here, "paths") if height else here
    return paths


def manifest(docs: DataFrame, children: int = CHILDREN, keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, source, idx (place in its source), leaf, path (steps to the root: the digests before and after), subroot, root
    and the columns of `keep`, which are computed from the document's row."""
    keep = keep or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    rows = docs.select("doc_id", "source", tree.alias("tree"), leaf().alias("digest"), *(c.alias(name) for name, c in keep.items()))
    leaves = stage(placed(rows, ["doc_id", "digest"]), "placed")
    of_source = levels(leaves, children)
    subroots = None
    for level in of_source:
        own = level.where("size = 1").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
        subroots = own if subroots is None else subroots.union(own)
    subroots = stage(placed(subroots, ["name"]), "subroots")
    of_dataset = levels(subroots, children)
    root = of_dataset[-1].select("tree", F.col("digest").alias("root"), F.array().cast(STEP).alias("rest"))
    to_root = handed_down(of_dataset, root, children)
    above = subroots.join(to_root, ["tree", "idx"]).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("rest"))
    paths = handed_down(of_source, above, children).withColumnRenamed("tree", "t").withColumnRenamed("idx", "i")
    found = leaves.join(paths, (F.col("tree") == F.col("t")) & (F.col("idx") == F.col("i")))
    return found.select("doc_id", "source", "idx", F.col("digest").alias("leaf"), "path", "subroot", "root", *keep)


def proof(path: Column) -> Column:
    """One digest for a whole path: of all siblings from the leaf to the root, left to right on each level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["before"], node, s["after"]))


def verified(found: DataFrame, received: Column) -> DataFrame:
    """The manifest with `folded_root`, what the leaves as received lead to, and whether that is the root."""
    folded = found.withColumn("folded_root", fold(received, F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
