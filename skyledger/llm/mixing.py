"""Mixing sources to target weights (operator 10), with DataFrame operations only.

Tokens are summed per source, targets follow from the weights, and a source's repetition rate is its target over its
size. A document is emitted floor(rate) times, and once more if a number drawn from a hash of its id and the source's
seed lies below the fraction of the rate. The seed is the one of SEEDS whose copies come nearest to the target: the sums
of all seeds are one mergeable aggregation, so a source of any size costs one pass and no sort.

Defined cases: null text has size 0; a null source is a source of its own and comes last; a null id hashes as the empty
text; rows with equal ids draw alike; a source without words has target 0 and keeps nothing; an empty table gives an
empty result; further columns of any name travel along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.columns import fresh, id_text, word_count
from skyledger.sources.tables import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2
SEEDS = 16


def draw(doc_id: Column, seed: Column) -> Column:
    """A number in [0, 1) from the id and a seed."""
    digest = F.md5(F.concat_ws(":", id_text(doc_id), seed.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32


def ranked_sources(totals: DataFrame) -> DataFrame:
    """Add the place of each source by code point, from 0, null last, without sorting all of them in one task."""
    dealt = totals.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("_part", F.spark_partition_id())
    dealt = stage(dealt, "sources")  # the ranges are drawn once, so both uses below see the same parts
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").isNull(), "source"))
    placed = dealt.withColumn("_within", within).join(offsets, "_part")
    return placed.select("source", "source_size", (F.col("_before") + F.col("_within") - 1).alias("place"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    The shares are filled like connected vessels: each pass gives the tokens that capped sources leave to the others by
    weight, until no target is above its cap. A pass is one sum over the table of sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = stage(ranked_sources(totals).select("source", "source_size", weight.alias("weight")), "targets")
    level, capped = None, F.lit(False)
    while True:
        wanted, full, open_weight = table.agg(
            F.sum("source_size"), F.sum(F.when(capped, F.col("source_size"))), F.sum(F.when(~capped, F.col("weight"))),
        ).first()
        new = (share * (wanted or 0) - ceiling * (full or 0)) / open_weight if open_weight else 0.0
        if new == level:
            break
        level, capped = new, F.col("weight") * new > ceiling * F.col("source_size")
    target = F.least(F.col("weight") * level, ceiling * F.col("source_size").cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def mixing_plan(sizes: DataFrame, seeds: int = SEEDS, **targets) -> DataFrame:
    """(source, source_size, target, rate, seed) from rows of (doc_id, source, size)."""
    table = source_targets(sizes, **targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    table = stage(table.withColumn("rate", rate), "rates")
    part = F.col("rate") - F.floor("rate")
    drawn = [F.sum(F.when(draw(F.col("doc_id"), F.lit(s)) < part, F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(seeds)]
    rated = sizes.alias("d").join(table.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    sums = rated.groupBy("t.source", "source_size", "target", "rate").agg(*drawn)
    misses = F.array(*[F.struct(F.abs(F.col(f"s{s}") - part * F.col("source_size")).alias("gap"), F.lit(s).alias("seed")) for s in range(seeds)])
    return stage(sums.select("source", "source_size", "target", "rate", F.array_min(misses)["seed"].alias("seed")), "plan")


def sizes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size), kept on disk: the texts are read once for all later passes."""
    return stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")


def copies(doc_id: Column, rate: Column, seed: Column) -> Column:
    return (F.floor(rate) + (draw(doc_id, seed) < rate - F.floor(rate)).cast("int")).cast("int")


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """Per document: size, its source's size and target, the words the mix takes, and the number of copies."""
    sizes = sizes_of(docs)
    plan = mixing_plan(sizes, **options)
    rows = sizes.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    n = copies(F.col("doc_id"), F.col("rate"), F.col("seed"))
    return rows.select("doc_id", "size", "source_size", "target", (n * F.col("size")).cast("long").alias("taken"), n.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every input column, each row as often as the mix takes it."""
    plan = mixing_plan(sizes_of(docs), **options)
    n = fresh(docs, "_copies")
    key = fresh(docs, "_source")
    plan = plan.select(F.col("source").alias(key), F.col("rate").alias("_rate"), F.col("seed").alias("_seed"))
    rated = docs.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col(f"p.{key}")))
    counted = rated.select("d.*", copies(F.col("d.doc_id"), F.col("p._rate"), F.col("p._seed")).alias(n))
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(n))).alias(n)
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns], repeated).drop(n)
