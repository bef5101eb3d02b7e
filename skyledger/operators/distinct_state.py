"""Exact distinct counts of any set of months, from stored bitmaps that merge.

Each value of a column gets a number once. A month holds, for each column, bitmaps over these numbers; months merge by OR, and
the bits of the result are the distinct values. Numbers stay dense: values are numbered within hash slots, and slots follow
each other by their sizes, so no task sees all values of a column. A later delivery numbers only values not met before,
behind the numbers already given.

State: `values` (column, value, number), appended to, and `months` (_source_year, _source_month, column, slot, bits). Values
are written before bitmaps, so a delivery that breaks off can be repeated: numbers that nothing uses change no count.
One delivery runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger import contract as C
from skyledger.sources import tables

PERIOD = ["_source_year", "_source_month"]
SLOTS = 1024  # numbering runs in this many parts a column
VALUES = "column string, value string, number long"
MONTHS = "column string, slot long, bits binary, _source_year int, _source_month int"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], schema)


def _numbered(new: DataFrame, known: DataFrame) -> DataFrame:
    """(column, value) rows with numbers from 1 on, behind those already given."""
    slotted = new.withColumn("_slot", F.pmod(F.xxhash64("value"), F.lit(SLOTS)))
    sizes = slotted.groupBy("column", "_slot").agg(F.count("*").alias("_size"))  # at most SLOTS rows a column
    ahead = Window.partitionBy("column").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("column", "_slot", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_start"))
    given = known.groupBy("column").agg(F.max("number").alias("_given"))
    place = F.row_number().over(Window.partitionBy("column", "_slot").orderBy("value"))
    placed = slotted.withColumn("_place", place).join(starts, ["column", "_slot"]).join(given, "column", "left")
    return placed.select("column", "value", (F.coalesce("_given", F.lit(0)) + F.col("_start") + F.col("_place")).alias("number"))


def deliver(raw: DataFrame, state: str, columns: list[str] = C.CARDINALITY_COLUMNS) -> None:
    """Take the months that `raw` holds into the state, in place of what it held of them."""
    spark = raw.sparkSession
    cells = raw.unpivot(PERIOD, columns, "column", "value").distinct()
    # NULL stays as one row, so that a column without values still has its count of 0.
    cells = tables.stage(cells, "cells")
    known = _read(spark, f"{state}/values", VALUES)
    new = cells.where("value IS NOT NULL").select("column", "value").distinct().join(known, ["column", "value"], "left_anti")
    tables.stage(_numbered(new, known), "numbers").write.mode("append").parquet(f"{state}/values")
    numbers = _read(spark, f"{state}/values", VALUES)
    found = cells.join(numbers, ["column", "value"], "left").withColumn("slot", F.coalesce(F.bitmap_bucket_number("number"), F.lit(1)))
    bits = found.groupBy(*PERIOD, "column", "slot").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    bits.hint("rebalance", *PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PERIOD).parquet(f"{state}/months")


def months(spark: SparkSession, state: str) -> DataFrame:
    """The stored bitmaps; filters on the period columns prune folders."""
    return _read(spark, f"{state}/months", MONTHS)


def merged(bitmaps: DataFrame, *keys) -> DataFrame:
    """Bitmaps of the months of each group as one, which can be merged further."""
    return bitmaps.groupBy(*keys, "column", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """(column, distinct_non_null) of merged bitmaps, for each group."""
    return bitmaps.groupBy(*keys, "column").agg(F.sum(F.bitmap_count("bits")).alias("distinct_non_null"))
