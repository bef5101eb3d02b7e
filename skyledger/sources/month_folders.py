"""Tables in YEAR= / MONTH= folders: which months changed since they were last looked at.

A month's version is the number of its files and a digest of their names and lengths, read from the listing alone. Spark
gives every file it writes a new name, so a month that was written again has another version even if it is as long as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.measures import any_of
from skyledger.sources import tables

MONTH = ["YEAR", "MONTH"]


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(YEAR, MONTH, files, version) of each month folder."""
    listing = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, YEAR int, MONTH int").load(path)
    name = F.regexp_extract("path", "[^/]+$", 0)
    return listing.groupBy(*MONTH).agg(F.count("*").alias("files"), F.bit_xor(F.xxhash64(name, "length")).alias("version"))


def known_versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions a state was made from, empty before its first refresh."""
    schema = "YEAR int, MONTH int, files long, version long"
    return spark.read.schema(schema).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], schema)


def changes(now: DataFrame, known: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """(months new or written again, months no longer there); a month is one small row, so the lists reach the driver."""
    before = known.select(*MONTH, F.struct("files", "version").alias("before"))
    after = now.select(*MONTH, F.struct("files", "version").alias("after"))
    same_month = [after[k].eqNullSafe(before[k]) for k in MONTH]
    both = after.join(before, same_month, "full").where(~F.col("after").eqNullSafe(F.col("before")))
    found = both.select(*(F.when(F.col("after").isNull(), before[k]).otherwise(after[k]).alias(k) for k in MONTH), F.col("after").isNull().alias("gone")).collect()
    pick = lambda gone: [(r["YEAR"], r["MONTH"]) for r in found if r["gone"] == gone]
    return pick(False), pick(True)


def in_months(months: list[tuple]) -> Column:
    """A condition on the folder columns alone, so it chooses folders."""
    same = [F.col("YEAR").eqNullSafe(F.lit(y).cast("int")) & F.col("MONTH").eqNullSafe(F.lit(m).cast("int")) for y, m in months]
    return any_of(same) if same else F.lit(False)


def folder(path: str, month: tuple) -> str:
    named = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in month)
    return path + "".join(f"/{k}={v}" for k, v in zip(MONTH, named))
