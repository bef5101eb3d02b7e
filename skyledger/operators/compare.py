"""Comparing tables: exact multisets, keyed aggregates with tolerances, and several tables side by side.

All comparisons stay in Spark; a caller sees counts of differences, never the compared rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import contract as C
from skyledger.functions.measures import any_of, count_when, in_period, same_number
from skyledger.operators.shape import stacked
from skyledger.sources import tables


def type_map(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


#: Parts in which whole wide tables are compared in full, one after the other.
PARTS = 12


def signed_rows(left: DataFrame, right: DataFrame, parts: int = 1) -> DataFrame:
    """Rows whose number differs, with `surplus` = copies on the left minus copies on the right.

    One shuffle for both directions. Equal rows, however many, meet as one partial sum per task.

    A shuffle holds its rows uncolumned, at several times their size as Parquet. With more than one of `parts` (at most so
    many; rows are dealt by a hash of their values) both tables are written once as Parquet, each part is shuffled and compared
    in full by itself, and its files go before the next begins. Then the work is done when this returns, and only differences
    are staged.
    """
    columns = left.columns
    tagged = left.withColumn("surplus", F.lit(1)).unionByName(right.select(*columns).withColumn("surplus", F.lit(-1)))

    def unbalanced(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter(F.col("surplus") != 0)

    return unbalanced(tagged) if parts == 1 else _by_part(tagged, _part(left.schema, parts), parts, unbalanced)


def _part(schema: T.StructType, parts: int) -> Column:
    """Rows that are equal are in the same part. Nested values and collated texts can be equal with different hashes, so only
    plain ones decide."""
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    plain = [f.name for f in schema if not isinstance(f.dataType, (*nested, T.StringType)) or f.dataType == T.StringType()]
    return F.pmod(F.xxhash64(F.lit(0), *plain), F.lit(parts))


def _by_part(tagged: DataFrame, part: Column, parts: int, compared: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `compared` finds in each part, staged."""
    spark = tagged.sparkSession
    dealt, found = tables.scratch_path(spark, "dealt"), tables.staging_path(spark, "differences")
    try:
        with tables.shuffles_dropped(spark):
            tagged.withColumn("surplus_part", part).write.mode("errorifexists").option("compression", "zstd").partitionBy("surplus_part").parquet(dealt)
            for k in range(parts):
                folder = f"{dealt}/surplus_part={k}"
                if tables.exists(spark, folder):
                    compared(spark.read.schema(tagged.schema).parquet(folder)).write.mode("append").parquet(found)
                    tables.discard(spark, folder)
    finally:
        tables.discard(spark, dealt)
    schema = compared(tagged).schema
    return spark.read.schema(schema).parquet(found) if tables.exists(spark, found) else spark.createDataFrame([], schema)


#: Parts in which two tables are compared by digest, a power of two. Their numbers are all that is broadcast.
BUCKETS = 1 << 14


def row_hashes(columns: list[Column]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. A NULL leaves a hash as it was, so which values are NULL is hashed as well; arrays go
    in as text, in which their own NULLs keep their places."""
    nulls = F.concat(*(F.when(c.isNull(), "0").otherwise("1") for c in columns))
    return F.xxhash64(F.lit(1), *columns, nulls), F.xxhash64(F.lit(2), nulls, *columns)


def _hashable(field: T.StructField) -> Column:
    simple = not isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.col(field.name) if simple else F.to_json(F.struct(field.name))


def _digests(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as its two hashes."""
    one, two = row_hashes([_hashable(frame.schema[c]) for c in columns])
    return frame.select(one.alias("one"), two.alias("two"))


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket) of those parts of two tables, dealt by row hash, whose number of rows or sum of row hashes differ.

    A digest is a sum, so it does not depend on the order of rows and counts copies. Each task sends one row a bucket.
    """
    columns = left.columns

    def hashed(frame: DataFrame, sign: int) -> DataFrame:
        rows = _digests(frame, columns)
        signed = lambda c: (F.lit(sign) * F.col(c).cast("decimal(20,0)")).cast("decimal(20,0)")
        return rows.select(F.col("one").bitwiseAND(F.lit(buckets - 1)).alias("bucket"), F.lit(sign).alias("rows"), signed("one").alias("one"), signed("two").alias("two"))

    sums = hashed(left, 1).union(hashed(right, -1)).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("rows", "one", "two")))
    return sums.where("rows <> 0 OR one <> 0 OR two <> 0").select("bucket")


def in_buckets(frame: DataFrame, columns: list[str], found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows that fall into the buckets found."""
    bucket = row_hashes([_hashable(frame.schema[c]) for c in columns])[0].bitwiseAND(F.lit(buckets - 1))
    return frame.join(F.broadcast(found.withColumnRenamed("bucket", "_bucket")), bucket == F.col("_bucket"), "left_semi")  # BUCKETS rows at most


def same_values(left: DataFrame, right: DataFrame, by_digest: bool = False, parts: int = 1) -> DataFrame:
    """One row: how many rows only the left and only the right has, and whether both hold the same multiset.

    Column order is ignored; duplicates and NULLs count; different names or types are never the same. All rows are shuffled,
    unless `by_digest`: then two 64-bit hashes take the place of a row, in one pass over each side, and no full row is shuffled
    whether the tables are equal or not. Two different rows have the same hashes with a probability of about 2^-128 a pair.
    With `parts` as in `signed_rows` full rows are compared with a fraction of them in the shuffle at a time.
    """
    same_types = type_map(left.schema) == type_map(right.schema) and len(left.columns) == len(right.columns)
    if not same_types:
        return left.sparkSession.createDataFrame(
            [(None, None, False)], "only_left bigint, only_right bigint, same boolean"
        )
    if by_digest:
        columns = left.columns
        left, right = (_digests(frame, columns) for frame in (left, right))
    surplus = F.col("surplus")
    counts = signed_rows(left, right, parts).agg(
        F.coalesce(F.sum(F.when(surplus > 0, surplus)), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.when(surplus < 0, -surplus)), F.lit(0)).alias("only_right"),
    )
    return counts.withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def diff(left: DataFrame, right: DataFrame, parts: int = 1) -> DataFrame:
    """Every row, copies included, that one side has more often than the other; one shuffle of the rows, or `parts` of them."""
    copies = F.explode(F.sequence(F.lit(1), F.abs("surplus")))
    return signed_rows(left, right, parts).withColumn("surplus", copies).select(*left.columns)


def side_by_side(frames: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """One row per key found in any frame, with `<frame>__<column>` values and `<frame>__rows`.

    A full outer join of any number of frames in one shuffle: NULL keys match, a repeated key shows as
    a row count above 1 instead of multiplying rows. Its numbers are added up, so totals hold all rows.
    """
    parts = []
    for name, frame in frames.items():
        values = [c for c in frame.columns if c not in keys]
        parts.append(frame.select(
            *keys, F.lit(1).alias(f"{name}__rows"), *(F.col(c).alias(f"{name}__{c}") for c in values)
        ))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    def merge(field: T.StructField) -> Column:
        total = F.sum(field.name) if isinstance(field.dataType, T.NumericType) else F.max(field.name)
        return (F.coalesce(total, F.lit(0)) if field.name.endswith("__rows") else total).alias(field.name)

    merged = [merge(f) for f in union.schema if f.name not in keys]
    return union.groupBy(*keys).agg(*merged)


def _measures(schema: T.StructType, keys: list[str]) -> tuple[list[str], list[str]]:
    doubles = [f.name for f in schema if f.name not in keys and isinstance(f.dataType, T.DoubleType)]
    whole = (T.IntegerType, T.LongType)
    counts = [f.name for f in schema if f.name not in keys and isinstance(f.dataType, whole)]
    return counts, doubles


def _mismatches(current: DataFrame, reference: DataFrame, grain: list[str], common_only: bool) -> DataFrame:
    counts, doubles = _measures(current.schema, grain)
    pairs = side_by_side({"new": current, "old": reference}, grain)
    missing, extra = F.col("new__rows") == 0, F.col("old__rows") == 0
    compared = ~missing & ~extra if common_only else F.lit(True)

    def differs(name: str) -> Column:
        new, old = F.col(f"new__{name}"), F.col(f"old__{name}")
        return compared & ~(same_number(new, old) if name in doubles else new.eqNullSafe(old))

    tests = {"missing_keys": missing, "extra_keys": extra,
             "repeated_keys": (F.col("new__rows") > 1) | (F.col("old__rows") > 1)}
    tests |= {name: differs(name) for name in [*counts, *doubles]}
    kinds = {"missing_keys": "keys", "extra_keys": "keys", "repeated_keys": "keys"}
    kinds |= {c: "counts" for c in counts} | {c: "doubles" for c in doubles}
    wide = pairs.agg(*(count_when(test).alias(name) for name, test in tests.items()))
    return stacked(wide, [], ((kinds[n], n, F.col(n)) for n in tests), ["kind", "measure", "mismatches"])


def compare_aggregates(current: DataFrame, reference: DataFrame, grain: list[str], window: C.Period) -> DataFrame:
    """Mismatches per measure between the window of a new aggregate table and a kept reference table.

    Counts must be equal, doubles equal within tolerance, NULL equals only NULL. A missing or extra key
    also counts in every measure, and a key that a side repeats counts by itself.
    """
    return _mismatches(current.filter(in_period(window)), reference, grain, common_only=False)


def compare_summary(current: DataFrame, reference: DataFrame, grain: list[str], window: C.Period) -> DataFrame:
    """The same for weekday, band and cause tables, where measures are compared on common keys only."""
    return _mismatches(current.filter(in_period(window)), reference, grain, common_only=True)


def month_rollup(table: DataFrame) -> DataFrame:
    """An aggregate table of any grain summed to its months."""
    sums = [*C.COUNT_MEASURES, "arrival_delay_minutes_sum"]
    return table.groupBy("YEAR", "MONTH").agg(*(F.sum(c).alias(c) for c in sums))


def unequal(left: str, right: str, measures: list[str]) -> Column:
    """Any of the measures differs between two sides of `side_by_side`."""
    return any_of(~F.col(f"{left}__{m}").eqNullSafe(F.col(f"{right}__{m}")) for m in measures)


def period_frame(spark, period: C.Period) -> DataFrame:
    """One row per configured month."""
    return spark.createDataFrame([(y, m) for y in period.years for m in period.months], "YEAR int, MONTH int")
