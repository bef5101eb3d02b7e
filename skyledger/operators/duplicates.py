"""Exact copies and candidate-key collisions, counted but never dropped.

A group that holds a third of all rows is safe in every operator here: partial counts shrink it to one
row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import any_of, count_when
from skyledger.functions.text import is_missing


def _group_numbers(repeated: Column) -> list[Column]:
    """Groups, rows in groups, and rows beyond the first of each group."""
    size = F.when(repeated, F.col("copies"))
    return [
        count_when(repeated).alias("duplicate_groups"),
        F.coalesce(F.sum(size), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(size - 1), F.lit(0)).alias("excess_rows"),
    ]


def exact_duplicates_direct(raw: DataFrame) -> DataFrame:
    """Group on all 36 columns. Simple, but moves every record in full through the shuffle."""
    groups = raw.groupBy(*C.RAW_COLUMNS).agg(F.count("*").alias("copies"))
    return groups.agg(*_group_numbers(F.col("copies") > 1))


def exact_duplicates(raw: DataFrame) -> DataFrame:
    """Same result for far less shuffle when copies are rare.

    The first pass shuffles only 64-bit row hashes. A row whose hash occurs once has no copy; only
    rows with a repeated hash are compared in full, so hash collisions cannot change the result.

    The join of records with the repeated hashes is left to adaptive execution: it broadcasts the hashes if
    they turn out small and otherwise moves each record once, splitting a hash that very many records share.
    """
    row_hash = F.xxhash64(*C.RAW_COLUMNS)
    repeated = raw.groupBy(row_hash.alias("_row_hash")).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select("_row_hash")
    suspects = raw.select(*C.RAW_COLUMNS, row_hash.alias("_row_hash"))
    return exact_duplicates_direct(suspects.join(repeated, "_row_hash", "left_semi"))


def key_groups(raw: DataFrame) -> DataFrame:
    """Row counts of the candidate keys that collide or are incomplete; keys with one row are left out.

    Both operators below read it; stage it to run its shuffle once.
    """
    groups = raw.groupBy(*C.CANDIDATE_KEY).agg(F.count("*").alias("copies"))
    return groups.filter((F.col("copies") > 1) | _incomplete())


def _incomplete() -> Column:
    return any_of(is_missing(c) for c in C.CANDIDATE_KEY)


def key_collisions(groups: DataFrame) -> DataFrame:
    """Collision numbers over complete keys; rows with an incomplete key are counted apart."""
    incomplete = F.sum(F.when(_incomplete(), F.col("copies")))
    return groups.agg(
        F.coalesce(incomplete, F.lit(0)).alias("incomplete_key_rows"),
        *_group_numbers(~_incomplete() & (F.col("copies") > 1)),
    )


def collision_samples(groups: DataFrame, n: int = 10) -> DataFrame:
    """The complete keys with most rows; equal counts go by key."""
    collisions = groups.filter(~_incomplete() & (F.col("copies") > 1))
    return collisions.orderBy(F.col("copies").desc(), *C.CANDIDATE_KEY).limit(n)
