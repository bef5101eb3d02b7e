"""Review of completed flights without arrival values, and of the approved reject list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import all_of, any_of, count_violations, count_when
from skyledger.functions.text import is_missing, to_double
from skyledger.operators.cleaning import classify_arrival_records
from skyledger.operators.compare import same_values
from skyledger.operators.shape import stacked

MARKERS = [f"missing_{c.lower()}" for c in C.ESSENTIAL_ARRIVAL]
REVIEW_ORDER = ["_source_file", "FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME"]


def missing_patterns(suspects: DataFrame) -> DataFrame:
    """Suspects by file and by which fields are blank."""
    return suspects.groupBy(*C.LINEAGE_COLUMNS, *MARKERS).agg(F.count("*").alias("n"))


def arrival_diagnostic(suspects: DataFrame) -> DataFrame:
    """One row: affected rows, blanks per field, rows with all three blank."""
    patterns = missing_patterns(suspects)

    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return patterns.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("affected_rows"),
        *(rows_where(F.col(m)).alias(m) for m in MARKERS),
        rows_where(all_of(F.col(m) for m in MARKERS)).alias("missing_all_three"),
    )


def suspect_sample(suspects: DataFrame, n: int = 1000) -> DataFrame:
    """The first n suspects in review order, to look at; the remaining columns break ties. Approval always works on
    the complete suspects, never on this sample."""
    if n < 1:
        raise ValueError("a review sample holds at least one row")
    rest = [c for c in suspects.columns if c not in REVIEW_ORDER]
    return suspects.orderBy(*REVIEW_ORDER, *rest).limit(n)


def sample_is_truncated(suspects: DataFrame, n: int = 1000) -> DataFrame:
    return arrival_diagnostic(suspects).select("affected_rows", (F.col("affected_rows") > n).alias("rows_truncated"))


def approved_reject_match(rejected: DataFrame, approved: DataFrame) -> DataFrame:
    """Do the rejected records equal the reviewed ones, with the reason worked out anew? One row."""
    expected = classify_arrival_records(approved).select(*rejected.columns)
    return same_values(rejected, expected)


def approved_reject_self_check(approved: DataFrame, recorded: DataFrame) -> DataFrame:
    """The reviewed rows against the one-row record of their review.

    Violations: rows that miss no essential field, rows that are not completed, and how far the row
    count and each blank count are from the recorded ones.
    """
    completed = (to_double(F.col("CANCELLED")) == 0) & (to_double(F.col("DIVERTED")) == 0)
    counted = approved.agg(
        count_violations(any_of(is_missing(c) for c in C.ESSENTIAL_ARRIVAL)).alias("without_missing_field"),
        count_violations(completed).alias("not_completed"),
        F.count("*").alias("_affected_rows"),
        *(count_when(is_missing(c)).alias(f"_{m}") for c, m in zip(C.ESSENTIAL_ARRIVAL, MARKERS)),
    )
    names = ["affected_rows", *MARKERS]
    # One row beside one row: the union is summed, so no join is needed.
    signed = counted.select("without_missing_field", "not_completed", *(F.col(f"_{c}").alias(c) for c in names)).unionByName(
        recorded.select(F.lit(0).alias("without_missing_field"), F.lit(0).alias("not_completed"), *((-F.col(c)).alias(c) for c in names))
    )
    wide = signed.agg(*(F.abs(F.sum(c)).alias(c) for c in signed.columns))
    rows = ((c if c in ("without_missing_field", "not_completed") else f"{c}_differs", F.col(c)) for c in signed.columns)
    checks = stacked(wide, [], rows, ["check", "violations"])
    return checks.withColumn("passed", F.col("violations") == 0)
