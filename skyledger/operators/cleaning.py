"""Raw text records to typed records, and the accepted / rejected split. All map-only: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import any_of
from skyledger.functions.status import (
    all_causes_reported,
    any_cause_reported,
    flight_status,
    is_delayed,
    is_rejected,
    missing_arrival_fields,
    rejection_reason,
)
from skyledger.functions.text import is_missing, normalized_text, to_double, typed_column


def clean_flights(raw: DataFrame) -> DataFrame:
    """36 typed columns, the source file and the flight status. Keeps every record."""
    typed = raw.select(
        *(typed_column(c).alias(c) for c in C.RAW_COLUMNS),
        normalized_text("_source_file").alias("_source_file"),
    )
    return typed.withColumn("flight_status", flight_status())


def classify_arrival_records(raw: DataFrame) -> DataFrame:
    """Add the blank essential arrival fields and, for completed flights with any, the rejection reason."""
    return raw.withColumn("missing_fields", missing_arrival_fields()).withColumn(
        "rejection_reason", rejection_reason(F.col("missing_fields"))
    )


def split_arrival_records(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted raw records, rejected records): two filters over one classification."""
    source = [*C.RAW_COLUMNS, *C.LINEAGE_COLUMNS]
    accepted = classified.filter(F.col("rejection_reason").isNull()).select(*source)
    rejected = classified.filter(F.col("rejection_reason").isNotNull()).select(
        *source, "rejection_reason", "missing_fields"
    )
    return accepted, rejected


def accepted_flights(raw: DataFrame) -> DataFrame:
    """Cleaned table: the accepted records, typed. The plain condition takes the place of the names of the blank fields."""
    return clean_flights(raw.filter(~is_rejected()))


def rejected_flights(raw: DataFrame) -> DataFrame:
    return split_arrival_records(classify_arrival_records(raw.filter(is_rejected())))[1]


def arrival_suspects(raw: DataFrame) -> DataFrame:
    """Completed raw records with any blank arrival field, with one marker column per field."""
    completed = (to_double(F.col("CANCELLED")) == 0) & (to_double(F.col("DIVERTED")) == 0)
    suspects = raw.filter(completed & any_of(is_missing(c) for c in C.ESSENTIAL_ARRIVAL))
    return suspects.select("*", *(is_missing(c).alias(f"missing_{c.lower()}") for c in C.ESSENTIAL_ARRIVAL))


def unpivot_causes(cleaned: DataFrame) -> DataFrame:
    """Five rows per delayed flight, one per cause; unreported minutes stay NULL."""
    flagged = cleaned.filter(is_delayed()).select(
        "YEAR", "MONTH",
        any_cause_reported().alias("any_cause_reported"),
        all_causes_reported().alias("all_causes_reported"),
        *C.CAUSE_COLUMNS,
    )
    keys = ["YEAR", "MONTH", "any_cause_reported", "all_causes_reported"]
    return flagged.unpivot(keys, C.CAUSE_COLUMNS, "cause_category", "cause_minutes")
