"""Flight status, missing arrival fields, departure bands and cause coverage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import all_of, any_of
from skyledger.functions.text import is_missing, safe_binary_flag, to_double


def status_of(cancelled: Column, diverted: Column) -> Column:
    """completed / cancelled / diverted, and invalid for any other pair, NULLs included."""
    return (
        F.when((cancelled == 0) & (diverted == 0), "completed")
        .when((cancelled == 1) & (diverted == 0), "cancelled")
        .when((cancelled == 0) & (diverted == 1), "diverted")
        .otherwise("invalid")
    )


def flight_status() -> Column:
    """Status of a cleaned record."""
    return status_of(F.col("CANCELLED"), F.col("DIVERTED"))


def raw_status() -> Column:
    """Status of a raw record, from the flag text."""
    return status_of(to_double(F.col("CANCELLED")), to_double(F.col("DIVERTED")))


def profile_status() -> Column:
    """Status of a raw record with the two invalid kinds told apart."""
    cancelled, diverted = to_double(F.col("CANCELLED")), to_double(F.col("DIVERTED"))
    both = (cancelled == 1) & (diverted == 1)
    known = status_of(cancelled, diverted)
    return (
        F.when(known != "invalid", known)
        .when(both, "invalid_both_flags")
        .otherwise("invalid_or_missing_flags")
    )


def missing_arrival_fields() -> Column:
    """Names of the blank essential arrival fields, in contract order."""
    names = [F.when(is_missing(c), F.lit(c)).otherwise(F.lit("")) for c in C.ESSENTIAL_ARRIVAL]
    # Not array_compact: Spark interprets its lambda, and with it all expressions that the columns are made of.
    return F.array_remove(F.array(*names), "")


def raw_completed() -> Column:
    """True or False, never NULL."""
    return F.coalesce((safe_binary_flag("CANCELLED") == 0) & (safe_binary_flag("DIVERTED") == 0), F.lit(False))


def is_rejected() -> Column:
    """Completed with a blank essential arrival field; True or False, never NULL."""
    return raw_completed() & any_of(is_missing(c) for c in C.ESSENTIAL_ARRIVAL)


def rejection_reason(missing_fields: Column) -> Column:
    return F.when(raw_completed() & (F.size(missing_fields) > 0), F.lit(C.REJECTION_REASON))


def is_completed() -> Column:
    return F.col("flight_status") == "completed"


def is_delayed() -> Column:
    return is_completed() & (F.col("ARR_DEL15") == 1)


def time_band(clock: str = "CRS_DEP_TIME") -> Column:
    """Departure band of an HHmm text. Comparing texts is safe once the format is known to be right."""
    value = F.col(clock)
    band = F.when(value.isNull(), "Missing").when(value == "2400", "Night")
    band = band.when(~value.rlike(C.CLOCK_PATTERN_BELOW_2400), "Invalid")
    for name, (_, last) in C.BAND_LIMITS.items():
        band = band.when(value <= last, name)
    return band


def any_cause_reported() -> Column:
    return any_of(F.col(c).isNotNull() for c in C.CAUSE_COLUMNS)


def all_causes_reported() -> Column:
    return all_of(F.col(c).isNotNull() for c in C.CAUSE_COLUMNS)
