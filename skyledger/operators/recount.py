"""An independent monthly recount of the cleaned flights, to hold the summaries against.

It counts with conditions of its own (band limits instead of the band expression, one column per
weekday and cause instead of grouping), so an error in a summary does not repeat here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import all_of, any_of, count_violations, count_when, is_finite
from skyledger.functions.status import flight_status, is_completed, is_delayed
from skyledger.functions.text import is_missing

INPUT_COUNTERS = [
    "invalid_weekdays", "invalid_statuses", "invalid_labels", "invalid_cause_rows",
    "status_flag_mismatches", "missing_completed_arrival", "nonfinite_arrival_delay",
]


def source_months(cleaned: DataFrame) -> DataFrame:
    """One row per month, about fifty counters, one pass."""
    completed, delayed = is_completed(), is_delayed()
    label, clock, delay = F.col("ARR_DEL15"), F.col("CRS_DEP_TIME"), F.col("ARR_DELAY")
    well_formed = clock.rlike(C.CLOCK_PATTERN_BELOW_2400)
    reported = [F.col(c).isNotNull() for c in C.CAUSE_COLUMNS]
    bad_causes = [F.col(c).isNotNull() & ~((F.col(c) >= 0) & is_finite(F.col(c))) for c in C.CAUSE_COLUMNS]
    counters = {
        **{f"{s}_flights": F.col("flight_status") == s for s in C.STATUSES},
        "on_time_arrival_flights": completed & (label == 0),
        "delayed_arrival_flights": delayed,
        "missing_completed_arrival": completed & (is_missing("ARR_TIME") | delay.isNull() | label.isNull()),
        "nonfinite_arrival_delay": delay.isNotNull() & ~is_finite(delay),
        "missing_times": clock.isNull(),
        "invalid_times": (clock != "2400") & ~well_formed,
        "midnight_2400": clock == "2400",
        "invalid_cause_rows": any_of(bad_causes),
        "any_reported": delayed & any_of(reported),
        "all_reported": delayed & all_of(reported),
        **{f"weekday_{d}": F.col("DAY_OF_WEEK") == d for d in C.SUMMARY_DOMAINS["day_of_week"]},
    }
    for band, (first, last) in C.BAND_LIMITS.items():
        inside = well_formed & clock.between(first, last)
        counters[f"band_{band}"] = inside | (clock == "2400") if band == "Night" else inside
    must_hold = {
        "invalid_weekdays": F.col("DAY_OF_WEEK").between(1, 7),
        "invalid_statuses": F.col("flight_status").isin(*C.STATUSES),
        "status_flag_mismatches": F.col("flight_status").eqNullSafe(flight_status()),
        "invalid_labels": F.when(completed, label.isin(0, 1)).otherwise(label.isNull()),
    }
    return cleaned.groupBy("YEAR", "MONTH").agg(
        F.count("*").alias("total_flights"),
        *(count_when(c).alias(name) for name, c in counters.items()),
        *(count_violations(rule).alias(name) for name, rule in must_hold.items()),
        *(F.count(F.when(delayed, F.col(c))).alias(f"reported_{c}") for c in C.CAUSE_COLUMNS),
        *(F.sum(F.when(delayed, F.col(c))).alias(f"minutes_{c}") for c in C.CAUSE_COLUMNS),
    )
