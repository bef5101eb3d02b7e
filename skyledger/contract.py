"""The data contract: column names, types, value domains and thresholds.

Everything here is a fixed value; no logic beyond building Spark schemas from the lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: the raw record ------------------------------------------------------

RAW_COLUMNS = [
    "YEAR", "MONTH", "DAY_OF_WEEK", "FL_DATE",
    "OP_UNIQUE_CARRIER", "OP_CARRIER_AIRLINE_ID", "TAIL_NUM", "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID", "ORIGIN_AIRPORT_SEQ_ID", "ORIGIN_CITY_MARKET_ID", "ORIGIN", "ORIGIN_CITY_NAME",
    "DEST_AIRPORT_ID", "DEST_AIRPORT_SEQ_ID", "DEST_CITY_MARKET_ID", "DEST", "DEST_CITY_NAME",
    "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY", "DEP_DEL15",
    "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15",
    "CANCELLED", "CANCELLATION_CODE", "DIVERTED", "DISTANCE",
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]
INT_COLUMNS = [
    "YEAR", "MONTH", "DAY_OF_WEEK", "OP_CARRIER_AIRLINE_ID",
    "ORIGIN_AIRPORT_ID", "ORIGIN_AIRPORT_SEQ_ID", "ORIGIN_CITY_MARKET_ID",
    "DEST_AIRPORT_ID", "DEST_AIRPORT_SEQ_ID", "DEST_CITY_MARKET_ID",
]
FLAG_COLUMNS = ["DEP_DEL15", "ARR_DEL15", "CANCELLED", "DIVERTED"]
CLOCK_COLUMNS = ["CRS_DEP_TIME", "DEP_TIME", "CRS_ARR_TIME", "ARR_TIME"]
CAUSE_COLUMNS = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]
MEASURE_COLUMNS = ["DEP_DELAY", "ARR_DELAY", "ARR_DELAY_NEW", "DISTANCE", *CAUSE_COLUMNS]
DATE_COLUMN = "FL_DATE"

LINEAGE_COLUMNS = ["_source_file", "_source_year", "_source_month"]
ESSENTIAL_ARRIVAL = ["ARR_TIME", "ARR_DELAY", "ARR_DEL15"]
CANDIDATE_KEY = [
    "FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME",
]
CARDINALITY_COLUMNS = ["OP_UNIQUE_CARRIER", "TAIL_NUM", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST"]
VALUE_COUNT_COLUMNS = [
    "YEAR", "MONTH", "DAY_OF_WEEK", "DEP_DEL15", "ARR_DEL15", "CANCELLED", "DIVERTED", "CANCELLATION_CODE",
]

# --- fixed values: formats and domains -------------------------------------------------

FLIGHT_DATE_FORMAT = "M/d/yyyy h:mm:ss a"
# Java's `$` also accepts one trailing newline; the CSV reader never yields one inside a field.
CLOCK_PATTERN = r"^(?:(?:[01]\d|2[0-3])[0-5]\d|2400)$"
CLOCK_PATTERN_BELOW_2400 = r"^([01][0-9]|2[0-3])[0-5][0-9]$"
SOURCE_FILE_PATTERN = r"(?i)_(\d{4})_(\d{2})\.csv$"
SHA256_PATTERN = r"^[0-9a-fA-F]{64}$"

STATUSES = ["completed", "cancelled", "diverted"]
STATUSES_WITH_INVALID = [*STATUSES, "invalid"]
PROFILE_STATUSES = [*STATUSES, "invalid_both_flags", "invalid_or_missing_flags"]
REJECTION_REASON = "completed_missing_essential_arrival"
NO_PARTITION = "null_or_invalid_partition"

# band -> inclusive HHmm limits; 2400 counts as Night
BAND_LIMITS = {
    "Night": ("0000", "0559"),
    "Morning": ("0600", "1159"),
    "Afternoon": ("1200", "1759"),
    "Evening": ("1800", "2359"),
}
BAND_ORDER = [*BAND_LIMITS, "Missing", "Invalid"]

# --- fixed values: measures ------------------------------------------------------------

COUNT_MEASURES = [
    "total_flights", "completed_flights", "cancelled_flights", "diverted_flights",
    "delayed_arrival_flights", "on_time_arrival_flights", "arrival_delay_observed_flights",
]
STATUS_MEASURES = COUNT_MEASURES[:4]
# identity -> a count and the counts it is the sum of
COUNT_IDENTITIES = {
    "status_reconciliation": ("total_flights", ["completed_flights", "cancelled_flights", "diverted_flights"]),
    "label_reconciliation": ("completed_flights", ["delayed_arrival_flights", "on_time_arrival_flights"]),
}
RATE_PARTS = {
    "arrival_delay_rate": ("delayed_arrival_flights", "completed_flights"),
    "on_time_arrival_rate": ("on_time_arrival_flights", "completed_flights"),
    "cancellation_rate": ("cancelled_flights", "total_flights"),
    "diversion_rate": ("diverted_flights", "total_flights"),
}
RATIO_PARTS = {
    **RATE_PARTS,
    "average_arrival_delay": ("arrival_delay_minutes_sum", "arrival_delay_observed_flights"),
}
KPI_MEASURES = [*COUNT_MEASURES, "arrival_delay_minutes_sum", "average_arrival_delay", *RATE_PARTS]
DOUBLE_MEASURES = [*RATE_PARTS, "arrival_delay_minutes_sum", "average_arrival_delay"]

GRAINS = {
    "monthly": ["YEAR", "MONTH"],
    "airline": ["YEAR", "MONTH", "OP_UNIQUE_CARRIER"],
    "origin_airport": ["YEAR", "MONTH", "ORIGIN"],
    "route": ["YEAR", "MONTH", "ORIGIN", "DEST"],
}
SUMMARY_GRAINS = {
    "day_of_week": ["YEAR", "MONTH", "DAY_OF_WEEK"],
    "departure_time_band": ["YEAR", "MONTH", "time_band"],
    "delay_causes": ["YEAR", "MONTH", "cause_category"],
}
SUMMARY_DOMAINS = {
    "day_of_week": list(range(1, 8)),
    "departure_time_band": BAND_ORDER,
    "delay_causes": CAUSE_COLUMNS,
}
# The cleaned columns the weekday, band and cause summaries need.
SUMMARY_INPUT_COLUMNS = [
    "YEAR", "MONTH", "DAY_OF_WEEK", "CRS_DEP_TIME", "flight_status", "ARR_DEL15",
    "ARR_TIME", "ARR_DELAY", "CANCELLED", "DIVERTED", *CAUSE_COLUMNS,
]

# --- fixed values: thresholds and tolerances -------------------------------------------

MIN_COMPLETED_FLIGHTS = 30          # volume heuristic of the ranking queries
TOP_AIRLINES_MIN_COMPLETED = 1000   # presentation threshold, pooled airlines
ROUTE_MONTH_MIN_COMPLETED = 300     # presentation threshold, route-months
REGRESSION_ABS_TOL = 1e-9
REGRESSION_REL_TOL = 1e-12
MONTH_SUM_ABS_TOL = 1e-8
FORMULA_REL_TOL = 1e-12
LARGEST_DOUBLE = 1.7976931348623157e308


@dataclass(frozen=True)
class Period:
    """The years and months a data set is meant to cover."""

    years: tuple[int, ...]
    months: tuple[int, ...] = tuple(range(1, 13))


def raw_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def raw_with_lineage_schema() -> T.StructType:
    lineage = {"_source_file": T.StringType(), "_source_year": T.IntegerType(), "_source_month": T.IntegerType()}
    return T.StructType([*raw_schema().fields, *(T.StructField(c, t) for c, t in lineage.items())])


def cleaned_schema() -> T.StructType:
    def target(column: str) -> T.DataType:
        if column in INT_COLUMNS or column in FLAG_COLUMNS:
            return T.IntegerType()
        if column in MEASURE_COLUMNS:
            return T.DoubleType()
        return T.DateType() if column == DATE_COLUMN else T.StringType()

    fields = [T.StructField(c, target(c)) for c in RAW_COLUMNS]
    fields += [T.StructField("_source_file", T.StringType()), T.StructField("flight_status", T.StringType())]
    return T.StructType(fields)


def rejected_schema() -> T.StructType:
    extra = [
        T.StructField("rejection_reason", T.StringType()),
        T.StructField("missing_fields", T.ArrayType(T.StringType())),
    ]
    return T.StructType([*raw_with_lineage_schema().fields, *extra])


def aggregate_schema(grain: list[str]) -> T.StructType:
    keys = [T.StructField(k, T.IntegerType() if k in ("YEAR", "MONTH") else T.StringType()) for k in grain]
    counts = [T.StructField(c, T.LongType()) for c in COUNT_MEASURES]
    doubles = [T.StructField(c, T.DoubleType()) for c in KPI_MEASURES if c not in COUNT_MEASURES]
    return T.StructType([*keys, *counts, *doubles])
