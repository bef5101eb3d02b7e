"""Profile of the raw text records, without changing any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import count_when
from skyledger.functions.status import profile_status, raw_status
from skyledger.functions.text import is_missing, is_present, parse_flight_timestamp, to_double, to_int
from skyledger.operators.shape import stacked

FILE_KEYS = ["_source_file", "_source_year", "_source_month"]


def file_profile(raw: DataFrame) -> DataFrame:
    """Per file: rows, blank values of each of the 36 columns, and the five statuses. Wide, one row per file."""
    status = raw.select("*", profile_status().alias("_status"))
    return status.groupBy(*FILE_KEYS).agg(
        F.count("*").alias("row_count"),
        *(count_when(is_missing(c)).alias(f"missing__{c}") for c in C.RAW_COLUMNS),
        *(count_when(F.col("_status") == s).alias(f"status__{s}") for s in C.PROFILE_STATUSES),
    )


def overall_profile(profile: DataFrame) -> DataFrame:
    """All files together: counts are summed, so percents are never averaged."""
    counts = [c for c in profile.columns if c not in FILE_KEYS]
    return profile.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts))


def missing_values(profile: DataFrame) -> DataFrame:
    """Long form of a file or overall profile: blank count and percent of each column."""
    keys = [c for c in FILE_KEYS if c in profile.columns]
    rows = ((c, F.col(f"missing__{c}"), F.col("row_count")) for c in C.RAW_COLUMNS)
    long = stacked(profile, keys, rows, ["column", "missing_count", "row_count"])
    percent = F.when(F.col("row_count") > 0, F.round(F.col("missing_count") / F.col("row_count") * 100, 4))
    return long.withColumn("missing_percent", F.coalesce(percent, F.lit(0.0)))


def status_profile(profile: DataFrame) -> DataFrame:
    """Status counts of a profile with their total and whether it equals the row count."""
    keys = [c for c in FILE_KEYS if c in profile.columns]
    counts = [F.col(f"status__{s}") for s in C.PROFILE_STATUSES]
    total = sum(counts[1:], counts[0])
    return profile.select(
        *keys, "row_count",
        *(c.alias(s) for c, s in zip(counts, C.PROFILE_STATUSES)),
        total.alias("reconciled_total"),
        (total == F.col("row_count")).alias("status_reconciles"),
    )


def _casts() -> dict:
    numbers = {c: to_int(F.col(c)) for c in C.INT_COLUMNS}
    return numbers | {c: to_double(F.col(c)) for c in C.RAW_COLUMNS if c in C.FLAG_COLUMNS + C.MEASURE_COLUMNS}


def cast_failures(raw: DataFrame) -> DataFrame:
    """Values that are present but do not convert, for each numeric column and the flight date."""
    casts = _casts() | {C.DATE_COLUMN: parse_flight_timestamp(F.col(C.DATE_COLUMN))}
    wide = raw.agg(*(count_when(is_present(c) & e.isNull()).alias(c) for c, e in casts.items()))
    return stacked(wide, [], ((c, F.col(c)) for c in casts), ["column", "cast_failures"])


def numeric_ranges(raw: DataFrame) -> DataFrame:
    """Smallest and largest value of each numeric column."""
    casts = _casts()
    wide = raw.agg(*(f(e).alias(f"{n}__{c}") for c, e in casts.items() for n, f in (("min", F.min), ("max", F.max))))
    rows = ((c, F.col(f"min__{c}").cast("double"), F.col(f"max__{c}").cast("double")) for c in casts)
    return stacked(wide, [], rows, ["column", "min_value", "max_value"])


def distinct_counts(raw: DataFrame) -> DataFrame:
    """Exact number of distinct non-NULL values. Values are made unique per column before they are
    counted, so a value that fills a third of the rows leaves each map task only once."""
    pairs = raw.select(F.explode(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in C.CARDINALITY_COLUMNS
    ))).alias("pair")).select("pair.*")
    return pairs.distinct().groupBy("column").agg(F.count("value").alias("distinct_non_null"))


def value_counts(raw: DataFrame, columns: list[str] = C.VALUE_COUNT_COLUMNS) -> DataFrame:
    """Frequency of every value, NULL included. The columns have few values, so combinations are counted
    first and only those are turned into one row per column."""
    combined = raw.groupBy(*columns).agg(F.count("*").alias("n"))
    return (
        unpivot_values(combined, columns, keep=["n"])
        .groupBy("column", "value").agg(F.sum("n").alias("value_count"))
    )


def unpivot_values(frame: DataFrame, columns: list[str] = C.VALUE_COUNT_COLUMNS, keep: list[str] = ()) -> DataFrame:
    """(column, value) rows of the named text columns, NULL values included."""
    return frame.unpivot(list(keep), columns, "column", "value")


def ordered_value_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy("column", F.col("value_count").desc(), F.col("value").asc_nulls_last())


def raw_summary(raw: DataFrame) -> DataFrame:
    """Per file: rows and the four raw statuses."""
    status = raw.select(*FILE_KEYS, raw_status().alias("_status"))
    return status.groupBy(*FILE_KEYS).agg(
        F.count("*").alias("row_count"),
        *(count_when(F.col("_status") == s).alias(s) for s in C.STATUSES_WITH_INVALID),
    )


def coverage_checks(profile: DataFrame, period: C.Period, files: DataFrame) -> DataFrame:
    """Every configured file has rows and no other file does, every period is present, statuses reconcile.

    `files` holds one `file_name` per configured file.
    """
    observed = profile.select("_source_file", "_source_year", "_source_month")
    matched = observed.select(F.col("_source_file").alias("file_name")).distinct().withColumn("_observed", F.lit(1)).join(
        files.select("file_name").distinct().withColumn("_configured", F.lit(1)), "file_name", "full"
    )
    file_check = matched.agg(
        F.lit("all_configured_files_have_rows").alias("check"),
        count_when(F.col("_observed").isNull() | F.col("_configured").isNull()).alias("violations"),
    )
    expected = [(y, m) for y in period.years for m in period.months]
    periods = profile.sparkSession.createDataFrame(expected, "year int, month int").withColumn("_configured", F.lit(1))
    seen = observed.select(F.col("_source_year").alias("year"), F.col("_source_month").alias("month")).distinct()
    period_check = seen.withColumn("_observed", F.lit(1)).join(periods, ["year", "month"], "full").agg(
        F.lit("all_configured_periods_present").alias("check"),
        count_when(F.col("_observed").isNull() | F.col("_configured").isNull()).alias("violations"),
    )
    status_check = status_profile(profile).agg(
        F.lit("status_reconciles").alias("check"),
        count_when(~F.col("status_reconciles")).alias("violations"),
    )
    union = file_check.unionByName(period_check).unionByName(status_check)
    return union.withColumn("passed", F.col("violations") == 0)
