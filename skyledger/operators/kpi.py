"""KPI aggregates: the shared summary, the four grains, weekday, band, cause and annual tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger import contract as C
from skyledger.functions.measures import count_when, ratio
from skyledger.functions.status import (
    all_causes_reported,
    any_cause_reported,
    is_completed,
    is_delayed,
    time_band,
)

DIMENSIONS = ["YEAR", "MONTH", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST"]


def _status_count(status: str) -> Column:
    return count_when(F.col("flight_status") == status)


def additive_measures() -> list[Column]:
    """Seven counts and the signed minute sum; all can be summed to a coarser grain."""
    completed = is_completed()
    delay = F.when(completed, F.col("ARR_DELAY"))
    return [
        F.count("*").alias("total_flights"),
        _status_count("completed").alias("completed_flights"),
        _status_count("cancelled").alias("cancelled_flights"),
        _status_count("diverted").alias("diverted_flights"),
        count_when(is_delayed()).alias("delayed_arrival_flights"),
        count_when(completed & (F.col("ARR_DEL15") == 0)).alias("on_time_arrival_flights"),
        F.count(delay).alias("arrival_delay_observed_flights"),
        F.sum(delay).alias("arrival_delay_minutes_sum"),
    ]


def rolled_up_measures() -> list[Column]:
    return [F.sum(c).alias(c) for c in [*C.COUNT_MEASURES, "arrival_delay_minutes_sum"]]


def with_ratios(frame: DataFrame, parts: dict[str, tuple[str, str]] = C.RATIO_PARTS) -> DataFrame:
    """Ratio of sums for every rate and for the signed average."""
    return frame.select("*", *(ratio(F.col(n), F.col(d)).alias(name) for name, (n, d) in parts.items()))


def level_label() -> Column:
    """Which grain a grouping-sets row belongs to. A NULL key in the source is not a subtotal."""
    present = {c: F.grouping(c) == 0 for c in ("OP_UNIQUE_CARRIER", "ORIGIN", "DEST")}
    return (
        F.when(present["OP_UNIQUE_CARRIER"], "airline")
        .when(present["DEST"], "route")
        .when(present["ORIGIN"], "origin_airport")
        .otherwise("monthly")
    )


def _grain_sets(frame: DataFrame, measures: list[Column]) -> DataFrame:
    grouped = frame.groupingSets([[F.col(k) for k in keys] for keys in C.GRAINS.values()], *DIMENSIONS)
    labelled = grouped.agg(level_label().alias("aggregation_level"), *measures)
    return with_ratios(labelled).select(*DIMENSIONS, "aggregation_level", *C.KPI_MEASURES)


def finest_grain(cleaned: DataFrame) -> DataFrame:
    """One row per month, carrier, origin and destination: the flight table is read once, and map-side
    partial sums collapse even a month or airport that holds a third of all flights."""
    return cleaned.groupBy(*DIMENSIONS).agg(*additive_measures())


def kpi_summary(cleaned: DataFrame) -> DataFrame:
    """All four grains in one frame, rolled up from the finest grain.

    Grouping sets copy their input once per grain, so they run on the small rolled-up rows.
    """
    return summary_of_finest(finest_grain(cleaned))


def summary_of_finest(finest: DataFrame) -> DataFrame:
    """The four grains from partial measures, computed just now or stored."""
    return _grain_sets(finest, rolled_up_measures())


def kpi_summary_direct(cleaned: DataFrame) -> DataFrame:
    """The same result with grouping sets over the flights themselves; used to test the roll-up."""
    return _grain_sets(cleaned, additive_measures())


def grain_performance(summary: DataFrame, level: str) -> DataFrame:
    """One grain of the summary with its own key columns."""
    return summary.filter(F.col("aggregation_level") == level).select(*C.GRAINS[level], *C.KPI_MEASURES)


def grain_table(cleaned: DataFrame, level: str) -> DataFrame:
    """One grain alone, without computing the other three."""
    keys = C.GRAINS[level]
    return with_ratios(cleaned.groupBy(*keys).agg(*additive_measures())).select(*keys, *C.KPI_MEASURES)


def _delay_counts() -> list[Column]:
    return [
        F.count("*").alias("total_flights"),
        _status_count("completed").alias("completed_flights"),
        count_when(is_delayed()).alias("delayed_arrival_flights"),
    ]


DELAY_RATE = {"arrival_delay_rate": C.RATE_PARTS["arrival_delay_rate"]}


def day_of_week(cleaned: DataFrame) -> DataFrame:
    """Month and weekday, 1 = Monday. Only weekdays that occur have a row."""
    counts = cleaned.groupBy("YEAR", "MONTH", "DAY_OF_WEEK").agg(*_delay_counts())
    return with_ratios(counts, DELAY_RATE)


def departure_time_band(cleaned: DataFrame) -> DataFrame:
    """Month and scheduled departure band."""
    banded = cleaned.withColumn("time_band", time_band())
    counts = banded.groupBy("YEAR", "MONTH", "time_band").agg(
        *_delay_counts(), count_when(F.col("CRS_DEP_TIME") == "2400").alias("scheduled_2400_flights")
    )
    return with_ratios(counts, DELAY_RATE)


def _cause_totals(cleaned: DataFrame) -> DataFrame:
    """Per month, the cause counts and minutes of delayed flights side by side."""
    delayed = cleaned.filter(is_delayed())
    return delayed.groupBy("YEAR", "MONTH").agg(
        F.count("*").alias("eligible_delayed_flights"),
        count_when(any_cause_reported()).alias("flights_with_any_reported_cause"),
        count_when(all_causes_reported()).alias("flights_with_all_reported_causes"),
        *(F.count(c).alias(f"reported_{c}") for c in C.CAUSE_COLUMNS),
        *(F.sum(c).alias(f"minutes_{c}") for c in C.CAUSE_COLUMNS),
    )


def delay_causes(cleaned: DataFrame) -> DataFrame:
    """Month and cause: coverage counts, attributed minutes and their share of the month.

    The coverage counts of the flights repeat on the five rows of a month and must not be summed.
    Flights are aggregated to one row per month first and only those rows are turned into five, so the
    flight rows are never multiplied.
    """
    cells = ", ".join(f"'{c}', reported_{c}, minutes_{c}" for c in C.CAUSE_COLUMNS)
    long = _cause_totals(cleaned).selectExpr(
        "YEAR", "MONTH", "eligible_delayed_flights",
        "flights_with_any_reported_cause", "flights_with_all_reported_causes",
        f"stack({len(C.CAUSE_COLUMNS)}, {cells}) AS (cause_category, reported_cause_flights, attributed_minutes)",
    )
    month = Window.partitionBy("YEAR", "MONTH")  # five rows
    return (
        long.withColumn("monthly_attributed_minutes", F.sum("attributed_minutes").over(month))
        .withColumn("cause_minute_share", ratio(F.col("attributed_minutes"), F.col("monthly_attributed_minutes")))
        .select(
            "YEAR", "MONTH", "cause_category", "eligible_delayed_flights", "reported_cause_flights",
            "flights_with_any_reported_cause", "flights_with_all_reported_causes",
            "attributed_minutes", "monthly_attributed_minutes", "cause_minute_share",
        )
    )


def period_totals(monthly: DataFrame) -> DataFrame:
    """One row of sums over months with ratios of the sums, e.g. for a year or a quarter."""
    return with_ratios(monthly.agg(*rolled_up_measures())).select(*C.KPI_MEASURES)


annual_summary = period_totals


def ordered_bands(bands: DataFrame) -> DataFrame:
    position = F.array_position(F.array(*map(F.lit, C.BAND_ORDER)), F.col("time_band"))
    return bands.orderBy("YEAR", "MONTH", position)


def ordered_causes(causes: DataFrame) -> DataFrame:
    return causes.orderBy("YEAR", "MONTH", F.col("cause_minute_share").desc_nulls_last(), "cause_category")


def ordered_weekdays(weekdays: DataFrame) -> DataFrame:
    return weekdays.orderBy("YEAR", "MONTH", "DAY_OF_WEEK")
