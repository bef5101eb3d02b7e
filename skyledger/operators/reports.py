"""Reporting views over the aggregate tables. Pooled rates are ratios of sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import in_period, ratio
from skyledger.operators.kpi import DELAY_RATE, period_totals, with_ratios


def monthly_extremes(monthly: DataFrame) -> DataFrame:
    """The months with the highest and lowest delay rate, the most delayed flights and the highest
    cancellation rate. Ties go to the earliest month. The difference is taken before any rounding."""
    month = F.concat_ws("-", F.col("YEAR"), F.lpad(F.col("MONTH").cast("string"), 2, "0"))
    earliest = -(F.col("YEAR") * 12 + F.col("MONTH"))

    def highest(measure):
        return F.max_by(month, F.when(F.col(measure).isNotNull(), F.struct(measure, earliest.alias("_e"))))

    lowest = F.min_by(month, F.when(F.col("arrival_delay_rate").isNotNull(),
                                    F.struct("arrival_delay_rate", (-earliest).alias("_e"))))
    spread = F.max("arrival_delay_rate") - F.min("arrival_delay_rate")
    return monthly.agg(
        highest("arrival_delay_rate").alias("highest_delay_rate_month"),
        F.max("arrival_delay_rate").alias("highest_delay_rate"),
        lowest.alias("lowest_delay_rate_month"),
        F.min("arrival_delay_rate").alias("lowest_delay_rate"),
        (100.0 * spread).alias("delay_rate_spread_pp"),
        highest("delayed_arrival_flights").alias("most_delayed_month"),
        F.max("delayed_arrival_flights").alias("most_delayed_flights"),
        highest("cancellation_rate").alias("highest_cancellation_rate_month"),
        F.max("cancellation_rate").alias("highest_cancellation_rate"),
    )


def month_weekday_heatmap(weekdays: DataFrame) -> DataFrame:
    """Months down, weekdays across, delay rate in the cells. The columns are fixed, so no extra job finds them."""
    days = C.SUMMARY_DOMAINS["day_of_week"]
    wide = weekdays.groupBy("YEAR", "MONTH").pivot("DAY_OF_WEEK", days).agg(F.first("arrival_delay_rate"))
    return wide.select("YEAR", "MONTH", *(F.col(str(d)).alias(f"weekday_{d}") for d in days))


def _pooled(aggregate: DataFrame, *keys: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("total_flights", "completed_flights", "delayed_arrival_flights")]
    return with_ratios(aggregate.groupBy(*keys).agg(*sums), DELAY_RATE)


def band_overview(bands: DataFrame) -> DataFrame:
    return _pooled(bands, "time_band")


def annual_cause_share(causes: DataFrame) -> DataFrame:
    """Minutes per cause over all months, share of all attributed minutes, and the share of the top two
    causes together. Five rows in the end, so one array holds them."""
    by_cause = causes.groupBy("cause_category").agg(F.sum("attributed_minutes").alias("attributed_minutes"))
    gathered = by_cause.agg(
        F.sum("attributed_minutes").alias("all_minutes"),
        F.collect_list(F.struct("cause_category", "attributed_minutes")).alias("causes"),
        F.array_sort(F.collect_list("attributed_minutes")).alias("sorted_minutes"),
    )
    top_two = F.aggregate(F.slice(F.reverse("sorted_minutes"), 1, 2), F.lit(0.0), lambda total, m: total + m)
    return gathered.select("all_minutes", top_two.alias("top_two_minutes"), F.inline("causes")).select(
        "cause_category", "attributed_minutes",
        ratio(F.col("attributed_minutes"), F.col("all_minutes")).alias("minute_share"),
        ratio(F.col("top_two_minutes"), F.col("all_minutes")).alias("top_two_share"),
    )


def top_airlines(airline: DataFrame, n: int = 5, min_completed: int = C.TOP_AIRLINES_MIN_COMPLETED) -> DataFrame:
    """Carriers with the highest pooled delay rate among those with enough completed flights."""
    pooled = _pooled(airline, "OP_UNIQUE_CARRIER").filter(F.col("completed_flights") >= min_completed)
    return pooled.orderBy(F.col("arrival_delay_rate").desc_nulls_last(), "OP_UNIQUE_CARRIER").limit(n)


def top_origins(origin: DataFrame, measure: str, n: int = 10) -> DataFrame:
    """Departure airports with the largest pooled `completed_flights` or `delayed_arrival_flights`."""
    return _pooled(origin, "ORIGIN").orderBy(F.col(measure).desc(), "ORIGIN").limit(n)


def window_totals(monthly: DataFrame, window: C.Period) -> DataFrame:
    """Totals and rates of a chosen set of months."""
    return period_totals(monthly.filter(in_period(window)))
