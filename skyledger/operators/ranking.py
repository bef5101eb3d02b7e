"""Rankings and month-over-month change. Windows run on aggregate tables only: a partition holds the
carriers of one month, the months of one carrier, or the directed airport pairs of one month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger import contract as C
from skyledger.functions.measures import all_of, ratio


def volume_threshold(aggregate: DataFrame, min_completed: int = C.MIN_COMPLETED_FLIGHTS) -> DataFrame:
    """Rows with enough completed flights and a known rate, through a bound parameter."""
    return aggregate.sparkSession.sql(
        "SELECT * FROM {aggregate} WHERE completed_flights >= :min_completed_flights "
        "AND arrival_delay_rate IS NOT NULL",
        args={"min_completed_flights": min_completed},
        aggregate=aggregate,
    )


def airline_ranking(airline: DataFrame, min_completed: int = C.MIN_COMPLETED_FLIGHTS) -> DataFrame:
    """Rank carriers of a month by delay rate, lowest first; low-volume rows stay with a NULL rank.

    Ineligible rows get a window of their own, which replaces a self-join. A row with a NULL key has no
    identity to compare, so it gets no rank; its rate still counts as one of the ranked rates.
    """
    meets = F.col("completed_flights") >= min_completed
    eligible = F.coalesce(meets & F.col("arrival_delay_rate").isNotNull(), F.lit(False))
    window = Window.partitionBy("YEAR", "MONTH", eligible).orderBy("arrival_delay_rate")
    ranked = eligible & all_of(F.col(k).isNotNull() for k in C.GRAINS["airline"])
    return airline.select(
        "YEAR", "MONTH", "OP_UNIQUE_CARRIER", "completed_flights", "delayed_arrival_flights", "arrival_delay_rate",
        meets.alias("meets_volume_heuristic"),
        F.when(ranked, F.dense_rank().over(window)).alias("arrival_delay_rank"),
    )


def ordered_ranking(ranking: DataFrame) -> DataFrame:
    return ranking.orderBy("YEAR", "MONTH", F.col("arrival_delay_rank").asc_nulls_last(), "OP_UNIQUE_CARRIER")


def high_delay_routes(route: DataFrame, min_completed: int = C.MIN_COMPLETED_FLIGHTS) -> DataFrame:
    """Rank directed route-months by delay rate, highest first; low-volume rows are left out."""
    month = Window.partitionBy("YEAR", "MONTH").orderBy(F.col("arrival_delay_rate").desc())
    return volume_threshold(route, min_completed).select(
        *C.GRAINS["route"], "completed_flights", "delayed_arrival_flights", "arrival_delay_rate",
        F.dense_rank().over(month).alias("observed_delay_rank"),
    )


def ordered_routes(routes: DataFrame) -> DataFrame:
    return routes.orderBy("YEAR", "MONTH", "observed_delay_rank", "ORIGIN", "DEST")


def airline_month_over_month(airline: DataFrame, min_completed: int = C.MIN_COMPLETED_FLIGHTS) -> DataFrame:
    """Each carrier-month beside its previous observed month; changes only if that is the previous calendar month."""
    carrier = Window.partitionBy("OP_UNIQUE_CARRIER").orderBy("YEAR", "MONTH")
    month_start = F.make_date("YEAR", "MONTH", F.lit(1))
    observed = airline.select(
        "YEAR", "MONTH", "OP_UNIQUE_CARRIER", "completed_flights", "delayed_arrival_flights", "arrival_delay_rate",
        F.lag(month_start).over(carrier).alias("previous_month"),
        F.lag("completed_flights").over(carrier).alias("previous_completed_flights"),
        F.lag("delayed_arrival_flights").over(carrier).alias("previous_delayed_flights"),
        F.lag("arrival_delay_rate").over(carrier).alias("previous_delay_rate"),
    )
    adjacent = F.coalesce(F.col("previous_month") == F.add_months(month_start, -1), F.lit(False))
    change = F.col("arrival_delay_rate") - F.col("previous_delay_rate")
    both_large = (F.col("completed_flights") >= min_completed) & (F.col("previous_completed_flights") >= min_completed)
    has_previous = F.col("has_previous_calendar_month")
    return observed.withColumn("has_previous_calendar_month", adjacent).select(
        "*",
        F.when(has_previous, 100.0 * change).alias("delay_rate_change_pp"),
        F.when(has_previous & (F.col("previous_delay_rate") > 0), ratio(100.0 * change, F.col("previous_delay_rate")))
        .alias("delay_rate_relative_change_pct"),
        F.coalesce(has_previous & both_large, F.lit(False)).alias("both_months_meet_volume_heuristic"),
    )


def ordered_months(change: DataFrame) -> DataFrame:
    return change.orderBy("OP_UNIQUE_CARRIER", "YEAR", "MONTH")
