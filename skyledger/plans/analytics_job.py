"""Cleaned table to the four aggregate tables, with checks, and the ranking queries over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import count_when, in_period
from skyledger.operators import checks as K
from skyledger.operators import kpi, ranking
from skyledger.operators.compare import compare_aggregates, same_values
from skyledger.operators.rules import grain_stats
from skyledger.plans import sql_views
from skyledger.sources import tables

TABLE_NAMES = {
    "monthly": "monthly_performance",
    "airline": "airline_monthly_performance",
    "origin_airport": "origin_airport_monthly_performance",
    "route": "route_monthly_performance",
}


@dataclass(frozen=True)
class Reference:
    """Aggregate tables kept from an earlier run, by level, and the months they cover."""

    tables: dict[str, DataFrame]
    window: C.Period


def register_views(frames: dict[str, DataFrame]) -> None:
    """Name frames so that SQL text can use them."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def summary_tables(summary: DataFrame) -> dict[str, DataFrame]:
    return {level: kpi.grain_performance(summary, level) for level in C.GRAINS}


def table_checks(level_tables: dict[str, DataFrame]) -> DataFrame:
    """Contract and rules of each table, and every grain summed to months equals the monthly table."""
    monthly = level_tables["monthly"]
    parts = []
    for level, table in level_tables.items():
        grain = C.GRAINS[level]
        one = [K.schema_check(table, C.aggregate_schema(grain)), K.aggregate_checks(table, grain)]
        if level != "monthly":
            one.append(K.reconcile_months(table, monthly))
        parts.append(K.prefixed(K.all_checks(one), level))
    return K.all_checks(parts)


def aggregate_read_back(table: DataFrame, back: DataFrame, monthly: DataFrame, level: str) -> DataFrame:
    """A stored aggregate against the frame that was written: contract, rules, months, all values."""
    grain = C.GRAINS[level]
    return K.all_checks([
        K.schema_check(back, C.aggregate_schema(grain)),
        K.aggregate_checks(back, grain),
        K.reconcile_months(back, monthly),
        K.values_check("all_values", same_values(table, back)),
    ])


def regression_checks(table: DataFrame, reference: DataFrame, level: str, window: C.Period) -> DataFrame:
    """The window of a new table against the kept one, keys first, then every measure."""
    grain = C.GRAINS[level]
    months = len(window.years) * len(window.months)

    def malformed(frame: DataFrame, side: str) -> DataFrame:
        stats = grain_stats(frame, grain, window)
        wrong = (F.col("rows") == 0) | (F.col("rows") != F.col("unique_keys")) | (F.col("periods") != months)
        return K.check_rows(stats, {f"{side}_grain_and_periods": count_when(wrong) + F.sum("invalid_keys")})

    compared = compare_aggregates(table, reference, grain, window).select(
        F.concat_ws(".", "kind", "measure").alias("check"),
        F.col("mismatches").alias("violations"), (F.col("mismatches") == 0).alias("passed"),
    )
    current = table.filter(in_period(window))
    return K.all_checks([
        K.schema_check(reference, table.schema), malformed(current, "current"), malformed(reference, "reference"), compared,
    ])


def business_queries(level_tables: dict[str, DataFrame], min_completed: int = C.MIN_COMPLETED_FLIGHTS) -> dict[str, DataFrame]:
    return {
        "airline_ranking": ranking.ordered_ranking(ranking.airline_ranking(level_tables["airline"], min_completed)),
        "airline_month_over_month": ranking.ordered_months(
            ranking.airline_month_over_month(level_tables["airline"], min_completed)),
        "high_delay_routes": ranking.ordered_routes(ranking.high_delay_routes(level_tables["route"], min_completed)),
    }


def preview(query: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of an ordered query."""
    if rows < 1:
        raise ValueError("a preview shows at least one row")
    return query.limit(rows)


def run(cleaned: DataFrame, baseline: DataFrame, period: C.Period, folder: str,
        reference: Reference | None = None) -> dict[str, DataFrame]:
    """Check the input, aggregate, check, write, read back and check, compare with the reference tables. Afterwards the
    session's SQL knows the functions of `sql_views` and the stored tables by name."""
    spark = cleaned.sparkSession
    K.assert_checks(K.schema_check(cleaned, C.cleaned_schema()), "cleaned schema")
    K.assert_checks(K.input_checks(cleaned, period), "cleaned input")
    summary = kpi.kpi_summary(cleaned).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        level_tables = summary_tables(summary)
        K.assert_checks(table_checks(level_tables), "aggregates")
        K.assert_checks(K.reconcile_baseline(level_tables["monthly"], baseline, period), "baseline")
        K.assert_checks(K.reconcile_status_months(level_tables["monthly"], baseline, period), "baseline months")
        stored = {}
        for level, table in level_tables.items():
            path = f"{folder}/{TABLE_NAMES[level]}"
            tables.write_aggregate(table, path)
            stored[level] = spark.read.schema(C.aggregate_schema(C.GRAINS[level])).parquet(path)
            K.assert_checks(aggregate_read_back(table, stored[level], level_tables["monthly"], level), f"{level} read back")
    finally:
        summary.unpersist()
    for level, kept in (reference.tables if reference else {}).items():
        K.assert_checks(regression_checks(stored[level], kept, level, reference.window), f"{level} regression")
    sql_views.register(cleaned)
    register_views({TABLE_NAMES[level]: table for level, table in stored.items()})  # the stored tables instead of computed ones
    return stored
