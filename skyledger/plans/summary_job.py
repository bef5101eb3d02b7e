"""Weekday, departure band and delay cause summaries with their checks and CSV export."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import count_violations, in_period
from skyledger.operators import checks as K
from skyledger.operators import kpi
from skyledger.operators.compare import compare_summary, same_values
from skyledger.operators.recount import source_months
from skyledger.sources import tables

QUERIES = {
    "day_of_week": (kpi.day_of_week, kpi.ordered_weekdays, K.weekday_checks),
    "departure_time_band": (kpi.departure_time_band, kpi.ordered_bands, K.band_checks),
    "delay_causes": (kpi.delay_causes, kpi.ordered_causes, K.cause_checks),
}


def csv_checks(summary: DataFrame, path: str, name: str, period: C.Period) -> DataFrame:
    """An exported file against the summary: header names in order, bound, row count, and all values."""
    back = tables.read_summary_csv(summary.sparkSession, path, summary.schema)
    expected = F.array(*map(F.lit, summary.columns))
    sides = summary.agg(F.count("*").alias("n")).union(back.agg(-F.count("*")))
    return K.all_checks([
        K.check_rows(tables.csv_header(summary.sparkSession, path), {"csv_schema": count_violations(F.col("names") == expected)}),
        K.bounded_rows(back, name, period),
        K.check_rows(sides, {"csv_rows": F.abs(F.sum("n"))}),
        K.values_check("csv_values", same_values(summary, back)),
    ])


def csv_round_trip(summary: DataFrame, path: str, name: str, period: C.Period) -> DataFrame:
    """Export in the order of the query, read back, and check."""
    tables.write_summary_csv(summary, path, QUERIES[name][1])
    return csv_checks(summary, path, name, period)


def summary_regression(summary: DataFrame, reference: DataFrame, name: str, window: C.Period) -> DataFrame:
    """The window of a summary against a kept one: schema, bound, values of the domain, keys once each, and measures."""
    mismatches = compare_summary(summary, reference, C.SUMMARY_GRAINS[name], window)
    dimension = C.SUMMARY_GRAINS[name][-1]
    in_domain = F.col(dimension).isin(*C.SUMMARY_DOMAINS[name]) & in_period(window)
    return K.all_checks([
        K.schema_check(reference, summary.schema, "reference_schema"),
        K.prefixed(K.bounded_rows(reference, name, window), "reference"),
        K.check_rows(reference, {"reference_domain_and_period": count_violations(in_domain)}),
        mismatches.select(
            F.concat_ws(".", "kind", "measure").alias("check"),
            F.col("mismatches").alias("violations"), (F.col("mismatches") == 0).alias("passed"),
        ),
    ])


def run(cleaned: DataFrame, baseline: DataFrame, monthly: DataFrame, period: C.Period, folder: str,
        references: dict[str, DataFrame] | None = None, window: C.Period | None = None) -> dict[str, DataFrame]:
    """Recount the input, check it, then build, check and export each summary."""
    recount = source_months(cleaned.select(*C.SUMMARY_INPUT_COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)
    results = {}
    try:
        K.assert_checks(K.source_input_checks(recount, period), "summary input")
        K.assert_checks(K.reconcile_source(recount, baseline, monthly), "recount")
        for name, (build, order, checks) in QUERIES.items():
            # A few rows per month: computed once, then checked, exported and compared.
            summary = build(cleaned).persist(StorageLevel.MEMORY_AND_DISK)
            K.assert_checks(K.bounded_rows(summary, name, period), name)
            K.assert_checks(checks(summary, recount), name)
            K.assert_checks(csv_round_trip(summary, f"{folder}/{name}", name, period), f"{name} csv")
            if references:
                K.assert_checks(summary_regression(summary, references[name], name, window), f"{name} regression")
            results[name] = order(tables.read_summary_csv(cleaned.sparkSession, f"{folder}/{name}", summary.schema))
            summary.unpersist()
    finally:
        recount.unpersist()
    return results
