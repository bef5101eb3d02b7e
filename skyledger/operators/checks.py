"""Checks as rows: (check, violations, passed). Nothing is collected except by `assert_checks`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import contract as C
from skyledger.functions.measures import (
    all_of,
    any_of,
    count_violations,
    count_when,
    is_finite,
    ratio,
    same_number,
)
from skyledger.operators.compare import month_rollup, period_frame, side_by_side, type_map, unequal
from skyledger.operators.recount import INPUT_COUNTERS
from skyledger.operators.rules import adds_up, input_rules, metric_rules, monthly_input_violations, null_grain_rule, table_summary
from skyledger.operators.shape import stacked

CHECK_COLUMNS = ["check", "violations", "passed"]
FLIGHT_COUNTS = ["total_flights", "completed_flights", "delayed_arrival_flights"]


class CheckFailure(ValueError):
    """One or more checks found violations."""


# --- building blocks -------------------------------------------------------------------


def check_rows(frame: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """Aggregate a frame once; each named aggregate becomes a check that passes when it is 0."""
    # The aggregates themselves turn NULL only when there was nothing to count.
    wide = frame.agg(*(F.coalesce(v, F.lit(0)).cast("bigint").alias(name) for name, v in violations.items()))
    rows = stacked(wide, [], ((name, F.col(name)) for name in violations), ["check", "violations"])
    return rows.withColumn("passed", F.col("violations") == 0)


def all_checks(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def prefixed(checks: DataFrame, prefix: str) -> DataFrame:
    return checks.withColumn("check", F.concat(F.lit(f"{prefix}."), F.col("check")))


def values_check(name: str, comparison: DataFrame) -> DataFrame:
    """A `same_values` row as a check; tables of different type count as one violation."""
    different = F.coalesce(F.col("only_left") + F.col("only_right"), F.lit(1))
    return comparison.select(
        F.lit(name).alias("check"), different.cast("bigint").alias("violations"), F.col("same").alias("passed")
    )


def schema_problems(actual: T.StructType, expected: T.StructType) -> dict[str, list[str]]:
    """Missing, extra, repeated and wrongly typed columns; order and nullability do not matter. Metadata only."""
    have, want = type_map(actual), type_map(expected)
    return {
        "missing": sorted(want.keys() - have.keys()),
        "extra": sorted(have.keys() - want.keys()),
        "repeated": sorted({n for n in actual.names if actual.names.count(n) > 1}),
        "mismatched": sorted(n for n in want.keys() & have.keys() if want[n] != have[n]),
    }


def schema_check(frame: DataFrame, expected: T.StructType, name: str = "schema") -> DataFrame:
    """The schema comparison as a check row."""
    count = sum(len(v) for v in schema_problems(frame.schema, expected).values())
    return frame.sparkSession.createDataFrame(
        [(name, count, count == 0)], "check string, violations bigint, passed boolean"
    )


def assert_checks(checks: DataFrame, label: str) -> None:
    """Raise with the names of the failed checks. Collects one small row per failed check."""
    failed = checks.filter(~F.coalesce(F.col("passed"), F.lit(False))).select("check", "violations").collect()
    if failed:
        raise CheckFailure(f"{label}: " + ", ".join(f"{r['check']} ({r['violations']})" for r in failed))


def unequal_rows(left: str, right: str, measures: list[str]) -> Column:
    return count_when(unequal(left, right, measures))


def not_once(*sides: str) -> Column:
    """Keys that some side lacks or repeats."""
    return count_when(any_of(F.col(f"{s}__rows") != 1 for s in sides))


# --- input and aggregate tables --------------------------------------------------------


def input_checks(cleaned: DataFrame, period: C.Period) -> DataFrame:
    months = monthly_input_violations(cleaned, period)
    empty = F.when(F.coalesce(F.sum("total_flights"), F.lit(0)) == 0, 1).otherwise(0)
    return check_rows(months, {"input_not_empty": empty} | {name: F.sum(name) for name in input_rules(period)})


def aggregate_checks(table: DataFrame, grain: list[str]) -> DataFrame:
    """Metric rules, non-NULL unique grain and at least one row."""
    months = table_summary(table, grain)
    names = [*metric_rules(), *null_grain_rule(grain), "duplicate_excess"]
    empty = F.when(F.count("*") == 0, 1).otherwise(0)
    return check_rows(months, {"not_empty": empty} | {name: F.sum(name) for name in names})


def grain_unique(table: DataFrame, grain: list[str]) -> DataFrame:
    keyed = table.groupBy(*grain).agg(F.count("*").alias("n"))
    null_key = ~all_of(F.col(k).isNotNull() for k in grain)
    return check_rows(keyed, {
        "null_grain": F.sum(F.when(null_key, F.col("n"))),
        "duplicate_excess": F.sum(F.col("n") - 1),
    })


# --- reconciliation --------------------------------------------------------------------


def reconcile_partition_counts(raw: DataFrame, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Raw = accepted + rejected in every file, month and status; an absent key is 0."""
    keys = [c for c in raw.columns if c != "n"]
    sides = side_by_side({"raw": raw, "accepted": accepted, "rejected": rejected}, keys)
    n = {s: F.coalesce(F.col(f"{s}__n"), F.lit(0)) for s in ("raw", "accepted", "rejected")}
    return check_rows(sides, {
        "file_month_status_conservation": count_when(n["raw"] != n["accepted"] + n["rejected"])
    })


def reconcile_months(table: DataFrame, monthly: DataFrame) -> DataFrame:
    """A table of any grain summed to months equals the monthly table."""
    sides = side_by_side({"table": month_rollup(table), "monthly": month_rollup(monthly)}, ["YEAR", "MONTH"])
    left, right = F.col("table__arrival_delay_minutes_sum"), F.col("monthly__arrival_delay_minutes_sum")
    return check_rows(sides, {
        "same_months": not_once("table", "monthly"),
        "monthly_counts": unequal_rows("table", "monthly", C.COUNT_MEASURES),
        "monthly_delay_minutes_sum": count_when(
            (F.col("table__rows") == 0) | (F.col("monthly__rows") == 0)
            | ~same_number(left, right, C.MONTH_SUM_ABS_TOL, C.REGRESSION_REL_TOL)
        ),
    })


def reconcile_status_months(monthly: DataFrame, baseline: DataFrame, period: C.Period) -> DataFrame:
    """Monthly counts equal the stored baseline, over exactly the configured months."""
    keys, measures = ["YEAR", "MONTH"], C.STATUS_MEASURES
    sides = side_by_side({
        "monthly": monthly.select(*keys, *measures),
        "baseline": baseline.select(*keys, *measures),
        "period": period_frame(monthly.sparkSession, period),
    }, keys)
    in_both = any_of(F.col(f"{s}__rows") > 0 for s in ("monthly", "baseline"))
    return check_rows(sides, {
        "exact_month_coverage": count_when(any_of(F.col(f"{s}__rows") != 1 for s in ("monthly", "baseline", "period"))),
        **{f"monthly_{m}": count_when(in_both & unequal("monthly", "baseline", [m])) for m in measures},
    })


def reconcile_baseline(monthly: DataFrame, baseline: DataFrame, period: C.Period) -> DataFrame:
    """Coverage, month totals, grand totals per status and absence of invalid records against the baseline."""
    keys = ["YEAR", "MONTH"]
    sides = side_by_side({
        "monthly": monthly.select(*keys, *C.STATUS_MEASURES),
        "baseline": baseline.select(*keys, *C.STATUS_MEASURES, "invalid_flights"),
        "period": period_frame(monthly.sparkSession, period),
    }, keys)
    in_both = any_of(F.col(f"{s}__rows") > 0 for s in ("monthly", "baseline"))

    def total_gap(measure):
        gap = F.coalesce(F.sum(f"monthly__{measure}"), F.lit(0)) - F.coalesce(F.sum(f"baseline__{measure}"), F.lit(0))
        return F.abs(gap)

    return check_rows(sides, {
        "configured_month_coverage": not_once("monthly", "baseline", "period"),
        "month_counts": count_when(in_both & unequal("monthly", "baseline", ["total_flights"])),
        "total": total_gap("total_flights"),
        "no_invalid_status": F.sum("baseline__invalid_flights"),
        **{s: total_gap(f"{s}_flights") for s in C.STATUSES},
    })


def reconcile_source(source: DataFrame, baseline: DataFrame, monthly: DataFrame) -> DataFrame:
    """Independent recount = baseline = monthly table, and the two identities hold in the recount."""
    keys, labels = ["YEAR", "MONTH"], ["delayed_arrival_flights", "on_time_arrival_flights"]
    sides = side_by_side({
        "source": source.select(*keys, *C.STATUS_MEASURES, *labels),
        "baseline": baseline.select(*keys, *C.STATUS_MEASURES),
        "monthly": monthly.select(*keys, *C.STATUS_MEASURES, *labels),
    }, keys)
    identities = all_of(adds_up(identity, "source__") for identity in C.COUNT_IDENTITIES)
    return check_rows(sides, {
        "same_months": not_once("source", "baseline", "monthly"),
        **{f"baseline_{m}": count_when(unequal("source", "baseline", [m]) | unequal("source", "monthly", [m]))
           for m in C.STATUS_MEASURES},
        **{f"monthly_{m}": unequal_rows("source", "monthly", [m]) for m in labels},
        "status_and_label_reconciliation": count_when((F.col("source__rows") > 0) & ~F.coalesce(identities, F.lit(False))),
    })


def monthly_baseline_check(monthly: DataFrame, recorded: DataFrame) -> DataFrame:
    """The stored monthly table meets its contract and equals the recorded month sums and row count."""
    keys = C.GRAINS["monthly"]
    rows = side_by_side({"stored": monthly.select(*keys), "recorded": recorded.select(*keys)}, keys)
    row_count = F.abs(F.sum(F.col("stored__rows") - F.col("recorded__rows")))
    return all_checks([
        schema_check(monthly, C.aggregate_schema(keys)),
        aggregate_checks(monthly, keys),
        reconcile_months(monthly, recorded),
        check_rows(rows, {"row_count": row_count}),
    ])


# --- weekday, band and cause summaries -------------------------------------------------


def source_input_checks(source: DataFrame, period: C.Period) -> DataFrame:
    keys = ["YEAR", "MONTH"]
    minutes = [f"minutes_{c}" for c in C.CAUSE_COLUMNS]
    sides = side_by_side({
        "source": source.select(*keys, "total_flights", *INPUT_COUNTERS, *minutes),
        "period": period_frame(source.sparkSession, period),
    }, keys)
    empty = F.when(F.coalesce(F.sum("source__total_flights"), F.lit(0)) == 0, 1).otherwise(0)
    not_finite = any_of(~is_finite(F.col(f"source__{m}")) for m in minutes)
    return check_rows(sides, {
        "input_nonempty": empty,
        "input_configured_months": not_once("source", "period"),
        **{f"input_{c}": F.sum(f"source__{c}") for c in INPUT_COUNTERS},
        "finite_monthly_cause_sums": count_when(not_finite),
    })


def _valid_ratio(value: Column, numerator: Column, denominator: Column) -> Column:
    """NULL exactly when the quotient is undefined, else the quotient and within [0, 1]."""
    expected = ratio(numerator, denominator)
    return F.when(expected.isNull(), value.isNull()).otherwise(
        value.isNotNull() & value.between(0.0, 1.0) & same_number(value, expected)
    )


def _months_beside_source(summary: DataFrame, source: DataFrame, dimension: str, cells: dict, extra: dict) -> DataFrame:
    """Summary rows folded to one row per month (a total per domain value) next to the recount."""
    per_key = summary.groupBy("YEAR", "MONTH", dimension).agg(
        F.count("*").alias("n"),
        *(F.sum(c).alias(c) for c in FLIGHT_COUNTS),
        count_violations(_count_rule()).alias("bad_counts"),
        *(agg.alias(name) for name, agg in extra.items()),
    )
    in_domain = F.coalesce(F.col(dimension).isin(*cells), F.lit(False))
    folded = per_key.groupBy("YEAR", "MONTH").agg(
        F.sum(F.when(in_domain, F.col("n") - 1).otherwise(F.col("n"))).alias("bad_keys"),
        *(F.sum(c).alias(c) for c in [*FLIGHT_COUNTS, "bad_counts", *extra]),
        *(F.sum(F.when(F.col(dimension) == value, F.col("total_flights"))).alias(f"cell_{column}")
          for value, column in cells.items()),
    )
    kept = source.select("YEAR", "MONTH", *FLIGHT_COUNTS, *cells.values(), "midnight_2400")
    return side_by_side({"summary": folded, "source": kept}, ["YEAR", "MONTH"])


def _count_rule() -> Column:
    """0 <= delayed <= completed <= total, total > 0, and the rate fits the counts."""
    total, completed, delayed = map(F.col, FLIGHT_COUNTS)
    ordered = (delayed >= 0) & (delayed <= completed) & (completed <= total) & (total > 0)
    return ordered & _valid_ratio(F.col("arrival_delay_rate"), delayed, completed)


def _performance_checks(cells: dict) -> dict[str, Column]:
    outside = F.when(F.col("source__rows") == 0, 1).otherwise(0)
    return {
        "grain_and_domain": F.sum(F.coalesce(F.col("summary__bad_keys"), F.lit(0)) + outside),
        "counts_and_rates": F.sum("summary__bad_counts"),
        "monthly_counts": unequal_rows("summary", "source", FLIGHT_COUNTS),
        # A domain value has a row exactly when the recount found flights for it.
        "observed_grain_coverage": count_when(any_of(
            F.col(f"summary__cell_{c}").isNotNull() != (F.coalesce(F.col(f"source__{c}"), F.lit(0)) > 0)
            for c in cells.values()
        )),
    }


def _cells_differ(columns) -> Column:
    return count_when(any_of(
        F.coalesce(F.col(f"summary__cell_{c}"), F.lit(0)) != F.coalesce(F.col(f"source__{c}"), F.lit(0)) for c in columns
    ))


def weekday_checks(weekdays: DataFrame, source: DataFrame) -> DataFrame:
    cells = {d: f"weekday_{d}" for d in C.SUMMARY_DOMAINS["day_of_week"]}
    months = _months_beside_source(weekdays, source, "DAY_OF_WEEK", cells, {})
    return check_rows(months, _performance_checks(cells) | {"weekday_totals": _cells_differ(cells.values())})


def band_checks(bands: DataFrame, source: DataFrame) -> DataFrame:
    hours = {b: f"band_{b}" for b in C.BAND_LIMITS}
    leftovers = {"Missing": "missing_times", "Invalid": "invalid_times"}
    cells = hours | leftovers
    midnight = F.col("scheduled_2400_flights")
    misplaced = ~midnight.between(F.lit(0), F.col("total_flights")) | ((F.col("time_band") != "Night") & (midnight != 0))
    extra = {"midnight": F.sum(midnight), "misplaced_2400": count_when(misplaced)}
    months = _months_beside_source(bands, source, "time_band", cells, extra)
    midnight_differs = ~F.col("summary__midnight").eqNullSafe(F.col("source__midnight_2400"))
    return check_rows(months, _performance_checks(cells) | {
        "hour_boundaries": _cells_differ(hours.values()),
        "missing_invalid_retained": _cells_differ(leftovers.values()),
        "2400_is_night": F.sum("summary__misplaced_2400") + count_when(midnight_differs),
    })


def cause_checks(causes: DataFrame, source: DataFrame) -> DataFrame:
    """Grain, coverage, minutes, denominators and shares of the cause table against the recount."""
    keys = C.SUMMARY_GRAINS["delay_causes"]
    minutes = [F.col(f"minutes_{c}") for c in C.CAUSE_COLUMNS]
    known = [F.coalesce(m, F.lit(0.0)) for m in minutes]
    month_minutes = F.when(F.coalesce(*minutes).isNotNull(), sum(known[1:], known[0]))
    with_delays = source.filter(F.col("delayed_arrival_flights") > 0)
    rows = ((c, F.col("delayed_arrival_flights"), F.col(f"reported_{c}"), F.col("any_reported"),
             F.col("all_reported"), F.col(f"minutes_{c}"), month_minutes) for c in C.CAUSE_COLUMNS)
    measures = ["eligible_delayed_flights", "reported_cause_flights", "flights_with_any_reported_cause",
                "flights_with_all_reported_causes", "attributed_minutes", "monthly_attributed_minutes"]
    expected = stacked(with_delays, ["YEAR", "MONTH"], rows, ["cause_category", *measures])
    sides = side_by_side({"table": causes, "recount": expected}, keys)

    def t(name):
        return F.col(f"table__{name}")

    def r(name):
        return F.col(f"recount__{name}")

    eligible, reported, with_any, with_all = map(t, measures[:4])
    ordered = all_of([reported.between(F.lit(0), eligible), with_all >= 0, with_all <= with_any, with_any <= eligible])
    spent = t("attributed_minutes")
    null_minutes = F.when(reported == 0, spent.isNull()).otherwise(spent.isNotNull() & is_finite(spent) & (spent >= 0))
    paired = (F.col("table__rows") > 0) & (F.col("recount__rows") > 0)
    has_row = F.col("table__rows") > 0
    shares_fit = same_number(t("monthly_attributed_minutes"), r("monthly_attributed_minutes")) & _valid_ratio(
        t("cause_minute_share"), spent, r("monthly_attributed_minutes"))
    row_checks = check_rows(sides, {
        "grain_and_categories": count_when(any_of(F.col(f"{s}__rows") != 1 for s in ("table", "recount"))),
        "nonnegative_counts_and_null_minutes": count_when(has_row & ~F.coalesce(ordered & null_minutes, F.lit(False))),
        "coverage_counts": count_when(paired & unequal("table", "recount", measures[:4])),
        "reported_minutes": count_when(paired & ~same_number(spent, r("attributed_minutes"))),
        "denominators_and_shares": count_when(paired & ~F.coalesce(shares_fit, F.lit(False))),
    })
    by_month = causes.groupBy("YEAR", "MONTH").agg(
        F.max("monthly_attributed_minutes").alias("minutes"), F.sum("cause_minute_share").alias("shares")
    )
    adds_up = F.when(F.col("minutes") > 0, same_number(F.col("shares"), F.lit(1.0))).otherwise(F.col("shares").isNull())
    return all_checks([row_checks, check_rows(by_month, {"share_sum": count_violations(adds_up)})])


def bounded_rows(summary: DataFrame, name: str, period: C.Period) -> DataFrame:
    """No more rows than months times domain values; the violations are the rows beyond that."""
    return check_rows(summary, {f"{name}_bounded_rows": F.greatest(F.count("*") - _ceiling(name, period), F.lit(0))})


def within_bound(summary: DataFrame, name: str, period: C.Period) -> DataFrame:
    """The same rule for the table as a whole: one violation, however many rows are beyond the bound."""
    return check_rows(summary, {f"{name}_bounded_rows": F.when(F.count("*") > _ceiling(name, period), 1).otherwise(0)})


def _ceiling(name: str, period: C.Period) -> int:
    return len(period.years) * len(period.months) * len(C.SUMMARY_DOMAINS[name])
