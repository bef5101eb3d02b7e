"""Hand-made records at the edges of the definitions."""

import pytest
from pyspark.sql import functions as F

from samples import CANCELLED, LATE
from skyledger import contract as C
from skyledger.functions.measures import count_violations, is_finite, same_number
from skyledger.functions.text import is_missing, to_int
from skyledger.operators import cleaning, compare, duplicates, kpi, ledger, profiling, ranking, rules

PERIOD = C.Period((2025,))


def rows(frame):
    return [r.asDict() for r in frame.collect()]


@pytest.mark.parametrize("text, number", [
    ("12.7", 12), ("12.", 12), ("-3.9", -3), (".5", 0), (" 7 ", 7), ("abc", None), ("99999999999", None), ("", None), ("1.2.3", None),
])
def test_text_to_int(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(to_int(F.col("t"))).first()[0] == number


def test_results_do_not_depend_on_ansi_mode(spark, raw_rows):
    raw = raw_rows({"YEAR": "abc", "DISTANCE": "x", "FL_DATE": "2025-01-01", "CANCELLED": "0.50"})
    with_ansi = rows(cleaning.clean_flights(raw))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert rows(cleaning.clean_flights(raw)) == with_ansi
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [with_ansi[0][c] for c in ("YEAR", "DISTANCE", "FL_DATE", "CANCELLED")] == [None] * 4


def test_unknown_flag_is_invalid_and_never_rejected(raw_rows):
    raw = raw_rows({"CANCELLED": None, "ARR_TIME": None})
    assert rows(cleaning.clean_flights(raw))[0]["flight_status"] == "invalid"
    assert cleaning.rejected_flights(raw).isEmpty()


def test_rejected_lists_fields_in_order(raw_rows):
    raw = raw_rows({"ARR_DEL15": " ", "ARR_TIME": None}, {"ARR_DELAY_NEW": None}, CANCELLED)
    rejected = rows(cleaning.rejected_flights(raw))
    assert [r["missing_fields"] for r in rejected] == [["ARR_TIME", "ARR_DEL15"]]
    assert rejected[0]["rejection_reason"] == C.REJECTION_REASON


def test_tab_is_present_and_no_clock(raw_rows):
    raw = raw_rows({"CRS_DEP_TIME": "\t"})
    assert raw.select(is_missing("CRS_DEP_TIME")).first()[0] is False
    counts = {r["rule"]: r["violations"] for r in rows(rules.anomaly_counts(raw, PERIOD))}
    assert counts["crs_dep_time_invalid_hhmm"] == 1


def test_half_is_no_flag(raw_rows):
    issues = {(r["column"], r["issue"]): r["records"] for r in rows(ledger.transformation_issues(raw_rows({"DIVERTED": "0.50"})))}
    assert issues["DIVERTED", "introduced_nulls"] == issues["DIVERTED", "invalid_binary"] == 1
    assert issues["DIVERTED", "source_nulls"] == 0


def test_null_carrier_is_no_subtotal_and_has_no_rank(flight):
    cleaned = flight({"OP_UNIQUE_CARRIER": None}, {"OP_UNIQUE_CARRIER": None, "MONTH": "2"}, {})
    for summary in (kpi.kpi_summary(cleaned), kpi.kpi_summary_direct(cleaned)):
        airline = kpi.grain_performance(summary, "airline")
        assert airline.filter("OP_UNIQUE_CARRIER IS NULL").count() == 2
        assert kpi.grain_performance(summary, "monthly").count() == 2
        ranks = {(r["MONTH"], r["OP_UNIQUE_CARRIER"]): r["arrival_delay_rank"] for r in rows(ranking.airline_ranking(airline, 1))}
        assert ranks == {(1, None): None, (2, None): None, (1, "AA"): 1}


def test_month_of_cancelled_flights(flight):
    month = rows(kpi.grain_table(flight(CANCELLED), "monthly"))[0]
    assert month["completed_flights"] == 0 and month["cancellation_rate"] == 1.0
    for undefined in ("arrival_delay_rate", "on_time_arrival_rate", "arrival_delay_minutes_sum", "average_arrival_delay"):
        assert month[undefined] is None


def test_unreported_causes_stay_null(flight):
    causes = rows(kpi.delay_causes(flight(LATE, {**LATE, "MONTH": "2", "NAS_DELAY": "0.00"})))
    january = [r for r in causes if r["MONTH"] == 1]
    assert len(january) == 5
    assert all(r["reported_cause_flights"] == 0 and r["attributed_minutes"] is None and r["cause_minute_share"] is None for r in january)
    nas = next(r for r in causes if r["MONTH"] == 2 and r["cause_category"] == "NAS_DELAY")
    assert nas["reported_cause_flights"] == 1 and nas["attributed_minutes"] == 0.0 and nas["cause_minute_share"] is None


@pytest.mark.parametrize("clock, band", [
    (None, "Missing"), (" ", "Missing"), ("\t", "Invalid"), ("2400", "Night"), ("0559", "Night"), ("0600", "Morning"), ("1159", "Morning"),
    ("1200", "Afternoon"), ("1800", "Evening"), ("2359", "Evening"), ("2460", "Invalid"), ("915", "Invalid"),
])
def test_bands(flight, clock, band):
    result = rows(kpi.departure_time_band(flight({"CRS_DEP_TIME": clock})))[0]
    assert result["time_band"] == band and result["MONTH"] == 1 and result["scheduled_2400_flights"] == (clock == "2400")


def airline_months(spark, *months):
    """(year, month, carrier, completed, delayed) rows with their rate."""
    frame = spark.createDataFrame(list(months), "YEAR int, MONTH int, OP_UNIQUE_CARRIER string, completed_flights long, delayed_arrival_flights long")
    return kpi.with_ratios(frame, kpi.DELAY_RATE)


def test_dense_ranks_and_low_volume(spark):
    airline = airline_months(spark, (2025, 1, "A", 40, 4), (2025, 1, "B", 80, 8), (2025, 1, "C", 40, 8), (2025, 1, "D", 29, 0))
    ranks = {r["OP_UNIQUE_CARRIER"]: (r["arrival_delay_rank"], r["meets_volume_heuristic"]) for r in rows(ranking.airline_ranking(airline))}
    assert ranks == {"A": (1, True), "B": (1, True), "C": (2, True), "D": (None, False)}


def test_month_over_month_gaps_year_end_and_zero(spark):
    airline = airline_months(spark, (2024, 12, "A", 40, 0), (2025, 1, "A", 40, 4), (2025, 3, "A", 40, 4), (2025, 4, "A", 20, 4))
    december, january, march, april = rows(ranking.ordered_months(ranking.airline_month_over_month(airline)))
    assert december["previous_month"] is None and december["has_previous_calendar_month"] is False
    assert january["delay_rate_change_pp"] == pytest.approx(10.0) and january["delay_rate_relative_change_pct"] is None
    assert march["previous_delay_rate"] == 0.1 and march["delay_rate_change_pp"] is None
    assert april["delay_rate_relative_change_pct"] == pytest.approx(100.0)
    assert april["both_months_meet_volume_heuristic"] is False


def test_three_copies_are_one_group(raw_rows):
    raw = raw_rows({}, {}, {}, {"TAIL_NUM": "N2"}, {"OP_CARRIER_FL_NUM": None}, {"OP_CARRIER_FL_NUM": None})
    expected = {"duplicate_groups": 2, "rows_in_groups": 5, "excess_rows": 3}
    assert rows(duplicates.exact_duplicates(raw)) == rows(duplicates.exact_duplicates_direct(raw)) == [expected]
    assert rows(duplicates.key_collisions(duplicates.key_groups(raw))) == [
        {"incomplete_key_rows": 2, "duplicate_groups": 1, "rows_in_groups": 4, "excess_rows": 3}]


def test_null_shifted_rows_are_no_copies(raw_rows):
    """Row hashes skip NULLs, so these two collide; the full comparison tells them apart."""
    raw = raw_rows({"TAIL_NUM": None, "OP_CARRIER_FL_NUM": "9"}, {"TAIL_NUM": "9", "OP_CARRIER_FL_NUM": None})
    assert rows(duplicates.exact_duplicates(raw))[0]["duplicate_groups"] == 0


def test_nan_is_not_finite(spark):
    frame = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (None,)], "x double")
    assert frame.agg(count_violations(is_finite(F.col("x")))).first()[0] == 3
    assert [r[0] for r in frame.select(same_number(F.col("x"), F.col("x"))).collect()] == [False, False, True, True]


def test_tolerances(spark):
    grain = C.GRAINS["airline"]
    new = airline_months(spark, (2025, 1, "A", 40, 4), (2025, 1, "B", 40, 4))
    old = new.withColumn("arrival_delay_rate", F.col("arrival_delay_rate") + 1e-13).withColumn(
        "completed_flights", F.col("completed_flights") + F.when(F.col("OP_UNIQUE_CARRIER") == "A", 1).otherwise(0))
    found = {r["measure"]: r["mismatches"] for r in rows(compare.compare_aggregates(new, old, grain, C.Period((2025,), (1,))))}
    assert found == {"missing_keys": 0, "extra_keys": 0, "repeated_keys": 0, "completed_flights": 1, "delayed_arrival_flights": 0, "arrival_delay_rate": 0}


def test_same_values_needs_same_types_and_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "k int, v string")
    assert compare.same_values(a, a.select("v", "k")).first()["same"] is True
    assert compare.same_values(a, a.distinct()).first().asDict() == {"only_left": 1, "only_right": 0, "same": False}
    assert compare.same_values(a, a.withColumn("k", F.col("k").cast("long"))).first()["same"] is False
    assert compare.diff(a, a.distinct()).count() == 1


def test_month_counts_null_bucket(flight):
    counts = {r["partition"]: r["row_count"] for r in rows(ledger.month_counts(flight({}, {}, {"MONTH": "x"}, {"YEAR": None})))}
    assert counts == {"2025-01": 2, C.NO_PARTITION: 2}


def test_value_counts_include_null(raw_rows):
    counts = {(r["column"], r["value"]): r["value_count"] for r in rows(profiling.value_counts(raw_rows({}, {}, CANCELLED)))}
    assert counts["CANCELLATION_CODE", None] == 2 and counts["CANCELLATION_CODE", "A"] == 1 and counts["YEAR", "2025"] == 3


def test_empty_input_gives_zero_counts(raw_rows):
    empty = raw_rows({}).limit(0)
    assert {r["violations"] for r in rows(rules.anomaly_counts(empty, PERIOD))} == {0}
    assert rows(duplicates.exact_duplicates(empty)) == [{"duplicate_groups": 0, "rows_in_groups": 0, "excess_rows": 0}]
