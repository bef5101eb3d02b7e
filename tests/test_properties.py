"""Statements that must hold between operators, and their shape in the plan."""

import re

import pytest
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.status import is_delayed
from skyledger.operators import checks, cleaning, compare, duplicates, kpi, profiling, ranking
from skyledger.plans import catalog
from skyledger.sources import tables


def same(left, right):
    return compare.same_values(left, right).first()["same"]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rollup_equals_grouping_sets_over_flights(medium):
    assert same(kpi.kpi_summary(medium.accepted), kpi.kpi_summary_direct(medium.accepted))


@pytest.mark.parametrize("level", C.GRAINS)
def test_one_grain_equals_its_part_of_the_summary(medium, level):
    assert same(kpi.grain_table(medium.accepted, level), kpi.grain_performance(kpi.kpi_summary(medium.accepted), level))


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_duplicates_agree_with_and_without_broadcasts(spark, small, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert duplicates.exact_duplicates(small.faulty).collect() == duplicates.exact_duplicates_direct(small.faulty).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_accepted_and_rejected_are_all_records(medium):
    accepted, rejected = cleaning.split_arrival_records(cleaning.classify_arrival_records(medium.faulty))
    assert same(accepted.unionByName(rejected.select(*accepted.columns)), medium.faulty)


def test_five_cause_rows_per_delayed_flight(medium):
    delayed = medium.accepted.filter(is_delayed()).count()
    assert cleaning.unpivot_causes(medium.accepted).count() == 5 * delayed > 0


def test_staged_view_equals_the_view(medium):
    from skyledger.sources.flight_view import raw_flights
    assert same(medium.raw, raw_flights(medium.spark, medium.sf_dir))


def hot(frame, copies):
    """One record repeated until it is a third of all rows or more."""
    one = frame.orderBy("FL_DATE", "OP_CARRIER_FL_NUM", "TAIL_NUM", "CRS_DEP_TIME").limit(1)
    return frame.unionByName(one.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_n"))


def test_one_record_holding_most_rows(small):
    skewed = hot(small.raw, 9000)
    numbers = duplicates.exact_duplicates(skewed).first()
    assert numbers.asDict() == duplicates.exact_duplicates_direct(skewed).first().asDict()
    assert numbers["excess_rows"] == 9000
    assert compare.same_values(skewed, small.raw).first()["only_left"] == 9000
    accepted = cleaning.accepted_flights(skewed)
    assert same(kpi.kpi_summary(accepted), kpi.kpi_summary_direct(accepted))
    counts = profiling.distinct_counts(skewed)
    assert same(counts, profiling.distinct_counts(small.raw))


def test_one_month_is_split_over_files(small, tmp_path):
    """A rebalanced write cuts a hot month into several files; a plain repartition would give it one task."""
    spark = small.spark
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    try:
        tables.write_partitioned(hot(small.accepted, 60000), f"{tmp_path}/accepted")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    paths = {}
    for f in tables.read_cleaned(spark, f"{tmp_path}/accepted").select(F.input_file_name().alias("f")).distinct().collect():
        paths.setdefault(f["f"].rsplit("/", 1)[0], []).append(f["f"])
    assert max(map(len, paths.values())) > 1
    assert tables.read_cleaned(spark, f"{tmp_path}/accepted").count() == small.accepted.count() + 60000


def test_period_filter_prunes_folders_and_columns(small):
    text = plan(catalog.period_filter(small))
    assert re.search(r"PartitionFilters: \[[^\]]*YEAR#\d+ = 1996", text)
    assert "DEST_CITY_NAME" not in text


def test_summary_reads_its_columns_only(small):
    text = plan(kpi.kpi_summary(small.accepted))
    assert "ReadSchema: struct<YEAR:int,MONTH:int,OP_UNIQUE_CARRIER:string,ORIGIN:string,DEST:string," in text.replace("... ", "")
    assert "TAIL_NUM" not in text


NO_PYTHON = ["kpi_summary", "airline_month_over_month", "delay_causes", "anomaly_counts", "exact_duplicates", "cause_checks", "pre_write_checks"]


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_and_no_cartesian_product(small, name):
    text = plan(catalog.QUERIES[name](small))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_failed_check_names_itself(spark):
    table = spark.createDataFrame([("fine", 0, True), ("broken", 3, False)], "check string, violations long, passed boolean")
    with pytest.raises(checks.CheckFailure, match=r"label: broken \(3\)"):
        checks.assert_checks(table, "label")


@pytest.mark.parametrize("n", [0, -1])
def test_review_sample_needs_a_size(small, n):
    from skyledger.operators import diagnostics
    with pytest.raises(ValueError):
        diagnostics.suspect_sample(cleaning.arrival_suspects(small.raw), n)


def test_volume_parameter_is_bound(medium):
    airline = kpi.grain_table(medium.accepted, "airline")
    assert ranking.volume_threshold(airline, 50).filter(F.col("completed_flights") < 50).isEmpty()


def test_schema_check_lists_problems():
    expected = C.aggregate_schema(C.GRAINS["monthly"])
    actual = C.aggregate_schema(C.GRAINS["airline"])
    assert checks.schema_problems(actual, expected) == {"missing": [], "extra": ["OP_UNIQUE_CARRIER"], "repeated": [], "mismatched": []}
