"""How the catalog builds and stages wide records."""

from pyspark.sql import functions as F

from samples import TESTDATA
from skyledger import contract as C
from skyledger.operators import cleaning, kpi, ledger
from skyledger.plans import catalog
from skyledger.plans.catalog import Inputs
from skyledger.sources import flight_view, tables


def test_records_are_built_by_every_core(spark):
    """Few order lines used to be broadcast, and the one task that read the orders built all records."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    built = flight_view.raw_flights(spark, f"{TESTDATA}/sf0.01").select(F.spark_partition_id().alias("part"), "TAIL_NUM")
    assert built.where("TAIL_NUM IS NOT NULL").select("part").distinct().count() == parts


def test_methods_stay_small_enough_to_compile(spark):
    limit, old = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        for given, kept in (("65535", tables.HUGE_METHOD), ("4000", "4000")):
            spark.conf.set(limit, given)
            Inputs(spark, f"{TESTDATA}/sf0.001")
            assert spark.conf.get(limit) == kept
    finally:
        spark.conf.set(limit, old)


def test_accepted_table_needs_no_staged_records(spark, monkeypatch):
    monkeypatch.setattr(tables, "_STAGED", {})
    inputs = Inputs(spark, f"{TESTDATA}/sf0.001")
    accepted = inputs.accepted_faulty
    assert not tables.is_staged(spark, inputs._key("faulty")) and tables.is_staged(spark, inputs._key("accepted_faulty"))
    monkeypatch.setattr(tables, "_STAGED", {})
    again = Inputs(spark, f"{TESTDATA}/sf0.001")
    assert again.faulty.count() > 0 and accepted.exceptAll(again.accepted_faulty).isEmpty() and again.accepted_faulty.exceptAll(accepted).isEmpty()


def test_write_counts_each_condition_by_itself():
    """Their sum inside the row was one method too big to compile."""
    watch = ledger.raw_watch()
    assert len(watch.metrics()) == 2 + sum(len(group) for group in watch.groups.values())


def test_bound_is_one_violation(spark, monkeypatch):
    """The query's statement counts the table, not its surplus rows."""
    class Few:
        accepted_faulty = None

    ceiling = 84 * 6
    for rows, violations in ((ceiling, 0), (ceiling + 1, 1), (ceiling + 12, 1)):
        monkeypatch.setattr(kpi, "departure_time_band", lambda _: spark.range(rows))
        assert catalog.bounded_rows(Few()).first()["violations"] == violations


def test_accepting_interprets_nothing(spark):
    """An array lambda in the condition used to be interpreted, with all expressions of the columns it was unfolded into."""
    faulty = flight_view.faulty_flights(spark, f"{TESTDATA}/sf0.001")
    for frame in (cleaning.accepted_flights(faulty), cleaning.rejected_flights(faulty)):
        assert "lambda" not in frame._jdf.queryExecution().optimizedPlan().toString().lower()


def test_faulty_record_is_built_once(spark):
    """Faults used to be planted into a finished record, and that record copied once more."""
    nodes = flight_view.faulty_flights(spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().optimizedPlan()
    wide, todo = 0, [nodes]
    while todo:
        node = todo.pop()
        wide += node.output().size() >= len(C.RAW_COLUMNS)
        todo += [node.children().apply(k) for k in range(node.children().size())]
    assert wide == 1


SINGLE_PASS = [
    "normalize_text", "missing_overall", "file_profile", "cast_failures", "classify_arrival_records", "same_values", "signed_rows",
    "approved_reject_match", "cleaned_partition_counts", "monthly_extremes", "departure_time_band", "day_of_week",
    "roundtrip_parquet", "period_filter", "monthly_baseline_check",
]


def test_single_pass_stages_no_whole_table(spark, monkeypatch):
    """All records or the whole accepted table used to be written first, with every column."""
    monkeypatch.setattr(tables, "_STAGED", {})
    for name in SINGLE_PASS:
        catalog.callables()[name](spark, f"{TESTDATA}/sf0.001")
        assert not tables._STAGED, name


def test_single_pass_reads_what_is_staged(spark, monkeypatch):
    monkeypatch.setattr(tables, "_STAGED", {})
    inputs = Inputs(spark, f"{TESTDATA}/sf0.001")
    inputs.faulty
    assert inputs.once("faulty").inputFiles() and len(tables._STAGED) == 1
    assert all("staged-" in file for file in inputs.once("faulty").inputFiles())


def test_comparing_by_digest_reads_each_table_once(spark, monkeypatch):
    """Both tables used to be staged, and once more shuffled in full where nearly all parts of them differ."""
    monkeypatch.setattr(tables, "_STAGED", {})
    found = catalog.callables()["same_values_by_digest"](spark, f"{TESTDATA}/sf0.001")
    assert not tables._STAGED
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 2 and "LeftSemi" not in plan
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line and "surplus" in line]
    assert grouped and not any(column in line for line in grouped for column in ("TAIL_NUM", "FL_DATE"))
    assert found.collect() == catalog.callables()["same_values"](spark, f"{TESTDATA}/sf0.001").collect()
