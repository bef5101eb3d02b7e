"""Stored states by month and the SQL side: only changed months are read, months merge exactly, names work in SQL text."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.operators import compare, distinct_state, kpi
from skyledger.plans import kpi_state, sql_views
from skyledger.sources import month_folders, tables


def same(left, right):
    return compare.same_values(left, right).first()["same"]


def test_only_changed_months_are_read(spark, small, tmp_path):
    path, state = f"{tmp_path}/cleaned", f"{tmp_path}/state"
    year = small.accepted.where("YEAR = 1996")
    tables.write_partitioned(year, path)
    changed, gone = kpi_state.refresh(spark, path, state)
    assert sorted(changed) == [(1996, m) for m in range(1, 13)] and gone == []
    assert kpi_state.refresh(spark, path, state) == ([], [])
    tables.replace_months(year.where("MONTH = 4").limit(3), path)
    tables.discard(spark, month_folders.folder(path, (1996, 9)))
    untouched = {p: os.path.getmtime(p) for p in map(str, tmp_path.glob("state/measures/YEAR=1996/MONTH=2/*.parquet"))}
    assert untouched
    changed, gone = kpi_state.refresh(spark, path, state)
    assert (changed, gone) == ([(1996, 4)], [(1996, 9)])
    assert {p: os.path.getmtime(p) for p in map(str, tmp_path.glob("state/measures/YEAR=1996/MONTH=2/*.parquet"))} == untouched
    scanned = kpi_state.changed_flights(spark, path, changed).select(F.col("_metadata.file_path")).distinct().collect()
    assert scanned and all("/MONTH=4/" in r[0] for r in scanned)
    plan = kpi_state.changed_flights(spark, path, changed)._jdf.queryExecution().executedPlan().toString()
    assert "MONTH" in plan.split("PartitionFilters: [")[1].split("]")[0]  # folders, not rows, are chosen
    now = tables.read_cleaned(spark, path)
    assert same(kpi_state.summary(spark, state), kpi.kpi_summary(now))
    for level in C.GRAINS:
        assert same(kpi_state.grain(spark, state, level), kpi.grain_table(now, level))


def test_a_refresh_that_breaks_off_is_repeated(spark, small, tmp_path, monkeypatch):
    path, state = f"{tmp_path}/cleaned", f"{tmp_path}/state"
    year = small.accepted.where("YEAR = 1996")
    tables.write_partitioned(year.where("MONTH <= 2"), path)
    kpi_state.refresh(spark, path, state)
    tables.replace_months(year.where("MONTH = 2").limit(2), path)
    with monkeypatch.context() as patched:
        patched.setattr(tables, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            kpi_state.refresh(spark, path, state)
    assert kpi_state.refresh(spark, path, state) == ([(1996, 2)], [])
    assert same(kpi_state.summary(spark, state), kpi.kpi_summary(tables.read_cleaned(spark, path)))


def test_months_without_a_name(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame = spark.createDataFrame([(None, 1, "a"), (1996, None, "b"), (1996, 2, "c")], "YEAR int, MONTH int, v string")
    frame.write.partitionBy("YEAR", "MONTH").parquet(path)
    changed, gone = month_folders.changes(month_folders.versions(spark, path), month_folders.known_versions(spark, f"{tmp_path}/none"))
    assert sorted(changed, key=str) == sorted([(None, 1), (1996, None), (1996, 2)], key=str) and gone == []
    read = spark.read.parquet(path)
    assert [r.v for r in read.where(month_folders.in_months([(None, 1)])).collect()] == ["a"]
    assert read.where(month_folders.in_months([])).count() == 0
    assert os.path.isdir(month_folders.folder(path, (1996, None)))


def delivery(spark, rows):
    return spark.createDataFrame(rows, "_source_year int, _source_month int, a string, b string")


def test_any_months_from_the_state(spark, tmp_path):
    state = str(tmp_path)
    first = [(2025, m, f"v{(m * k) % 7}" if k % 3 else None, None) for m in (1, 2) for k in range(50)]
    second = [(2025, 3, f"v{k}", None) for k in range(3000)] + [(None, None, "v1", None)]
    for rows in (first, second, first):
        distinct_state.deliver(delivery(spark, rows), state, ["a", "b"])
    stored = distinct_state.months(spark, state)

    def counts(condition):
        merged = distinct_state.merged(stored.where(condition))
        return {r["column"]: r.distinct_non_null for r in distinct_state.distinct_counts(merged).collect()}

    def direct(rows):
        return {"a": len({r[2] for r in rows if r[2] is not None}), "b": 0}

    assert counts("true") == direct(first + second)
    assert counts("_source_month <= 2") == direct(first)
    assert counts("_source_month IN (1, 3)") == direct([r for r in first + second if r[1] in (1, 3)])
    assert counts("_source_year IS NULL") == {"a": 1, "b": 0}
    numbers = [r.number for r in spark.read.parquet(f"{state}/values").collect()]
    assert sorted(numbers) == list(range(1, 3001))  # dense, none given twice


def test_no_bits_from_an_empty_delivery(spark, tmp_path):
    distinct_state.deliver(delivery(spark, []), str(tmp_path), ["a", "b"])
    assert distinct_state.months(spark, str(tmp_path)).count() == 0


def test_sql_text_over_views(spark, small):
    sql_views.register(small.accepted)
    for level, view in (("monthly", "monthly_performance"), ("route", "route_monthly_performance")):
        assert same(spark.table(view), kpi.grain_table(small.accepted, level))
    clocks = ["0000", "0559", "0600", "1159", "1759", "2359", "2400", "0960", "9", None]
    frame = spark.createDataFrame([(c,) for c in clocks], "c string")
    assert [r[0] for r in frame.select(F.expr("time_band(c)")).collect()] == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Evening", "Night", "Invalid", "Invalid", "Missing"]
    plan = sql_views.run(spark, "high_delay_routes", min_completed_flights=1)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "TAIL_NUM" not in plan  # pruned to the columns in use
