"""The four jobs end to end on the smallest data, limited to whole years so that every month is covered."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import in_period
from skyledger.operators import cleaning, kpi, ledger, profiling
from skyledger.operators.checks import CheckFailure, assert_checks
from skyledger.plans import analytics_job, cleaning_job, profile_job, summary_job
from skyledger.sources import tables

PERIOD = C.Period(tuple(range(1995, 2001)))


@pytest.fixture(scope="module")
def raw(small):
    return small.raw.filter(F.col("_source_year").isin(*PERIOD.years))


@pytest.fixture(scope="module")
def rejected_month(raw):
    """A window without rejected records: the month before the first reject."""
    return {(r["_source_year"], r["_source_month"]) for r in cleaning.rejected_flights(raw).select("_source_year", "_source_month").collect()}


@pytest.fixture(scope="module")
def evidence(raw, rejected_month):
    year = next(y for y in PERIOD.years if not {(y, m) for m in (1, 2, 3)} & rejected_month)
    window = C.Period((year,), (1, 2, 3))
    return cleaning_job.Evidence(
        baseline=ledger.profile_baseline(profiling.file_profile(raw)),
        approved=cleaning.rejected_flights(raw).select(*C.RAW_COLUMNS, *C.LINEAGE_COLUMNS),
        reference=cleaning.accepted_flights(raw).filter(in_period(window)),
        window=window,
    )


@pytest.fixture(scope="module")
def accepted(spark, raw, evidence, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cleaning")
    before, after = cleaning_job.run(raw, evidence, f"{folder}/accepted", f"{folder}/rejected")
    assert before.count() == 24 and after.count() == 17
    return tables.read_cleaned(spark, f"{folder}/accepted")


def test_cleaning_stops_before_writing(raw, evidence, tmp_path):
    wrong = cleaning_job.Evidence(evidence.baseline, evidence.approved.limit(0), evidence.reference, evidence.window)
    with pytest.raises(CheckFailure, match="rejected_matches_approved"):
        cleaning_job.run(raw, wrong, f"{tmp_path}/accepted", f"{tmp_path}/rejected")
    assert not os.listdir(tmp_path)


def test_analytics_job(spark, accepted, tmp_path):
    baseline = ledger.baseline_status_by_month(ledger.cleaned_partition_counts(accepted))
    window = C.Period((1996,), (1, 2, 3))
    reference = analytics_job.Reference(
        {level: kpi.grain_table(accepted, level).filter(in_period(window)) for level in C.GRAINS}, window)
    stored = analytics_job.run(accepted, baseline, PERIOD, str(tmp_path), reference)
    assert stored["monthly"].count() == 72
    queries = analytics_job.business_queries(stored, 1)
    assert analytics_job.preview(queries["airline_ranking"], 5).count() == 5
    with pytest.raises(ValueError):
        analytics_job.preview(queries["airline_ranking"], 0)


def test_analytics_regression_fails(accepted):
    window = C.Period((1996,), (1, 2, 3))
    monthly = kpi.grain_table(accepted, "monthly")
    bent = monthly.filter(in_period(window)).withColumn("total_flights", F.col("total_flights") + 1)
    with pytest.raises(CheckFailure, match=r"^regression: counts.total_flights \(3\)$"):
        assert_checks(analytics_job.regression_checks(monthly, bent, "monthly", window), "regression")


def test_summary_job(accepted, tmp_path):
    baseline = ledger.baseline_status_by_month(ledger.cleaned_partition_counts(accepted))
    monthly = kpi.grain_table(accepted, "monthly")
    window = C.Period((1996,), (1, 2, 3))
    references = {name: build(accepted).filter(in_period(window)) for name, (build, _, _) in summary_job.QUERIES.items()}
    results = summary_job.run(accepted, baseline, monthly, PERIOD, str(tmp_path), references, window)
    assert results["delay_causes"].count() == 72 * 5
    first = results["departure_time_band"].first()
    assert (first["YEAR"], first["MONTH"], first["time_band"]) == (1995, 1, "Night")


def test_profile_job(spark, raw, tmp_path):
    files = raw.select(F.col("_source_file").alias("file_name")).distinct()
    report = profile_job.run(raw, PERIOD, files, str(tmp_path / "full"))
    assert report["missing_overall"].count() == 36 and report["anomaly_counts"].count() == 39
    few = profiling.coverage_checks(report["file_profile"], PERIOD, files.limit(3))
    with pytest.raises(CheckFailure, match=r"^profile: all_configured_files_have_rows \(69\)$"):
        assert_checks(few, "profile")
