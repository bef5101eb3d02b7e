"""Counting while writing, publishing, quarantine, digests of files and of tables."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import in_period
from skyledger.operators import cleaning, compare, ledger, profiling
from skyledger.operators.checks import CheckFailure
from skyledger.plans import cleaning_job
from skyledger.sources import digests, files, tables

HEADER = ",".join(C.RAW_COLUMNS)
YEAR = 1996


def rows(frame):
    return sorted((tuple(str(v) for v in r.asDict().values()) for r in frame.collect()))


@pytest.fixture(scope="module")
def raw(small):
    return small.faulty.filter(F.col("_source_year") == YEAR)


@pytest.fixture(scope="module")
def evidence(small):
    sound = small.raw.filter(F.col("_source_year") == YEAR)
    window = C.Period((YEAR,), (1,))
    return cleaning_job.Evidence(
        baseline=ledger.profile_baseline(profiling.file_profile(sound)),
        approved=cleaning.rejected_flights(sound).select(*C.RAW_COLUMNS, *C.LINEAGE_COLUMNS),
        reference=cleaning.accepted_flights(sound).filter(in_period(window)), window=window)


def test_a_write_counts_what_a_scan_counts(spark, raw):
    accepted = cleaning.accepted_flights(raw)
    _, seen = tables.staged_and_counted(raw, "raw", ledger.raw_watch().metrics())
    counts = tables.Observed(ledger.cleaned_watch().metrics())
    tables.write_partitioned(accepted, tables.scratch_path(spark, "accepted"), counts)

    def summed(frame, keys):
        names = [c for c in frame.columns if c not in ledger.PARTITION_KEYS]
        return rows(frame.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in names)))

    for written, scanned in ((ledger.raw_ledger_of(spark, seen), ledger.raw_ledger(raw)), (ledger.cleaned_ledger_of(spark, counts.seen), ledger.cleaned_ledger(accepted))):
        assert summed(written.select(*scanned.columns), []) == summed(scanned, [])
        assert rows(written.where("n > 0").select(*ledger.PARTITION_KEYS, "n")) == rows(scanned.select(*ledger.PARTITION_KEYS, "n"))
    assert rows(ledger.cleaned_ledger_of(spark, counts.seen).where("n > 0").select("month", "flight_status", *ledger.MISSINGNESS)) == rows(
        ledger.cleaned_ledger(accepted).select("month", "flight_status", *ledger.MISSINGNESS))


def test_too_many_keys_are_noticed(spark, monkeypatch):
    monkeypatch.setattr(ledger, "OBSERVED_KEYS", 10)
    frame = spark.range(1000).select((F.col("id") % 50).cast("int").alias("year"))
    watch = ledger.Watch([F.col("year")])
    _, seen = tables.staged_and_counted(frame, "keys", watch.metrics())
    with pytest.raises(ledger.TooManyKeys):
        watch.counted(spark, seen, "year int")
    _, seen = tables.staged_and_counted(frame.where("year < 10"), "keys", watch.metrics())
    assert rows(watch.counted(spark, seen, "year int")) == sorted((str(y), "20") for y in range(10))
    _, seen = tables.staged_and_counted(frame.where("year > 99"), "keys", watch.metrics())
    assert watch.counted(spark, seen, "year int").isEmpty()


def test_arrival_states(flight):
    late = {"ARR_DEL15": "1.00", "ARR_DELAY": "20.00"}
    made = flight({}, {"ARR_DELAY_NEW": None}, {"ARR_TIME": "99"}, {"ARR_DELAY": "NaN", "ARR_DELAY_NEW": None}, {**late, "ARR_DEL15": None, "ARR_TIME": None}, {"CANCELLED": "1.00"})
    states = [r[0] for r in made.select(ledger.arrival_state()).collect()]
    assert states == ["vvvv", "vvv-", "xvvv", "vxv-", "-v-v", None]
    found = ledger.arrival_missingness(made).select(*ledger.MISSINGNESS).first().asDict()
    assert list(found.values()) == [1, 0, 1, 2, 1, 1]


def sound_job(small, evidence, folder, **options):
    sound = small.raw.filter(F.col("_source_year") == YEAR)
    months = {r["_source_month"] for r in cleaning.rejected_flights(sound).select("_source_month").collect()}
    window = C.Period((YEAR,), (next(m for m in range(1, 13) if m not in months),))
    fitting = cleaning_job.Evidence(evidence.baseline, evidence.approved, cleaning.accepted_flights(sound).filter(in_period(window)), window)
    return cleaning_job.run(sound, fitting, f"{folder}/accepted", f"{folder}/rejected", **options)


def test_publishing_in_one_step(spark, small, evidence, tmp_path, monkeypatch):
    old = small.accepted.limit(7)
    tables.write_partitioned(old, f"{tmp_path}/accepted")
    with pytest.raises(FileExistsError):
        sound_job(small, evidence, tmp_path)
    assert tables.read_cleaned(spark, f"{tmp_path}/accepted").count() == 7 and os.listdir(tmp_path) == ["accepted"]
    with monkeypatch.context() as patched:
        failing = lambda *a: spark.createDataFrame([("bent", 1, False)], "check string, violations long, passed boolean")
        patched.setattr(cleaning_job, "read_back_checks", failing)
        with pytest.raises(CheckFailure, match="bent"):
            sound_job(small, evidence, tmp_path, replace=True)
    assert tables.read_cleaned(spark, f"{tmp_path}/accepted").count() == 7 and os.listdir(tmp_path) == ["accepted"]


def test_a_failed_rename_brings_the_old_table_back(spark, tmp_path):
    tables.write_plain(spark.range(3), f"{tmp_path}/t")
    with pytest.raises(Exception):
        tables.publish(spark, f"{tmp_path}/missing", f"{tmp_path}/t", replace=True)
    assert os.listdir(tmp_path) == ["t"] and spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_publish_replaces(spark, small, evidence, tmp_path):
    tables.write_partitioned(small.accepted.limit(7), f"{tmp_path}/accepted")
    before, after = sound_job(small, evidence, tmp_path, replace=True)
    assert (before.count(), after.count()) == (24, 17) and sorted(os.listdir(tmp_path)) == ["accepted", "rejected"]
    want = cleaning.accepted_flights(small.raw.filter(F.col("_source_year") == YEAR))
    assert compare.same_values(tables.read_cleaned(spark, f"{tmp_path}/accepted"), want).first()["same"]


def test_months_are_replaced_alone(spark, small, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_partitioned(small.accepted.where("YEAR = 1996"), path)
    march = small.accepted.where("YEAR = 1996 AND MONTH = 3").limit(2)
    untouched = {p: os.path.getmtime(p) for p in map(str, tmp_path.glob("t/YEAR=1996/MONTH=2/*.parquet"))}
    tables.replace_months(march, path)
    assert {p: os.path.getmtime(p) for p in map(str, tmp_path.glob("t/YEAR=1996/MONTH=2/*.parquet"))} == untouched
    left = small.accepted.where("YEAR = 1996 AND MONTH <> 3").union(march)
    assert compare.same_values(tables.read_cleaned(spark, path), left).first()["same"]


def test_quarantine_keeps_the_text_of_malformed_rows(spark, tmp_path):
    good = ",".join(["2025", *[""] * 35])
    (tmp_path / "ontime_2025_01.csv").write_text(f"{HEADER}\n{good}\n2025,1\n{good},more\n{good}\n")
    (tmp_path / "ontime_2025_02.csv").write_text(f"{HEADER}\n{good}\n")
    read, bad = files.read_with_quarantine(spark, str(tmp_path))
    assert read.count() == 3 and read.columns == C.raw_with_lineage_schema().names
    assert sorted(r["record"] for r in bad.collect()) == sorted(["2025,1", f"{good},more"])
    assert rows(files.malformed_rows(bad)) == [("ontime_2025_01.csv", "2")]
    (tmp_path / "ontime_2025_03.csv").write_text(HEADER.lower().replace("year", "annus") + f"\n{good}\n")
    with pytest.raises(Exception):
        files.read_with_quarantine(spark, str(tmp_path))


def test_files_are_hashed_in_blocks(spark, tmp_path):
    content = {"a.csv": b"", "b c.csv": os.urandom(100_000), "ß.csv": b"x" * 8192, "d.csv": b"\n" * 4096 + b"y"}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    found = digests.file_digests(spark, str(tmp_path), block=4096)
    assert rows(found.select("file_name", "size_bytes", "sha256")) == sorted((n, str(len(d)), hashlib.sha256(d).hexdigest()) for n, d in content.items())
    assert found.rdd.getNumPartitions() == len(content)


@pytest.mark.parametrize("left, right", [
    ([("a", None)], [(None, "a")]), ([("a", "b")], [("b", "a")]), ([(None, None)], [("", None)]), ([("a", "b")] * 3, [("a", "b")] * 2),
    ([("a", "b"), ("c", "d")], [("a", "d"), ("c", "b")]), ([], [("a", "b")]),
])
def test_digests_tell_tables_apart(spark, left, right):
    schema = "k string, v string"
    one, other = (spark.createDataFrame(r, schema) for r in (left, right))
    for a, b in ((one, other), (other, one)):
        assert compare.same_values(a, b, by_digest=True).first() == compare.same_values(a, b).first()
        assert not compare.same_values(a, b, by_digest=True).first()["same"]
    assert compare.same_values(one, one.repartition(3), by_digest=True).first().asDict() == {"only_left": 0, "only_right": 0, "same": True}


def test_digests_see_nulls_inside_arrays_and_signed_zero(spark):
    schema = "k array<string>, x double"
    make = lambda *r: spark.createDataFrame(list(r), schema)
    assert not compare.same_values(make((["a", None], 1.0)), make(([None, "a"], 1.0)), by_digest=True).first()["same"]
    assert not compare.same_values(make(([], 1.0)), make((None, 1.0)), by_digest=True).first()["same"]
    assert compare.same_values(make((["a"], 0.0), (["b"], float("nan"))), make((["b"], float("nan")), (["a"], -0.0)), by_digest=True).first()["same"]


def test_equal_tables_shuffle_no_full_row(small):
    found = compare.same_values(small.accepted, small.accepted, by_digest=True)
    assert found.first()["same"]
    assert compare.differing_buckets(small.accepted, small.accepted.repartition(3)).isEmpty()
    kept = compare.in_buckets(small.accepted, small.accepted.columns, compare.differing_buckets(small.accepted, small.accepted))
    assert kept.isEmpty()
