"""Files: reading, lineage, header, manifest, round trips."""

import hashlib

import pytest
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.operators.checks import CheckFailure, assert_checks
from skyledger.operators.compare import same_values, type_map
from skyledger.plans import analytics_job
from skyledger.sources import files, tables

HEADER = ",".join(C.RAW_COLUMNS)


def record(**fields):
    return ",".join(f'"{v}"' if "," in v else v for v in (fields.get(c, "") for c in C.RAW_COLUMNS))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "ontime_2025_01.csv").write_text(f"{HEADER}\n{record(YEAR='2025', MONTH='1', ORIGIN_CITY_NAME='New York, NY', CRS_DEP_TIME='0015')}\n")
    quoted = ",".join(f'"{c}"' for c in C.RAW_COLUMNS)
    (tmp_path / "ontime_2025_02.CSV").write_bytes(f"\ufeff{quoted}\r\n{record(YEAR='2025', MONTH='2', CRS_DEP_TIME=' ')}\r\n".encode())
    return tmp_path


def manifest(spark, folder, **changes):
    rows = [(p.name, p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest().upper()) for p in sorted(folder.glob("ontime*"))]
    rows = [changes.get(name.rsplit(".", 1)[0], (name, size, digest)) for name, size, digest in rows]
    return tables.from_rows(spark, rows, "file_name string, size_bytes long, sha256 string")


def failed(checks):
    return {r["check"] for r in checks.collect() if not r["passed"]}


def test_read_raw_csv(spark, folder):
    raw = files.read_raw_csv(spark, [str(p) for p in folder.glob("ontime*")])
    assert type_map(raw.schema) == type_map(C.raw_with_lineage_schema()) and raw.columns == C.raw_with_lineage_schema().names
    january, february = raw.orderBy("_source_month").collect()
    assert january["ORIGIN_CITY_NAME"] == "New York, NY" and january["CRS_DEP_TIME"] == "0015" and january["TAIL_NUM"] is None
    assert (january["_source_file"], january["_source_year"], january["_source_month"]) == ("ontime_2025_01.csv", 2025, 1)
    assert february["_source_month"] == 2 and february["CRS_DEP_TIME"] == " "
    assert_checks(files.lineage_check(raw), "lineage")


def test_malformed_row_fails_even_when_pruned(spark, folder):
    (folder / "ontime_2025_03.csv").write_text(f"{HEADER}\n2025,3\n")
    with pytest.raises(Exception):
        files.read_raw_csv(spark, str(folder / "ontime_2025_03.csv")).agg(F.count("YEAR")).collect()


def test_unknown_period_fails(spark, folder):
    (folder / "flights.csv").write_text(f"{HEADER}\n{record(YEAR='2025')}\n")
    with pytest.raises(CheckFailure, match="source_period_known"):
        assert_checks(files.lineage_check(files.read_raw_csv(spark, str(folder / "flights.csv"))), "lineage")


def test_header_and_manifest_pass(spark, folder):
    facts = files.file_facts(spark, f"{folder}/ontime*")
    assert failed(files.check_header(facts)) == set()
    assert failed(files.check_manifest(facts, manifest(spark, folder))) == set()
    sizes = {r["file_name"]: r["size_bytes"] for r in files.file_sizes(spark, f"{folder}/ontime*").collect()}
    assert sizes == {p.name: p.stat().st_size for p in folder.glob("ontime*")}


def test_header_is_case_and_order_sensitive(spark, folder):
    (folder / "ontime_2025_03.csv").write_text(HEADER.replace("YEAR", "Year") + "\n")
    (folder / "ontime_2025_04.csv").write_text(",".join([*C.RAW_COLUMNS[1:], C.RAW_COLUMNS[0]]) + "\n")
    problems = {r["file_name"]: r for r in files.header_problems(files.file_facts(spark, f"{folder}/ontime_2025_0[34].csv")).collect()}
    assert problems["ontime_2025_03.csv"]["missing_names"] == ["YEAR"]
    assert problems["ontime_2025_03.csv"]["unexpected_names"] == ["Year"]
    moved = problems["ontime_2025_04.csv"]
    assert moved["missing_names"] == [] and moved["header_matches"] is False


@pytest.mark.parametrize("change, check", [
    (("ontime_2025_01.csv", 1, None), "sizes_match"),
    (("ontime_2025_01.csv", 1, "0" * 64), "hashes_match"),
    (("ontime_2025_01.csv", 1, "xyz"), "manifest_hash_well_formed"),
    (("other.csv", 1, "0" * 64), "no_missing_file"),
    (("other.csv", 1, "0" * 64), "no_unexpected_file"),
])
def test_manifest_faults(spark, folder, change, check):
    facts = files.file_facts(spark, f"{folder}/ontime*")
    assert check in failed(files.check_manifest(facts, manifest(spark, folder, ontime_2025_01=change)))


def test_partitioned_round_trip_keeps_clock_texts(spark, tmp_path):
    sample = tables.from_rows(spark, [(2025, 1, "0015"), (2025, 1, "2400"), (2025, 2, None)], "YEAR int, MONTH int, CRS_DEP_TIME string")
    back = tables.roundtrip_parquet(sample, f"{tmp_path}/clocks", ["YEAR", "MONTH"])
    assert type_map(back.schema) == {"YEAR": "int", "MONTH": "int", "CRS_DEP_TIME": "string"}
    assert same_values(sample, back).first()["same"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.roundtrip_parquet(sample, f"{tmp_path}/clocks", ["YEAR", "MONTH"])


def test_named_views(spark):
    analytics_job.register_views({"one_row": spark.range(1), "two_rows": spark.range(2)})
    assert spark.sql("SELECT count(*) FROM two_rows LEFT JOIN one_row USING (id)").first()[0] == 2


def test_staged_table_is_written_again_when_cleared(spark, tmp_path):
    first, seen = tables.stage_once(spark, ("test",), lambda: spark.range(3), {"n": F.count("*"), "top": F.max("id")})
    assert first.count() == 3 and seen == {"n": 3, "top": 2}
    key = next(k for k in tables._STAGED if k[1:] == ("test",))
    tables._STAGED[key] = (f"{tmp_path}/gone", first.schema, {})
    assert tables.stage_once(spark, ("test",), lambda: spark.range(3))[0].count() == 3


def test_summary_csv_keeps_the_order_of_the_query(spark, medium, tmp_path):
    from skyledger.operators import kpi
    from skyledger.plans import summary_job

    for name, (build, order, _) in summary_job.QUERIES.items():
        summary = build(medium.accepted)
        tables.write_summary_csv(summary, f"{tmp_path}/{name}", order)
        part, = (tmp_path / name).glob("part-*.csv")
        lines = part.read_text().splitlines()
        assert lines[0] == ",".join(summary.columns)
        keys = [tuple(str(v) for v in r[:3]) for r in order(summary).collect()]
        assert [tuple(line.split(",")[:3]) for line in lines[1:]] == keys


def test_staged_tables_inside_a_scope_are_removed(spark, tmp_path):
    with tables.temporary(spark):
        staged = tables.stage(spark.range(3), "scoped")
        path = staged.inputFiles()[0]
        assert staged.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_first_line_of_any_length(spark, tmp_path):
    long = ",".join(f"c{i}" for i in range(5000))
    (tmp_path / "wide.csv").write_text(long + "\n1,2\n")
    assert files.file_headers(spark, f"{tmp_path}/wide.csv").first()["header"] == long.split(",")


def test_contents_tell_changed_files_apart(spark, tmp_path):
    for name, text in {"a.csv": "x\n1\n2\n", "b.csv": "x\n2\n1\n", "c.csv": "x\n1\n3\n"}.items():
        (tmp_path / name).write_text(text)
    found = {r["file_name"]: (r["lines"], r["digest"]) for r in files.file_contents(spark, f"{tmp_path}/*.csv").collect()}
    assert found["a.csv"] == found["b.csv"] != found["c.csv"] and found["a.csv"][0] == 3
