"""What queries over whole tables leave in the shared folder, and comparisons that hold a part of the rows at a time."""

import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from samples import TESTDATA
from skyledger import contract as C
from skyledger.operators import compare
from skyledger.plans import catalog
from skyledger.plans.catalog import Inputs
from skyledger.sources import tables

NAN = float("nan")


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """A shared folder of its own, and nothing staged before."""
    monkeypatch.setattr(tables, "_STAGED", {})
    monkeypatch.setattr(tables, "shared_folder", lambda _: str(tmp_path))
    return tmp_path


def bag(frame):
    return Counter(tuple(map(str, r)) for r in frame.collect())


def test_comparing_in_parts_finds_the_same(spark, folder):
    """NULLs, copies, both zeros, NaN, arrays with NULLs, a record that is most of a table, and rows of one side only."""
    make = lambda *rows: spark.createDataFrame(list(rows), "k int, t string, d double, a array<double>")
    some = [(k, f"t{k}", float(k), [k / 2, None]) for k in range(50)]
    left = make(*some, *[(1, "hot", 1.0, None)] * 500, (None, None, None, None), (None, None, None, None), (2, "z", 0.0, [0.0]), (3, "n", NAN, [NAN]))
    right = make(*some[1:], *[(1, "hot", 1.0, None)] * 490, (None, None, None, None), (2, "z", -0.0, [-0.0]), (3, "n", NAN, [NAN]), (9, "", None, []))
    for a, b in ((left, right), (left, left.limit(0)), (left.limit(0), left.limit(0))):
        direct, parts = compare.signed_rows(a, b), compare.signed_rows(a, b, parts=3)
        assert parts.dtypes == direct.dtypes and bag(parts) == bag(direct)
    assert bag(compare.signed_rows(left, right, parts=3))["1", "hot", "1.0", "None", "10"] == 1
    assert bag(compare.diff(right, left, parts=3)) == bag(compare.diff(right, left))
    for a, b in ((left, right), (left, left)):
        assert compare.same_values(a, b, parts=3).first() == compare.same_values(a, b).first()
    nested = left.select("a")
    assert bag(compare.signed_rows(nested, right.select("a"), parts=3)) == bag(compare.signed_rows(nested, right.select("a")))
    assert not glob.glob(f"{folder}/dealt-*") and spark.conf.get(tables.SHUFFLE_CLEANUP) == "false"


def test_a_failed_part_leaves_nothing_dealt(spark, folder):
    frame = spark.range(10)
    with pytest.raises(Exception):
        compare._by_part(frame.withColumn("surplus", F.lit(1)), F.col("id") % 2, 2, lambda rows: rows.select(F.raise_error(F.lit("no"))))
    assert not glob.glob(f"{folder}/dealt-*") and spark.conf.get(tables.SHUFFLE_CLEANUP) == "false"


def test_whole_tables_are_compared_in_parts(spark, folder):
    """All records of both sides used to lie in one shuffle."""
    for name in ("signed_rows", "diff", "same_values"):
        found = catalog.callables()[name](spark, f"{TESTDATA}/sf0.001")
        assert found.inputFiles() and all("differences-" in file for file in found.inputFiles()), name
    assert not tables._STAGED and not glob.glob(f"{folder}/dealt-*")


def test_records_are_written_as_compressed_text_at_once(spark, folder):
    """They used to be staged, shuffled and written uncompressed."""
    found = catalog.callables()["read_raw_csv"](spark, f"{TESTDATA}/sf0.001")
    assert not tables._STAGED and {file.rpartition(".csv")[2] for file in found.inputFiles()} == {".gz"}
    assert found.count() == Inputs(spark, f"{TESTDATA}/sf0.001").once("raw").count()


def test_malformed_rows_keep_only_the_parse(spark, folder):
    """All records used to be staged, and the text to stay."""
    found = catalog.callables()["malformed_rows"](spark, f"{TESTDATA}/sf0.001")
    assert not tables._STAGED and [name.partition("-")[0] for name in os.listdir(folder)] == ["parsed"]
    assert found.agg(F.sum("read_rows") + F.sum("malformed_rows")).first()[0] == Inputs(spark, f"{TESTDATA}/sf0.001").once("raw").count()


def test_csv_text_is_written_as_it_is(spark, folder, small):
    """Quotes, separators, spaces, comment signs and other letters, by several tasks, each of which heads its own files."""
    texts = ['a,"b, c",d', '"x ""y"" z",1', " lead, trail ", "#1,2", "\\,\\\"", "ü,漢", ",,,", '"', "a\tb"]
    records = spark.createDataFrame([(f"s{k % 2}", t) for k, t in enumerate(texts * 4)], "source string, text string").repartition(4)
    path = catalog._csv_folder(small, records, "text")
    files = glob.glob(f"{path}/source=*/*.gz")
    lines = Counter((r["source"], r["value"]) for r in spark.read.text(path).collect())
    header = ",".join(C.RAW_COLUMNS)
    assert len(files) > 2 and sum(n for (_, text), n in lines.items() if text == header) == len(files)
    assert {line: n for line, n in lines.items() if line[1] != header} == Counter((r["source"], r["text"]) for r in records.collect())
    assert all(spark.read.text(file).first()["value"] == header for file in files)


def test_publishing_reads_what_is_published(spark, folder):
    """Raw records and the accepted table used to be staged, and the faulty records twice, once by the query and once by the job."""
    found = catalog.callables()["publish_refused"](spark, f"{TESTDATA}/sf0.001")
    assert not tables._STAGED and os.listdir(folder) and not glob.glob(f"{folder}/raw-*")
    assert {r["refused"] for r in found.collect()} == {True}
