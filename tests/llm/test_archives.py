import base64
import glob
import gzip
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from skyledger.llm import archives, queries

SCHEMA = "page_id long, url string, html string, record_type string, file string"


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def brute(rows, min_bytes=0):
    payloads = [(i, html or "") for i, _, html in rows]
    known = {}
    for i, p in payloads:
        known[p] = max(known.get(p, (False, 0)), (i is not None, i or 0))
    out, kept = [], set()
    for i, p in sorted(payloads, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        own = (i is not None, i or 0) == known[p] and p not in kept or len(p.encode()) < min_bytes
        if own:
            kept.add(p)
        target = known[p][1] if known[p][0] else None
        out.append((i, len(p.encode()), sha(p), "response" if own else "revisit", None if own else target))
    return sorted(out, key=str)


def through(spark, rows, tmp_path, partitions=3, **options):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(partitions)
    arc, warc = f"file://{tmp_path}/arc", f"file://{tmp_path}/warc"
    archives.write_arc(pages, arc)
    archives.convert(spark, arc, warc, prefer=archives.page_id(F.col("head")), **options)
    return archives.resolved(archives.read_warc(spark, warc))


def plain(found):
    rows = found.collect()
    assert all(r.intact for r in rows) and len({r.record_id for r in rows}) == len(rows)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


LIKE_A_RECORD = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 999999\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"
ROWS = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/ with blank", "<p>same</p>"), (3, None, None), (4, "", ""), (None, "http://c/", "<p>same</p>"),
    (None, "http://d/", "no id"), (5, "http://e/\n\t", "line\nbreaks\r\n\r\n"), (6, "http://f/", LIKE_A_RECORD), (7, "http://f/", "\n" + LIKE_A_RECORD + "\n\n"),
    (8, "http://g/", "http://x/ 0.0.0.0 20000101000000 text/html 5\nabc"), (9, "http://h/", "ß\u0000\u2028" * 3), (10, "http://i/", "w" * 3_000_000),
    (11, "http://j/", "filedesc://x 0.0.0.0 20000101000000 text/plain 3\n"), (-12, "http://k/?q=%20", "-\n"), (-12, "http://k/?q=%20", "-\n"),
]


def test_round_trip_of_hard_payloads(spark, tmp_path):
    assert plain(through(spark, ROWS, tmp_path)) == brute(ROWS)


def test_small_payloads_are_all_responses(spark, tmp_path):
    assert plain(through(spark, ROWS, tmp_path, partitions=1, min_bytes=5)) == brute(ROWS, 5)


def test_one_payload_in_most_rows_and_empty_table(spark, tmp_path):
    rows = [(i, "http://a/", "hot" if i % 3 else str(i)) for i in range(600)]
    assert plain(through(spark, rows, tmp_path / "hot", 8)) == brute(rows)
    assert plain(through(spark, rows[:0], tmp_path / "none")) == []


def test_whole_table(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    found = queries.op11_warc(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_files_hold_what_the_formats_ask_for(spark, tmp_path):
    through(spark, ROWS, tmp_path, 4)
    versions = set()
    for path in glob.glob(f"{tmp_path}/arc/*.gz"):
        data = gzip.open(path).read()
        assert data.startswith(b"filedesc://pages-")
        about = data.split(b"\n")[1:3]
        versions.add(int(about[0].split()[0]))
        assert about[1].decode() == archives.ARC_FIELDS[int(about[0].split()[0])]
    assert versions == {1, 2}
    for path in glob.glob(f"{tmp_path}/warc/*.gz"):
        data, at, types = gzip.open(path).read(), 0, []
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
            block = data[end + 4: end + 4 + int(head["Content-Length"])]
            assert data[at:at + 10] == b"WARC/1.1\r\n" and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", head["WARC-Date"])
            if head["WARC-Type"] == "response":
                assert head["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            if head["WARC-Type"] == "revisit":
                assert head["WARC-Profile"] == archives.REVISIT_PROFILE and head["WARC-Refers-To"] != head["WARC-Record-ID"]
            types.append(head["WARC-Type"])
            at = end + 4 + len(block)
            assert data[at:at + 4] == b"\r\n\r\n"
            at += 4
        assert types[0] == "warcinfo" and "warcinfo" not in types[1:]


V1 = (b"filedesc://old.arc 0.0.0.0 19980203040506 text/plain 71\n1 0 origin\nURL IP-address Archive-date Content-type Archive-length\n"
      b"\nhttp://a/with blank 1.2.3.4 19980203040507 text/html 22\nHTTP/1.0 200 OK\n\n\nbody\n\ndns:a 1.2.3.4 19980203040508 text/dns 6\n1.2.3.\n")
V2 = (b"filedesc://new.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 new.arc 120\n2 0 origin\nURL IP-address Archive-date Content-type Result-code Checksum "
      b"Location Offset Filename Archive-length\n\nhttp://b/ 1.2.3.4 20010203040507 text/html 200 - - 221 new.arc 4\nabc\n\n")


@pytest.mark.parametrize("compressed", [True, False])
def test_foreign_archives_of_both_versions(spark, tmp_path, compressed):
    write = gzip.open if compressed else open
    lengths = [len(x.split(b"\n", 1)[1].split(b"\n\n")[0]) + 1 for x in (V1, V2)]
    for name, data, n in (("old.arc", V1, lengths[0]), ("new.arc", V2, lengths[1])):
        with write(tmp_path / (name + ".gz" * compressed), "wb") as f:
            f.write(re.sub(rb" \d+\n", b" %d\n" % n, data, count=1))
    found = archives.read_arc(spark, f"file://{tmp_path}", compressed=compressed).orderBy("version", "offset").collect()
    got = [(r.version, r.kind, r.url, r.date, bytes(r.payload)) for r in found if r.kind != "warcinfo"]
    assert got == [(1, "response", "http://a/with blank", "19980203040507", b"\nbody"), (1, "resource", "dns:a", "19980203040508", b"1.2.3."),
                   (2, "resource", "http://b/", "20010203040507", b"abc\n")]
    assert [r.kind for r in found].count("warcinfo") == 2


def test_cut_off_record_names_its_file(spark, tmp_path):
    with gzip.open(tmp_path / "cut.arc.gz", "wb") as f:
        f.write(b"http://a/ 1.2.3.4 19980203040507 text/html 50\nshort\n")
    with pytest.raises(Exception, match="cut.arc.gz: 50 bytes are declared"):
        archives.read_arc(spark, f"file://{tmp_path}").collect()
