"""Legacy archive converter, ARC to WARC (operator 11).

Archives are streams of gzip text: Spark's text reader takes such a file in one task, line by line and in order, from any file
system it knows, so a task holds one record at a time and the lines of one batch, however long the file is. Records are cut by their declared
lengths, never by what a payload looks like. An ARC file starts with a version block; its last line names the fields of the
header lines in that file, which is how versions 1 (five fields) and 2 (ten) are told apart. Files that are not compressed may be
split by the reader; their lines are put in order again by file and place first (`compressed=False`).

Each ARC record becomes one WARC record: the identifier is made from file name, place and header line, so converting again gives the
same one; 14-digit dates become ISO timestamps; a block that starts with an HTTP status line is a response, any other a
resource, the version block the file's warcinfo; digests are bare base32 SHA-1 of payload and block. Of responses with equal
payloads one stays a response and the others become revisits that refer to it: one aggregation over digests picks it, and only
the revisits, without payloads, are joined back. Writers only add lines to the rows they have, so each task writes one
archive and nothing is gathered.

Defined cases: a null html is an empty payload; a null id is written without one, is read as null and counts as the smallest;
repeated rows and ties are records of their own, of which one is the response; a null url becomes `unknown:`, white space
and control characters in one are escaped; a payload may hold any bytes, also such that look like headers; a record is
held whole by one task, so it may have 2 GB at most; a cut-off record or a header line that does not fit its version stops the read with its file and place; an
empty table gives archives without records; further columns of any name do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.tables import stage

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURED = "20000101000000"
PAGE_ID = "X-Page-Id"
#: Bytes of records that a task returns at once.
BATCH_BYTES = 8 << 20

ARC_RECORDS = """file string, offset long, version int, record_id string, url string, ip string, date string, mime string, kind string,
    head binary, payload binary, payload_bytes long, payload_digest string, payload_hash string, block_digest string"""
WARC_RECORDS = """file string, offset long, record_type string, record_id string, url string, date string, refers_to_id string, declared_digest string,
    head binary, payload binary, payload_bytes long, payload_digest string"""


# --- Streams of lines and records --------------------------------------------------------------------------------------


def lines(spark: SparkSession, path: str, compressed: bool = True) -> DataFrame:
    """(file, line) with the lines of a file in order and in one task."""
    read = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("block"))
    if compressed:
        return read.select("file", "line")
    ordered = read.withColumn("place", F.monotonically_increasing_id()).repartition("file").sortWithinPartitions("file", "block", "place")
    return ordered.select("file", "line")


class Stream:
    """One file's bytes, given as lines without their line breaks."""

    def __init__(self, name: str, found: Iterator[bytes]):
        self.name, self.found, self.offset, self.rest = name, found, 0, None

    def line(self) -> bytes | None:
        """The next line, None at the end."""
        out, self.rest = (self.rest if self.rest is not None else next(self.found, None)), None
        if out is not None:
            self.offset += len(out) + 1
        return out

    def text(self) -> bytes | None:
        """The next line that is not blank, without a carriage return."""
        while (out := self.line()) is not None:
            if out.strip(b"\r"):
                return out.rstrip(b"\r")
        return None

    def take(self, n: int) -> bytes:
        """The next n bytes."""
        parts, have = [], 0
        while have < n:
            line = self.line()
            if line is None:
                raise ValueError(f"{self.name}: {n} bytes are declared before byte {self.offset}, {have} follow")
            parts.append(line)
            have += len(line) + 1
        out = b"\n".join(parts)
        if have == n:  # the last line break belongs to the block
            return out + b"\n" if n else out
        if have > n + 1:  # the line goes on behind the block
            self.rest = out[n:]
            self.offset -= len(self.rest) + 1
        return out[:n]


def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[Stream]:
    """A stream for each file of a task; each must be read to its end before the next."""
    rows = ((f, line) for b in batches for f, line in zip(b.column("file").to_pylist(), (v.as_py() for v in b.column("line"))))
    row = next(rows, None)
    while row is not None:
        name = row[0]

        def own():
            nonlocal row
            while row is not None and row[0] == name:
                line = row[1]
                row = next(rows, None)
                yield line

        yield Stream(name, own())


def read_with(records: Callable[[Stream], Iterator[dict]], fields: list[str], schema: str) -> Callable:
    """The Arrow function that turns lines into rows of the records found, a bounded number of bytes at a time."""
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = {name: kinds[kind] for name, kind in (f.split() for f in schema.replace("\n", " ").split(","))}
    schema = pa.schema([(f, types[f]) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for stream in streams(batches):
            for record in records(stream):
                rows.append({f: record.get(f) for f in fields})
                size += 1000 + len(rows[-1].get("payload") or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def selected(found: DataFrame, records: Callable, schema: str, payloads: bool) -> DataFrame:
    fields = {f.split()[0]: f for f in schema.replace("\n", " ").split(",")}
    if not payloads:
        del fields["payload"]
    return found.mapInArrow(read_with(records, list(fields), schema), ",".join(fields.values()))


# --- What is in a record -------------------------------------------------------------------------------------------------


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """An HTTP message's head, with the blank line, and its payload."""
    ends = [i + len(gap) for gap in (b"\r\n\r\n", b"\n\n") if (i := block.find(gap)) >= 0]
    end = min(ends, default=len(block))
    return block[:end], block[end:]


def arc_records(stream: Stream) -> Iterator[dict]:
    """The records of one ARC file, its version block first."""
    names, version = ["url", "ip", "date", "mime", "length"], 1
    base = stream.name.rsplit("/", 1)[-1]
    while (line := stream.text()) is not None:
        offset = stream.offset - len(line) - 1
        version_block = line.startswith(b"filedesc://")
        values = line.decode("utf-8", "surrogateescape").split(" ")
        if version_block:
            values = [*values[:4], values[-1]]
        if not version_block and len(values) > len(names):  # blanks in the first field, which some writers left in
            values = [" ".join(values[: 1 - len(names)]), *values[1 - len(names):]]
        field = dict(zip(["url", "ip", "date", "mime", "length"] if version_block else names, values))
        if len(field) < 5 or not field["length"].isdigit() or not re.fullmatch(r"\d{14}", field["date"]):
            raise ValueError(f"{stream.name}: no header line of ARC version {version} at byte {offset}: {line[:200]!r}")
        block = stream.take(int(field["length"]))
        if version_block:
            about = block.decode("utf-8", "replace").split("\n")
            version = int(about[0].split(" ")[0])
            short = {"URL": "url", "IP-address": "ip", "Archive-date": "date", "Content-type": "mime", "Archive-length": "length"}
            names = [short.get(n, n) for n in (about[1] if len(about) > 1 and about[1].strip() else ARC_FIELDS[version]).strip().split(" ")]
        response = block.startswith(b"HTTP/") and not version_block
        head, payload = http_parts(block) if response else (b"", block)
        field = {k: v.encode("utf-8", "surrogateescape").decode("utf-8", "replace") for k, v in field.items()}
        yield {
            "file": base, "offset": offset, "version": version, "head": head, "payload": payload, "payload_bytes": len(payload),
            "record_id": f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(b'%s %d %s' % (base.encode(), offset, line)).digest()[:16], version=5)}>",
            "url": field["url"], "ip": field["ip"], "date": field["date"], "mime": field["mime"],
            "kind": "warcinfo" if version_block else "response" if response else "resource",
            "payload_digest": base32_sha1(payload), "payload_hash": hashlib.blake2b(payload, digest_size=16).hexdigest(), "block_digest": base32_sha1(block),
        }


def warc_records(stream: Stream) -> Iterator[dict]:
    """The records of one WARC file."""
    base = stream.name.rsplit("/", 1)[-1]
    while (line := stream.text()) is not None:
        offset = stream.offset - len(line) - 1
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{stream.name}: no WARC record at byte {offset}: {line[:200]!r}")
        field = {}
        while (line := stream.line()) is not None and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            field[name.strip().lower()] = value.strip()
        if not field.get("content-length", "").isdigit():
            raise ValueError(f"{stream.name}: no length in the record at byte {offset}")
        block = stream.take(int(field["content-length"]))
        head, payload = http_parts(block) if field.get("content-type", "").startswith("application/http") else (b"", block)
        yield {
            "file": base, "offset": offset, "record_type": field.get("warc-type"), "record_id": field.get("warc-record-id"), "url": field.get("warc-target-uri"),
            "date": field.get("warc-date"), "refers_to_id": field.get("warc-refers-to"), "declared_digest": field.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "head": head, "payload": payload, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload),
        }


def read_arc(spark: SparkSession, path: str, payloads: bool = True, compressed: bool = True) -> DataFrame:
    """The records of ARC files of either version, version blocks among them."""
    return selected(lines(spark, path, compressed), arc_records, ARC_RECORDS, payloads)


def read_warc(spark: SparkSession, path: str, payloads: bool = True, compressed: bool = True) -> DataFrame:
    """The records of WARC files; `payload_digest` is computed from what was read, `declared_digest` is what the header says."""
    return selected(lines(spark, path, compressed), warc_records, WARC_RECORDS, payloads)


def page_id(head: Column) -> Column:
    """The id in an HTTP head, null where there is none."""
    found = F.regexp_extract(head.cast("string"), rf"(?im)^{PAGE_ID}: *(-?\d+)\r?$", 1)
    return F.nullif(found, F.lit("")).cast("long")


# --- Writing -----------------------------------------------------------------------------------------------------------


def write_records(records: DataFrame, record: Column, first: Column, between: str, path: str) -> None:
    """One gzip file for each task that has rows. `first` opens a file; a line break `between` follows each record."""
    number = F.monotonically_increasing_id()  # its low 33 bits count the rows of a partition
    begins = number.bitwiseAND(F.lit((1 << 33) - 1)) == 0
    text = F.concat(F.when(begins, F.concat(first, F.lit(between))).otherwise(F.lit("")), record)
    records.select(text.alias("value")).write.option("lineSep", between).option("compression", "gzip").text(path)


def write_arc(pages: DataFrame, path: str, captured: str = CAPTURED) -> None:
    """Pages (page_id, url, html) as ARC files, those of odd tasks of version 2."""
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    version = part % 2 + 1
    by_version = lambda one, two: F.when(version == 1, one).otherwise(two)
    html = F.coalesce("html", F.lit(""))
    url = F.regexp_replace(F.coalesce(F.nullif(F.col("url"), F.lit("")), F.lit("unknown:")), r"[\x00-\x20\x7F]", "%20")
    own_id = F.coalesce(F.concat(F.lit(f"{PAGE_ID}: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), own_id, F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    length = (F.octet_length(head) + F.octet_length(html)).cast("string")
    name = F.concat(F.lit("pages-"), part.cast("string"), F.lit(".arc"))
    line = F.concat(url, F.lit(f" 0.0.0.0 {captured} text/html "), by_version(F.lit(""), F.concat(F.lit("200 - - - "), name, F.lit(" "))), length, F.lit("\n"))
    about = F.concat(version.cast("string"), F.lit(" 0 skyledger\n"), by_version(F.lit(ARC_FIELDS[1]), F.lit(ARC_FIELDS[2])), F.lit("\n"))
    filedesc = F.concat(F.lit("filedesc://"), name, F.lit(f" 0.0.0.0 {captured} text/plain "), by_version(F.lit(""), F.concat(F.lit("200 - - 0 "), name, F.lit(" "))), F.octet_length(about).cast("string"), F.lit("\n"), about)
    write_records(pages, F.concat(line, head, html), filedesc, "\n", path)


def warc_text(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """A WARC record; header fields that are null are left out."""
    rows = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in [("WARC-Type", kind), *fields]]
    return F.concat(F.lit(f"{WARC_VERSION}\r\n"), *rows, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def iso(date: Column) -> Column:
    """A 14-digit date as an ISO timestamp."""
    return F.regexp_replace(date, r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", "$1-$2-$3T$4:$5:$6Z")


def revisits(records: DataFrame, prefer: Column, min_bytes: int) -> DataFrame:
    """(record_id, refers_to) of the responses whose payload another one keeps: of equal ones with at least `min_bytes` that with
    the largest `prefer`."""
    light = records.where("kind = 'response'").where(F.col("payload_bytes") >= min_bytes)
    light = light.select("record_id", "url", "date", prefer.alias("prefer"), F.struct("payload_digest", "payload_hash", "payload_bytes").alias("content"))
    light = stage(light, "responses")
    kept = F.max_by(F.struct("record_id", "url", "date"), F.struct("prefer", "record_id")).alias("refers_to")
    shared = light.groupBy("content").agg(kept, F.count("*").alias("n")).where("n > 1").select("content", "refers_to")
    found = light.join(shared, "content").where("record_id <> refers_to.record_id")
    return stage(found.select("record_id", "refers_to"), "revisits")


def convert(spark: SparkSession, arc: str, warc: str, prefer: Column, min_bytes: int = 0, compressed: bool = True) -> None:
    """Write the records of the ARC files in `arc` as WARC files in `warc`, `prefer` being computed from an ARC record without
    its payload. Version blocks are replaced by a warcinfo in each file."""
    known = revisits(read_arc(spark, arc, False, compressed), prefer, min_bytes)
    records = read_arc(spark, arc, True, compressed).where("kind <> 'warcinfo'").join(known, "record_id", "left")
    again = F.col("refers_to").isNotNull()
    kind = F.when(again, F.lit("revisit")).otherwise(F.col("kind"))
    mime = F.when(F.col("kind") == "response", F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))
    target = F.col("refers_to")
    fields = [
        ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", iso(F.col("date"))), ("WARC-Target-URI", F.col("url")), ("WARC-IP-Address", F.col("ip")),
        ("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))), ("WARC-Refers-To", target["record_id"]),
        ("WARC-Refers-To-Target-URI", target["url"]), ("WARC-Refers-To-Date", iso(target["date"])),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Block-Digest", F.when(~again, F.concat(F.lit("sha1:"), F.col("block_digest")))), ("Content-Type", mime),
    ]
    block = F.concat(F.col("head").cast("string"), F.when(again, F.lit("")).otherwise(F.col("payload").cast("string")))
    info = F.lit("software: skyledger\r\nformat: WARC File Format 1.1\r\ndescription: converted from ARC\r\n")
    about = warc_text(F.lit("warcinfo"), [("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))), ("WARC-Date", iso(F.lit(CAPTURED))), ("Content-Type", F.lit("application/warc-fields"))], info)
    write_records(records, warc_text(kind, fields, block), about, "\r\n\r\n", warc)


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits with their full payload's size and digest, a revisit's being those of the response it refers to:
    record_id, record_type, url, page_id, payload_bytes, payload_digest, intact, refers_to (that response's page_id)."""
    light = records.where("record_type in ('response', 'revisit')").select(
        "record_id", "record_type", "url", "refers_to_id", "declared_digest", page_id(F.col("head")).alias("page_id"), "payload_bytes", "payload_digest")
    light = stage(light, "records")
    known = light.where("record_type = 'response'")
    own = known.withColumn("refers_to", F.lit(None).cast("long"))
    target = known.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    again = light.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(target, "refers_to_id", "left")
    both = own.unionByName(again).withColumn("intact", F.coalesce(F.col("payload_digest") == F.col("declared_digest"), F.lit(False)))
    return both.select("record_id", "record_type", "url", "page_id", "payload_bytes", "payload_digest", "intact", "refers_to")
