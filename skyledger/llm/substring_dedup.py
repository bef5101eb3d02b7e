"""Substring deduplication by super-k-mers (operator 1).

A window is WIDTH consecutive words. Its minimiser is the smallest hash among its M-word runs; consecutive windows of a
document with the same minimiser form a super-k-mer, and its words travel as one packed string (single blanks between the
words) to the bucket of the minimiser, instead of one string per window. In a bucket the words get exact numbers, windows
are sorted, and each window learns the smallest doc_id it occurs in. Windows sort by a hash of those numbers, and
neighbours are compared number by number, so equal means equal words.

Buckets are dealt into GROUPS groups per shuffle partition. A chunk of documents sends one compressed row to each group with
all its packed strings for it, which more than halves what is shuffled. A task sorts its rows by group and holds one group
at a time, about 1 / (GROUPS * partitions) of the super-k-mers.
A minimiser above 1 / (HEAVY * shuffle partitions) of all super-k-mers, found by a first pass that counts per chunk, is
heavy: there are at most HEAVY * partitions of them. Its windows travel one by one and meet in a pre-aggregated minimum
and a join that adaptive execution can split, so a passage in a third of all documents burdens no task. Which minimisers
are heavy decides only the way, never the result.

Defined cases: words are unchanged runs without ASCII white space; null text has none; a document shorter than a window
keeps everything; rows with equal doc_id never remove from each other (they are told
apart by a 32-bit hash of their texts); a null doc_id is larger than every other; equal
rows get equal results; windows are judged on the input; further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import bytesplit as B
from skyledger.sources.tables import stage

WIDTH, M = 13, 3
HEAVY = 4
GROUPS = 16
LEVEL = 9
LARGEST = np.iinfo(np.int64).max


def packed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words, each followed by one blank; where each begins (one more entry), and each row's first word."""
    data, offsets = B.text_bytes(column)
    starts, ends, first = B.word_bounds(data, offsets)
    begins = np.append(0, np.cumsum(ends - starts + 1))
    out = np.full(begins[-1], 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[begins[1:] - 1] = False
    out[inside] = data[~B.IS_WHITE[data]]
    return out, begins, first


class SuperKmers:
    """The super-k-mers of a chunk of documents: row, first word, words, minimiser."""

    def __init__(self, rows: pa.RecordBatch, hasher: B.WordHasher, width: int) -> None:
        self.data, self.begins, first = packed_words(rows.column("text"))
        hashed = hasher(self.data, self.begins[:-1], self.begins[1:] - 1)
        n = len(hashed) - width + 1
        if n <= 0:
            self.row = self.word = self.windows = self.at = np.zeros(0, np.int64)
            self.minimiser = np.zeros(0, np.int64)
            return
        m = min(M, width)
        least = B.window_hashes(hashed, m)
        for span in _spans(width - m + 1):
            least = np.minimum(least[: len(least) - span], least[span:])
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        whole = row[:n] == row[width - 1 :]
        same = np.zeros(n, bool)
        same[1:] = (least[1:] == least[:-1]) & whole[:-1] & (row[1:n] == row[: n - 1])
        begin = np.flatnonzero(whole & ~same)
        counted = np.append(0, np.cumsum(whole))
        self.windows = np.diff(np.append(counted[begin], counted[-1]))
        self.row, self.word = row[begin], begin - first[row[begin]]
        self.at = begin
        self.minimiser = least[begin].view(np.int64)


def _spans(width: int) -> list[int]:
    """Shifts whose repeated pairwise minima cover `width` neighbours."""
    spans, covered = [], 1
    while covered < width:
        spans.append(min(covered, width - covered))
        covered += spans[-1]
    return spans


def counted_minimisers(width: int):
    """The Arrow function of the first pass: minimisers seen twice or more in a chunk, and under null all super-k-mers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = B.WordHasher()
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                found = SuperKmers(rows, hasher, width)
                values, n = np.unique(found.minimiser, return_counts=True)
                values, n = values[n > 1], n[n > 1]
                yield pa.record_batch({"minimiser": pa.array([*values.tolist(), None], pa.int64()), "n": pa.array([*n.tolist(), len(found.minimiser)], pa.int64())})

    return B.thrifty(count)


def heavy_minimisers(keyed: DataFrame, width: int) -> np.ndarray:
    """Sorted minimisers above their share of all super-k-mers, HEAVY * partitions at most."""
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = keyed.mapInArrow(counted_minimisers(width), "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    counted = stage(counted.where(F.col("minimiser").isNull() | (F.col("n") > 8)), "minimisers")
    total = counted.where("minimiser IS NULL").agg(F.sum("n")).first()[0] or 0
    heavy = counted.where("minimiser IS NOT NULL").where(F.col("n") * HEAVY * parts > total)
    return np.sort(np.array([r.minimiser for r in heavy.select("minimiser").collect()], np.int64))


def picked_strings(found: SuperKmers, heavy: np.ndarray, want_heavy: bool, width: int):
    """Row, first word, bucket and packed string of the super-k-mers of light buckets, or of the windows of heavy ones."""
    is_heavy = np.isin(found.minimiser, heavy)
    pick = np.flatnonzero(is_heavy == want_heavy)
    row, word, begin, windows, bucket = found.row[pick], found.word[pick], found.at[pick], found.windows[pick], found.minimiser[pick]
    if want_heavy:
        step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        row, word, begin, bucket = (np.repeat(x, windows) for x in (row, word, begin, bucket))
        word, begin, windows = word + step, begin + step, np.ones(len(row), np.int64)
    lo, hi = found.begins[begin], found.begins[begin + windows + width - 1]
    return row, word, bucket, lo, hi


def window_splitter(width: int, heavy: np.ndarray):
    """The Arrow function: documents to the single windows of heavy buckets."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = B.WordHasher()
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                found = SuperKmers(rows, hasher, width)
                row, word, _, lo, hi = picked_strings(found, heavy, True, width)
                text = found.data.tobytes()
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id").take(pa.array(row)), "tag": rows.column("tag").take(pa.array(row)), "word": pa.array(word.astype(np.int32)),
                    "packed": pa.array([text[a:b] for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()),
                })

    return B.thrifty(split)


def planes(values: np.ndarray) -> bytes:
    """32-bit values with all first bytes first, then all second bytes and so on, which compresses well."""
    return values.view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes, n: int, offset: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, offset).reshape(4, n).T).view(np.uint32).ravel().astype(np.int64)


def group_splitter(width: int, heavy: np.ndarray, groups: int):
    """The Arrow function: documents to one compressed row of packed super-k-mers for each group of light buckets."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, codec = B.WordHasher(), pa.Codec("zstd", compression_level=LEVEL)
        for batch in batches:
            for rows in B.chunks(batch, "text", size=2 * B.CHUNK):
                found = SuperKmers(rows, hasher, width)
                row, word, bucket, lo, hi = picked_strings(found, heavy, False, width)
                group = (B.mix(bucket.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                row, lo, hi, group = row[order], lo[order], hi[order], group[order]
                doc = pc.fill_null(rows.column("doc_id"), LARGEST).to_numpy()[row]
                tag, word, length = rows.column("tag").to_numpy()[row], word[order].astype(np.uint32), (hi - lo).astype(np.uint32)
                text = found.data.tobytes()
                strings = [text[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
                cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)] if len(group) else [0]
                sizes, payloads = [], []
                for a, b in zip(cuts, cuts[1:]):
                    raw = b"".join([np.diff(doc[a:b], prepend=0).tobytes(), tag[a:b].tobytes(), planes(word[a:b]), planes(length[a:b]), *strings[a:b]])
                    sizes.append(len(raw))
                    payloads.append(codec.compress(raw, asbytes=True))
                yield pa.record_batch({
                    "group": pa.array(group[cuts[:-1]].astype(np.int32)), "n": pa.array(np.diff(cuts).astype(np.int32)),
                    "size": pa.array(sizes, pa.int32()), "payload": pa.array(payloads, pa.binary()),
                })

    return B.thrifty(split)


def repeated_windows(rows: list[tuple[int, bytes]], width: int) -> pa.RecordBatch:
    """From the unpacked rows of whole buckets: the runs of windows that a document with a smaller id has too."""
    docs = np.concatenate([np.cumsum(np.frombuffer(raw, np.int64, n)) for n, raw in rows])
    tags = np.concatenate([np.frombuffer(raw, np.int32, n, 8 * n) for n, raw in rows])
    words = np.concatenate([from_planes(raw, n, 12 * n) for n, raw in rows])
    lengths = np.concatenate([from_planes(raw, n, 16 * n) for n, raw in rows])
    data = np.concatenate([np.frombuffer(raw, np.uint8, offset=20 * n) for n, raw in rows])
    stops = np.flatnonzero(data == 0x20) + 1
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(np.append(0, stops).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    number = pieces.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.append(0, np.searchsorted(stops, np.cumsum(lengths, dtype=np.int64)) + 1)
    row = np.repeat(np.arange(len(lengths)), np.diff(first))
    n = max(len(number) - width + 1, 0)
    at = np.flatnonzero(row[:n] == row[width - 1 :]) if n else np.zeros(0, np.int64)
    doc = docs[row[at]]
    hashed = B.window_hashes(B.mix(number.astype(np.uint64) + np.uint64(1)), width)[at]
    order = np.lexsort((doc, hashed))
    place = at[order]
    equal = hashed[order][1:] == hashed[order][:-1]
    near = np.flatnonzero(equal)
    exact = np.ones(len(near), bool)
    for j in range(width):
        exact &= number[place[near] + j] == number[place[near + 1] + j]
    if not exact.all():  # two different windows with one hash: sort by the words themselves
        order = np.lexsort((doc, *(number[at + j] for j in range(width))))
        place = at[order]
        equal = np.ones(len(place) - 1, bool)
        for j in range(width):
            equal &= number[place[1:] + j] == number[place[:-1] + j]
    group = np.append(0, np.cumsum(~equal))[: len(order)]
    doc = doc[order]
    leader = doc[np.searchsorted(group, np.arange(group[-1] + 1))] if len(group) else doc
    hit = np.sort(place[doc > leader[group]]) if len(group) else place
    begin = np.ones(len(hit), bool)
    begin[1:] = (np.diff(hit) > 1) | (row[hit[1:]] != row[hit[:-1]])
    start = np.flatnonzero(begin)
    runs = np.diff(np.append(start, len(hit)))
    of = row[hit[start]]
    return pa.record_batch({
        "rank": pa.array(docs[of]), "tag": pa.array(tags[of]),
        "word": pa.array((words[of] + hit[start] - first[of]).astype(np.int32)), "windows": pa.array(runs.astype(np.int32)),
    })


def group_reader(width: int):
    """The Arrow function over rows sorted by group: searches one group after the other, small ones together."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for group, n, raw_size, payload in zip(*(batch.column(c).to_pylist() for c in ("group", "n", "size", "payload"))):
                if group != last and size > B.CHUNK:
                    yield repeated_windows(held, width)
                    held, size = [], 0
                held.append((n, pa.decompress(payload, raw_size, codec="zstd", asbytes=True)))
                size, last = size + raw_size, group
        if held:
            yield repeated_windows(held, width)

    return B.thrifty(read)


def remover(width: int, with_text: bool):
    """The Arrow function: documents with their marked runs to counts, digest and (if asked for) the kept text."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                data, begins, first = packed_words(rows.column("text"))
                runs = rows.column("runs")
                owner = np.repeat(np.arange(len(rows)), pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False))
                marks = runs.flatten()
                lo = first[owner] + marks.field("word").to_numpy(zero_copy_only=False)
                hi = lo + marks.field("windows").to_numpy(zero_copy_only=False) + width - 1
                change = np.zeros(len(begins), np.int64)
                np.add.at(change, lo, 1)
                np.add.at(change, hi, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = data[np.repeat(~gone, np.diff(begins))]
                sizes = np.append(0, np.cumsum(np.where(gone, 0, np.diff(begins))))[first]
                text = kept.tobytes()
                texts = [text[a : max(a, b - 1)] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist())]
                out = {
                    "doc_id": rows.column("doc_id"), "n_words": np.diff(first), "n_removed": np.diff(np.append(0, np.cumsum(gone))[first]),
                    "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                }
                yield pa.record_batch(out | ({"kept_text": pa.array(texts, pa.binary()).cast(pa.string())} if with_text else {}))

    return B.thrifty(remove)


def substring_dedup(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and with `with_text` the kept words joined by blanks."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = keyed.withColumn("tag", F.hash("text"))  # tells the rows of one id apart
    heavy = heavy_minimisers(keyed, width)
    groups = GROUPS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = keyed.mapInArrow(group_splitter(width, heavy, groups), "group int, n int, size int, payload binary")
    marks = packed.repartition("group").sortWithinPartitions("group").mapInArrow(group_reader(width), "rank long, tag int, word int, windows int")
    if len(heavy):
        windows = keyed.mapInArrow(window_splitter(width, heavy), "doc_id long, tag int, word int, packed binary")
        windows = stage(windows.withColumn("rank", F.coalesce("doc_id", F.lit(LARGEST))), "windows")
        least = windows.groupBy("packed").agg(F.min("rank").alias("least"), F.max("rank").alias("most")).where("least < most")
        late = windows.join(least.select("packed", "least"), "packed").where("rank > least")
        marks = marks.union(late.select("rank", "tag", "word", F.lit(1).alias("windows")))
    found = marks.groupBy("rank", "tag").agg(F.collect_set(F.struct("word", "windows")).alias("runs")).select("rank", F.col("tag").alias("_tag"), "runs")
    same = (F.col("tag") == F.col("_tag")) & (F.coalesce("doc_id", F.lit(LARGEST)) == F.col("rank"))
    marked = keyed.join(found, same, "left").select("doc_id", "text", F.coalesce("runs", F.array().cast("array<struct<word:int,windows:int>>")).alias("runs"))
    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return marked.mapInArrow(remover(width, with_text), columns)
