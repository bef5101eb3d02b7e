"""MinHash near-duplicate detection with odd sketches (operator 5).

1. One Arrow pass gives each document the digest of its shingle set, a band key per group of MinHash samples, and an odd
   sketch: a parity bitmap of all samples. Documents with equal sets are one class from here on.
2. Classes that share a band key are candidates. In every bucket each class is held against the most popular one, the one
   whose buckets are fullest; the XOR population count of two sketches estimates the similarity and drops pairs that are
   surely below the threshold. Each class confirms the most similar pair that is left on the full sets, and the links give
   first components; a group of near copies comes together around its original here.
3. What is left to do are pairs of one bucket in different components. Only buckets with several components are joined
   with themselves, classes outside the bucket's largest component against all, each pair in the first band it shares. The
   join compares a second, four times as precise odd sketch inside its condition, so near copies never become all their
   pairs. Survivors are confirmed on the full sets.
4. Components of all links, and the smallest doc_id of each.

With ROWS samples per band and BANDS bands a pair at similarity 0.8 shares no band with probability
(1 - 0.8^5)^32 < 4e-6, and the sketch limits lie five standard deviations away from the expected difference.

Defined cases: A-Z is lower-cased and nothing else; null text and text without words have an empty set, link with nothing
and are their own component; fewer words than a shingle are one shingle; rows with equal ids are separate documents; a
null id never becomes a component's id unless all its members have none; a pair of equal texts is one class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import bytesplit as B
from skyledger.llm.columns import fresh
from skyledger.llm.components import components
from skyledger.sources.tables import stage

BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
PRECISE_SAMPLES, PRECISE_BITS = 1024, 4096
DEVIATIONS = 5


def sketch_limit(threshold: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """The largest XOR population count that a pair at the threshold can have, DEVIATIONS standard deviations up.

    s different samples toggle 2s bits of the two sketches; a bit differs with probability (1 - (1 - 2/n)^2s) / 2."""
    s = samples * (1 - threshold)
    mean = bits / 2 * (1 - np.exp(-4 * s / bits))
    slope = 2 * np.exp(-4 * s / bits)
    collisions = bits / 4 * (1 - np.exp(-8 * s / bits)) - 2 * s * np.exp(-8 * s / bits)
    return int(np.ceil(mean + DEVIATIONS * np.sqrt(s * threshold * slope**2 + max(collisions, 0))))


def min_samples(values: np.ndarray, at: np.ndarray, samples: int) -> np.ndarray:
    """MinHash samples of sets that stand end to end in `values` and begin at `at`: sets x samples, hashes with the sample's
    number mixed in."""
    seeds = B.mix(np.arange(1, 2 * samples + 1, dtype=np.uint64))
    flips, factors = seeds[:samples], seeds[samples:] | np.uint64(1)
    least = np.stack([np.minimum.reduceat((values ^ f) * m, at) for f, m in zip(flips, factors)], axis=1)
    return B.mix(least ^ flips)


def odd_sketch(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps: each sample toggles one bit of its set's sketch."""
    spot = (samples >> np.uint64(20)) % np.uint64(bits) + (np.arange(len(samples), dtype=np.uint64) * np.uint64(bits))[:, None]
    parity = np.bincount(spot.ravel().astype(np.int64), minlength=len(samples) * bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.uint64).reshape(len(samples), -1)


def long_lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.view(np.int64).ravel()), rows.shape[1]).cast(pa.list_(pa.int64()))


def shingle_sets(column: pa.Array, hasher: B.WordHasher, width: int) -> list[np.ndarray]:
    """The sorted hashes of each row's distinct shingles."""
    data, offsets = B.text_bytes(column)
    data = B.lower_ascii(data)
    starts, ends, first = B.word_bounds(data, offsets)
    hashed = hasher(data, starts, ends)
    windows = B.window_hashes(hashed, width)
    sets = []
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= width:
            sets.append(np.unique(windows[lo : hi - width + 1]))
        elif hi > lo:  # the whole sequence; its length keeps it apart from longer shingles
            sets.append(B.window_hashes(hashed[lo:hi], hi - lo) ^ np.uint64(hi - lo))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signer(width: int):
    """The Arrow function: (doc_id, row_key, text) to (doc_id, row_key, n_shingles, class, bands, sketch)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = B.WordHasher()
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                sets = shingle_sets(rows.column("text"), hasher, width)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                bands = np.zeros((len(sets), BANDS), np.uint64)
                sketches = np.zeros((len(sets), SKETCH_BITS // 64), np.uint64)
                if len(full):
                    samples = min_samples(np.concatenate(sets), np.append(0, np.cumsum(sizes[full]))[:-1], SAMPLES)
                    keyed = samples[:, ::ROWS].copy()
                    for j in range(1, ROWS):
                        keyed = keyed * np.uint64(B.BASE) + samples[:, j::ROWS]
                    bands[full] = B.mix(keyed)
                    sketches[full] = odd_sketch(samples, SKETCH_BITS)
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id"), "row_key": rows.column("row_key"), "n_shingles": sizes,
                    "class": pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    "bands": long_lists(bands), "sketch": long_lists(sketches),
                })

    return B.thrifty(sign)


def precise_signer(width: int):
    """The Arrow function: (class, text) to (class, precise), leaving out texts of other sets than the class."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = B.WordHasher()
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                sets = shingle_sets(rows.column("text"), hasher, width)
                right = [i for i, (s, c) in enumerate(zip(sets, rows.column("class").to_pylist())) if len(s) and set_digest(s) == c]
                if right:
                    sets = [sets[i] for i in right]
                    samples = min_samples(np.concatenate(sets), np.append(0, np.cumsum([len(s) for s in sets]))[:-1], PRECISE_SAMPLES)
                    yield pa.record_batch({"class": rows.column("class").take(pa.array(right)), "precise": long_lists(odd_sketch(samples, PRECISE_BITS))})

    return B.thrifty(sign)


def confirmer(width: int, threshold_percent: int):
    """The Arrow function: pairs of classes with a text each to the pairs whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = B.WordHasher()
        for batch in batches:
            for rows in B.chunks(batch, "text_a", "text_b"):
                left, right = (shingle_sets(rows.column(c), hasher, width) for c in ("text_a", "text_b"))
                a, b = rows.column("a").to_pylist(), rows.column("b").to_pylist()
                keep = []
                for i, (x, y) in enumerate(zip(left, right)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * common >= threshold_percent * (len(x) + len(y) - common) and set_digest(x) == a[i] and set_digest(y) == b[i]:
                        keep.append(i)
                yield pa.record_batch({"a": pa.array([a[i] for i in keep], pa.binary()), "b": pa.array([b[i] for i in keep], pa.binary())})

    return B.thrifty(confirm)


def difference(left: Column, right: Column, bits: int = SKETCH_BITS) -> Column:
    """Population count of the XOR of two sketches."""
    counts = [F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(bits // 64)]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total


def first_shared_band(left: Column, right: Column) -> Column:
    found = F.when(left[0] == right[0], 0)
    for i in range(1, BANDS):
        found = found.when(left[i] == right[i], i)
    return found


def row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes whose full sets pass the threshold."""
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    held = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return held.mapInArrow(confirmer(width, percent), "a binary, b binary").distinct()


def labelled_rows(docs: DataFrame, width: int = 5, threshold_percent: int = 80) -> DataFrame:
    """Per row: doc_id, row_key (hash of id and text), n_shingles and the label of its component, null without words."""
    limit = sketch_limit(threshold_percent / 100)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    signed = stage(keyed.mapInArrow(signer(width), "doc_id long, row_key long, n_shingles long, class binary, bands array<long>, sketch array<long>"), "signed")
    classes = signed.where("class IS NOT NULL").groupBy("class").agg(F.min_by(F.struct("row_key", "bands", "sketch"), "row_key").alias("one")).select("class", "one.*")
    classes = stage(classes, "classes")

    # Buckets that several classes share, and the most popular class of each.
    filed = classes.select("class", F.posexplode("bands").alias("band", "value")).select("class", "band", F.xxhash64("band", "value").alias("bucket"))
    shared = filed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(filed.join(shared, "bucket"), "members")
    popular = members.groupBy("class").agg(F.sum("n").alias("weight"))
    pivots = members.join(popular, "class").groupBy("bucket").agg(F.max(F.struct("weight", "class")).alias("pivot")).select("bucket", F.col("pivot.class").alias("b"))

    # One confirmed link for each class: with the most similar pivot of its buckets.
    sketches = classes.select(F.col("class").alias("_class"), "sketch")
    pairs = members.select("bucket", F.col("class").alias("a")).join(pivots, "bucket").where("a <> b").select("a", "b").distinct()
    pairs = pairs.join(sketches.select(F.col("_class").alias("a"), F.col("sketch").alias("sketch_a")), "a").join(sketches.select(F.col("_class").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    pairs = pairs.select("a", "b", difference(F.col("sketch_a"), F.col("sketch_b")).alias("differ")).where(F.col("differ") <= limit)
    pairs = pairs.groupBy("a").agg(F.min(F.struct("differ", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    wanted = popular.select("class").join(classes.select("class", "row_key"), "class")
    texts = stage(keyed.select("row_key", "text").join(wanted, "row_key").select("class", "text"), "texts")
    first = stage(confirmed(pairs, texts, width, threshold_percent), "links")
    labels = components(first)

    # The pairs of one bucket that are still in different components.
    known = labels.select(F.col("node").alias("class"), "label")
    placed = members.select("bucket", "band", "class").join(known, "class", "left").withColumn("label", F.coalesce("label", "class"))
    placed = stage(placed, "placed")
    sizes = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy("bucket").agg(F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("main")).where("labels > 1").select("bucket", "main")
    open_members = stage(placed.join(open_, "bucket"), "open")
    precise = texts.join(open_members.select("class").distinct(), "class").mapInArrow(precise_signer(width), "class binary, precise array<long>")
    precise = stage(precise.join(classes.select("class", "bands", "sketch"), "class"), "precise")
    open_members = open_members.join(precise, "class")
    x, y = open_members.where("label <> main").alias("x"), open_members.alias("y")
    close = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.main")) | (F.col("x.class") < F.col("y.class")))
    close &= difference(F.col("x.sketch"), F.col("y.sketch")) <= limit
    close &= first_shared_band(F.col("x.bands"), F.col("y.bands")) == F.col("x.band")
    close &= difference(F.col("x.precise"), F.col("y.precise"), PRECISE_BITS) <= sketch_limit(threshold_percent / 100, PRECISE_SAMPLES, PRECISE_BITS)
    rest = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & close).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
    second = confirmed(rest.distinct(), texts, width, threshold_percent)
    labels = components(first.union(second))

    narrow = signed.select("doc_id", "row_key", "n_shingles", "class")
    known = labels.select(F.col("node").alias("class"), "label")
    return narrow.join(known, "class", "left").select("doc_id", "row_key", "n_shingles", F.coalesce("label", "class").alias("label"))


def near_duplicates(docs: DataFrame, width: int = 5, threshold_percent: int = 80) -> DataFrame:
    """Per document: doc_id, row_key (hash of id and text), n_shingles, component_id, kept."""
    rows = labelled_rows(docs, width, threshold_percent)
    # The smallest document of each component, brought back to every row.
    placed = rows.where("label IS NOT NULL")
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    grouped = placed.join(least, "label").select("doc_id", "row_key", "n_shingles", "component_id")
    alone = rows.where("label IS NULL").select("doc_id", "row_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The input rows, all columns, one for each component: the smallest doc_id (null last), then the smallest hash of id
    and text, of the further columns. Documents without words stay."""
    key, wordless, number, rest, row = (fresh(docs, n) for n in ("_row_key", "_wordless", "_number", "_rest", "_row"))
    rows = labelled_rows(docs, **options)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("one")).select(F.col("one.row_key").alias(key), F.lit(False).alias(wordless))
    kept = first.union(rows.where("label IS NULL").select("row_key", F.lit(True)).distinct())
    further = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
    keyed = docs.withColumn(key, row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    held = keyed.join(kept, key).withColumns({number: F.when(F.col(wordless), F.monotonically_increasing_id()), rest: F.xxhash64(further)})
    # Rows with one id and one text still share a key; those without words stay apart by their number.
    single = held.groupBy(key, number).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), rest).alias(row))
    return single.select(f"{row}.*")
