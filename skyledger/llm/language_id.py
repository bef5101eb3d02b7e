"""Language identification with string kernels (operator 9).

A text is the set of n-grams of 1 to 4 bytes it contains (blended spectrum, presence only), hashed to DIMENSIONS; ASCII
letters are lower-cased and other ASCII characters count as a blank. The kernel of two texts is the size of the common set
over the root of the product of their sizes. Up to LANDMARKS training texts span a Nyström approximation of it, and a
one-versus-rest ridge regression is fitted on the approximation.

The model is fitted on a bounded sample: SAMPLE labelled documents, the same number for each of the at most LANGUAGES most
frequent languages, picked by a hash of their id. Everything scored is whole. A kernel row is the presence row times the landmark
matrix over two norms, and the regression follows, so both matrices are multiplied beforehand; scoring a batch is one
matrix product of presence rows and DIMENSIONS x languages weights.

Defined cases: null text and text without a letter are `und` with score 0; with no labelled document everything is; equal
scores take the first language by code point; a null doc_id is the empty text for the fold; an empty table gives an
empty result; further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import bytesplit as B
from skyledger.llm.columns import fresh, id_text

DIMENSIONS = 1 << 14
GRAMS = 4
LANDMARKS = 256
SAMPLE = 2000
LANGUAGES = 200
RIDGE = 1.0
BATCH_ROWS = 256
UNKNOWN = "und"


def fold_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 0x20
    for upper, lower in zip(range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1)):
        table[upper] = table[lower] = lower
    return table


FOLD = fold_table()


def presence(column: pa.Array) -> np.ndarray:
    """One row of 0 and 1 per text: which hashed n-grams of bytes it holds."""
    data, offsets = B.text_bytes(column)
    out = np.zeros((len(offsets) - 1, DIMENSIONS), np.uint8)
    if not len(data):
        return out
    data = FOLD[data].astype(np.uint32)
    lengths = np.diff(offsets)
    base = np.repeat(np.arange(len(lengths), dtype=np.int64) * DIMENSIONS, lengths)
    left = np.repeat(offsets[1:], lengths) - np.arange(len(data))
    gram = np.zeros(len(data), np.uint32)
    for n in range(1, GRAMS + 1):
        m = len(data) - n + 1
        if m <= 0:
            break
        gram = (gram[:m] << np.uint32(8)) | data[n - 1 :]
        hashed = ((gram.astype(np.uint64) + (np.uint64(n) << np.uint64(32))) * np.uint64(B.BASE)) >> np.uint64(50)
        whole = left[:m] >= n
        out.reshape(-1)[base[:m][whole] + hashed[whole].astype(np.int64)] = 1
    return out


def featurizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The Arrow function: (lang, place, text) to (lang, place, bits)."""
    for batch in batches:
        for chunk in B.chunks(batch, "text"):
            for first in range(0, len(chunk), BATCH_ROWS):
                rows = chunk.slice(first, BATCH_ROWS)
                bits = np.packbits(presence(rows.column("text")), axis=1)
                yield pa.record_batch({"lang": rows.column("lang"), "place": rows.column("place"), "bits": pa.array([b.tobytes() for b in bits], pa.binary())})


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.crc32(id_text(doc_id)) % 4 == 2


def training_sample(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, and packed presence rows with the number of each row's language; bounded whatever the table's size."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & has_letter(F.col("text")))
    usable = usable.select("lang", F.col("text").cast("string").alias("text"), F.xxhash64("doc_id").alias("place"))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    names = sorted(r["lang"] for r in counts)
    if not names:
        return [], np.zeros((0, DIMENSIONS // 8), np.uint8), np.zeros(0, np.int64)
    each = max(1, SAMPLE // len(names))
    # A hash below a share that leaves a little more than `each` per language; what is too much goes below.
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.3 * each / r["count"])))])
    picked = usable.where(F.col("place").bitwiseAND(F.lit((1 << 40) - 1)) < F.try_element_at(share, F.col("lang")) * float(1 << 40))
    sample = picked.mapInArrow(B.thrifty(featurizer), "lang string, place long, bits binary")
    kept = sample.orderBy("place", "lang", "bits").limit(2 * each * len(names)).collect()
    number, seen, bits, labels = {n: i for i, n in enumerate(names)}, [0] * len(names), [], []
    for r in kept:
        k = number[r["lang"]]
        if seen[k] < each:
            seen[k] += 1
            bits.append(np.frombuffer(r["bits"], np.uint8))
            labels.append(k)
    rows = np.stack(bits) if bits else np.zeros((0, DIMENSIONS // 8), np.uint8)
    return names, rows, np.array(labels, np.int64)


def dimension_blocks(rows: np.ndarray, width: int = 1024) -> Iterator[tuple[slice, np.ndarray]]:
    """The presence rows a block of dimensions at a time, so that they never lie unpacked in memory as a whole."""
    for first in range(0, DIMENSIONS, width):
        yield slice(first, first + width), np.unpackbits(rows[:, first // 8 : (first + width) // 8], axis=1).astype(np.float32)


def fit(rows: np.ndarray, labels: np.ndarray, languages: int) -> np.ndarray:
    """DIMENSIONS x languages weights from packed presence rows; the score of a text is its presence row times these over the
    root of its size."""
    every = [np.flatnonzero(labels == k) for k in range(languages)]
    share = max(1, LANDMARKS // max(languages, 1))
    chosen = np.concatenate([e[:share] for e in every])
    common, sizes = np.zeros((len(rows), len(chosen)), np.float32), np.zeros(len(rows), np.float32)  # whole numbers
    for _, block in dimension_blocks(rows):
        common += block @ block[chosen].T
        sizes += block.sum(1)
    norms = np.sqrt(np.maximum(sizes, 1).astype(np.float64))
    kernel = common / norms[:, None] / norms[chosen]
    values, vectors = np.linalg.eigh(kernel[chosen])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # landmarks to Nyström features
    features = kernel @ root
    features = np.hstack([features, np.ones((len(features), 1))])
    targets = np.where(labels[:, None] == np.arange(languages), 1.0, -1.0)
    counts = np.maximum(np.bincount(labels, minlength=languages), 1)
    weight = (1 / counts[labels])[:, None] * len(labels) / languages  # every language counts alike
    inner = features.T @ (features * weight) + RIDGE * np.eye(features.shape[1])
    solved = np.linalg.solve(inner, features.T @ (targets * weight))
    shares = (root @ solved[:-1]) / norms[chosen][:, None]  # what a landmark's dimensions add to each language
    weights = np.empty((DIMENSIONS + 1, languages), np.float32)
    for at, block in dimension_blocks(rows[chosen]):
        weights[at] = block.T.astype(np.float64) @ shares
    weights[-1] = solved[-1]  # the bias
    return weights


def scorer(names: list[str], weights):
    """The Arrow function: (doc_id, held_out, is_text, text) to (doc_id, held_out, lang_pred, score)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = weights.value
        for batch in batches:
            for chunk in B.chunks(batch, "text"):
                for first in range(0, len(chunk), BATCH_ROWS):
                    rows = chunk.slice(first, BATCH_ROWS)
                    known = rows.column("is_text").to_numpy(zero_copy_only=False) & (len(names) > 0)
                    best, value = np.zeros(len(rows), np.int64), np.zeros(len(rows))
                    if known.any():
                        present = presence(rows.column("text")).astype(np.float32)
                        values = present @ matrix[:-1] / np.sqrt(np.maximum(present.sum(1), 1))[:, None] + matrix[-1]
                        best = values.argmax(1)
                        value = np.clip((values.max(1).astype(np.float64) + 1) / 2, 0, 1)
                    lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                    yield pa.record_batch({"doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"),
                                           "lang_pred": pa.array(lang, pa.string()), "score": np.where(known, value, 0.0)})

    return B.thrifty(score)


def learned(docs: DataFrame):
    """The languages and the broadcast weights: (DIMENSIONS + 1) x LANGUAGES numbers at most."""
    names, rows, labels = training_sample(docs)
    weights = fit(rows, labels, len(names)) if len(rows) else np.zeros((DIMENSIONS + 1, 1), np.float32)
    return names if len(rows) else [], docs.sparkSession.sparkContext.broadcast(weights)


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    text = F.col("text").cast("string")
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), has_letter(text).alias("is_text"), text.alias("text"))
    return asked.mapInArrow(scorer(*learned(docs)), "doc_id long, held_out boolean, lang_pred string, score double")


def tagger(names: list[str], weights, flag: str):
    """The Arrow function over whole rows: the flag column tells whether a language was found, so no join brings it back.
    Where no language was learned, having a letter decides alone."""
    score = scorer(names or [""], weights)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = pa.nulls(len(batch), pa.int64())
            asked = pa.record_batch({"doc_id": none, "held_out": none, "is_text": batch.column(flag), "text": batch.column("text")})
            found = [lang != UNKNOWN for out in score(iter([asked])) for lang in out.column("lang_pred").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index(flag), flag, pa.array(found, pa.bool_()))

    return B.thrifty(tag)


def with_language_only(docs: DataFrame) -> DataFrame:
    """The input rows, all columns, without those whose language is unknown."""
    flag = fresh(docs, "_has_language")
    flagged = docs.withColumn(flag, has_letter(F.col("text").cast("string")))
    tagged = flagged.mapInArrow(tagger(*learned(docs), flag), flagged.schema)
    return tagged.where(F.col(flag)).drop(flag)
