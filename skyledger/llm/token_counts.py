"""Token counts (operator 2): batch encoding in Arrow functions that return lengths only.

The bytes of a batch are cut at safe boundaries: before a single ASCII white-space byte that stands between two
characters surely not white space. The byte-level pre-tokenizer ends a token there and starts the next one there whatever
stands around, and no special token holds white space, so the count of a text is the sum over its pieces. Equal pieces of
a batch are encoded once, in batches of about equal bytes; texts are whole however long they are.

Defined cases: null or empty text has 0 bytes and 0 tokens; rows repeat as they are; an empty table gives an empty
result; only doc_id and text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import bytesplit as B

TOKENIZER = "byte_bpe_50k.json"
ENCODE_BYTES = 256 << 10
#: Pieces whose counts a task remembers.
KNOWN = 400_000


def safe_neighbours() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes may stand before and after a cut: printable ASCII, and two-byte characters from U+00C0 on, which
    hold no white space. A two-byte character ends in a continuation byte, so the byte before the cut is judged
    together with the one before it."""
    after = np.zeros(256, bool)
    after[0x21:0x7F] = True
    lead = np.zeros(256, bool)
    lead[0xC3:0xE0] = True
    return after | lead, lead


AFTER, LEAD = safe_neighbours()


def piece_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all rows begin: at each row and at each safe boundary."""
    if len(data) < 3:
        return np.unique(offsets[:-1])[: len(data)]
    cut = np.zeros(len(data), bool)
    cut[1:-1] = B.IS_WHITE[data[1:-1]] & AFTER[data[2:]] & ((data[:-2] > 0x20) & (data[:-2] < 0x7F))
    cut[2:-1] |= B.IS_WHITE[data[2:-1]] & AFTER[data[3:]] & LEAD[data[:-3]]
    cut[offsets[offsets < len(data)]] = True
    return np.flatnonzero(cut)


def distinct_pieces(data: np.ndarray, begins: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The different pieces and which of them each piece is."""
    ends = np.append(begins, len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def encode_groups(texts: list[bytes], size: int = ENCODE_BYTES) -> Iterator[list[str]]:
    """Batches for the tokenizer of about `size` bytes each."""
    group, held = [], 0
    for text in texts:
        group.append(text.decode("utf-8", "replace"))
        held += len(text)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def load(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    return Tokenizer.from_file(path)


def counter(path: str):
    """The Arrow function: (doc_id, text) to (doc_id, n_bytes, n_tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = load(path), {}
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                data, offsets = B.text_bytes(rows.column("text"))
                begins = piece_bounds(data, offsets)
                pieces, which = distinct_pieces(data, begins) if len(data) else (pa.array([], pa.large_binary()), np.zeros(0, np.int64))
                pieces = pieces.to_pylist()
                new = [p for p in pieces if p not in known]
                fresh = iter(new)
                for group in encode_groups(new):
                    for encoded in tokenizer.encode_batch_fast(group, add_special_tokens=False):
                        known[next(fresh)] = len(encoded)
                lengths = np.fromiter((known[p] for p in pieces), np.int64, len(pieces))
                sums = np.append(0, np.cumsum(lengths[which]))
                at = np.searchsorted(begins, offsets)
                if len(known) > KNOWN:
                    known = dict(zip(pieces, lengths.tolist()))
                yield pa.record_batch({"doc_id": rows.column("doc_id"), "n_bytes": np.diff(offsets), "n_tokens": sums[at[1:]] - sums[at[:-1]]})

    return B.thrifty(count)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens and whether n_tokens is above `limit`. `tokenizer` is the file's path,
    which must be the same on every executor."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(counter(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
