"""Best-fit packing with swap-based local search (operator 4).

1. One Arrow pass tokenizes whole documents. White space ends a token in this tokenizer, so the different words of a chunk
   (cut and lower-cased where that changes no token) are encoded once and a document's ids are put together from them. A document longer than a sequence is cut into
   pieces; only lengths, places and checksums are kept.
2. Pieces are dealt by hash into shards of about SHARD. A task packs a shard best-fit by falling length and then improves it:
   one underfull bin after the other gives documents to the others by a move, a one-for-one or a two-for-one exchange. Every exchange
   raises the sum of squared fills, and bins become empty.
3. What is left underfull in each shard is dealt again into fewer shards until one remains, so shards cost about one open bin
   in all instead of one each. Once a level leaves more than GO_ON of its pieces (those above half a sequence, say, which
   nothing fits), only the emptiest OPEN_SHARE of each shard's bins are dealt again from then on. A shard holds pieces for
   FEWEST sequences or more, so every level is smaller than the one before by a fixed rate, whatever the lengths are.

Defined cases: null text is the end token alone; rows repeat and are packed each; a text of any length is tokenized whole;
an empty table gives an empty result; further columns of any name do no harm.
"""

from __future__ import annotations

import array
import bisect
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import bytesplit as B
from skyledger.llm.substring_dedup import packed_words
from skyledger.llm.token_counts import KNOWN, encode_groups, load
from skyledger.sources.tables import stage

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END = 1
SHARD = 4096
OPEN_BELOW = 0.97
GO_ON = 0.8
OPEN_SHARE = 0.25
FEWEST = 16
JOINED = 300  # words that are encoded as one text

SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
APOSTROPHE = 0x27


def encodable_parts(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (each with a blank behind it) as parts that the tokenizer treats alike on their own: the bytes without the
    blanks, and where parts begin.

    This tokenizer lower-cases, and no token of it spans an ASCII letter and an ASCII character that is none, but for the
    contractions, which begin with an apostrophe; so words are cut there and ASCII letters lower-cased, unless a character
    that could combine with the letter follows. Far fewer different parts are left to encode. Special tokens would be torn
    apart, so where one might be, words stay as they are."""
    small = data | 32
    letter = (small >= ord("a")) & (small <= ord("z"))
    plain = data < 0x80
    lowered = data.copy()
    change = letter[:-1] & plain[1:]
    lowered[:-1][change] = small[:-1][change]
    solid = data != 0x20
    text = B.lower_ascii(data).tobytes()
    special = any(token in text for token in SPECIAL)
    cut = np.zeros(len(data), bool)
    cut[begins[:-1]] = True
    if not special:
        cut[1:] |= letter[:-1] & plain[1:] & ~letter[1:] & solid[1:]
        cut[1:] |= plain[:-1] & ~letter[:-1] & (data[:-1] != APOSTROPHE) & letter[1:]
    return (data if special else lowered)[solid], np.flatnonzero(cut[solid])


def word_ends(tokenizer) -> np.ndarray | None:
    """Which ids end a word, or None if the vocabulary does not mark that."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab()
    marks = np.zeros(max(vocabulary.values()) + 1, bool)
    marks[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return marks


def one_word(part: bytes) -> bool:
    """Whether the tokenizer sees one word in a part by itself: nothing but letters, also after it has composed and lower-cased
    them (a capital dotted I, say, becomes a letter and a mark)."""
    if part.isascii():
        return part.isalpha()
    text = part.decode("utf-8", "replace")
    return text.isalpha() and len(text.lower()) == len(text) and unicodedata.is_normalized("NFC", text)


def encode_parts(tokenizer, parts: list[bytes], ends: np.ndarray | None) -> Iterator[tuple[bytes, bytes]]:
    """Each part with the bytes of its ids. Letters alone are one word to the tokenizer and each ASCII digit is one, so many
    such parts are encoded as one text and its ids cut behind the last token of each part; where the words do not come out
    even, and for all other parts, each is encoded by itself."""
    words, single = [], []
    for p in parts:
        (words if ends is not None and (p.isdigit() or one_word(p)) else single).append(p)
    groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
    for group, encoded in zip(groups, tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
        ids = np.array(encoded.ids, np.uint32)
        last = np.flatnonzero(ends[ids])
        counts = np.cumsum([len(p) if p.isdigit() else 1 for p in group])
        if len(last) != counts[-1]:
            single += group
            continue
        raw, begin = ids.tobytes(), 0
        for part, end in zip(group, (4 * (last[counts - 1] + 1)).tolist()):
            yield part, raw[begin:end]
            begin = end
    given = iter(single)
    for texts in encode_groups(single):
        for encoded in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield next(given), array.array("I", encoded.ids).tobytes()


def piece_cutter(path: str, capacity: int):
    """The Arrow function: (doc_id, row, text) to one row for each piece of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = load(path), {}
        ends_word = word_ends(tokenizer)
        for batch in batches:
            for rows in B.chunks(batch, "text"):
                data, begins, first = packed_words(rows.column("text"))
                solid, starts_at = encodable_parts(data, begins) if len(data) else (data, begins[:0])
                bounds = np.append(starts_at, len(solid)).astype(np.int64)
                parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts_at), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(solid))]).dictionary_encode()
                distinct, which = parts.dictionary.to_pylist(), parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                ids_of = list(map(known.get, distinct))
                new = [i for i, ids in enumerate(ids_of) if ids is None]
                known.update(encode_parts(tokenizer, [distinct[i] for i in new], ends_word))
                for i in new:
                    ids_of[i] = known[distinct[i]]
                sizes = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
                pool = np.frombuffer(b"".join(ids_of), np.uint32)
                starts = np.append(0, np.cumsum(sizes))[:-1]
                lengths = sizes[which] if len(which) else np.zeros(0, np.int64)
                ends = np.append(0, np.cumsum(lengths))
                stream = pool[np.repeat(starts[which] - ends[:-1], lengths) + np.arange(ends[-1])] if len(which) else pool[:0]
                cuts = ends[np.searchsorted(starts_at, begins[first] - first)]
                out = []
                for i, (doc_id, row) in enumerate(zip(rows.column("doc_id").to_pylist(), rows.column("row").to_pylist())):
                    ids = np.append(stream[cuts[i] : cuts[i + 1]], np.uint32(END)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((doc_id, row, piece, start, len(part), zlib.crc32(part.tobytes())))
                if len(known) > KNOWN:
                    known = dict(zip(distinct, ids_of))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return B.thrifty(cut)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: items by falling length, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g: some bin has a gap of g
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            k = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
            bins[k].append(item)
        else:
            k, gap = len(bins), capacity
            bins.append([item])
        gap -= size
        if gap:
            by_gap[gap].append(k)
            open_gaps |= 1 << gap
    return bins


def exchange(giver: list[int], taker: list[int], gap: int, lengths: list[int]) -> tuple[int, list[int], list[int]]:
    """The exchange that fills `gap` of the taker most: gain, items of the giver, items of the taker for them.

    A move gives one item for none; otherwise one or two items of the giver go for one of the taker."""
    best: tuple[int, list[int], list[int]] = (0, [], [])
    own = sorted((lengths[i], i) for i in taker)
    parts = [(lengths[i], [i]) for i in giver] + [(lengths[a] + lengths[b], [a, b]) for n, a in enumerate(giver) for b in giver[n + 1 :]]
    for size, given in parts:
        if len(given) == 1 and best[0] < size <= gap:
            best = (size, given, [])
        at = bisect.bisect_left(own, (size - gap, -1))  # the smallest item that makes room
        if at < len(own) and best[0] < size - own[at][0] <= gap:
            best = (size - own[at][0], given, [own[at][1]])
    return best


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search: underfull bins, the least filled first, are emptied into the others. A bin that cannot be emptied stays
    as far as it came and the next one is tried, until all were tried since the last success or the lower bound is reached."""
    full = [b for b in bins if sum(lengths[i] for i in b) >= capacity]
    bins = [list(b) for b in bins if sum(lengths[i] for i in b) < capacity]
    fills = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
    items = [i for b in bins for i in b]
    at = {i: n for n, i in enumerate(items)}
    # What can be given back: items, and for moves an empty place of length 0 in each bin.
    places = np.array([lengths[i] for i in items] + [0] * len(bins), np.int64)
    owners = np.append(np.repeat(np.arange(len(bins)), [len(b) for b in bins]), np.arange(len(bins)))
    alive = np.ones(len(bins), bool)

    def takers(giver: int) -> list[int]:
        """The bins an exchange with which raises the sum of squares, those with the largest gaps first."""
        own = np.sort(np.array([lengths[i] for i in bins[giver]], np.int64))
        first, second = np.triu_indices(len(own), 1)
        parts = np.append(0, np.unique(np.append(own, own[first] + own[second])))
        gaps = np.where(alive, capacity - fills, 0)
        gaps[giver] = 0
        largest = parts[np.searchsorted(parts, places + gaps[owners], "right") - 1]  # that fits instead of a place
        found = owners[largest - places > np.maximum(fills[giver] - fills[owners], 0)]
        found = np.unique(found)
        return found[np.argsort(fills[found], kind="stable")].tolist()

    def empty(giver: int) -> bool:
        moved = True
        while moved and bins[giver]:
            moved = False
            for k in takers(giver):
                gain, given, back = exchange(bins[giver], bins[k], capacity - int(fills[k]), lengths)
                if gain > max(fills[giver] - fills[k], 0):
                    bins[k] = [i for i in bins[k] if i not in back] + given
                    bins[giver] = [i for i in bins[giver] if i not in given] + back
                    owners[[at[i] for i in given]] = k
                    owners[[at[i] for i in back]] = giver
                    fills[k] += gain
                    fills[giver] -= gain
                    moved = True
                    if not bins[giver]:
                        break
        alive[giver] = bool(bins[giver])
        return not bins[giver]

    tried: set[int] = set()
    # Below a capacity of gaps in all, the others cannot take any bin whatever is exchanged.
    while (capacity - fills[alive]).sum() >= capacity:
        left = [k for k in np.flatnonzero(alive & (fills < capacity)).tolist() if k not in tried]
        if not left:
            break
        giver = min(left, key=lambda k: (fills[k], k))
        tried.add(giver)
        if empty(giver):
            tried.clear()
    return full + [bins[k] for k in np.flatnonzero(alive)]


def shard_packer(capacity: int, level: int, share: float):
    """The grouped function: the pieces of one shard with the bin and the place each gets."""

    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["row", "piece"], ignore_index=True)
        lengths = pieces["length"].tolist()
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        place, offset, fill = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for k, items in enumerate(bins):
            used = 0
            for i in items:
                place[i], offset[i] = k, used
                used += lengths[i]
            fill[items] = used
        emptiest = sorted(range(len(bins)), key=lambda k: (sum(lengths[i] for i in bins[k]), k))
        may_open = np.isin(place, emptiest[: max(1, int(share * len(bins)))])
        pieces["sequence_id"] = level * (1 << 56) + pieces["shard"].astype("int64") * (1 << 24) + place
        pieces["offset"] = offset
        pieces["is_open"] = may_open & ((fill < OPEN_BELOW * capacity) | (place == emptiest[0]))
        return pieces

    return pack


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Per piece: doc_id, row (number of the input row), piece, start, length, ids_crc32, sequence_id, offset."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    piece = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
    left = stage(rows.mapInArrow(piece_cutter(tokenizer, capacity), piece), "pieces")
    columns, done, level, before, share = left.columns, [], 0, None, 1.0
    while True:
        pieces, tokens = left.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        if before and pieces > GO_ON * before:
            share = OPEN_SHARE
        before = pieces
        shards = max(1, min(-(-pieces // shard), tokens // (FEWEST * capacity)))
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row", "piece", F.lit(level)), F.lit(shards)).cast("int"))
        packed = dealt.groupBy("shard").applyInPandas(shard_packer(capacity, level, share), piece + ", shard int, sequence_id long, offset long, is_open boolean")
        packed = stage(packed, "packed")
        if shards == 1:
            done.append(packed)
            break
        done.append(packed.where("NOT is_open"))
        left, level = packed.where("is_open").select(columns), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select(*columns, "sequence_id", "offset")
