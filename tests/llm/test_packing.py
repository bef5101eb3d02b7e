import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing, queries
from skyledger.llm.token_counts import load

PATH = public_tokenizers.path(packing.TOKENIZER)


def expected_pieces(texts, capacity=4096):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check(rows, texts, capacity=4096):
    """Pieces are right, sequences gapless and not too long; returns how many there are above the lower bound."""
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected_pieces(texts, capacity), key=key)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins) - -(-sum(r.length for r in rows) // capacity)


def test_whole_table(spark, documents):
    over = check(queries.op4_packing(spark, "/root/testdata/sf0.001").collect(), [d[:2] for d in documents])
    assert over <= 1


NASTY = ["It's", "WE'LL", "a'b", "''s", "x1y2", "J\u030c", "I\u0307", "É", "E\u0301", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>B", "A.B-c_d", "1\u0301", "\x1cA\x1f", "K\u212aK", "ſS", "ß.É", "don't.Stop'Twas", "汉A字", "\u200bA"]


def test_parts_of_words_encode_like_whole_texts(spark, docs_of, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(NASTY) + rng.choice(["", *NASTY]) for _ in range(rng.randrange(30)))) for i in range(200)]
    for size in (packing.B.CHUNK, 300):
        monkeypatch.setattr(packing.B, "CHUNK", size)
        check(packing.pack(docs_of(rows), PATH).collect(), rows)


def test_several_shards_stay_close_to_the_bound(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text) for r in table.collect()]
    assert check(packing.pack(table, PATH).collect(), texts) <= 1
    assert check(packing.pack(table, PATH, shard=100).collect(), texts) <= 2


def test_defined_cases(docs_of):
    texts = [None, "", " ", "Hello World", "é é <|endoftext|> x<|startoftext|>y", "it's 12 34ab's", "word " * 10_000, "x" * 9000, "Σ ΑΣ", "a　b c", "汉字🙂"]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, texts[3]), (3, texts[3])]
    assert check(packing.pack(docs_of(rows), PATH).collect(), rows) <= 1
    assert check(packing.pack(docs_of(rows), PATH, capacity=7, shard=50).collect(), rows, 7) >= 0
    assert packing.pack(docs_of(rows).where("doc_id > 99"), PATH).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_local_search_empties_bins(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(200, 700) for _ in range(300)]
    before = packing.best_fit(lengths, 1000)
    after = packing.improve([list(b) for b in before], lengths, 1000)
    assert sorted(i for b in after for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 1000 for b in after) and len(after) <= len(before)
    squares = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    assert squares(after) >= squares(before)


def test_two_for_one_and_moves():
    lengths = [60, 30, 15, 10]
    assert packing.exchange([3], [0], 40, lengths) == (10, [3], [])
    assert packing.exchange([1, 2], [3], 35, lengths)[0] == 35  # 30 and 15 for 10
    assert packing.exchange([0], [1], 5, lengths) == (0, [], [])


def test_bins_behind_a_stuck_one_are_emptied_too():
    rng = random.Random(1)
    for low, high, most in ((700, 1500, 0.98), (900, 1900, 0.97)):
        lengths = [rng.randrange(low, high) for _ in range(1024)]
        before = packing.best_fit(lengths, 4096)
        after = packing.improve([list(b) for b in before], lengths, 4096)
        assert sorted(i for b in after for i in b) == list(range(1024))
        assert all(sum(lengths[i] for i in b) <= 4096 for b in after) and len(after) <= most * len(before)


def test_words_encoded_together_equal_words_encoded_alone():
    rng, tokenizer = random.Random(3), load(PATH)
    make = lambda: "".join(rng.choice(rng.choice(["abcdefghij", "0123456789", "qxzkvw"])) for _ in range(rng.randrange(1, 12)))
    words = sorted({make().encode() for _ in range(3000)} | {b"7", b"a", b"endoftext", "é".encode(), b"'s", b"a" * 5000, b"1" * 3000, b"!!"})
    ends = packing.word_ends(tokenizer)
    want = {w: np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32).tobytes() for w in words}
    assert dict(packing.encode_parts(tokenizer, words, ends)) == want == dict(packing.encode_parts(tokenizer, words, None))
    assert dict(packing.encode_parts(tokenizer, words, np.zeros_like(ends))) == want  # words that do not come out even
    assert dict(packing.encode_parts(tokenizer, [], ends)) == {}


@pytest.mark.parametrize("low, high", [(2100, 3900), (1500, 3900), (10, 11)])
def test_levels_shrink_whatever_the_lengths_are(spark, docs_of, monkeypatch, low, high):
    rng, sizes = random.Random(low), []
    rows = [(i, "a " * (rng.randrange(low, high) // 10)) for i in range(3000)]
    stage = packing.stage

    def noted(frame, name):
        staged = stage(frame, name)
        if name == "packed":
            sizes.append(staged.count())
        return staged

    monkeypatch.setattr(packing, "stage", noted)
    above = check(packing.pack(docs_of(rows), PATH, capacity=409, shard=250).collect(), rows, 409)
    assert len(sizes) <= 5 and sum(sizes[2:]) <= 0.8 * sizes[0]
    lengths = [len(t) // 2 + 1 for _, t in rows]
    in_one_task = packing.improve(packing.best_fit(lengths, 409), lengths, 409)
    assert above + -(-sum(lengths) // 409) <= len(in_one_task) * 1.01 + 1


def test_letters_of_any_script_are_encoded_together():
    """Words with a letter beyond ASCII used to be a text for the tokenizer each."""
    tokenizer, texts = load(PATH), 0

    class Counted:
        model = tokenizer.model

        def encode_batch_fast(self, batch, **options):
            nonlocal texts
            texts += len(batch)
            return tokenizer.encode_batch_fast(batch, **options)

    every = [chr(c) for c in range(0xAA, 0x30000) if chr(c).isalpha()]
    words = sorted({w.encode() for a, b in zip(every, every[7:]) for w in (a, a + b)} | {"beröä".encode(), "café".encode(), b"plain", b"389"})
    for group, most in ((words, len(words)), ([w for w in words if w.decode() < "ɀ"], 20)):
        texts = 0
        found = dict(packing.encode_parts(Counted(), group, packing.word_ends(tokenizer)))
        assert found == {w: np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32).tobytes() for w in group}
        assert texts <= most
