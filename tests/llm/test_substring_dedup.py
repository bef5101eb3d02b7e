import hashlib
import random
import re

import numpy as np
import pytest

from skyledger.llm import queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=13):
    split = [WORD.findall(r[1] or "") for r in rows]
    rank = [float("inf") if r[0] is None else r[0] for r in rows]
    first = {}
    for words, k in zip(split, rank):
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            first[w] = min(k, first.get(w, k))
    out = []
    for (i, *_), words, k in zip(rows, split, rank):
        gone = {j for s in range(len(words) - width + 1) if first[tuple(words[s : s + width])] < k for j in range(s, s + width)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()), key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()]
    want = brute(rows)
    assert any(w[2] for w in want)
    assert got(queries.op1_substring_dedup(spark, f"/root/testdata/{folder}")) == want


def planted(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 5 == 0 else f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            at, lo = rng.randrange(len(words) + 1), rng.randrange(10)
            words[at:at] = passage[lo : lo + rng.randrange(5, 30)]
        rows.append((rng.randrange(100) if i > 5 else i, rng.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(500, "a " * 40), (501, "a " * 13), (502, "a " * 12), (None, " ".join(passage)), (None, " ".join(passage)), (503, None), (504, ""), (505, " \n")]
    return rows + [rows[3], rows[4]]


@pytest.mark.parametrize("heavy", [4, 10**9])
def test_planted_passages_light_and_heavy(docs_of, monkeypatch, heavy):
    monkeypatch.setattr(substring_dedup, "HEAVY", heavy)  # the larger share makes every repeated minimiser heavy
    rows = planted(3)
    assert got(substring_dedup.substring_dedup(docs_of(rows))) == brute(rows)


def test_small_chunks_agree(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup.B, "CHUNK", 300)
    rows = planted(5)
    assert got(substring_dedup.substring_dedup(docs_of(rows))) == brute(rows)


def test_equal_hashes_fall_back_to_the_words(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup.B, "window_hashes", lambda h, width: np.zeros(max(len(h) - width + 1, 0), np.uint64))
    rows = planted(8)[:60]
    assert got(substring_dedup.substring_dedup(docs_of(rows))) == brute(rows)


def test_kept_text_and_empty_table(docs_of):
    rows = [(1, " ".join(f"w{i}" for i in range(20))), (2, "x " + " ".join(f"w{i}" for i in range(20)) + " y"), (3, None)]
    texts = {r.doc_id: r.kept_text for r in substring_dedup.substring_dedup(docs_of(rows), with_text=True).collect()}
    assert texts == {1: rows[0][1], 2: "x y", 3: ""}
    assert substring_dedup.substring_dedup(docs_of(rows).where("doc_id > 9")).collect() == []
