import zlib

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import language_id as L
from skyledger.llm import queries


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_accuracy_on_held_out_documents(spark, folder):
    rows = {r.doc_id: r for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()}
    found = queries.op9_language_id(spark, f"/root/testdata/{folder}").collect()
    assert len(found) == len(rows) and all(r.held_out == is_held_out(r.doc_id) for r in found)
    held = [r for r in found if r.held_out and rows[r.doc_id].lang]
    assert np.mean([r.lang_pred == rows[r.doc_id].lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def text_of(i, lang):
    words = {"xa": ["bla", "blu", "bli"], "yo": ["kro", "kru", "kri"]}[lang]
    return " ".join(words[(i * 7 + j * j) % 3] + words[j % 2] for j in range(20))


def test_defined_cases(docs_of):
    rows = [(i, text_of(i, "xa" if i % 2 else "yo"), "xa" if i % 2 else "yo") for i in range(80)]
    rows += [(100, None, "xa"), (101, "", "xa"), (102, "12 34 !!", "yo"), (103, "KRO KRU", None), (104, "bla " * 40_000, None), (None, "kri kro", "yo"), (1, text_of(1, "xa"), "yo"), (105, "汉字", None)]
    found = L.identify(docs_of(rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102))
    assert by[103].lang_pred == "yo" and by[104].lang_pred == "xa" and by[None].lang_pred == "yo" and by[105].lang_pred in ("xa", "yo")
    kept = L.with_language_only(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs_of(rows).collect() if r.doc_id not in (100, 101, 102))
    assert L.identify(docs_of(rows).where("doc_id > 999")).collect() == []


def test_without_labels_everything_is_unknown(docs_of):
    assert {r.lang_pred for r in L.identify(docs_of([(1, "some words"), (2, "more")])).collect()} == {"und"}


def test_labels_of_held_out_documents_are_not_used(docs_of):
    rows = [(i, text_of(i, "xa" if i % 2 else "yo"), "zz" if is_held_out(i) else ("xa" if i % 2 else "yo")) for i in range(200)]
    assert {r.lang_pred for r in L.identify(docs_of(rows)).collect()} == {"xa", "yo"}


def test_presence_against_brute_force():
    texts = ["Ab c", None, "", "ab" * 30, "né 1a"]
    rows = L.presence(pa.array(texts))
    for text, row in zip(texts, rows):
        data = bytes(L.FOLD[list((text or "").encode())])
        want = set()
        for n in range(1, 5):
            for i in range(len(data) - n + 1):
                value = (int.from_bytes(data[i : i + n], "big") + (n << 32)) * L.B.BASE & (2**64 - 1)
                want.add(value >> 50)
        assert set(np.flatnonzero(row)) == want


def test_without_labels_the_stage_keeps_every_text(docs_of):
    kept = L.with_language_only(docs_of([(1, "some words"), (2, "more"), (3, "12 !"), (4, None)])).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2]
