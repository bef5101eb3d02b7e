import re
from collections import Counter

import pytest

from skyledger.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def counts(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_base_counts_of_the_table(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()}
    found = queries.op7_quality(spark, f"/root/testdata/{folder}").collect()
    assert len(found) == len(texts)
    for r in found:
        assert counts(r) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_labelled_junk_goes_and_good_documents_stay(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = [r for r in queries.op7_quality(spark, "/root/testdata/sf0.01").collect() if r.doc_id in labels]
    assert not [r for r in found if labels[r.doc_id] == 1 and not r.base_failed and not r.kept]
    assert not [r for r in found if labels[r.doc_id] == 0 and r.kept]


def test_defined_cases(docs_of):
    texts = [None, "", " \n\t", "a", "a b c", "a b c d", "a b c a b c", "x x x x x x", "a\nb\na\n\n a\n", "#$%&*|<>", "a\x0bb\x0cc\rd",
             "é ß 汉 🙂 " * 20, "w1 w2 w3 " * 40, " ".join(f"w{i}" for i in range(25_000)), "a b c x a b c y b c x a"]
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s") for i, t in enumerate(texts)] + [(4, texts[4]), (None, "a b")]
    found = quality.quality(docs_of(rows)).collect()
    assert len(found) == len(rows)
    want = {r[0]: brute(r[1]) for r in rows}
    assert all(counts(r) == want[r.doc_id] for r in found)
    assert quality.quality(docs_of(rows).where("doc_id > 99")).collect() == []


def test_groups_have_their_own_fences(docs_of):
    plain = lambda i, w: " ".join(w * 3 + str((i * 7 + j) % 97) for j in range(60))
    rows = [(i, plain(i, "ab"), "en", "short") for i in range(60)] + [(100 + i, plain(i, "abcdefgh"), "en", "long") for i in range(60)]
    rows += [(999, plain(1, "abcdefgh"), "en", "short"), (998, plain(1, "ab"), "en", "long")]
    kept = {r.doc_id: r.kept for r in quality.quality(docs_of(rows), least=20).collect()}
    assert not kept.pop(999) and not kept.pop(998) and all(kept.values())


def test_repeated_lines_go_where_no_other_document_has_any(docs_of):
    line = lambda i, j: " ".join(f"w{i}x{j}y{n}" for n in range(20))
    clean = lambda i: "\n".join(line(i, j) for j in range(6))
    rows = [(i, clean(i), "en", "clean") for i in range(150)] + [(999, "\n".join([*[line(999, j) for j in range(4)], line(999, 0), line(999, 1)]), "en", "clean")]
    rows += [(200 + i, clean(200 + i) + ("\n" + line(200 + i, 0)) * (i % 4 == 0), "en", "mixed") for i in range(150)]
    kept = {r.doc_id: r.kept for r in quality.quality(docs_of(rows), least=20).collect()}
    assert not kept.pop(999) and all(kept.values())
