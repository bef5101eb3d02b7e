import random
import re

import pytest

from skyledger.llm import near_dedup, queries
from skyledger.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width=4, percent=80):
    """(doc_id, n_shingles, component_id, kept) of every row from all pairs of different sets."""
    sets = [frozenset(shingles(r[1], width)) for r in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    where = {s: i for i, s in enumerate(distinct)}
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(distinct):
        near = {}
        for x in s:
            for j in holders.get(x, ()):
                near[j] = near.get(j, 0) + 1
            holders.setdefault(x, []).append(i)
        for j, n in near.items():
            if 100 * n >= percent * (len(s) + len(distinct[j]) - n):
                parent[root(j)] = root(i)
    least = {}
    for r, s in zip(rows, sets):
        if s and r[0] is not None:
            k = root(where[s])
            least[k] = min(r[0], least.get(k, r[0]))
    out = []
    for r, s in zip(rows, sets):
        c = least.get(root(where[s])) if s else r[0]
        out.append((r[0], len(s), c, r[0] == c))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()), key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()]
    assert got(queries.op5_near_dedup(spark, f"/root/testdata/{folder}")) == brute(rows)


def variants(rng, base, n, rate):
    return [" ".join(w if rng.random() > rate else f"{w}{rng.randrange(9)}" for w in base) for _ in range(n)]


def test_chains_groups_and_cases(docs_of):
    rng = random.Random(7)
    texts = []
    for g in range(6):  # similarities on both sides of the threshold, and chains whose ends are not linked
        base = [f"g{g}w{i}" for i in range(120)]
        texts += variants(rng, base, 40, 0.02 + 0.01 * g)
        for _ in range(10):
            base = base[:]
            base[rng.randrange(120)] = f"x{rng.random()}"
            texts.append(" ".join(base))
    texts += texts[:20] + [texts[0].upper()] + ["a b", "A  b", "a b c d", "b a", "a", "", None, " \n", "é É", "a b c", "w " * 30_000]
    rows = list(enumerate(texts)) + [(3, "other text of the same id here"), (3, texts[3]), (None, texts[5]), (None, "nobody else says this"), (None, None)]
    rng.shuffle(rows)
    assert got(near_dedup.near_duplicates(docs_of(rows), width=4)) == brute(rows)


def test_filtering_keeps_columns(docs_of):
    base = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base[:-1])), (4, "something else entirely"), (5, None), (6, "")]
    out = near_dedup.without_near_duplicates(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 4, 5, 6]
    assert near_dedup.near_duplicates(docs_of(rows).where("doc_id > 9")).collect() == []


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 500: 500, 501: 500}


def test_sketch_limit_grows_with_distance():
    assert 0 < near_dedup.sketch_limit(0.9) < near_dedup.sketch_limit(0.8) < near_dedup.SKETCH_BITS // 2


def test_stage_leaves_one_row_for_each_component(docs_of):
    words = lambda n, k=40: " ".join(f"w{n}x{i}" for i in range(k))
    rows = [(1, words(1)), (1, words(1)), (2, words(1)), (3, words(2)), (3, words(2) + " more"), (None, words(3)), (None, words(3)), (None, words(3) + " more"),
            (None, words(4)), (5, words(4)), (6, words(5)), (None, words(6)), (7, ""), (7, ""), (None, None), (None, None)]
    docs = docs_of(rows)
    kept = near_dedup.without_near_duplicates(docs, width=5, threshold_percent=80)
    assert kept.schema.names == docs.schema.names
    out = [(r.doc_id, r.text) for r in kept.collect()]
    worded = [(i, t.replace(" more", "")) for i, t in out if t]
    assert sorted(worded, key=str) == sorted([(1, words(1)), (3, words(2)), (None, words(3)), (5, words(4)), (6, words(5)), (None, words(6))], key=str)
    assert sorted((i for i, t in out if not t), key=str) == [7, 7, None, None]
