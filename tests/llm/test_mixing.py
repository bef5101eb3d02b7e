import math

import pytest

from skyledger.llm import mixing, queries


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, ceiling=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if per * weight[s] > ceiling * sizes[s]}
        if not over:
            target |= {s: per * weight[s] for s in open_}
            break
        target |= {s: float(ceiling * sizes[s]) for s in over}
        left -= sum(ceiling * sizes[s] for s in over)
        open_ -= over
    return target


def check(rows, result):
    size = lambda t: len([w for w in (t or "").replace("\n", " ").split(" ") if w])
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    want = brute_targets(sizes)
    source_of = {r[0]: r[3] for r in rows}
    taken = {}
    for r in result:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], abs_tol=1e-6)
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
    return taken, want


def test_table_near_targets(spark, documents):
    result = queries.op10_mixing(spark, "/root/testdata/sf0.001").collect()
    assert len(result) == len(documents)
    taken, want = check(documents, result)
    longest = {}
    for r in documents:
        longest[r[3]] = max(longest.get(r[3], 0), len(r[1].split()))
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in want)
    again = queries.op10_mixing(spark, "/root/testdata/sf0.001").collect()
    assert sorted(result) == sorted(again)


def test_defined_cases(docs_of):
    rows = [(1, "a b c", "en", "x"), (2, None, "en", "x"), (3, "", "en", None), (4, "w " * 50, "en", None), (5, "q", None, "ß"),
            (6, "q r", None, "Z"), (7, None, None, "empty")]
    result = mixing.mixed_sizes(docs_of(rows)).collect()
    assert len(result) == len(rows)
    check(rows, result)
    assert mixing.mixed_sizes(docs_of(rows).where("doc_id > 99")).collect() == []
    assert all(r.taken == 0 for r in mixing.mixed_sizes(docs_of(rows).where("doc_id in (2, 7)")).collect())


def test_mix_repeats_rows(docs_of):
    rows = [(i, f"w{i} " * (1 + i % 7), "en", f"s{i % 4}") for i in range(300)]
    docs = docs_of(rows)
    want = {r.doc_id: r.copies for r in mixing.mixed_sizes(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7])
def test_ranks(spark, n):
    names = [None, "b", "a", "ß", "Z", "é", "aa"][:n]
    got = {r.source: r.place for r in mixing.ranked_sources(spark.createDataFrame([(s, 1) for s in names], "source string, source_size long")).collect()}
    assert got == {s: i for i, s in enumerate(sorted(names, key=lambda s: (s is None, (s or "").encode())))}


def test_sql(spark, sql):
    got = queries.op10_mixing(spark, "/root/testdata/sf0.001").toPandas()
    want = sql(queries.ORACLES["op10_mixing"], "/root/testdata/sf0.001")[list(got.columns)]
    key = lambda f: sorted(map(tuple, f.astype({"target": float}).values.tolist()))
    assert key(got) == key(want)
