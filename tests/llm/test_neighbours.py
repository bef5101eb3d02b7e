import math

import numpy as np
from pyspark.sql import functions as F

from skyledger.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>, id string"


def brute(rows, k, step):
    rows = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q, v in rows.items():
        if q % step == 0:
            ranked = sorted((-(v * w).sum(), i) for i, w in rows.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in ranked]
    return out


def by_query(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want]
    return np.mean(hits)


def test_recall_on_the_whole_table(spark):
    for folder in ("sf0.01", "sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").collect()]
        got, want = by_query(queries.op6_neighbours(spark, f"/root/testdata/{folder}")), brute(rows, 20, 20)
        assert recall(got, want) >= 0.95
        vectors = dict(rows)
        for q, found in got.items():
            assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
            for i, score in found:
                exact = (np.array(vectors[q], float) * np.array(vectors[i], float)).sum()
                assert math.isclose(score, exact, rel_tol=1e-12, abs_tol=1e-12)


def test_defined_cases(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    bad = [(100, None), (120, [0.0] * 4), (140, [1.0, None, 0.0, 0.0]), (160, [float("nan")] * 4), (180, [float("inf")] * 4), (200, [1.0, 2.0]), (None, [1.0] * 4), (220, [])]
    frame = spark.createDataFrame([(*r, "x") for r in good + bad + good[:3]], SCHEMA).repartition(3)
    got, want = by_query(neighbours.nearest(frame, F.col("id") % 20 == 0, k=20)), brute(good, 20, 20)
    assert recall(got, want) == 1.0
    few = spark.createDataFrame([(*r, "x") for r in good[:4]], SCHEMA)
    assert {q: len(v) for q, v in by_query(neighbours.nearest(few, F.col("id") % 2 == 0)).items()} == {0: 3, 2: 3}
    assert neighbours.nearest(frame.where("vec_id > 999"), F.col("id") % 20 == 0).collect() == []
    assert neighbours.nearest(frame.where("vec_id = 0"), F.col("id") % 20 == 0).collect() == []


def test_one_vector_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(1500, 16))
    unit /= np.linalg.norm(unit, axis=1)[:, None]  # so that the equal vectors are the nearest of each other
    rows = [(i, unit[0 if i % 3 == 0 else i].tolist()) for i in range(1500)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got, want = by_query(neighbours.nearest(frame, F.col("id") % 100 == 0, block=200)), brute(rows, 20, 100)
    assert recall(got, want) >= 0.95
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]] == [i for i in range(0, 63, 3) if i != 300][:20]


def test_recall_with_unequal_lengths(spark):
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(4000, 64))
    unit *= (np.exp(rng.normal(size=4000)) / np.linalg.norm(unit, axis=1))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(unit)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert recall(by_query(neighbours.nearest(frame, F.col("id") % 40 == 0)), brute(rows, 20, 40)) >= 0.95


def test_one_very_long_vector(spark):
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(3000, 32))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    unit[7] *= 100
    rows = [(i, v.tolist()) for i, v in enumerate(unit)]
    got = by_query(neighbours.nearest(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), F.col("id") % 50 == 0))
    want = brute(rows, 20, 50)
    assert recall(got, want) >= 0.95
    assert all(got[q][0][0] == 7 for q in want if want[q][0][0] == 7)


def test_rows_of_one_id_and_vectors_of_other_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 40, rng.normal(size=4).tolist(), "x") for i in range(80)] + [(i, rng.normal(size=7).tolist(), "x") for i in range(100, 130)]
    found = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, k=100, opened=100.0).collect()
    want = []
    for q, v, _ in rows:
        if q % 20 == 0:
            v = np.array(v, np.float32).astype(float)
            scores = [(-(v * np.array(w, np.float32).astype(float)).sum(), i) for n, (i, w, _) in enumerate(rows) if len(w) == len(v) and (i, w) != (q, list(w) if np.allclose(w, v, atol=1e-6) else None)]
            want += [(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(sorted(scores))]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found) == sorted(want)


def test_pieces_of_files_give_the_same_rows(spark):
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([(i, rng.normal(size=8).tolist(), "x") for i in range(600)], SCHEMA)
    whole = neighbours.nearest(frame, F.col("id") % 3 == 0, k=5, share=1.0)
    dealt = neighbours.nearest(frame, F.col("id") % 3 == 0, k=5, share=1.0, block=10, query_block=7)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, dealt.collect()))
