import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string"


def brute(rows, k=8, rounds=10, d=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) with Python's own integers."""
    data = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows]
    middle = [v for _, v in sorted(data, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in data]

    for _ in range(rounds):
        near = [c for _, c in assign()]
        for c in set(near):
            own = [v for (_, v), n in zip(data, near) if n == c]
            middle[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total = lambda c: sum(s for s, n in found if c in (n, None))
    return sorted((-1 if i is None else i, c, s, total(c), total(None), tuple(middle[c])) for (i, _), (s, c) in zip(data, found))


def plain(frame):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in frame.collect())


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(partitions)


def points(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) + 3 * (i % 5)).tolist()) for i in range(n)]


def test_against_a_direct_version(spark):
    rows = points(300, 64)
    assert plain(centroids.cluster(table(spark, rows))) == brute(rows)


def test_defined_cases(spark):
    good = points(40, 4)
    bad = [(100, None), (101, [1.0] * 3), (102, [1.0] * 5), (103, [None, 1.0, 1.0, 1.0]), (104, [float("nan")] * 4), (105, [float("-inf")] * 4), (106, []), (107, [1e300] * 4)]
    run = lambda rows, **more: plain(centroids.cluster(table(spark, rows), components=4, **more))
    assert run(good + bad) == brute(good, d=4)
    ties = [(i, [float(i % 2)] * 4) for i in range(30)] + [(None, [0.5] * 4), (None, [0.5] * 4)] + good[:2] * 3
    assert run(ties) == brute(ties, d=4)
    assert run(good[:3]) == brute(good[:3], d=4)
    assert run(bad) == []
    hot = [(i, [0.25, -7.5, 3.0, 1.0]) for i in range(200)] + good
    assert run(hot) == brute(hot, d=4)


def test_large_values_stay_exact(spark):
    rows = [(i, [float(2**30 + 3 * i), -float(2**30 - i * i), 0.1 * i, 2.0**20]) for i in range(60)]
    want = brute(rows, k=3, rounds=4)
    fits = lambda v: v if v < 2**63 else None
    assert plain(centroids.cluster(table(spark, rows), k=3, rounds=4, components=4)) == [(i, c, *map(fits, (s, a, b)), m) for i, c, s, a, b, m in want]


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_threshold_walk_finds_the_nearest(data):
    d, k, n = (data.draw(st.integers(1, m)) for m in (4, 9, 12))
    small = st.integers(-6, 6)
    grid = lambda rows: np.array(data.draw(st.lists(st.lists(small, min_size=d, max_size=d), min_size=rows, max_size=rows)), np.int64)
    x, middle = grid(n), grid(k)
    number, best = centroids.nearest_centroids(x, middle)
    full = ((x[:, None] - middle[None]) ** 2).sum(axis=2)
    assert number.tolist() == full.argmin(axis=1).tolist() and best.tolist() == full.min(axis=1).tolist()


def test_the_walk_stops_early():
    """Far centroids are left out: only the lists' near ends are read."""
    asked = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, int):
                asked.append(key)
            return super().__getitem__(key)

    middle = (np.arange(100)[:, None] * np.array([[1000, 1000]])).astype(np.int64)
    x = np.array([[5010, 5020], [90_001, 89_999]])
    number, best = centroids.nearest_centroids(x, middle.view(Watched))
    assert number.tolist() == [5, 90] and best.tolist() == [500, 2] and len(asked) < 10
