"""Centroid clustering with the threshold algorithm (operator 12).

Vectors are turned into integers, so distances, sums and centroids are exact and do not depend on the order of rows. To find a
vector's nearest centroid, the centroids are sorted along each dimension once. From the place of the vector's own value, each
list is walked outward: every step takes the closest centroid not yet met in each dimension, computes the full distance
of those seen for the first time, and adds up the squared distances of all dimensions' frontiers. A centroid that no list has met
is at least that far away, so a vector is done once the sum strictly exceeds its best distance (strictly, so that ties are
met as well), or once every centroid has been seen. A batch of vectors takes its steps together, those done drop out.

Each round is one pass: tasks return the sums and counts of their centroids, dimension by dimension, Spark adds them up, and
CENTROIDS x dimensions exact sums reach the driver, which divides. The vectors are staged once as integers; assignments of the
last pass are staged too, so inertias need no further pass over vectors.

Defined cases: null vectors, vectors of another number of components, with null or non-finite ones, or with one whose integer
does not fit 62 bits take no part; a null vec_id takes part and hashes as the empty text; repeated rows are vectors of their
own; ties go to the smaller centroid number; fewer vectors than centroids give fewer centroids; an empty centroid stays where
it is; a distance or inertia beyond 64 bits is null (sums are exact all the same); an empty table gives an empty
result; there are no texts; further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.sources.tables import stage

CENTROIDS, ROUNDS, SEED = 8, 10, 3
COMPONENTS, SCALE = 64, 1024

#: With all values below this, squared distances over up to 256 dimensions stay within 64 bits.
SMALL = 2**26
LONGEST = 2**63 - 1
#: Values of vectors handled together, which bounds a batch's memory.
CELLS = 1 << 20


def whole_numbers(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the rows that take part, with floor(scale * x) for every component x."""
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where(F.size("vector") == components)
    fits = F.forall("vector", lambda x: F.coalesce(F.abs(scale * x) < 2.0**62, F.lit(False)) & ~F.isnan(x))
    return plain.where(fits).select("vec_id", F.transform("vector", lambda x: F.floor(scale * x)).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids hash lowest, in order of the hash."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name, 256).alias("h"), "vector").orderBy("h", "vector").limit(k).collect()
    return [r["vector"] for r in rows]


def matrix(rows: list[list[int]]) -> np.ndarray:
    """Integers as 64-bit numbers where squared distances fit, as Python's own otherwise."""
    values = np.array(rows, object)
    return values.astype(np.int64) if not values.size or abs(values).max() < SMALL else values


def nearest_centroids(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid."""
    n, d = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T.copy()  # dimension by place: a centroid's number
    lists = np.take_along_axis(centroids, order.T, axis=0).T.copy()  # and its value
    big = np.abs(lists[:, -1] - lists[:, 0]).max() + np.abs(x).max() + 1 + np.abs(lists).max()
    padded = np.hstack([lists, lists[:, -1:]])  # read, never used, behind the ends
    dims = np.arange(d)
    best, number = np.full(n, -1, x.dtype), np.full(n, -1, np.int64)
    seen = np.zeros((n, k), bool)
    open_ = np.arange(n)
    right = np.stack([np.searchsorted(lists[i], x[:, i]) for i in range(d)], axis=1)  # the next place on either side
    left = right - 1
    for _ in range(k):
        at = x[open_]
        down = np.where(left >= 0, at - padded[dims, np.maximum(left, 0)], big)
        up = np.where(right < k, padded[dims, np.minimum(right, k)] - at, big)
        lower = down <= up
        met = order[dims, np.where(lower, left, np.minimum(right, k - 1))]
        frontier = np.where(lower, down, up)
        left, right = left - lower, right + ~lower
        new = np.zeros((len(open_), k), bool)
        np.put_along_axis(new, met, True, axis=1)
        new &= ~seen[open_]
        seen[open_] |= new
        for c in range(k):
            asked = open_[new[:, c]]
            if not len(asked):
                continue
            gap = x[asked] - centroids[c]
            distance = (gap * gap).sum(axis=1)
            closer = (number[asked] < 0) | (distance < best[asked]) | ((distance == best[asked]) & (c < number[asked]))
            best[asked[closer]], number[asked[closer]] = distance[closer], c
        bound = (frontier * frontier).sum(axis=1)
        go_on = ~((bound > best[open_]) | seen[open_].all(axis=1))
        open_, left, right = open_[go_on], left[go_on], right[go_on]
        if not len(open_):
            break
    return number, best


def batches(found: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, centroid numbers and distances, a bounded number of values at a time."""
    k, d = centroids.shape
    rows = max(1, CELLS // max(d, k))
    for batch in found:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            x = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            small = centroids.dtype != object and max(abs(int(x.min())), abs(int(x.max()))) < SMALL
            x, own = (x, centroids) if small else (x.astype(object), centroids.astype(object))
            yield part.column("vec_id"), x, *nearest_centroids(x, own)


def partial_sums(centroids: np.ndarray) -> Callable:
    """What one task adds to the centroids: cluster, dim, n, and the total in a high part of units of 2^40 and a low part."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.shape
        totals, counts = np.zeros((k, d), object), np.zeros(k, np.int64)
        for _, x, number, _ in batches(found, centroids):
            for c in np.unique(number):
                mine = x[number == c]
                counts[c] += len(mine)
                totals[c] += mine.sum(axis=0).astype(object)
        rows = [(c, i, int(counts[c]), int(totals[c, i]) >> 40, int(totals[c, i]) & (2**40 - 1)) for c in range(k) if counts[c] for i in range(d)]
        names = ["cluster", "dim", "n", "high", "low"]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[]] * 5, [pa.int32(), pa.int32()] + [pa.int64()] * 3)], names)

    return run


def assignments(centroids: np.ndarray) -> Callable:
    """Each vector's centroid and distance."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, number, distance in batches(found, centroids):
            exact = pa.array([int(v) if v <= LONGEST else None for v in distance], pa.int64()) if distance.dtype == object else pa.array(distance)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), exact], ["vec_id", "cluster", "distance"])

    return run


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    found = vectors.mapInArrow(partial_sums(matrix(centroids)), "cluster int, dim int, n long, high long, low long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    out = [list(c) for c in centroids]
    for r in found.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), exact("high"), exact("low")).collect():  # k x dimensions rows
        out[r["cluster"]][r["dim"]] = (int(r["high"]) * 2**40 + int(r["low"])) // r["n"]
    return out


def fitted(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """The centroids after all rounds; none for an empty table."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        after = moved(vectors, centroids)
        if after == centroids:  # the remaining rounds would change nothing
            break
        centroids = after
    return centroids


def per_cluster(values: list, kind: str) -> Column:
    """The value of the row's cluster, out of one for each."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid (its final components)."""
    data = stage(whole_numbers(vectors, components, scale), "vectors")
    centroids = fitted(data, k, rounds, seed)
    kind = data.schema["vec_id"].dataType.simpleString()
    if not centroids:
        return data.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.col("vector").alias("centroid"))
    found = stage(data.mapInArrow(assignments(matrix(centroids)), f"vec_id {kind}, cluster int, distance long"), "assignments")
    total = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("total")
    sums = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(total).collect()}  # k rows
    fits = lambda v: None if v is None or v > LONGEST else int(v)
    inertia = None if None in sums.values() else fits(sum(sums.values()))
    return found.select("vec_id", "cluster", "distance", per_cluster([fits(sums.get(c)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
                        F.lit(inertia).cast("long").alias("inertia"), per_cluster(centroids, "array<long>").alias("centroid"))
