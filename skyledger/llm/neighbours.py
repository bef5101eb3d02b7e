"""Approximate nearest neighbours with a permutation index (operator 6).

Pivots are vectors picked by a hash of the id, PIVOT_RATE times the root of the table's rows; the index is fitted on nothing
else. Every vector is represented by the order of its PREFIX nearest pivots by direction.

Inverted files: a vector is posted in the files of its POSTS nearest pivots. As long vectors have large inner products with
everything, files are kept apart by length in steps of the square root of 2, and a step with few vectors uses only the first
pivots, so that its files are no smaller than those of others. A query opens the files of its nearest pivots in each step,
OPENED times the root of their number, so the share of a table that is looked at falls while it grows. In a file the query sums the
footrule distance of the two orders (a missing pivot stands at place PREFIX), takes the SHARE that is closest and ranks those
by the inner product in double precision. The best of each file meet in a window with a rank limit, pruned before the shuffle.

Vectors travel POSTS times and queries once for each opened file. A file of more than BLOCK vectors or QUERY_BLOCK queries is
dealt by hash into pieces, each a group of its own, so no task depends on how many rows one pivot attracts. Of exactly equal
vectors only the smallest k + 1 ids can be among the k nearest, so the others are not posted: a vector that a third of all
rows share costs nothing.

Defined cases: null vectors, zero vectors, vectors with null or non-finite components and null ids take no part; vectors of
each number of components are searched among themselves; equal rows count once, rows with one id and different vectors are
queries and candidates of their own; ties go to the smaller id; fewer candidates than k give fewer rows; an empty table gives
an empty result; further columns of any name do no harm. On the test vectors, which have no structure at all, recall needs a
large share of the files; vectors with clusters need far smaller OPENED.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.tables import stage

PIVOT_RATE, PREFIX = 1.0, 48
POSTS, OPENED = 2, 6.0
SHARE = 0.3
BLOCK, QUERY_BLOCK = 4096, 8192
TOGETHER = 64  # queries that one array operation handles
ROW = "id long, h long, vector array<double>, d int, band int"


def usable(vectors: DataFrame) -> DataFrame:
    """The different rows that take part: id, h (hash of the vector), vector, d (its components), band (its step of length)."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = plain.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)).distinct()
    largest = F.array_max(F.transform("vector", F.abs))  # taken out of the sum, which neither overflows nor vanishes then
    square = F.aggregate(F.transform("vector", lambda x: x / largest), F.lit(0.0), lambda a, x: a + x * x)
    band = F.round(2 * F.log2(largest) + F.log2(square)).cast("int")
    return stage(plain.select("id", F.xxhash64("vector").alias("h"), "vector", F.size("vector").alias("d"), band.alias("band")), "vectors")


def pivot_number(rows: int, rate: float) -> int:
    return max(1, math.ceil(rate * math.sqrt(rows)))


class Index:
    """What every task needs: unit pivots by number of components, and how many of them each step of length uses."""

    def __init__(self, data: DataFrame, rate: float, prefix: int):
        self.used: dict[int, dict[int, int]] = {}
        sizes: dict[int, int] = {}
        for d, band, rows in data.groupBy("d", "band").count().collect():
            self.used.setdefault(d, {})[band] = pivot_number(rows, rate)
            sizes[d] = sizes.get(d, 0) + rows
        wanted = {d: pivot_number(rows, rate) for d, rows in sizes.items()}
        self.pivots: dict[int, np.ndarray] = {}
        self.prefix = prefix
        if not wanted:
            return
        numbers = data.sparkSession.createDataFrame(list(wanted.items()), "d int, wanted int")
        place = F.row_number().over(Window.partitionBy("d").orderBy(F.xxhash64("id"), "id", "h"))
        picked = data.where("copy = 1").withColumn("place", place).where(F.col("place") <= max(wanted.values()))
        rows = picked.join(numbers, "d").where("place <= wanted").select("d", "place", "vector").collect()  # the root of all rows
        for d in wanted:
            x = np.array([r["vector"] for r in sorted((r for r in rows if r["d"] == d), key=lambda r: r["place"])], np.float64)
            x /= np.abs(x).max(1, keepdims=True)
            self.pivots[d] = x / np.linalg.norm(x, axis=1, keepdims=True)


def first(similar: np.ndarray, n: int) -> np.ndarray:
    """The columns with the n largest values of each row, largest first."""
    n = min(n, similar.shape[1])
    part = np.sort(np.argpartition(-similar, n - 1, axis=1)[:, :n], axis=1)
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(similar, part, 1), axis=1, kind="stable"), 1)


def poster(index, files: float, at_most_root: bool):
    """The mapping of rows to (row, order, files): the files of its own step, or with `at_most_root` those a query opens."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = index.value
        for batch in batches:
            for d, rows in batch.groupby("d"):
                x = np.stack(rows["vector"].to_list())
                similar = (x / np.abs(x).max(1, keepdims=True)) @ own.pivots[d].T
                out = rows.assign(order=list(first(similar, own.prefix).astype(np.int32)))
                for band, used in own.used[d].items():
                    here = np.ones(len(rows), bool) if at_most_root else (rows["band"] == band).to_numpy()
                    if here.any():
                        n = math.ceil(files * math.sqrt(used)) if at_most_root else int(files)
                        yield out[here].assign(band=band, files=list(first(similar[here, :used], n).astype(np.int32)))

    return post


def searcher(index, share: float, k: int):
    """The cogrouped function: a piece of a file and the queries that open it to each query's best in it."""

    def search(cell: tuple, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        kinds = {"query_id": "int64", "query_h": "int64", "vec_ids": "object", "hs": "object", "scores": "object"}
        if data.empty or asked.empty:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in kinds.items()})
        data = data.sort_values(["id", "h"], ignore_index=True)
        x, ids, hs = np.stack(data["vector"].to_list()), data["id"].to_numpy(), data["h"].to_numpy()
        order = np.stack(data["order"].to_list())
        depth, n = order.shape[1], len(x)
        # For each pivot the weights (PREFIX less the place) of all vectors; twice the sum of the smaller of two weights
        # is what the footrule distance of two orders falls short of its largest value.
        weights = np.zeros((len(index.value.pivots[cell[0]]), n), np.uint8)
        weights[order.T, np.arange(n)] = np.arange(depth, 0, -1, dtype=np.uint8)[:, None]
        mine = np.arange(depth, 0, -1, dtype=np.uint8)[None, :, None]
        wanted = min(n, max(2 * k, math.ceil(share * n)) + 1)
        parts = []
        for start in range(0, len(asked), TOGETHER):
            some = asked.iloc[start : start + TOGETHER]
            q = np.stack(some["vector"].to_list())
            shared = weights[np.stack(some["order"].to_list())]
            close = np.minimum(shared, mine, out=shared).sum(1, dtype=np.uint16)
            near = np.sort(np.argpartition(close, n - wanted, axis=1)[:, n - wanted :], axis=1)  # in order of id
            score = (x[near] * q[:, None, :]).sum(2)
            own = (ids[near] == some["id"].to_numpy()[:, None]) & (hs[near] == some["h"].to_numpy()[:, None])
            score[own] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            near, score = np.take_along_axis(near, best, 1), np.take_along_axis(score, best, 1)
            for query, h, at, s in zip(some["id"], some["h"], near, score):
                there = s > -np.inf
                parts.append((query, h, ids[at[there]], hs[at[there]], s[there]))
        return pd.DataFrame(parts, columns=list(kinds))

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, rate: float = PIVOT_RATE, prefix: int = PREFIX, posts: int = POSTS, opened: float = OPENED, share: float = SHARE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Each query's k nearest: query_id, rank, vec_id, score. `is_query` is a condition on `id`. At most 255 for `prefix`."""
    rows = usable(vectors)
    spark = rows.sparkSession
    copy = F.row_number().over(Window.partitionBy("h", "vector").orderBy("id"))
    data = stage(rows.withColumn("copy", copy).where(F.col("copy") <= k + 1), "candidates")
    index = spark.sparkContext.broadcast(Index(data, rate, prefix))  # of the size of the root of all rows
    shape = ROW + ", order array<int>, files array<int>"
    post = lambda frame, files, root: frame.select("id", "h", "vector", "d", "band").mapInPandas(poster(index, files, root), shape)
    posted = stage(post(data, posts, False), "posted")
    asked = stage(post(rows.where(is_query), opened, True), "asked")
    # A file is known by three columns. How many pieces its vectors and its queries are dealt into:
    file = ["d", "band", "pivot"]
    filed = lambda frame: frame.withColumn("pivot", F.explode("files")).drop("files")
    pieces = lambda size: F.ceil(F.count("*") / size).cast("int")
    holding = filed(posted.select("d", "band", "files")).groupBy(file).agg(pieces(block).alias("n_data"))
    asking = filed(asked.select("d", "band", "files")).groupBy(file).agg(pieces(query_block).alias("n_asked"))
    parts = stage(holding.join(asking, file), "files")
    number = lambda n: F.pmod(F.xxhash64("id", "h"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = filed(posted).join(parts, file).withColumn("p", number("n_data")).withColumn("q", every("n_asked"))
    right = filed(asked).join(parts, file).withColumn("q", number("n_asked")).withColumn("p", every("n_data"))
    cell, needed = [*file, "p", "q"], ["id", "h", "vector", "order"]
    result = "query_id long, query_h long, vec_ids array<long>, hs array<long>, scores array<double>"
    found = left.select(*cell, *needed).groupBy(cell).cogroup(right.select(*cell, *needed).groupBy(cell)).applyInPandas(searcher(index, share, k), result)
    found = found.select("query_id", "query_h", F.explode(F.arrays_zip("vec_ids", "hs", "scores")).alias("f"))
    found = found.select("query_id", "query_h", F.col("f.vec_ids").alias("vec_id"), F.col("f.hs").alias("h"), F.col("f.scores").alias("score"))
    # A vector found in several files has the same score in each, so they share a rank.
    rank = F.dense_rank().over(Window.partitionBy("query_id", "query_h").orderBy(F.desc("score"), "vec_id", "h"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k).dropDuplicates(["query_id", "query_h", "rank"])
    return ranked.select("query_id", "rank", "vec_id", "score")
