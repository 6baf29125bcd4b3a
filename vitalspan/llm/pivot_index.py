"""Exact search for the largest inner products with a pivot-distance index.

A vector x becomes the integers floor(1024 x). One more coordinate, sqrt(M^2 - |x|^2) with M the
largest length, turns the largest inner product into the nearest neighbour: for a query q, lengthened
by zero, |q - x|^2 = |q|^2 + M^2 - 2 q.x. The index keys every vector by its nearest pivot and its
distance from it, sorted, in blocks of bounded size (annuli). A block whose distances lie in [a, b]
can't hold anything nearer to q than max(d - b, a - d), d being q's distance from the pivot; a query
takes blocks in the order of these bounds and stops where they exceed its k-th best distance. Scores
are exact integer products; distances only decide what can be left out, with a margin for rounding.

Vectors that are null or hold null or infinite components or NaN take no part, nor do rows without
an id. Shorter vectors count as filled up with zeros. Ids tell rows apart: rows that repeat an id
are all candidates of other ids' queries but not of their own id's; each different vector of an id
is a query of its own, which equal rows share. Ties go to smaller ids. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import batch, importable, written

#: Vectors of the sample that serve as pivots.
PIVOTS = 64

#: Vectors in a block, and in the blocks that one task searches.
BLOCK, GROUP = 512, 16_384

#: Queries searched together.
QUERIES = 512

#: Bounds must exceed the k-th best distance by this share before a block is left out.
MARGIN = 1e-9


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integers(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``x``, the integer components."""
    parts = F.transform(F.col(vector), lambda x: F.floor(1024 * x.cast("double")))
    return df.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), parts.alias("x")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integer lists as a matrix, filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values[offsets[0] : offsets[-1]].reshape(len(column), width).copy()
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        out[i, : b - a] = values[a:b]
    return out


@dataclass
class Space:
    """Pivots and the length that the additional coordinate fills up to."""

    pivots: np.ndarray
    width: int
    longest: float
    exact: bool  # products fit the integers that floating point holds exactly

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.exact:
            return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
        return a @ b.T

    def extra(self, x: np.ndarray) -> np.ndarray:
        squares = np.square(x.astype(float)).sum(axis=1)
        return np.sqrt(np.maximum(self.longest**2 - squares, 0))

    def distances(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """From each pivot, with the additional coordinate ``extra`` of each row."""
        p, x = self.pivots.astype(float), x.astype(float)
        squares = np.square(x).sum(1)[:, None] + np.square(p).sum(1)[None, :] - 2 * x @ p.T
        between = extra[:, None] - self.extra(self.pivots)[None, :]
        return np.sqrt(np.maximum(squares + np.square(between), 0))


def space(vectors: DataFrame) -> tuple[Space | None, int]:
    """Pivots are a sample of fixed size, by a hash; the rest is one row of maxima."""
    size = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    most = vectors.agg(
        F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max(size).alias("square")
    ).first()
    if not most["n"]:
        return None, 0
    width = max(most["width"], 1)
    sample = vectors.orderBy(F.xxhash64("x"), "vec_id").limit(4 * PIVOTS).select("x").collect()
    rows = np.zeros((len(sample), width), np.int64)
    for i, row in enumerate(sample):
        rows[i, : len(row["x"])] = row["x"]
    rows = np.unique(rows, axis=0)
    rows = rows[np.random.default_rng(0).permutation(len(rows))[:PIVOTS]]
    square = float(most["square"])
    return Space(rows, width, np.sqrt(square) + 1, square < 2**52), most["n"]


INDEX = "part long, pivot int, least double, most double, ids array<long>, x array<long>"


def _assigned(where: Space) -> Callable:
    schema = pa.schema(
        [("vec_id", pa.int64()), ("x", pa.list_(pa.int64())), ("pivot", pa.int32()),
         ("distance", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not len(rows):
                continue
            x = matrix(rows.column(1), where.width)
            far = where.distances(x, where.extra(x))
            nearest = far.argmin(axis=1)
            yield batch(
                schema,
                [rows.column(0), rows.column(1), nearest.astype(np.int32),
                 far[np.arange(len(x)), nearest]],
            )

    return run


def _blocks(where: Space, parts: int) -> Callable:
    def made(ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(6)]
        part = TaskContext.get().partitionId() % parts
        cuts = np.flatnonzero(np.diff(pivot)) + 1
        bounds = [0, *cuts.tolist(), len(pivot)]
        for a, b in zip(bounds, bounds[1:]):
            for i in range(a, b, BLOCK):
                j = min(i + BLOCK, b)
                row = (part, int(pivot[i]), far[i:j].min(), far[i:j].max(), ids[i:j], x[i:j].ravel())
                for column, value in zip(out, row):
                    column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
             pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64()),
             pa.array(out[4], pa.list_(pa.int64())), pa.array(out[5], pa.list_(pa.int64()))],
            names=["part", "pivot", "least", "most", "ids", "x"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if len(rows):
                yield made(
                    rows.column(0).to_numpy(),
                    matrix(rows.column(1), where.width),
                    rows.column(2).to_numpy(),
                    rows.column(3).to_numpy(),
                )

    return run


def index(vectors: DataFrame, where: Space, parts: int) -> DataFrame:
    """Blocks of vectors, dealt by pivot and distance: a hot pivot is spread over many parts."""
    keyed = vectors.mapInArrow(
        _assigned(where), "vec_id long, x array<long>, pivot int, distance double"
    )
    return (
        keyed.repartitionByRange(parts, "pivot", "distance", "vec_id")
        .sortWithinPartitions("pivot", "distance", "vec_id")
        .mapInArrow(_blocks(where, parts), INDEX)
    )


def best(
    scores: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest of each row, ties to smaller ids."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


_NONE = -np.iinfo(np.int64).max  # its negative is a number too
_LAST = np.iinfo(np.int64).max


def searched(
    where: Space, blocks: list[tuple], query_ids: np.ndarray, q: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Best scores and ids of each query in the blocks, expanding them by their bounds."""
    scores = np.full((len(q), k), _NONE)
    ids = np.full((len(q), k), _LAST)
    far = where.distances(q, np.zeros(len(q)))
    pivot = np.array([b[0] for b in blocks])
    least, most = np.array([b[1] for b in blocks]), np.array([b[2] for b in blocks])
    bounds = np.maximum(far[:, pivot] - most, np.maximum(least - far[:, pivot], 0))
    squares = np.square(q.astype(float)).sum(axis=1) + where.longest**2
    for b in np.argsort(bounds.min(axis=0), kind="stable"):
        kth = scores[:, -1]
        reach = np.sqrt(np.maximum(squares - 2.0 * kth, 0))
        open_ = (kth == _NONE) | (bounds[:, b] <= reach * (1 + MARGIN) + MARGIN)
        rows = np.flatnonzero(open_)
        if not len(rows):
            continue
        found = where.products(q[rows], blocks[b][4])
        there = np.broadcast_to(blocks[b][3], found.shape)
        own = there == query_ids[rows, None]
        found = np.where(own, _NONE, found)
        there = np.where(own, _LAST, there)
        if found.shape[1] > 4 * k:
            # all that reach the k-th highest stay, so that ties are settled by id
            level = np.partition(found, -k, axis=1)[:, -k]
            level = np.maximum(level, scores[rows, -1])
            wanted = (found >= level[:, None]).any(axis=0)
            found, there = found[:, wanted], there[:, wanted]
        scores[rows], ids[rows] = best(
            np.concatenate((scores[rows], found), axis=1),
            np.concatenate((ids[rows], there), axis=1),
            k,
        )
    return scores, ids


def _search(where: Space, k: int) -> Callable:
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[tuple] = []
        part = None
        waiting: list[tuple[int, int, np.ndarray]] = []

        def answers() -> pa.RecordBatch:
            keys = np.array([w[0] for w in waiting], np.int64)
            rows = np.array([w[1] for w in waiting], np.int64)
            scores, ids = searched(where, blocks, keys, np.stack([w[2] for w in waiting]), k)
            waiting.clear()
            there = (scores != _NONE) & (ids != _LAST)
            many = there.sum(axis=1)
            return batch(
                schema, [np.repeat(keys, many), np.repeat(rows, many), ids[there], scores[there]]
            )

        for rows in batches:
            parts, kinds = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for i, (p, query) in enumerate(zip(parts, kinds)):
                if p != part:
                    if waiting and blocks:
                        yield answers()
                    part, blocks, waiting = p, [], []
                values = np.asarray(rows.column(6)[i].values)
                if query is None:
                    blocks.append(
                        (rows.column(2)[i].as_py(), rows.column(3)[i].as_py(),
                         rows.column(4)[i].as_py(), np.asarray(rows.column(5)[i].values),
                         values.reshape(-1, where.width))
                    )
                    continue
                filled = np.zeros(where.width, np.int64)
                filled[: len(values)] = values
                waiting.append((rows.column(5)[i][0].as_py(), query, filled))
                if len(waiting) == QUERIES and blocks:
                    yield answers()
        if waiting and blocks:
            yield answers()

    return run


def top_k(
    df: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` best of all rows for each row whose id is divisible by ``every``.

    Each part of the index is searched by all queries, its blocks in memory and the queries
    streaming past; the parts' best are merged by rank.
    """
    spark = df.sparkSession
    importable(spark)
    out = "query_id long, rank int, vec_id long, score long"
    vectors = integers(df, key, vector)
    where, n = space(vectors)
    if where is None:
        return spark.createDataFrame([], out)
    parts = -(-n // GROUP)
    blocks = written(index(vectors, where, parts), "pivot-index").select(
        "part", F.lit(None).cast("long").alias("query"), "pivot", "least", "most", "ids", "x"
    )
    queries = vectors.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "x"]).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
        F.xxhash64("vec_id", "x").alias("query"),
        F.lit(-1).alias("pivot"), F.lit(0.0).alias("least"), F.lit(0.0).alias("most"),
        F.array("vec_id").alias("ids"), "x",
    )
    merged = (
        blocks.unionByName(queries)
        .repartition(parts, "part")
        .sortWithinPartitions("part", F.col("query").asc_nulls_first())
    )
    found = merged.mapInArrow(_search(where, k), "query_id long, query long, vec_id long, score long")
    lists = found.groupBy("query_id", "query").agg(
        F.slice(
            F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))),
            1, k,
        ).alias("best")
    )
    return lists.select("query_id", F.posexplode("best").alias("i", "b")).select(
        "query_id", (F.col("i") + 1).alias("rank"), "b.vec_id", "b.score"
    )
