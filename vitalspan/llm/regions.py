"""Candidate pairs of rows that share a region of a sorted order, and the links among them.

A region is a run of rows with equal ``tree`` and ``hi``. In a region of up to ``SMALL`` rows all are
candidates of each other. In larger ones the depth adapts: the neighbours that share the longest
prefix of ``lo`` are taken first, from the nodes of each depth. What a large region, or one cut by a
partition's end, has left over is compared in a second sweep, between components that the first has
not connected, so no candidate is lost. Orders are range partitioned, so a hot region is spread over
tasks. Candidates are pruned by ``n``, whose smaller must reach a share of the larger, and by the
agreement of 128 bits in ``b0`` and ``b1``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import batch, importable, written
from vitalspan.llm.components import components

#: Rows of a region that are all compared.
SMALL = 16

#: In larger regions: neighbours taken by each row, and first rows of each node that they are
#: taken from. ``lo`` holds four values of 16 bits, so there are five depths.
NEAREST, HEADS, DEPTHS = 3, 16, 5


def agreement(bits: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many of the 128 bits agree."""
    return 128 - np.bitwise_count(bits ^ others).sum(axis=-1, dtype=np.int64)


@dataclass(frozen=True)
class Bounds:
    """What candidates must have: a share of sizes, and agreeing bits."""

    percent: int
    agreeing: int

    def met(self, n, m, agree) -> np.ndarray:
        sizes = 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        return sizes & (agree >= self.agreeing)


class Region:
    """Rows that share a tree and the first values, in sorted order."""

    def __init__(
        self, lo: np.ndarray, k: np.ndarray, n: np.ndarray, bits: np.ndarray, bounds: Bounds
    ):
        self.lo, self.k, self.n, self.bits, self.bounds = lo, k, n, bits, bounds

    def near(self, i: int | np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``others`` that may be linked with row ``i``, and their agreement."""
        agree = agreement(self.bits[i], self.bits[others])
        fits = self.bounds.met(self.n[i], self.n[others], agree)
        return others[fits], agree[fits]

    def all_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.triu_indices(len(self.k), 1)
        agree = agreement(self.bits[i], self.bits[j])
        fits = self.bounds.met(self.n[i], self.n[j], agree)
        return self.k[i[fits]], self.k[j[fits]]

    def nearest_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Each row with its nearest among the first rows of the nodes it lies in, deepest first."""
        heads: list[list[int]] = [[] for _ in range(DEPTHS)]
        same = self.lo[1:] ^ self.lo[:-1]
        a, b = [], []
        for i in range(len(self.k)):
            if i:
                # of the second four values, those that this row shares with the one before
                differing = int(same[i - 1]) % (1 << 64)
                shared = (64 - differing.bit_length()) // 16
                for depth in range(shared + 1, len(heads)):
                    heads[depth] = []
                others = np.unique(np.array([i - 1, *(h for d in heads for h in d)]))
                found, agree = self.near(i, others)
                best = found[np.argsort(-agree, kind="stable")[:NEAREST]]
                a += [self.k[i]] * len(best)
                b += self.k[best].tolist()
            for node in heads:
                if len(node) < HEADS:
                    node.append(i)
        return np.array(a, np.int64), np.array(b, np.int64)


SCANNED = (
    "left_over boolean, a long, b long, tree int, hi long, k long, n long, b0 long, b1 long"
)


def _scan(limits: Bounds) -> Callable:
    schema = pa.schema(
        [("left_over", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()),
         ("hi", pa.int64()), ("k", pa.int64()), ("n", pa.int64()), ("b0", pa.int64()),
         ("b1", pa.int64())]
    )

    def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), f.type) for f in list(schema)[3:]]
        return batch(schema, [np.zeros(len(a), bool), np.minimum(a, b), np.maximum(a, b), *none])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        opening = True  # the first region may have begun in another partition

        def regions(rows: list[np.ndarray], closing: bool) -> Iterator[pa.RecordBatch]:
            nonlocal opening
            tree, hi, lo, k, n, b0, b1 = rows
            bits = np.stack((b0, b1), axis=1).view(np.uint64)
            cut = np.flatnonzero((hi[1:] != hi[:-1]) | (tree[1:] != tree[:-1])) + 1
            starts = np.concatenate(([0], cut))
            sizes = np.diff(np.append(starts, len(hi)))
            edge = np.zeros(len(starts), bool)
            edge[0], edge[-1] = opening, closing
            opening = False
            left = np.repeat(edge | (sizes > SMALL), sizes)
            two = starts[sizes == 2]
            fits = limits.met(n[two], n[two + 1], agreement(bits[two], bits[two + 1]))
            found = [(k[two[fits]], k[two[fits] + 1])]
            for s, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                part = slice(s, s + size)
                region = Region(lo[part], k[part], n[part], bits[part], limits)
                found.append(region.all_pairs() if size <= SMALL else region.nearest_pairs())
            yield pairs(*(np.concatenate(x) for x in zip(*found)))
            if left.any():
                none = pa.nulls(int(left.sum()), pa.int64())
                yield batch(
                    schema, [np.ones(len(none), bool), none, none, tree[left], hi[left], k[left],
                             n[left], b0[left], b1[left]]
                )

        for rows in batches:
            if not len(rows):
                continue
            new = [c.to_numpy() for c in rows.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            last = np.flatnonzero((held[1] != held[1][-1]) | (held[0] != held[0][-1]))
            if len(last) and len(held[0]) > 1 << 16:
                whole = int(last[-1]) + 1
                yield from regions([x[:whole] for x in held], False)
                held = [x[whole:] for x in held]
        if held is not None:
            yield from regions(held, True)

    return run


def _across(limits: Bounds) -> Callable:
    """Pairs of rows of one region that lie in different components."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region: tuple | None = None
        rows: list[np.ndarray] = []

        def compared() -> Iterator[pa.RecordBatch]:
            root, k, n, b0, b1 = (np.concatenate(x) for x in zip(*rows))
            whole = Region(root, k, n, np.stack((b0, b1), axis=1).view(np.uint64), limits)
            for i in range(1, len(k)):
                others, _ = whole.near(i, np.flatnonzero(root[:i] != root[i]))
                if len(others):
                    same = np.full(len(others), k[i])
                    yield batch(schema, [np.minimum(same, k[others]), np.maximum(same, k[others])])

        for part in batches:
            if not len(part):
                continue
            new = [c.to_numpy() for c in part.columns]
            cut = np.flatnonzero((np.diff(new[1]) != 0) | (np.diff(new[0]) != 0)) + 1
            bounds = [0, *cut.tolist(), len(part)]
            for s, e in zip(bounds, bounds[1:]):
                own = (new[0][s], new[1][s])
                if own != region:
                    if rows:
                        yield from compared()
                    region, rows = own, []
                rows.append(np.stack([x[s:e] for x in new[2:]]))
        if rows:
            yield from compared()

    return run


def links(
    rows: DataFrame,
    limits: Bounds,
    confirmed: Callable[[DataFrame], DataFrame],
    compared: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Confirmed links ``a``, ``b`` among rows of ``tree, hi, lo, k, n, b0, b1``.

    They connect whatever candidates connect: pairs inside a component may be missing.
    ``confirmed`` has pairs of candidates and returns the true ones. For the second sweep
    ``compared`` may return the links of the rows left over (``tree, hi, root, k, n, b0, b1``)
    itself, where many candidates that are no links would make too many pairs.
    """
    importable(rows.sparkSession)
    order = ["tree", "hi", "lo", "k"]
    rows = rows.select(*order, "n", "b0", "b1")
    scanned = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = written(scanned.mapInArrow(_scan(limits), SCANNED), "regions")
    first = written(scanned.filter("NOT left_over").select("a", "b").distinct(), "candidates")
    found = written(confirmed(first), "links")

    # second sweep: large or cut regions that hold more than one component
    roots = components(found)
    rest = scanned.filter("left_over").select("tree", "hi", "k", "n", "b0", "b1")
    rest = rest.join(roots, rest["k"] == roots["node"], "left").select(
        "tree", "hi", F.coalesce("root", "k").alias("root"), "k", "n", "b0", "b1"
    )
    rest = written(rest, "left-over")
    several = (
        rest.groupBy("tree", "hi")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select(F.col("tree").alias("t"), F.col("hi").alias("h"))
    )
    same = (F.col("tree") == F.col("t")) & (F.col("hi") == F.col("h"))
    open_ = rest.join(several, same, "left_semi")
    if compared is not None:
        open_ = written(open_, "left-over")
        return found if open_.isEmpty() else found.unionByName(compared(open_))
    across = (
        open_.repartition("tree", "hi")
        .sortWithinPartitions("tree", "hi", "root", "k")
        .mapInArrow(_across(limits), "a long, b long")
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    second = written(across, "candidates")
    if second.isEmpty():
        return found
    return found.unionByName(confirmed(second))
