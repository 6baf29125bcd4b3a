"""Near-duplicate documents with an LSH forest over MinHash signatures.

Texts with equal shingle sets form a class; one set of each class takes part. Every tree of the
forest sorts the classes by its own sequence of MinHash values. In a sorted order, classes that
share a prefix are adjacent; those that share the first ``LEAST_DEPTH`` values form a region, in
which neighbours with the longest common prefix are candidates, to a depth that adapts to the region
(``regions.py``). Candidates are pruned by set sizes, which is exact, and by 128 one-bit MinHashes at
a bound that pairs at the threshold miss about once in a million. Every link is confirmed on the full
sets.

A null, empty or blank text has an empty set and no links: its component is itself. A row without
``doc_id`` has no component and is kept. Rows that repeat an id have a component by their own text.
Ties can't arise: components have their least id. Other columns are not read. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalspan.llm import regions
from vitalspan.llm.common import batch, documents, importable, with_filter, written
from vitalspan.llm.components import components
from vitalspan.llm.hashing import mixed
from vitalspan.llm.pair_index_bpe import gathered
from vitalspan.llm.shingles import set_blocks, set_key

#: Sorted orders, and values of 16 bits in each.
TREES, DEPTH = 20, 8

#: Values that neighbours share at least, packed into one number. At similarity 0.8 two sets share four values in at least
#: one of twenty orders but for 3 pairs in 100,000.
LEAST_DEPTH = 4

#: Of 128 bits, so many agree. At similarity 0.8 they are 115 in the mean, and fewer than 98 once
#: in a million.
AGREEING = 98

_COUNT = TREES * DEPTH
_MULTIPLY = (mixed(np.arange(1, _COUNT + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_FLIP = (mixed(np.arange(_COUNT + 1, 2 * _COUNT + 1, dtype=np.uint64))).astype(np.uint32)


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of each set (rows) under each function; sets are not empty."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, _COUNT), np.uint32)
    for k in range(_COUNT):
        out[:, k] = np.minimum.reduceat((low ^ _FLIP[k]) * _MULTIPLY[k], bounds[:-1])
    out ^= out >> 15
    out *= np.uint32(0x846CA68B)
    return (out >> np.uint32(16)).astype(np.uint16)


def _packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each order's first and second four values as numbers, and 128 bits as two."""
    four = values.reshape(len(values), TREES, 2, LEAST_DEPTH).astype(np.int64)
    numbers = (four[..., 0] << 48) | (four[..., 1] << 32) | (four[..., 2] << 16) | four[..., 3]
    bits = np.packbits(values[:, :128] & 1, axis=1).view(np.int64)
    return numbers[..., 0], numbers[..., 1], bits


_ORDER = pa.struct([("hi", pa.int64()), ("lo", pa.int64())])


def _described(size: int) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("k", pa.int64()), ("b0", pa.int64()),
         ("b1", pa.int64()), ("orders", pa.list_(_ORDER))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a, b, shingles, bounds in set_blocks(rows.column(1), size):
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                keys = np.zeros(b - a, np.int64)
                bits = np.zeros((b - a, 2), np.int64)
                his = los = np.zeros((0, TREES), np.int64)
                if len(full):
                    his, los, own = _packed(signatures(shingles, np.append(bounds[full], bounds[-1])))
                    bits[full] = own
                    keys[full] = [set_key(shingles[bounds[i] : bounds[i + 1]]) for i in full]
                orders = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum((n > 0) * TREES))), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(his.ravel()), pa.array(los.ravel())], fields=list(_ORDER)
                    ),
                )
                yield batch(
                    schema, [rows.column(0).slice(a, b - a), n, keys, bits[:, 0], bits[:, 1], orders]
                )

    return run


ORDERS = "array<struct<hi: bigint, lo: bigint>>"


def described(docs: DataFrame, size: int) -> DataFrame:
    """Set size, set key, bits and orders of each document, without its text."""
    importable(docs.sparkSession)
    return documents(docs).mapInArrow(
        _described(size), f"doc_id long, n long, k long, b0 long, b1 long, orders {ORDERS}"
    )


def _confirmed(percent: int) -> Callable:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            linked = np.zeros(len(rows), bool)
            for i, (x, y) in enumerate(zip(rows.column(2), rows.column(3))):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                linked[i] = 100 * common >= percent * (len(both) - common)
            yield rows.select([0, 1]).filter(pa.array(linked))

    return run


def _sets(size: int) -> Callable:
    schema = pa.schema([("k", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for _, _, shingles, bounds in set_blocks(rows.column(1), size):
                some = [shingles[i:j] for i, j in zip(bounds, bounds[1:]) if j > i]
                yield batch(schema, [[set_key(s) for s in some], [s.tobytes() for s in some]])

    return run


def sets_of(docs: DataFrame, classes: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """Keys and full sets of the classes with ``keys``. Only documents that stand for one are
    read again."""
    ids = written(classes.join(keys, F.col("k") == F.col("e"), "left_semi").select("doc_id"), "ids")
    texts = with_filter(documents(docs), ids, "doc_id").filter("maybe").drop("maybe")
    texts = texts.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    return texts.mapInArrow(_sets(size), "k long, shingles binary").dropDuplicates(["k"])


def confirmed(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int
) -> DataFrame:
    """The pairs whose full sets are similar."""
    ends = pairs.select(F.col("a").alias("e")).unionByName(pairs.select(F.col("b").alias("e")))
    sets = sets_of(docs, classes, ends.distinct(), size)
    x = sets.select(F.col("k").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("k").alias("b"), F.col("shingles").alias("y"))
    return (
        pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        .mapInArrow(_confirmed(percent), "a long, b long")
    )


class _Cell:
    """Rows of a region that lie in one or two of its blocks."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, limits: regions.Bounds):
        column = lambda name: rows.column(name).to_numpy()
        self.tree = int(column("tree")[0])
        self.root, self.k, self.n = (column(c) for c in ("root", "k", "n"))
        bits = np.stack((column("b0"), column("b1")), axis=1).view(np.uint64)
        self.root = self.root.copy()  # links change it
        self.block = column("block")
        self.region = regions.Region(self.root, self.k, self.n, bits, limits)
        his = rows.column("his").combine_chunks()
        self.his = np.asarray(his.flatten()).reshape(len(self.k), TREES)
        self.one = int(column("x")[0]) == int(column("y")[0])

    def candidates(self, i: int) -> np.ndarray:
        """Earlier rows of other components that may be linked with row ``i``.

        A pair belongs to the first order in which it shares a region, and there to one cell.
        """
        others = self.root[:i] != self.root[i]
        if not self.one:
            others &= self.block[:i] != self.block[i]
        others, _ = self.region.near(i, np.flatnonzero(others))
        before = self.his[others, : self.tree] == self.his[i, : self.tree]
        return others[~before.any(axis=1)]


def _cells(work: Callable[[_Cell, pa.Table], pa.RecordBatch], limits: regions.Bounds) -> Callable:
    """Applies ``work`` to each cell of rows that are sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        own = None

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return work(_Cell(table, limits), table)

        for part in batches:
            keys = np.stack([part.column(c).to_numpy() for c in ("tree", "hi", "x", "y")], axis=1)
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *cut.tolist(), len(part)]
            for s, e in zip(bounds, bounds[1:]):
                if s == e:
                    continue
                if held and tuple(keys[s]) != own:
                    yield done()
                    held.clear()
                own = tuple(keys[s])
                held.append(part.slice(s, e - s))
        if held:
            yield done()

    return run


def _active(cell: _Cell, rows: pa.Table) -> pa.RecordBatch:
    """Rows of the cell that have a candidate."""
    active = np.zeros(len(cell.k), bool)
    for i in range(1, len(cell.k)):
        found = cell.candidates(i)
        active[found] = True
        active[i] |= len(found) > 0
    return rows.filter(pa.array(active)).combine_chunks().to_batches()[0] if active.any() else (
        pa.RecordBatch.from_pylist([], schema=rows.schema)
    )


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _linked(percent: int) -> Callable:
    def work(cell: _Cell, rows: pa.Table) -> pa.RecordBatch:
        """Links on full sets, until the cell's components are connected by them."""
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        begins = np.concatenate(([0], np.cumsum(sizes)))
        # rows that have a shingle, for each shingle
        owners = np.repeat(np.arange(len(sets)), sizes)[np.argsort(number, kind="stable")]
        first = np.concatenate(([0], np.cumsum(np.bincount(number))))
        a, b = [], []
        for i in range(1, len(sets)):
            found = cell.candidates(i)
            if not len(found):
                continue
            mine = number[begins[i] : begins[i + 1]]
            shared, _ = gathered(owners, first[mine], first[mine + 1] - first[mine])
            common = np.bincount(shared, minlength=len(sets))[found]
            linked = found[100 * common >= percent * (sizes[i] + sizes[found] - common)]
            for j in linked.tolist():
                if cell.root[i] != cell.root[j]:
                    a.append(min(cell.k[i], cell.k[j]))
                    b.append(max(cell.k[i], cell.k[j]))
                    cell.root[cell.root == cell.root[i]] = cell.root[j]
        return batch(_LINKS, [np.array(a, np.int64), np.array(b, np.int64)])

    return work


#: Rows of a region that are compared in one task; larger regions are cut into blocks, and each
#: pair of blocks is a cell.
CELL_ROWS = 2048


def compared(
    docs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, limits: regions.Bounds
) -> DataFrame:
    """Links between components of a region. Sets are moved to the rows instead of pairs to the
    sets, as regions with several components can hold many candidates that are no links."""
    keys = ["tree", "hi", "x", "y"]
    many = rows.groupBy("tree", "hi").agg(F.ceil(F.count("*") / CELL_ROWS).alias("blocks"))
    of_class = classes.select("k", F.transform("orders", lambda o: o["hi"]).alias("his"))
    dealt = (
        rows.join(many, ["tree", "hi"]).join(of_class, "k")
        .withColumn("block", F.pmod("k", "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("tree", "hi", F.least("block", "other").alias("x"),
                F.greatest("block", "other").alias("y"), "block", "root", "k", "n", "b0", "b1", "his")
    )
    kinds = "tree int, hi long, x long, y long, block long, root long, k long, n long, b0 long, b1 long, his array<long>"
    active = (
        dealt.repartition(*keys).sortWithinPartitions(*keys, "k")
        .mapInArrow(_cells(_active, limits), kinds)
    )
    active = written(active, "open-rows")
    sets = sets_of(docs, classes, active.select(F.col("k").alias("e")).distinct(), size)
    return (
        active.join(sets, "k")
        .select(*keys, "block", "root", "k", "n", "b0", "b1", "his", "shingles")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "k")
        .mapInArrow(_cells(_linked(limits.percent), limits), "a long, b long")
    )


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links between classes."""
    rows = classes.select(F.posexplode("orders").alias("tree", "o"), "k", "n", "b0", "b1").select(
        "tree", "o.hi", "o.lo", "k", "n", "b0", "b1"
    )
    limits = regions.Bounds(percent, AGREEING)
    return regions.links(
        rows,
        limits,
        lambda pairs: confirmed(docs, classes, pairs, size, percent),
        lambda left: compared(docs, classes, left, size, limits),
    )


def _verdicts(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, set key ``k``, ``component_id`` and ``kept`` of each document."""
    table = written(described(docs, size), "signatures")
    full = table.filter("n > 0 AND doc_id IS NOT NULL")
    members = full.groupBy("k").agg(F.min("doc_id").alias("first_id"))
    standing = full.join(
        members.withColumnsRenamed({"k": "key"}),
        (F.col("k") == F.col("key")) & (F.col("doc_id") == F.col("first_id")),
    )
    classes = written(
        standing.dropDuplicates(["k"]).select("k", "doc_id", "n", "b0", "b1", "orders"), "classes"
    )
    roots = components(links(docs, classes, size, percent))
    labelled = classes.select("k", "doc_id").join(roots, F.col("k") == F.col("node"), "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "k"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = labelled.join(least, "root").select(F.col("k").alias("key"), "component_id")
    component = written(component, "components")
    # the key of an empty set is no class's
    key = F.when(F.col("n") > 0, F.col("k"))
    out = table.select("doc_id", F.col("n").alias("n_shingles"), key.alias("k"))
    out = out.join(component, F.col("k") == F.col("key"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "k", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each document."""
    return _verdicts(docs, size, percent).drop("k")


def _with_keys(size: int) -> Callable:
    """Rows of (row struct, id, text) as (row struct, id, set key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a, b, shingles, bounds in set_blocks(rows.column(2), size):
                own = zip(bounds[:-1], bounds[1:])
                keys = [set_key(shingles[i:j]) if j > i else None for i, j in own]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(a, b - a), rows.column(1).slice(a, b - a),
                     pa.array(keys, pa.int64())],
                    names=["row", "doc_id", "k"],
                )

    return run


def accepted(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all columns. Rows that repeat an id are decided by their own
    sets, and of different sets of one id in a group one stays; rows that repeat both stay together.
    """
    verdicts = written(_verdicts(docs, size, percent).filter("k IS NOT NULL"), "verdicts")
    standing = verdicts.filter("kept AND doc_id IS NOT NULL")
    several = standing.groupBy("component_id").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    several = several.filter("low <> high").select(F.col("component_id").alias("c"), "low")
    others = standing.join(several, F.col("component_id") == F.col("c")).filter("k <> low")
    gone = verdicts.filter("NOT kept").select("doc_id", "k")
    gone = written(gone.unionByName(others.select("doc_id", "k")).distinct(), "copies")
    packed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    packed = with_filter(packed, gone, "doc_id")
    schema = T.StructType(
        [packed.schema["row"], T.StructField("doc_id", T.LongType()), T.StructField("k", T.LongType())]
    )
    maybe = packed.filter("maybe").select("row", "doc_id", "text")
    left = maybe.mapInArrow(_with_keys(size), schema).join(gone, ["doc_id", "k"], "left_anti")
    return packed.filter("NOT maybe").select("row.*").unionAll(left.select("row.*"))
