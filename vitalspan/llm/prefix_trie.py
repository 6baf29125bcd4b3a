"""Conversations as a trie of shared prefixes.

A conversation is the sequence of its turns. Each of its prefixes has a 128-bit key, a digest chained
over the turns, so that equal prefixes have equal keys, in whatever task they are seen.

Every task puts its conversations into a z-fast trie: only prefixes at which conversations branch or
end are nodes, and a hash table finds a node by its handle, the key of the prefix whose length is the
number between its parent's length and its own that most powers of two divide. A fat binary search
over these lengths locates the node at which a conversation leaves the trie in a logarithmic number
of lookups. Conversations are inserted in batches, sorted by that exit node. At last every edge is
expanded into one row per prefix, with its counts, and Spark adds up the rows of equal keys from all
tasks. So a prefix that many conversations share moves once a task, not once a conversation.

Sums over subtrees need no walk through the levels. Words of members below a prefix are sums over the
members of the rest of each, which tries yield with the other counts. Words of distinct prefixes, and
leaves, are added up along the paths of the conversations that own them, each prefix belonging to
its least conversation, whose prefixes end its path.

Turns are ordered by number, null first, and by a digest of role and text where numbers are equal;
repeated rows are turns of their own. Null roles and texts are empty. Rows without a conversation
belong to none. A conversation's turns are held in one row, at 16 bytes each, so very long texts don't
count. Other columns are not read. An empty table gives no prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalspan.llm.common import batch, importable, written

#: A task's trie is expanded and begun anew beyond so many prefixes, which bounds its memory.
MOST_PREFIXES = 500_000

#: Prefixes with more than this part of all as children are joined by broadcast; so many at most.
HOT_PARENTS = 1000

#: The key of the empty prefix.
ROOT = bytes(16)

_WORD = r"[^\x20\x09-\x0D]+"


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order: number, digest of role and text, words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role keeps it apart from the text
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct(
        F.col("turn"), F.unhex(digest).alias("said"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    rows = rows.where(F.col("conv_id").isNotNull())
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(chats: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first turns taken from the one that opens its group.

    Of conversation c, the first h = crc32(c) mod ``most`` turns are those of c - c mod ``every``, as
    far as it has them; the rest are its own after its first h.
    """
    own = chats.select(
        "conv_id", "turns",
        (F.col("conv_id") - F.col("conv_id") % every).alias("opener"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"),
    )
    openers = chats.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("opener"), F.slice("turns", 1, max(most - 1, 1)).alias("opening")
    )
    joined = own.join(openers, "opener", "left")
    none = F.slice("turns", F.lit(1), F.lit(0))
    # slices of lengths beyond the array's end stop there
    opening = F.slice(F.coalesce("opening", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


_PATHS = pa.schema(
    [("conv_id", pa.int64()), ("keys", pa.list_(pa.binary())), ("words", pa.list_(pa.int64()))]
)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        keys = []
        for turns in part.column(1).to_pylist():
            path, key = [], ROOT
            for said in turns:
                key = hashlib.blake2b(key + said, digest_size=16).digest()
                path.append(key)
            keys.append(path)
        yield batch(_PATHS, [part.column(0), keys, part.column(2)])


def paths(chats: DataFrame) -> DataFrame:
    """``conv_id``, the ``keys`` of its prefixes from the first turn on, and ``words`` of each turn."""
    importable(chats.sparkSession)
    named = chats.select(
        "conv_id", F.col("turns.said").alias("said"), F.col("turns.words").alias("words")
    )
    return named.mapInArrow(_chained, "conv_id long, keys array<binary>, words array<long>")


def fattest(low: int, high: int) -> int:
    """The number above ``low``, up to ``high``, that the greatest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A prefix at which conversations branch or end. ``path`` has the keys of one of them."""

    __slots__ = ("path", "words", "length", "parent", "children", "ends", "least")

    def __init__(self, path: list[bytes], words: list[int], length: int, parent: Node | None):
        self.path, self.words, self.length, self.parent = path, words, length, parent
        self.children: dict[bytes, Node] = {}
        self.ends, self.least = 0, None


class ZFastTrie:
    """Nodes by handle; the empty prefix is the root."""

    def __init__(self):
        self.root = Node([], [], 0, None)
        self.handles: dict[bytes, Node] = {}
        self.prefixes = 1

    def _name(self, node: Node) -> None:
        self.handles[node.path[fattest(node.parent.length, node.length) - 1]] = node

    def locate(self, path: list[bytes], above: Node | None = None) -> Node:
        """The deepest node whose whole prefix begins ``path``, at or below ``above``."""
        found = above or self.root
        low, high = found.length, len(path)
        while low < high:
            middle = fattest(low, high)
            node = self.handles.get(path[middle - 1])
            if node is None:
                high = middle - 1
            elif node.length <= len(path) and node.path[node.length - 1] == path[node.length - 1]:
                found, low = node, node.length
            else:
                # the path leaves inside this node's edge
                return node.parent
        return found

    def insert(
        self, path: list[bytes], words: list[int], ends: int, least: int, above: Node | None = None
    ) -> None:
        """Adds ``ends`` conversations of equal turns, ``least`` being the lowest of their ids."""
        node = self.locate(path, above)
        if node.length < len(path):
            child = node.children.get(path[node.length])
            if child is not None:
                node = self._split(child, path)
            if node.length < len(path):
                leaf = Node(path, words, len(path), node)
                node.children[path[node.length]] = leaf
                self._name(leaf)
                self.prefixes += len(path) - node.length
                node = leaf
        node.ends += ends
        node.least = least if node.least is None else min(node.least, least)

    def _split(self, node: Node, path: list[bytes]) -> Node:
        """A new node where ``path`` leaves the edge of ``node``; keys agree up to there only."""
        low, high = node.parent.length + 1, min(node.length - 1, len(path))
        while low < high:
            middle = (low + high + 1) // 2
            if node.path[middle - 1] == path[middle - 1]:
                low = middle
            else:
                high = middle - 1
        parent = node.parent
        fork = Node(node.path, node.words, low, parent)
        parent.children[path[parent.length]] = fork
        fork.children[node.path[low]] = node
        node.parent = fork
        self._name(fork)
        self._name(node)
        return fork

    def insert_batch(self, rows: list[tuple[list[bytes], list[int], int, int]]) -> None:
        """Locates all rows first, then inserts them in the order of their exit nodes."""
        exits = [self.locate(row[0]) for row in rows]
        for i in sorted(range(len(rows)), key=lambda i: (exits[i].length, id(exits[i]))):
            self.insert(*rows[i], above=exits[i])

    def expand(self) -> Iterator[tuple[bytes, int, bytes | None, int, int, int, int]]:
        """One row for each prefix: key, depth, parent's key, members, the least of them, words of
        its last text, and the words of all members from that text on."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        sums: dict[int, list] = {}
        for node in reversed(order):
            below = [sums.pop(id(child)) for child in node.children.values()]
            members = node.ends + sum(b[0] for b in below)
            least = min([b[1] for b in below] + ([] if node.least is None else [node.least]))
            total = sum(b[2] for b in below)
            start = node.parent.length if node.parent else 0
            for depth in range(node.length, start, -1):
                total += members * node.words[depth - 1]
                yield (
                    node.path[depth - 1], depth, node.path[depth - 2] if depth > 1 else ROOT,
                    members, least, node.words[depth - 1], total,
                )
            sums[id(node)] = [members, least, total]
        members, least, total = sums[id(self.root)]
        yield ROOT, 0, None, members, least, 0, total


_PREFIXES = pa.schema(
    [("key", pa.binary()), ("depth", pa.int64()), ("parent", pa.binary()), ("n_convs", pa.int64()),
     ("conv_id", pa.int64()), ("words", pa.int64()), ("member_words", pa.int64())]
)


def _expanded(most: int) -> Callable:
    def rows_of(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in trie.expand():
            rows.append(row)
            if len(rows) == 10_000:
                yield batch(_PREFIXES, list(zip(*rows)))
                rows = []
        yield batch(_PREFIXES, list(zip(*rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        filled = False
        for part in batches:
            same: dict[bytes, list] = {}
            for conv_id, path, words in zip(*(column.to_pylist() for column in part.columns)):
                entry = same.setdefault(path[-1] if path else ROOT, [path, words, 0, conv_id])
                entry[2] += 1
                entry[3] = min(entry[3], conv_id)
            trie.insert_batch([tuple(entry) for entry in same.values()])
            filled |= bool(same)
            if trie.prefixes > most:
                yield from rows_of(trie)
                trie, filled = ZFastTrie(), False
        if filled:
            yield from rows_of(trie)

    return run


def prefixes(ways: DataFrame) -> DataFrame:
    """``key, depth, parent, n_convs, conv_id, words, member_words`` of every distinct prefix."""
    importable(ways.sparkSession)
    schema = (
        "key binary, depth long, parent binary, n_convs long, conv_id long, words long, "
        "member_words long"
    )
    parts = ways.select("conv_id", "keys", "words").mapInArrow(_expanded(MOST_PREFIXES), schema)
    return parts.groupBy("key").agg(
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("words").alias("words"),
        F.sum("member_words").alias("member_words"),
    )


_OWNED = pa.schema([("key", pa.binary()), ("own_words", pa.int64()), ("n_leaves", pa.int64())])


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each owner adds to the prefixes of its path."""
    for part in batches:
        keys, words, leaves = [], [], []
        for path, counts, start, leaf in zip(*(column.to_pylist() for column in part.columns)):
            # words of the prefix itself count from its owner's first prefix on
            values = np.array([0, *counts], np.int64)
            values[:start] = 0
            keys += [ROOT, *path]
            words.append(np.cumsum(values[::-1])[::-1])
            leaves += [leaf] * len(values)
        if keys:
            yield batch(_OWNED, [keys, np.concatenate(words), leaves])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of the sorted ids of each key, taken as the rows stream by."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    now, digest = None, None
    for part in batches:
        out = []
        for key, conv_id in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if key != now:
                if digest:
                    out.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(b"%d" % conv_id)
            else:
                digest.update(b",%d" % conv_id)
        if out:
            yield batch(schema, list(zip(*out)))
    if digest:
        yield batch(schema, [[now], [digest.hexdigest()]])


def ends(ways: DataFrame) -> DataFrame:
    """``key`` and the digest of the ids of the conversations that end there.

    A SHA-256 takes its input in order, so the ids of one key pass through one task, in sorted runs;
    none are held.
    """
    last = F.coalesce(F.try_element_at("keys", F.lit(-1)), F.lit(ROOT)).alias("key")
    rows = ways.select(last, "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    return rows.mapInArrow(_ends, "key binary, ends_sha256 string")


def trie(ways: DataFrame) -> DataFrame:
    """Every distinct prefix of the conversations, with what its subtree holds.

    ``conv_id`` is its least member, ``parent_conv_id`` that of the prefix before it (null for the
    empty one); ``saved_tokens`` are words that members below share, each text counted once less than
    it has members.
    """
    ways = written(ways, "paths")
    nodes = written(prefixes(ways), "prefixes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))
    )
    counted = written(counted, "prefixes")
    owners = counted.groupBy("conv_id").agg(
        F.min("depth").alias("start"), F.count_if(F.col("n_children") == 0).alias("leaf")
    )
    owned = ways.join(owners, "conv_id").select("keys", "words", "start", "leaf")
    below = owned.mapInArrow(_owned, "key binary, own_words long, n_leaves long")
    below = below.groupBy("key").agg(
        F.sum("own_words").alias("own_words"), F.sum("n_leaves").alias("n_leaves")
    )
    full = counted.join(below, "key").join(ends(ways), "key", "left")
    # few prefixes can have that many children; those of the others are joined by key
    most = F.lit(max(1, counted.count() // HOT_PARENTS))
    parents = counted.where("n_children > 0").select(
        F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    hot = parents.where(F.col("n_children") > most).drop("n_children")
    hot = hot.withColumnRenamed("parent_conv_id", "hot_conv_id")
    cold = parents.where(F.col("n_children") <= most).drop("n_children")
    full = full.join(F.broadcast(hot), "parent", "left")
    # children of hot prefixes need no partner, so they are dealt by their own key instead
    by = F.when(F.col("hot_conv_id").isNull(), F.col("parent")).otherwise(F.col("key"))
    cold = cold.withColumnRenamed("parent", "of")
    full = full.withColumn("by", by).join(cold, F.col("by") == F.col("of"), "left")
    nothing = hashlib.sha256().hexdigest()
    return full.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("hot_conv_id", "parent_conv_id")).alias(
            "parent_conv_id"
        ),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("member_words") - F.col("own_words")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
