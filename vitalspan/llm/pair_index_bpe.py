"""Byte-pair encoding and decoding with an index of pair occurrences.

All distinct pre-tokens of a batch lie in one symbol array. An index maps the rank of each pair to
its positions in the whole batch; active ranks are applied in ascending order, each to all of its
positions at once, and the lists of the pairs that a merge makes are extended. A pre-token that
comes again is looked up.

Nulls count as empty texts; an empty text has no tokens. Repeated rows give repeated results. A
null ``doc_id`` stays null. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from vitalspan.llm.common import batch, documents, importable, released, row_blocks, text_buffer
from vitalspan.llm.hashing import range_hashes
from vitalspan.llm.hashing import words as blank_words

#: Texts encoded together. The more, the fewer pre-tokens are looked up twice; a worker takes some
#: 110 MB for them at 1 MB, 160 MB at 3 MB, which takes a ninth less time.
BATCH_BYTES = 1 << 20

#: Distinct pieces that a worker remembers, and ids of them; it starts afresh beyond that.
REMEMBERED, REMEMBERED_IDS = 200_000, 2_000_000


class PairIndex:
    """Merges of symbol pairs, by rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        self.left, self.right, self.made = left, right, made
        keys = (left.astype(np.int64) << 32) | right
        # of two merges of the same pair, the later one counts, as in a map filled in order
        _, last = np.unique(keys[::-1], return_index=True)
        self.order = len(keys) - 1 - last
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges within words laid end to end; symbols left over, and how many each word has."""
        n = len(symbols)
        if n == 0 or len(self.keys) == 0:
            return symbols, lengths
        symbols = symbols.astype(np.int64)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        word_ends = np.cumsum(lengths)[lengths > 0]
        after[word_ends - 1] = -1
        before[np.concatenate(([0], word_ends[:-1]))] = -1
        merged = np.zeros(n, bool)
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def extend(positions: np.ndarray) -> None:
            found = self.ranks(symbols[positions], symbols[after[positions]])
            positions, found = positions[found >= 0], found[found >= 0]
            if not len(found):
                return
            by_rank = np.argsort(found, kind="stable")
            positions, found = positions[by_rank], found[by_rank]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            begins = [0, *cuts.tolist()]
            ends = [*cuts.tolist(), len(found)]
            for rank, a, b in zip(found[begins].tolist(), begins, ends):
                if rank in lists:
                    lists[rank].append(positions[a:b])
                else:
                    lists[rank] = [positions[a:b]]
                    heapq.heappush(heap, rank)

        extend(np.flatnonzero(after >= 0))
        while heap:
            rank = heapq.heappop(heap)
            parts = lists.pop(rank)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            left, right = self.left[rank], self.right[rank]
            if left == right:
                at = np.sort(at)
            follower = after[at]
            valid = (symbols[at] == left) & (follower >= 0)
            valid &= symbols[follower] == right
            at, follower = at[valid], follower[valid]
            if left == right and len(at) > 1:
                # of overlapping occurrences, as in a a a, the first, third, ... of a run count
                new_run = np.concatenate(([True], follower[:-1] != at[1:]))
                run_begin = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                taken = (np.arange(len(at)) - run_begin) % 2 == 0
                at, follower = at[taken], follower[taken]
            if not len(at):
                continue
            symbols[at] = self.made[rank]
            symbols[follower] = -1
            rest = after[follower]
            after[at] = rest
            before[rest[rest >= 0]] = at[rest >= 0]
            ahead = before[at]
            ahead = ahead[ahead >= 0]
            merged[at] = True
            extend(np.concatenate((ahead[~merged[ahead]], at[rest >= 0])))
            merged[at] = False
        alive = symbols >= 0
        counts = np.concatenate(([0], np.cumsum(alive)))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        return symbols[alive], counts[bounds[1:]] - counts[bounds[:-1]]


def _byte_names() -> list[str]:
    """The characters that stand for the bytes 0 to 255 in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in names]
    return [names.get(b) or chr(256 + hidden.index(b)) for b in range(256)]


_LETTER, _DIGIT, _OTHER, _SPACE, _ODD = range(5)


def _byte_classes() -> np.ndarray:
    """What a byte of a regular piece is. Odd: it leaves the piece to the library.

    Regular pieces hold ASCII and Latin-1 letters. The apostrophe may begin a contraction and the
    angle bracket a special token, so they are odd, as are blanks other than space and line feed.
    """
    classes = np.full(256, _ODD, np.int8)
    classes[33:127] = _OTHER
    classes[48:58] = _DIGIT
    classes[65:91] = classes[97:123] = _LETTER
    classes[[39, 60]] = _ODD
    classes[[10, 32]] = _SPACE
    return classes


_CLASSES = _byte_classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def classified(flat: np.ndarray) -> np.ndarray:
    """The class of each byte; both bytes of a Latin-1 letter are letters."""
    classes = _CLASSES[flat]
    lead = np.flatnonzero(flat[:-1] == 0xC3)
    trail = flat[lead + 1]
    lead = lead[(trail >= 0x80) & (trail <= 0xBF) & (trail != 0x97) & (trail != 0xB7)]
    classes[lead] = classes[lead + 1] = _LETTER
    return classes


def lowered(flat: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters of UTF-8 in lower case."""
    out = _LOWER[flat]
    upper = np.flatnonzero(flat[:-1] == 0xC3) + 1
    upper = upper[(flat[upper] >= 0x80) & (flat[upper] <= 0x9E) & (flat[upper] != 0x97)]
    out[upper] += 32
    return out


class Memory:
    """Ids of byte ranges that were encoded before, by their hashes.

    Hashes lie in parts that are merged when the last is as large as the one before, so that adding
    some seldom copies all.
    """

    def __init__(self):
        self.parts: list[pd.Index] = []
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.first) - 1

    def places(self, hashes: np.ndarray) -> np.ndarray:
        out, begin = np.full(len(hashes), -1, np.int64), 0
        for part in self.parts:
            left = np.flatnonzero(out < 0)
            found = part.get_indexer(hashes[left])
            out[left] = np.where(found >= 0, found + begin, -1)
            begin += len(part)
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The places of the new ones."""
        places = len(self) + np.arange(len(hashes))
        self.parts.append(pd.Index(hashes))
        while len(self.parts) > 1 and len(self.parts[-1]) >= len(self.parts[-2]):
            last = self.parts.pop()
            self.parts[-1] = pd.Index(np.concatenate((self.parts[-1].to_numpy(), last.to_numpy())))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(counts)))
        self.ids = np.concatenate((self.ids, ids.astype(np.uint32)))
        return places

    def read(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = self.first[places]
        return gathered(self.ids, begins, self.first[places + 1] - begins)


class Encoder:
    """Token ids of whole texts, as a ``tokenizers`` file defines them.

    Texts are cut into pieces where the pre-tokenizer is sure to cut. Distinct pieces are encoded
    once: regular ones with the pair index, the others (special tokens, contractions, other
    scripts, odd blanks) by the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.word_ends: str = model.get("end_of_word_suffix") or ""
        self.path = path
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = self.vocab
        self.index = PairIndex(
            np.array([ids[a] for a, _ in pairs], np.int64),
            np.array([ids[b] for _, b in pairs], np.int64),
            np.array([ids[a + b] for a, b in pairs], np.int64),
        )
        names = _byte_names()
        self.byte_ids = np.array([ids[c] for c in names], np.int64)
        self.last_ids = np.array([ids[c + self.word_ends] for c in names], np.int64)
        self.pieces = blank_words if self.word_ends else cut_pieces
        self.forget()

    @functools.cached_property
    def library(self):
        """Loaded for the first piece that needs it."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_padding()
        library.no_truncation()
        return library

    def forget(self) -> None:
        self.whole, self.tokens = Memory(), Memory()

    def _distinct(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and the number of each."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begins = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        classes = classified(flat)
        odd = np.add.reduceat(classes == _ODD, begins[:-1]) > 0
        cut = np.ones(len(flat) + 1, bool)
        cut[1:-1] = classes[1:] != classes[:-1]
        if self.word_ends:
            flat = lowered(flat)
            cut[:-1] |= classes == _DIGIT
        else:
            # a space goes with what it precedes
            cut[1:-1] &= ~((flat[:-1] == 32) & (classes[1:] != _SPACE))
        cut[begins] = True
        edges = np.flatnonzero(cut)
        hashes = np.concatenate(
            [
                range_hashes(
                    flat[edges[a] : edges[b]],
                    edges[a:b] - edges[a],
                    edges[a + 1 : b + 1] - edges[a],
                )
                for a, b in row_blocks(edges)
            ]
        )
        codes, distinct = pd.factorize(hashes)
        at = self.tokens.places(distinct)
        fresh = np.flatnonzero(at < 0)
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        first = first[fresh]
        lengths = edges[first + 1] - edges[first]
        raw, _ = gathered(flat, edges[first], lengths)
        symbols = self.byte_ids[raw]
        if self.word_ends:
            ends = np.cumsum(lengths) - 1
            symbols[ends] = self.last_ids[raw[ends]]
        at[fresh] = self.tokens.add(distinct[fresh], *self.index.encode(symbols, lengths))
        ids, many = self.tokens.read(at[codes])
        ends = np.concatenate(([0], np.cumsum(many)))[np.searchsorted(edges, begins)]
        totals = np.diff(ends)
        if not odd.any():
            return ids, totals
        own = self.library.encode_batch(
            [pieces[i].decode("utf-8", "replace") for i in np.flatnonzero(odd).tolist()],
            add_special_tokens=False,
        )
        parts, at = [], 0
        for i, encoding in zip(np.flatnonzero(odd).tolist(), own):
            parts += [ids[at : ends[i]], np.array(encoding.ids, np.int64)]
            at = ends[i + 1]
            totals[i] = len(encoding.ids)
        return np.concatenate([*parts, ids[at:]]), totals

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts laid end to end, and where each text's ids begin (one more than texts)."""
        hashes, rows, places = [], [], []
        for a, b in row_blocks(offsets):
            lo, hi = offsets[a], offsets[b]
            starts, ends, row = self.pieces(offsets[a : b + 1] - lo, data[lo:hi])
            hashes.append(range_hashes(data[lo:hi], starts, ends))
            rows.append(row + a)
            places.append(np.stack((starts + lo, ends + lo)))
        if not hashes or not sum(map(len, hashes)):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        codes, distinct = pd.factorize(np.concatenate(hashes))
        if len(self.whole) > REMEMBERED or len(self.whole.ids) > REMEMBERED_IDS:
            self.forget()
        at = self.whole.places(distinct)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            place = np.concatenate(places, axis=1)
            seen = np.zeros(len(distinct), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]
            raw = data.tobytes()
            where = place[:, seen[fresh]]
            ids, counts = self._distinct(
                [raw[a:b] for a, b in zip(where[0].tolist(), where[1].tolist())]
            )
            at[fresh] = self.whole.add(distinct[fresh], ids, counts)
        ids, many = self.whole.read(at[codes])
        # every piece has a row, in order
        row = np.concatenate(rows)
        total = np.concatenate(([0], np.cumsum(many)))
        return ids, total[np.searchsorted(row, np.arange(len(offsets)))]


def gathered(
    values: np.ndarray, begins: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``values[begin:begin + count]`` for each range, end to end."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    index = np.arange(total) + np.repeat(begins - (ends - counts), counts)
    return values[index], counts


_BLANKISH = np.zeros(256, bool)
_BLANKISH[:33] = True
_BLANKISH[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # lead bytes of blanks outside ASCII


def cut_pieces(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces between which the byte-level pre-tokenizer surely cuts: starts, ends, rows.

    It cuts before a blank that a character other than a blank follows, and after a line feed.
    """
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    follows = np.zeros(n, bool)
    follows[:-1] = ~_BLANKISH[data[1:]]
    follows[offsets[1:][offsets[1:] > 0] - 1] = False  # nothing follows the end of a text
    feed = (data == 10) & follows
    cut = ((data == 32) & follows) | feed
    cut[1:] |= feed[:-1]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    cut |= edge[:-1]
    starts = np.flatnonzero(cut)
    ends = np.concatenate((starts[1:], [n]))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary, so that tasks share what it remembers."""
    return Encoder(path)


def encoded_rows(
    column: pa.Array, path: str
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, ids and where each row's ids begin, for runs of rows of bounded size."""
    offsets, data = text_buffer(column)
    for a, b in row_blocks(offsets, BATCH_BYTES):
        lo, hi = offsets[a], offsets[b]
        ids, begins = encoder(path).encode(offsets[a : b + 1] - lo, data[lo:hi])
        yield a, b, ids, begins
    released()


def _rows(path: str, keep: bool) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
         ("decoded_sha256", pa.string())]
        + ([("ids", pa.binary()), ("decoded", pa.string())] if keep else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sorted(encoder(path).vocab.items(), key=lambda x: x[1])
        token = np.full(encoder(path).library.get_vocab_size(), "", object)
        for name, i in names:
            token[i] = name
        for i, added in encoder(path).library.get_added_tokens_decoder().items():
            token[i] = added.content
        token = token.tolist()
        for rows in batches:
            keys = rows.column(0)
            for a, b, ids, begins in encoded_rows(rows.column(1), path):
                raw, where = ids.astype("<u4").tobytes(), begins.tolist()
                out: list[list] = [[], [], [], []]
                for i, j in zip(where, where[1:]):
                    text = " ".join([token[x] for x in ids[i:j].tolist()])
                    own = raw[4 * i : 4 * j]
                    out[0].append(hashlib.sha256(own).hexdigest())
                    out[1].append(hashlib.sha256(text.encode()).hexdigest())
                    if keep:
                        out[2].append(own)
                        out[3].append(text)
                yield batch(
                    schema, [keys.slice(a, b - a), np.diff(begins), *out[: 4 if keep else 2]]
                )

    return run


def encode_and_decode(docs: DataFrame, path: str, with_tokens: bool = True) -> DataFrame:
    """Ids of every whole text and the text they decode to, by the vocabulary file ``path``.

    ``with_tokens`` adds the ids (little-endian unsigned 32-bit numbers) and the decoded text to
    their digests. The decoder joins token names with a blank, as vocabularies without a decoder
    of their own are read.
    """
    importable(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" if with_tokens else ""
    return documents(docs).mapInArrow(_rows(path, with_tokens), schema)
