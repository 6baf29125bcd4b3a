"""Token counts of texts by dynamic programming over a shared trie.

Distinct pre-tokens go into a trie. The unigram forward score of a node - the best sum of piece
scores over all ways to spell the characters from the root to it - is computed once, when the node
is made, from its ancestors; so words that begin alike share the work. The number of pieces on the
best way is stored with it, and kept for the nodes at which a word ends. A text's count is the sum
over its words.

A character that no piece covers takes its UTF-8 bytes as tokens, each below the lowest score. Of
equal scores the way with fewer tokens counts. Null and empty texts have none. Repeated rows give
repeated results; a null ``doc_id`` stays null. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from vitalspan.llm.common import batch, documents, importable, row_blocks, text_buffer
from vitalspan.llm.hashing import range_hashes, words

#: What a piece vocabulary puts before a word.
WORD_MARK = "▁"

#: Nodes that a worker remembers; it starts a new trie beyond that.
REMEMBERED = 600_000


class Trie:
    """Forward scores of word beginnings under scored pieces."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - 1.0
        # every tail of a piece, so that a search backwards knows when to stop
        self.tails = {p[i:] for p in pieces for i in range(len(p))}
        self.forget()

    def forget(self) -> None:
        #: Node after (node, character), both in one number.
        self.children: dict[int, int] = {}
        self.scores, self.counts = [0.0], [0]
        self.terminals: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of the best way to spell ``word``."""
        known = self.terminals.get(word)
        if known is None:
            known = self.terminals[word] = self._insert(word)
        return known

    def _insert(self, word: str) -> int:
        children, scores, counts = self.children, self.scores, self.counts
        pieces, tails, longest = self.pieces, self.tails, self.longest
        path = [0]
        for i, character in enumerate(word):
            last = path[-1]
            edge = last << 21 | ord(character)
            after = children.get(edge)
            if after is None:
                size = len(character.encode("utf-8", "surrogatepass"))
                # bytes, if no piece ends here
                best, least = scores[last] + size * self.unknown, counts[last] + size
                for j in range(i, max(i - longest, -1), -1):
                    part = word[j : i + 1]
                    if part in pieces:
                        start = path[j]
                        score = scores[start] + pieces[part]
                        if score > best or (score == best and counts[start] + 1 < least):
                            best, least = score, counts[start] + 1
                    elif part not in tails:
                        break
                after = children[edge] = len(scores)
                scores.append(best)
                counts.append(least)
            path.append(after)
        return counts[path[-1]]


@functools.cache
def trie(path: str) -> Trie:
    """One for each worker and vocabulary: a sentencepiece file's pieces and their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    normal = [
        i for i in range(size)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return Trie({model.id_to_piece(i): model.get_score(i) for i in normal})


def _rows(path: str) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = trie(path)
        for rows in batches:
            offsets, data = text_buffer(rows.column(1))
            many, total = [], []
            for a, b in row_blocks(offsets, 8 << 20):
                begins = offsets[a : b + 1] - offsets[a]
                block = data[offsets[a] : offsets[b]]
                hashes, places, row = [], [], []
                for i, j in row_blocks(begins):
                    lo = begins[i]
                    starts, ends, own = words(begins[i : j + 1] - lo, block[lo : begins[j]])
                    hashes.append(range_hashes(block[lo : begins[j]], starts, ends))
                    places.append(np.stack((starts + lo, ends + lo)))
                    row.append(own + i)
                codes, distinct = pd.factorize(np.concatenate(hashes))
                place = np.concatenate(places, axis=1)
                seen = np.zeros(len(distinct), np.int64)
                seen[codes[::-1]] = np.arange(len(codes))[::-1]
                raw = block.tobytes()
                if len(shared.scores) > REMEMBERED:
                    shared.forget()
                counts = np.fromiter(
                    (
                        shared.count(WORD_MARK + raw[s:e].decode("utf-8", "replace"))
                        for s, e in place[:, seen].T.tolist()
                    ),
                    np.int64,
                    len(distinct),
                )
                of = np.concatenate(row)
                many.append(np.bincount(of, minlength=b - a))
                total.append(np.bincount(of, weights=counts[codes], minlength=b - a))
            none = np.zeros(0, np.int64)
            yield batch(
                schema,
                [rows.column(0), np.concatenate([none, *many]).astype(np.int64),
                 np.concatenate([none, *total]).astype(np.int64)],
            )

    return run


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Words and tokens of each whole text under the pieces of the vocabulary file ``path``."""
    importable(docs.sparkSession)
    return documents(docs).mapInArrow(_rows(path), "doc_id long, n_words long, n_tokens long")
