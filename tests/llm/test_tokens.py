"""Encoding, packing and counting against the libraries and plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vitalspan.llm import common, pack_fit, pack_squares, pair_index_bpe, trie_counts
from vitalspan.llm.queries import vocabulary


def library_ids(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def texts_by_id(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def random_texts(n, seed):
    rng = random.Random(seed)
    signs = "aabbeeinrst  \n.,'!ÀéßZ019<|>\t  "
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_both_vocabularies_agree_with_the_library(byte_level, word_level):
    import pyarrow as pa

    texts = random_texts(3000, 1)
    for path in (byte_level, word_level):
        tokenizer = Tokenizer.from_file(path)
        want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        got = []
        for _, _, ids, begins in pair_index_bpe.encoded_rows(pa.array(texts), path):
            got += [ids[i:j].tolist() for i, j in zip(begins, begins[1:])]
        assert got == want


def test_encode_and_decode(odd_docs, word_level):
    tokenizer = Tokenizer.from_file(word_level)
    out = pair_index_bpe.encode_and_decode(odd_docs, word_level).collect()
    want = sorted(
        (
            (i, len(ids), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False))
            for i, ids in ((i, library_ids(word_level, t)) for i, t in texts_by_id(odd_docs))
        ),
        key=str,
    )
    assert sorted(((r[0], r[1], bytes(r[4]), r[5]) for r in out), key=str) == want
    for r in out:
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_encode_of_nothing(no_docs, word_level):
    assert pair_index_bpe.encode_and_decode(no_docs, word_level).collect() == []


def rebuilt(pieces, size):
    """Documents from pieces, after checks of the windows' layout."""
    windows, documents = {}, {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        assert p["ids_crc32"] == zlib.crc32(bytes(p["ids"]))
        documents.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], bytes(p["ids"])))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == size or at & (at - 1) == 0 and at <= size
    return documents


def test_squares_round_trip(odd_docs, byte_level):
    pieces = pack_squares.pack(odd_docs.coalesce(2), byte_level, end_id=1, size=64).collect()
    documents = rebuilt(pieces, 64)
    for doc_id, text in texts_by_id(odd_docs):
        want = np.array([*library_ids(byte_level, text), 1], "<u4").tobytes()
        parts = sorted(documents[doc_id, len(want) // 4])
        if doc_id is not None and len({s for s, _ in parts}) == len(parts):
            assert b"".join(p for _, p in parts) == want
    assert sum(p["length"] for p in pieces) == sum(
        len(library_ids(byte_level, t)) + 1 for _, t in texts_by_id(odd_docs)
    )


def test_squares_of_nothing(no_docs, byte_level):
    assert pack_squares.pack(no_docs, byte_level).collect() == []


def test_squares_takes_the_level_of_least_gain():
    size, rng = 32, random.Random(3)
    packer, counts = pack_squares.Packer(size), {}
    for document in range(400):
        length = rng.randint(1, size)
        gains = {}
        for level in [0, *counts]:
            if level + length > size:
                continue
            after = dict(counts)
            if level:
                after[level] -= 1
            if level + length < size:
                after[level + length] = after.get(level + length, 0) + 1
            gains[level] = sum(v * v for v in after.values())
        best = max(level for level in gains if gains[level] == min(gains.values()))
        full = packer.place(document, 0, length)
        if best:
            counts[best] -= 1
        if best + length < size:
            counts[best + length] = counts.get(best + length, 0) + 1
        counts = {k: v for k, v in counts.items() if v}
        assert (full is not None) == (best + length == size)
        assert counts == {i: int(c) for i, c in enumerate(packer.counts) if c}


@pytest.mark.parametrize("size", [7, 16, 33])
def test_best_fit_decreasing(size):
    rng = random.Random(size)
    for _ in range(100):
        lengths = [rng.randint(0, 3 * size) for _ in range(rng.randint(0, 50))]
        rows = pack_fit.fitted(np.array(lengths, np.int64), size)
        room = []
        for rest in sorted((n % size for n in lengths if n % size), reverse=True):
            fits = [i for i, r in enumerate(room) if r >= rest]
            if fits:
                room[min(fits, key=lambda i: room[i])] -= rest
            else:
                room.append(size - rest)
        assert sorted(size - sum(p[2] for p in row) for row in rows) == sorted(
            room + [0] * sum(n // size for n in lengths)
        )
        ends = [0] * len(lengths)
        for document, start, length in sorted(p for row in rows for p in row):
            assert start == ends[document]
            ends[document] += length
        assert ends == lengths


def test_matrices_hold_every_document(odd_docs, no_docs, byte_level, tmp_path, spark):
    packed = pack_fit.pack(odd_docs.filter("doc_id IS NOT NULL").distinct(), byte_level, end_id=1, size=64)
    pack_fit.write(packed, str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    parts = {}
    for row in stored.collect():
        ids, positions = (np.frombuffer(row[c], "<u4") for c in ("ids", "positions"))
        ends = row["cu_seqlens"]
        assert len(ids) == len(positions) == 64 and ends[0] == 0 and ends[-1] <= 64
        assert not ids[ends[-1] :].any() and not positions[ends[-1] :].any()
        for doc, start, i, j in zip(row["doc_ids"], row["starts"], ends, ends[1:]):
            assert positions[i:j].tolist() == list(range(j - i))
            parts.setdefault(doc, []).append((start, ids[i:j].tolist()))
    for doc_id, text in texts_by_id(odd_docs.filter("doc_id IS NOT NULL").distinct()):
        got = [x for _, p in sorted(parts[doc_id]) for x in p]
        assert got == [*library_ids(byte_level, text), 1]
    digests = pack_fit.digests(stored).collect()
    for d in digests:
        positions = np.arange(d["length"], dtype="<u4").tobytes()
        assert d["positions_crc32"] == zlib.crc32(positions)
    assert sum(d["length"] for d in digests) == sum(len(x) for p in parts.values() for _, x in p)
    assert pack_fit.digests(pack_fit.pack(no_docs, byte_level)).collect() == []


def plain_count(trie, word):
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        size = len(word[i - 1].encode())
        ways = [(best[i - 1][0] + size * trie.unknown, best[i - 1][1] - size)]
        for j in range(max(0, i - trie.longest), i):
            if word[j:i] in trie.pieces:
                ways.append((best[j][0] + trie.pieces[word[j:i]], best[j][1] - 1))
        best.append(max(ways))
    return -best[-1][1]


def test_trie_counts_are_those_of_plain_dynamic_programming(odd_docs, no_docs):
    path = vocabulary("piece_bpe_32k.model")
    trie = trie_counts.trie(path)
    got = {r["doc_id"]: r for r in trie_counts.count_tokens(odd_docs, path).collect()}
    for doc_id, text in texts_by_id(odd_docs):
        if doc_id is None:
            continue
        words = [w.decode() for w in (text or "").encode().split()]
        known = {w: plain_count(trie, "▁" + w) for w in set(words)}
        assert got[doc_id]["n_words"] == len(words)
        assert got[doc_id]["n_tokens"] == sum(known[w] for w in words)
    assert trie_counts.count_tokens(no_docs, path).collect() == []


def test_a_trie_shares_prefixes():
    trie = trie_counts.Trie({"a": -1.0, "ab": -1.5, "b": -1.0, "abc": -4.0, "c": -1.0})
    assert [trie.count(w) for w in ("ab", "abc", "abd", "")] == [1, 2, 2, 0]
    assert len(trie.scores) == 5


def test_workers_get_batches_of_bounded_bytes(spark):
    key, _ = common.BATCH
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('abcdefgh', 1250) AS text").repartition(1)

    def sizes(batches):
        for rows in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rows.nbytes])], names=["n"])

    common.importable(spark)
    assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) < 10 << 20
    own = spark.conf.get(key)
    try:
        spark.conf.set(key, str(1 << 20))
        common.importable(spark)
        assert spark.conf.get(key) == str(1 << 20)
    finally:
        spark.conf.set(key, own)
