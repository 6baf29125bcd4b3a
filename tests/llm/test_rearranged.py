"""Fill-in-the-middle, repeated windows and the prefix trie against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vitalspan.llm import fill_middle, prefix_trie, queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill in the middle


def plain_order(doc_id, text):
    text = text or ""
    n = len(text)
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, a, b - a, sha(out), sha(text)


SENTINELS = ["a<P>b", "<S>", "x<M>", "<P", "S><S", "<<P>", "p<", "日本語<M", "é🙂" * 40, "<M" * 5]


def test_fill_in_the_middle(spark, odd_docs):
    more = [(100 + i, SENTINELS[i % len(SENTINELS)]) for i in range(200)]
    more += [(None, "no id"), (-3, "negative"), (7, None)]
    docs = odd_docs.unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True
    ).selectExpr("*", "1 AS form", "2 AS output")
    got = Counter(tuple(r) for r in fill_middle.digests(fill_middle.transform(docs)).collect())
    rows = docs.select("doc_id", "text").collect()
    assert got == Counter(plain_order(*r) for r in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_the_middle_of_a_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in queries.op11_fill_middle(spark, sf_dir).collect())
    assert got == Counter(plain_order(*r) for r in rows)


def test_fill_in_the_middle_of_nothing(no_docs):
    assert fill_middle.digests(fill_middle.transform(no_docs)).collect() == []


@pytest.mark.parametrize("lengths", [(0, 0, 0), (1, 0, 2), (3, 4, 5), (2, 7, 0), (0, 5, 5)])
def test_rotation_is_in_place(lengths):
    a, b, c = lengths
    block = np.arange(a + b + c, dtype=np.uint8)
    whole = block.tolist()
    fill_middle.rotate(block, a, a + b, a + b + c)
    assert block.tolist() == whole[:a] + whole[a + b :] + whole[a : a + b]


# repeated windows


def plain_kept(rows, size):
    """Rows are (number, text); equal numbers are one document."""
    first, found = {}, []
    for number, text in rows:
        words = WORD.findall(text or "")
        found.append(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            first[window] = min(first.get(window, (number, i)), (number, i))
    for (number, _), words in zip(rows, found):
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < (number, i):
                gone[i : i + size] = [True] * size
        yield len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))


def kept_of(docs, size):
    out = substring_dedup.digests(substring_dedup.remove_repeats(docs, size))
    return Counter(tuple(r) for r in out.collect())


def numbered(docs):
    rows = docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    numbers = [
        (r.doc_id if r.doc_id is not None else -(1 << 63) + ((r.h % (1 << 64)) >> 2), r.text) for r in rows
    ]
    return [r.doc_id for r in rows], numbers


@pytest.mark.parametrize("size", [1, 3, 20])
def test_repeated_windows_go(spark, odd_docs, size, monkeypatch):
    monkeypatch.setattr(substring_dedup, "RANGE_BYTES", 1 << 14)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 1 << 12)
    rng = random.Random(size)
    passage = " ".join(rng.choices("abcdefgh", k=60))
    more = []
    for i in range(200):
        words = rng.choices("abcdefghij", k=rng.randrange(0, 90))
        at = rng.randrange(0, 90)
        text = " ".join(words[:at] + ([passage] if i % 3 else []) + words[at:])
        more.append((rng.choice([i, i, i, 5, None, -i]), text))
    more += [more[3], more[3], (None, passage), (1, passage + "  " + passage)]
    docs = odd_docs.unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True
    )
    ids, rows = numbered(docs)
    want = Counter((i, *r) for i, r in zip(ids, plain_kept(rows, size)))
    assert kept_of(docs.repartition(5), size) == want


def test_removed_intervals_are_maximal(spark):
    said = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, said), (2, f"a b {said} c {said} d")], "doc_id long, text string")
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(docs, 20).collect()}
    assert out[1].removed == [] and out[1].kept == said
    assert [tuple(x) for x in out[2].removed] == [(2, 30), (33, 30)]
    assert out[2].kept == "a b c d" and out[2].n_removed == 60


def test_windows_of_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids, rows = numbered(docs)
    want = Counter((i, *r) for i, r in zip(ids, plain_kept(rows, 20)))
    got = Counter(tuple(r) for r in queries.op12_substring_dedup(spark, sf_dir).collect())
    assert got == want
    assert any(r[2] for r in got)


def test_windows_of_nothing(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []


# prefix trie


def plain_trie(rows):
    said = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            said[conv_id].append(((turn is not None, turn or 0), digest, role, text))
    for turns in said.values():
        turns.sort()
    paths = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        opener = c - (c % 20 if c >= 0 else -(-c % 20))
        paths[c] = tuple(t[2:] for t in said.get(opener, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = Counter()
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in own if paths[c] == path)
        out[
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), children[path],
            sum(not children[p] for p in below),
            sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p),
            sha(",".join(map(str, ends))),
        ] += 1
    return out


def trie_of(turns):
    chats = prefix_trie.rebuilt(prefix_trie.conversations(turns))
    return Counter(tuple(r) for r in prefix_trie.trie(prefix_trie.paths(chats)).collect())


@pytest.mark.parametrize("most,hot", [(500_000, 1000), (5, 1000), (5, 2)])
def test_trie_of_odd_conversations(spark, monkeypatch, most, hot):
    monkeypatch.setattr(prefix_trie, "MOST_PREFIXES", most)
    monkeypatch.setattr(prefix_trie, "HOT_PARENTS", hot)
    rng = random.Random(most + hot)
    texts = ["hello there", "", None, "a  b\tc", "é 日本", "hello", "x" * 500 + " y"]
    rows = []
    for c in [*range(60), -1, -20, -25, 400, 433, 10**12, 10**12 + 7, None]:
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", None]),
                         texts[rng.randrange(2 if turn < 6 else 7)]))
    rows += rows[:7] + [(700 + i, t, "user", f"turn {t}") for i in range(30) for t in range(40)]
    rows += [(721, 40, "user", "one more"), (722, 20, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' AS key", "1 AS depth", "'y' AS turns", "2 AS n_children", "3 AS h")
    assert trie_of(df.repartition(3)) == plain_trie(rows)


def test_trie_of_a_table(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = turns.select("conv_id", "turn", "role", "text").collect()
    got = Counter(tuple(r) for r in queries.op13_prefix_trie(spark, sf_dir).collect())
    assert got == plain_trie([tuple(r) for r in rows])


def test_trie_of_nothing(spark):
    assert not trie_of(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))


def test_exit_nodes_are_found(spark):
    """Against a walk over all prefixes, with paths of up to 70 keys."""
    rng = random.Random(3)
    trie, held = prefix_trie.ZFastTrie(), []
    for _ in range(400):
        base = rng.choice(held)[: rng.randrange(71)] if held and rng.random() < 0.8 else []
        path = list(base)
        while len(path) < rng.randrange(1, 71):
            path.append(hashlib.md5(b"".join(path[-1:]) + bytes([rng.randrange(3)])).digest())
        held.append(path)
        trie.insert(path, [1] * len(path), 1, len(held))
        probe = rng.choice(held)[: rng.randrange(71)]
        nodes = {n.path[n.length - 1]: n for n in trie.handles.values()}
        want = next((nodes[k] for k in reversed(probe) if k in nodes), trie.root)
        assert trie.locate(probe) is want
