"""Near-duplicate documents, repeated lines, components."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vitalspan.llm import banded, components, fuzzy_lines, lsh_forest, regions


def shingles(text, size):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_components(rows, size):
    sets = {i: shingles(t, size) for i, t in rows}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    links = set()
    for i, s in sets.items():
        for j in {j for x in s for j in by_shingle[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                links.add((i, j))
    return {i: len(s) for i, s in sets.items()}, groups(sets, links)


def copies(seed=5):
    """Originals, exact copies, near copies around the threshold, and a large group."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = [[word() for _ in range(rng.randint(3, 90))] for _ in range(40)]
    for t in list(texts):
        for _ in range(rng.randint(0, 4)):
            own = list(t)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = word()
            texts.append(own)
    base = [word() for _ in range(100)]
    for _ in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(100)] = word()
        texts.append(own)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [4, 5])
def test_components_are_those_of_all_pairs(spark, size):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes, want = plain_components(rows, size)
    got = lsh_forest.near_duplicates(docs, size, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_regions_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(regions, "SMALL", 2)
    rows = copies(9)
    _, want = plain_components(rows, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lsh_forest.near_duplicates(docs, 4, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_test_table_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    _, want = plain_components([tuple(r) for r in docs.select("doc_id", "text").collect()], 4)
    got = lsh_forest.near_duplicates(docs, 4, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_odd_documents(spark, odd_docs, no_docs):
    rows = lsh_forest.near_duplicates(odd_docs, 4, 80).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["component_id"] == r["doc_id"] for r in rows if r["doc_id"] in (0, 1, 2))
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert lsh_forest.near_duplicates(no_docs).collect() == []
    left = lsh_forest.accepted(odd_docs)
    assert left.schema == odd_docs.schema and left.count() == odd_docs.count()
    assert lsh_forest.accepted(no_docs).collect() == []


def test_chains_and_stars_connect(spark):
    rng = random.Random(2)
    ids = rng.sample(range(-(10**6), 10**6), 400)
    links = list(zip(ids[:150], ids[1:150])) + [(ids[200], x) for x in ids[201:300]]
    links += [(ids[310], ids[310]), (ids[5], ids[4])]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    want = groups(ids, [x for x in links if x[0] != x[1]])
    assert len(set(got.values())) == 2
    for a, b in links[:-2]:
        assert got[a] == got[b] and want[a] == want[b]
    assert components.components(df.limit(0)).collect() == []


def normal_line(line):
    line = re.sub(r"[!-/:-@\[-`{-~]", "", line)
    line = re.sub("[0-9]", "0", line.translate({c: c + 32 for c in [*range(65, 91), *range(0xC0, 0xDF)] if c != 0xD7}))
    return tuple(re.findall("[^\x20\x09-\x0d]+", line))


def plain_lines(rows):
    """Groups of lines by all pairs of classes, with the operator's own SimHashes."""
    first, bits = {}, {}
    for doc, text in rows:
        block = np.frombuffer((text or "").encode(), np.uint8)
        own = fuzzy_lines.lines_of(np.array([0, len(block)]), block)
        lines = (text or "").split("\n")
        numbers = [i for i, x in enumerate(lines) if len(normal_line(x)) >= fuzzy_lines.LEAST_WORDS]
        assert own["line"].tolist() == numbers
        for i, s0, s1 in zip(numbers, own["s0"].tolist(), own["s1"].tolist()):
            words = normal_line(lines[i])
            first.setdefault(words, []).append((doc, i))
            bits[words] = (s0 % 2**64) << 64 | s1 % 2**64
    classes = list(first)
    links = []
    for a in range(len(classes)):
        for b in range(a):
            x, y = classes[a], classes[b]
            if (bits[x] ^ bits[y]).bit_count() <= fuzzy_lines.DIFFERING:
                if 100 * min(len(x), len(y)) >= 60 * max(len(x), len(y)):
                    if fuzzy_lines.similar(" ".join(x), " ".join(y)):
                        links.append((b, a))
    root = groups(range(len(classes)), links)
    by_group = defaultdict(list)
    for c, words in enumerate(classes):
        by_group[root[c]] += first[words]
    return {place for places in by_group.values() for place in sorted(places)[1:]}, links


def line_texts(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    lines = [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rows = []
    for i in range(80):
        own = []
        for _ in range(rng.randint(0, 6)):
            words = rng.choice(lines).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = word()
            line = " ".join(words)
            own.append(rng.choice([line, line.upper() + "!", line + ", 12" if len(words) > 40 else line]))
        rows.append((i, "\n".join(own)))
    return rows


def test_lines_left_out_are_those_of_all_pairs(spark):
    rows = line_texts()
    want, links = plain_lines(rows)
    assert links  # the fixture has lines that only a fuzzy match connects
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lines = fuzzy_lines.line_groups(docs)
    assert {(r["doc_id"], r["line"]) for r in lines.filter("NOT kept").collect()} == want
    texts = {
        i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in want) for i, t in rows
    }
    cleaned = fuzzy_lines.cleaned(docs).select("row.doc_id", "text").collect()
    assert {r["doc_id"]: r["text"] for r in cleaned} == texts


def test_odd_lines(odd_docs, no_docs):
    out = fuzzy_lines.accepted(odd_docs)
    assert out.schema.names == odd_docs.schema.names and out.dtypes == odd_docs.dtypes
    texts = {r["doc_id"]: r["text"] for r in out.filter("doc_id IS NOT NULL").collect()}
    assert texts[0] is None and texts[1] == "" and texts[16] == "same line again\n"
    assert out.filter("doc_id = 8").count() == odd_docs.filter("doc_id = 8").count()
    assert fuzzy_lines.accepted(no_docs).collect() == []
    assert fuzzy_lines.digests(odd_docs).count() == odd_docs.count()


def test_edit_distance():
    rng = random.Random(1)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert fuzzy_lines.edit_distance(a, b) == plain(a, b)


def test_set_keys_and_signatures_depend_on_sets_only():
    from vitalspan.llm.shingles import set_blocks

    column = pa.array(["a b c d e f", "x", "A B C D e f", None, "a b c d e f a b c d"])
    (_, _, s, bounds), = set_blocks(column, 4)
    sets = [s[i:j].tolist() for i, j in zip(bounds, bounds[1:])]
    assert sets[0] == sets[2] and len(sets[0]) == 3 and len(sets[1]) == 1 and sets[3] == []
    assert len(sets[4]) == 6 and set(sets[0]) < set(sets[4])


def test_lines_of_edit_similarity_alone_are_found(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    lines = []
    for _ in range(150):
        line = [word() for _ in range(rng.randint(5, 40))]
        lines.append(line)
        for _ in range(2):
            own = list(line)
            for _ in range(max(1, len(own) // 10)):
                own[rng.randrange(len(own))] = word()
            lines.append(own)
    texts = [" ".join(x) for x in lines]
    pairs = [
        (i, j) for j in range(len(texts)) for i in range(j)
        if 100 * min(len(texts[i]), len(texts[j])) >= 80 * max(len(texts[i]), len(texts[j]))
        if i // 3 == j // 3 and fuzzy_lines.similar(texts[i], texts[j])
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {r["doc_id"]: r["group_id"] for r in fuzzy_lines.line_groups(docs).collect()}
    found = sum(group[i] == group[j] for i, j in pairs)
    assert len(pairs) > 300 and found >= 0.98 * len(pairs)


def test_short_lines_and_lines_without_blanks(spark):
    long = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳云腾致雨"
    texts = ["And ornd.", "and ORND", "ok", "Ok!", "---", "---", long, long, long.replace("日", "目"), "apples", "pear"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = {r["doc_id"] for r in fuzzy_lines.line_groups(docs).filter("NOT kept").collect()}
    assert gone == {1, 3, 7, 8}


def test_large_regions_of_lines_are_compared_in_cells(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = [f"{rng.randint(10, 99)} {rng.randint(10, 99)} {word()}" for _ in range(120)]
    base = [word() for _ in range(25)]
    for _ in range(40):
        own = list(base)
        own[rng.randrange(25)] = word()
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = sorted({normal_line(t) for t in texts})
    pairs = [
        (a, b) for b, y in enumerate(classes) for a, x in enumerate(classes[:b])
        if fuzzy_lines.similar(" ".join(x), " ".join(y))
    ]
    monkeypatch.setattr(fuzzy_lines, "SMALL", 4)
    monkeypatch.setattr(fuzzy_lines, "CELL_ROWS", 16)
    made, verified = [], fuzzy_lines.verified
    monkeypatch.setattr(
        fuzzy_lines, "verified", lambda d, c, p: made.append(p.count()) or verified(d, c, p)
    )
    group = {r["doc_id"]: r["group_id"] for r in fuzzy_lines.line_groups(docs).collect()}
    assert sum(made) < 3 * len(texts)  # the region's 7,000 pairs leave no task
    of = {normal_line(t): group[i] for i, t in enumerate(texts)}
    found = sum(of[classes[a]] == of[classes[b]] for a, b in pairs)
    assert len(pairs) > 700 and found >= 0.97 * len(pairs)


def test_copies_with_small_changes_leave_nothing_for_cells(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, texts = [word() for _ in range(40)], []
    for _ in range(60):
        own = list(base)
        own[rng.randrange(40)] = word()
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left, in_cells = [], fuzzy_lines.in_cells

    def counted(docs, classes, rows):
        left.append((rows.select("h").distinct().count(), rows.select("root").distinct().count()))
        return in_cells(docs, classes, rows)

    monkeypatch.setattr(fuzzy_lines, "in_cells", counted)
    groups = {r["group_id"] for r in fuzzy_lines.line_groups(docs).collect()}
    (regions, roots), = left
    assert regions > 0 and roots == 1 and len(groups) == 1


def test_rows_that_repeat_an_id_are_decided_by_their_own_text(spark):
    rng = random.Random(6)
    text = lambda: [str(rng.randint(0, 10**6)) for _ in range(60)]
    one, two, three = text(), text(), text()
    near = [*three[:-1], "x"]
    rows = [(1, one), (5, one), (5, two), (7, three), (7, near), (7, near)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    left = [(r["doc_id"], r["text"].split()) for r in lsh_forest.accepted(docs).collect()]
    assert (1, one) in left and (5, two) in left and (5, one) not in left
    assert ((7, three) in left) != ((7, near) in left)


def test_bounds_of_edit_distances():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5)))
    xs, ys = [], []
    for _ in range(400):
        own = [word() for _ in range(rng.randint(1, 12))]
        other = list(own)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(other))
            other[at : at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
            other = other or [word()]
        xs.append(" ".join(own))
        ys.append(" ".join(other if rng.random() < 0.9 else [word() for _ in own]))
    exact = [fuzzy_lines.edit_distance(x, y) for x, y in zip(xs, ys)]
    above = [fuzzy_lines.edits_by_words(x, y, 10**6) for x, y in zip(xs, ys)]
    below = fuzzy_lines.least_edits(fuzzy_lines.run_counts(xs), fuzzy_lines.run_counts(ys))
    assert all(b <= e <= a for a, e, b in zip(above, exact, below.tolist()))
    assert sum(a == e for a, e in zip(above, exact)) > 50 and max(below) > 0
    want = [100 * e <= 20 * max(len(x), len(y)) for x, y, e in zip(xs, ys, exact)]
    assert fuzzy_lines.pairs_similar(xs, ys).tolist() == want
    assert 50 < sum(want) < 350 and fuzzy_lines.pairs_similar([], []).tolist() == []


def test_distances_of_many_pairs_at_once(monkeypatch):
    rng = random.Random(13)
    xs, ys = [], []
    for i in range(1500):
        own = [rng.choice("abcé😀 ") for _ in range(rng.randint(0, 90) if i else 3000)]
        other = list(own)
        for _ in range(rng.randint(0, 20)):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randint(0, 2)] = rng.choices("abc", k=rng.randint(0, 2))
        xs.append("".join(own))
        ys.append("".join(other))
    exact = np.array([fuzzy_lines.edit_distance(x, y) for x, y in zip(xs, ys)])
    most = np.array([rng.randint(0, 25) for _ in xs])
    assert (banded.near(xs, ys, most) == (exact <= most)).all()
    assert 300 < (exact <= most).sum() < 1400 and (exact == most).any()
    want = [100 * e <= 20 * max(len(x), len(y)) for x, y, e in zip(xs, ys, exact.tolist())]
    # none is computed alone
    monkeypatch.setattr(fuzzy_lines, "edit_distance", None)
    assert fuzzy_lines.pairs_similar(xs, ys).tolist() == want
    monkeypatch.undo()
    # but those too long to be compared together are
    monkeypatch.setattr(banded, "LONGEST", 40)
    assert fuzzy_lines.pairs_similar(xs, ys).tolist() == want
