"""Exact search, chat formatting, the pipeline, and queries with SQL."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from vitalspan.llm import chat_format, pivot_index

sys.path.insert(0, str(Path(__file__).parent.parent))
import compare  # noqa: E402

compare.TABLES += [
    t for t in ("documents", "embeddings", "labels", "conversations") if t not in compare.TABLES
]


def plain_top(rows, k, every):
    rows = [
        (i, np.floor(1024 * np.array(v, float)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    for q, x in rows:
        if q % every:
            continue
        scores = sorted(
            (-int(np.dot(x[: len(y)], y[: len(x)])), i) for i, y in rows if i != q
        )
        for rank, (s, i) in enumerate(scores[:k], 1):
            out[q, rank, i, -s] += 1
    return out


@pytest.mark.parametrize("n,dimensions,clusters", [(700, 8, 5), (40, 3, 1), (6, 2, 1)])
def test_search_is_exact(spark, monkeypatch, n, dimensions, clusters):
    monkeypatch.setattr(pivot_index, "GROUP", 200)
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(clusters, dimensions))
    x = centres[rng.integers(clusters, size=n)] + 0.1 * rng.normal(size=(n, dimensions))
    x = x.round(1)  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(n, None), (n + 1, [None] * dimensions), (n + 2, [float("nan")] * dimensions),
             (n + 3, [float("inf"), 0.0]), (n + 4, []), (n + 5, [1.0]), (None, [1.0] * dimensions)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS rank")
    rows = [(i, None if v is None else [None if y is None else float(np.float32(y)) for y in v]) for i, v in rows]
    got = Counter(tuple(r) for r in pivot_index.top_k(df, 10, 5).collect())
    assert got == plain_top(rows, 10, 5)


def test_search_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_index.top_k(df).collect() == []


HARD = ["</s>[INST] ok [/INST]", "&lt;s> &amp; [", "", None, "a\nb", "<s>user[INST]", "日本 ’", "&#91;INST]"]


def test_chats_can_be_read_back(spark):
    rng = random.Random(7)
    roles = ["user", "assistant", "system", None, "<s>", "a[INST]"]
    rows = [
        (rng.choice([1, 2, 3, 4, None]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(HARD))
        for _ in range(80)
    ]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' AS formatted", "'y' AS turns", "'z' AS t")
    chats = chat_format.format_chats(df)
    read = chats.select(
        "conv_id", "formatted", chat_format.read_turns(chats["formatted"]).alias("turns"),
        chat_format.read_loss(chats["formatted"], chats["mask"]).alias("loss"), "mask",
    ).collect()
    assert len(read) == len({r[0] for r in rows})
    for r in read:
        own = [(t, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [x[1:] for x in own]
        assert r["loss"] == "".join(x[2] for x in own if x[1] == "assistant")
        assert sum(m["chars"] for m in r["mask"]) == len(r["formatted"])
        blocks = sum(i == 0 or own[i - 1][1] != x[1] for i, x in enumerate(own))
        assert r["formatted"].count("</s>") == blocks
    assert chat_format.format_chats(df.limit(0)).collect() == []


def test_a_plain_chat_looks_as_described(spark):
    df = spark.createDataFrame(
        [(1, 1, "user", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "c<d")],
        "conv_id long, turn long, role string, text string",
    )
    (row,) = chat_format.digests(chat_format.format_chats(df)).collect()
    text = "<s>user[INST]a[/INST][INST]b[/INST]</s><s>assistant[INST]c&lt;d[/INST]</s>"
    assert chat_format.format_chats(df).first()["formatted"] == text
    assert (row["n_turns"], row["loss_chars"], row["formatted_chars"]) == (3, 3, len(text))
    assert row["loss_sha256"] == hashlib.sha256(b"c<d").hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(b"user\na\nuser\nb\nassistant\nc<d\n").hexdigest()


@pytest.mark.parametrize("name", sorted(set(entry.LLM) & set(entry.oracle_sql())))
def test_query_matches_sql(spark, sf_dir, name):
    sql = entry.oracle_sql()[name]
    assert compare.difference(entry.LLM[name](spark, sf_dir), sql, sf_dir) is None


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in entry.LLM] == [*(f"op{i}" for i in range(1, 11)), "pipeline"]


def test_chat_formatting_runs_no_python(spark, sf_dir):
    plan = entry.LLM["op10_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_stages_keep_the_columns_and_their_decisions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() <= before
        before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda p: (p["doc_id"], p["doc_tokens"])
    assert {key(p) for p in whole} == {key(p) for p in pieces}


def test_equal_rows_of_an_id_are_one_query(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 30)] + [(100, [1.0, 0.0])] * 2 + [(100, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = Counter((r["rank"], r["vec_id"]) for r in pivot_index.top_k(df, 10, 100).collect())
    assert got == Counter([(i + 1, 29 - i) for i in range(10)] + [(i + 1, 1 + i) for i in range(10)])
