"""Quality rules and classifier."""

import math
import re
import zlib

import numpy as np
import pytest

from vitalspan.llm import quality_qda, quality_rules
from vitalspan.llm.queries import QUERIES
from vitalspan.llm.statistics import text_statistics

BLANK = "[\x20\x09-\x0d]"


def plain_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(words) < 2000 else None
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_lines": len(lines),
        "n_distinct_words": len(set(words)),
        "n_upper": len(re.findall("[A-ZÀ-ÖØ-Þ]", text)),
        "n_repeat_words": None
        if again is None
        else len({i + k for i, w in enumerate(windows) if w in again for k in range(3)}),
    }


def test_counts_are_the_plain_ones(odd_docs):
    import pyarrow as pa

    texts = [r["text"] for r in odd_docs.select("text").collect()]
    got = text_statistics(pa.array(texts))
    for i, text in enumerate(texts):
        for name, value in plain_counts(text).items():
            assert value is None or got[name][i] == value, (name, text[:50] if text else text)


def test_every_row_has_a_verdict(odd_docs, no_docs):
    out = quality_rules.judge(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r["base_failed"] is not None and r["kept"] is not None for r in out)
    assert all(not r["kept"] for r in out if r["base_failed"])
    assert quality_rules.judge(no_docs).collect() == []


def test_accepted_rows_are_those_kept_with_all_columns(odd_docs, no_docs, sf_dir, spark):
    assert quality_rules.accepted(odd_docs).schema == odd_docs.schema
    assert quality_rules.accepted(no_docs).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    rows = quality_rules.accepted(docs).collect()
    assert {r["doc_id"] for r in rows} == kept and len(rows) == len(kept)


def test_fences_follow_language_and_source(spark):
    usual = " ".join(f"word{i}" for i in range(80))
    loud = " ".join(f"WORD{i}" for i in range(80))
    rows = [(i, usual, "a", "s") for i in range(300)] + [(400, loud, "a", "s")]
    rows += [(500 + i, loud, "b", "s") for i in range(300)] + [(900, loud, None, "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert kept[0] and not kept[400] and kept[500]


def test_merged_sketches_are_the_sketch_of_all(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stats = quality_rules.with_statistics(docs, "text", "s")
    whole = quality_rules.sketches(stats, "s")
    parts = quality_rules.sketches(stats.filter("doc_id % 2 = 0"), "s").unionAll(
        quality_rules.sketches(stats.filter("doc_id % 2 = 1"), "s")
    )
    key = ["lang", "source", "rule", "v"]
    merged = parts.groupBy(*key).agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    assert sorted(merged.select(*key, "n").collect()) == sorted(whole.select(*key, "n").collect())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_qda.judge(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert out.count() == docs.count()


def test_scores_of_odd_rows_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 1, 0), (4, 0, 0), (9, None, 0), (None, 1, 0), (10, 7, 0), (777, 0, 1), (3, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    for some in (labels, labels.filter("quality = 1"), labels.limit(0)):
        rows = quality_qda.judge(odd_docs, some).collect()
        assert len(rows) == odd_docs.count()
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows} == {0.5}
    assert quality_qda.judge(no_docs, labels).collect() == []
    assert quality_qda.accepted(odd_docs, odd_docs, labels).schema == odd_docs.schema
    assert quality_qda.accepted(no_docs, no_docs, labels).collect() == []


def test_only_texts_go_to_python_and_no_row_comes_back(spark, odd_docs):
    labels = spark.createDataFrame([(3, 1), (4, 0)], "doc_id long, quality int")
    for kept in (quality_rules.accepted(odd_docs), quality_qda.accepted(odd_docs, odd_docs, labels)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(0)
    size = len(quality_qda.FEATURES)
    x = [rng.normal(size=(500, size)), 1 + 2 * rng.normal(size=(300, size))]
    model = quality_qda.fitted(
        np.array([500.0, 300.0]), np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x])
    )
    point = rng.normal(size=(1, size))

    def log_density(k):
        covariance = np.linalg.inv(model.inverses[k].T @ model.inverses[k])
        d = point[0] - model.means[k]
        return -0.5 * d @ np.linalg.solve(covariance, d) - 0.5 * np.linalg.slogdet(covariance)[1]

    ratio = log_density(1) - log_density(0) + np.log(301 / 802) - np.log(501 / 802)
    assert model.scores(point)[0] == pytest.approx(1 / (1 + np.exp(-ratio)))


def plain_features(text):
    text = text or ""
    own = plain_counts(text)
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, again = {}, set()
    for i in range(len(words) - 2):
        first = seen.setdefault(tuple(words[i : i + 3]), i)
        if first != i:
            again |= {first, first + 1, first + 2, i, i + 1, i + 2}
    n, chars = max(len(words), 1), max(own["word_chars"], 1)
    return [
        math.log(1 + len(words)), math.log(1 + own["word_chars"] / n), math.sqrt(own["n_symbols"] / n),
        math.sqrt(len(re.findall("[!?]", text)) / n), math.sqrt(own["n_upper"] / chars),
        math.sqrt(len(again) / n), math.sqrt(own["n_dup_lines"] / n),
        math.sqrt(len(re.findall("[0-9]", text)) / chars),
        math.log(1 + own["n_distinct_words"]) - math.log(1 + len(words)),
        math.sqrt(len(re.findall("[.,;:]", text)) / n), math.log(1 + n / max(own["n_lines"], 1)),
    ]


def test_whole_query_against_a_plain_version(spark, sf_dir):
    """Features by regular expressions, covariances of the rows themselves, densities by solving."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    x = {i: np.array(plain_features(t)) for i, t in docs.items()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    of = [
        np.array([x[r["doc_id"]] for r in labels
                  if r["quality"] == k and r["doc_id"] in x and not out[r["doc_id"]]])
        for k in (0, 1)
    ]
    total = sum(map(len, of))
    target = np.diag(np.maximum(np.concatenate(of).var(axis=0), 1e-6))
    logs = {i: [] for i in x}
    for rows in of:
        own = np.cov(rows.T, bias=True)
        scale = np.mean(np.diag(own) / np.diag(target))
        shrunk = 0.9 * own + 0.1 * max(scale, 0.05) * target
        constant = math.log((len(rows) + 1) / (total + 2)) - 0.5 * np.linalg.slogdet(shrunk)[1]
        for i in x:
            d = x[i] - rows.mean(axis=0)
            logs[i].append(constant - 0.5 * d @ np.linalg.solve(shrunk, d))
    want = {i: 1 / (1 + math.exp(min(max(bad - good, -700), 700))) for i, (bad, good) in logs.items()}
    got = QUERIES["op6_quality_qda"](spark, sf_dir).collect()
    assert len(got) == len(docs) and min(map(len, of)) > 1
    for r in got:
        assert r["held_out"] == out[r["doc_id"]]
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-4, abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.3)
