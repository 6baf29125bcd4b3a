"""Quality rules whose thresholds follow the data.

Each rate of a text (an integer per thousand) goes into a sketch of its language and source: counts
of values rounded down to three digits. Sketches merge by adding counts, in any order and with the
same result, so they are one map-side combined aggregate, and those of a language or of the corpus
are sums of the smaller ones. Quantiles read from them (within one per cent) give each language and
source its own fences; few texts borrow the fences of their language, or of the corpus. The fences
are joined to the texts.

Texts that fail the base rules do not enter the sketches. A null text has no words and fails them.
Null languages and sources are groups of their own. Repeated rows count each time. An empty table
gives no rows. Of other columns none are read, and names that clash with results are not either.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vitalspan.llm.common import documents, importable, written
from vitalspan.llm.statistics import NAMES, text_statistics

#: Rate, per thousand of, least spread, sides fenced.
RULES = [
    ("word_length", "word_chars", "n_words", 250, "both"),
    ("symbols", "n_symbols", "n_words", 12, "above"),
    ("marks", "n_marks", "n_words", 12, "above"),
    ("capitals", "n_upper", "word_chars", 15, "above"),
    ("repeats", "n_repeat_words", "n_words", 80, "above"),
    ("lines_again", "n_dup_lines", "n_words", 10, "above"),
]

#: Spreads (upper minus lower quartile) beyond the quartiles at which the fences stand.
SPREADS = 6

#: Texts that a group needs for fences of its own.
LEAST_TEXTS = 200

STATS = T.StructType([T.StructField(name, T.LongType()) for name in NAMES])


def with_statistics(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the counts of its ``text`` as a struct column ``name``.

    Only the texts go to Python, and only counts come back. Spark may not copy the call into the
    conditions that use them.
    """
    importable(df.sparkSession)
    kinds = [pa.field(n, pa.int64()) for n in NAMES]

    def run(texts: pa.Array) -> pa.Array:
        counts = text_statistics(texts)
        return pa.StructArray.from_arrays(
            [pa.array(counts[n], pa.int64()) for n in NAMES], fields=kinds
        )

    counted = F.arrow_udf(run, STATS).asNondeterministic()
    return df.select("*", counted(F.col(text)).alias(name))


def base_failed(stats: str) -> Column:
    """Too few words, or over half of them in windows of three that come again."""
    return (F.col(f"{stats}.n_words") < 50) | (
        100 * F.col(f"{stats}.n_repeat_words") > 50 * F.col(f"{stats}.n_words")
    )


def rate(stats: str, count: str, total: str) -> Column:
    return F.expr(f"1000 * {stats}.{count} div greatest({stats}.{total}, 1)")


def sketches(df: DataFrame, stats: str) -> DataFrame:
    """Counts of rounded rates by language, source and rule."""
    rates = F.array(
        *[F.struct(F.lit(r[0]).alias("rule"), rate(stats, *r[1:3]).alias("value")) for r in RULES]
    )
    digits = F.length(F.col("r.value").cast("string"))
    step = F.pow(F.lit(10), F.greatest(digits - 3, F.lit(0))).cast("long")
    return (
        df.filter(~base_failed(stats))
        .select("lang", "source", F.explode(rates).alias("r"))
        .select("lang", "source", "r.rule", (F.col("r.value") - F.col("r.value") % step).alias("v"))
        .groupBy("lang", "source", "rule", "v")
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """Texts, lower and upper quartile of the merged sketches of each key."""
    merged = sketch.groupBy(*keys, "rule", "v").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    below = F.sum("n").over(group.orderBy("v"))
    return (
        merged.withColumn("below", below)
        .withColumn("all", F.sum("n").over(group))
        .groupBy(*keys, "rule")
        .agg(
            F.max("all").alias(f"n{suffix}"),
            F.min(F.when(4 * F.col("below") >= F.col("all"), F.col("v"))).alias(f"q1{suffix}"),
            F.min(F.when(4 * F.col("below") >= 3 * F.col("all"), F.col("v"))).alias(f"q3{suffix}"),
        )
    )


def fences(sketch: DataFrame) -> DataFrame:
    """A row for each language and source of the sketches: least and largest rate of each rule."""
    own = _quartiles(sketch, ["lang", "source"], "_0")
    language = _quartiles(sketch, ["lang"], "_1").withColumnsRenamed({"lang": "l", "rule": "r"})
    corpus = _quartiles(sketch, [], "_2").withColumnsRenamed({"rule": "c"})
    joined = own.join(
        language, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("r"))
    ).join(corpus, F.col("rule") == F.col("c"))

    def chosen(name: str) -> Column:
        return (
            F.when(F.col("n_0") >= LEAST_TEXTS, F.col(f"{name}_0"))
            .when(F.col("n_1") >= LEAST_TEXTS, F.col(f"{name}_1"))
            .otherwise(F.col(f"{name}_2"))
        )

    def bounds(least_spread: int, sides: str) -> list[Column]:
        spread = SPREADS * F.greatest(chosen("q3") - chosen("q1"), F.lit(least_spread))
        low = chosen("q1") - spread if sides == "both" else F.lit(None).cast("long")
        return [low, chosen("q3") + spread]

    sides = [(name, *bounds(spread, side)) for name, _, _, spread, side in RULES]
    return joined.groupBy("lang", "source").agg(
        *[
            F.max(F.when(F.col("rule") == name, value)).alias(f"{name}_{side}")
            for name, low, high in sides
            for side, value in (("low", low), ("high", high))
        ]
    )


def kept(stats: str) -> Column:
    """Not failed, and every rate within the fences that are joined."""
    verdict = ~base_failed(stats)
    for name, count, total, _, _ in RULES:
        value = rate(stats, count, total)
        verdict = (
            verdict
            & F.coalesce(value >= F.col(f"{name}_low"), F.lit(True))
            & F.coalesce(value <= F.col(f"{name}_high"), F.lit(True))
        )
    return verdict


def _joined(df: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows with the fences of their language and source, nulls matching nulls.

    The fences are a written table, so that Spark knows their size: it broadcasts few and
    otherwise sorts both sides, where adaptive execution splits a hot source.
    """
    limits = limits.withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    same = F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(
        F.col("f_source")
    )
    return df.join(limits, same, "left")


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each document."""
    df = with_statistics(documents(docs, "lang", "source"), "text", "s").drop("text")
    df = written(df, "quality-statistics")
    df = _joined(df, written(fences(sketches(df, "s")), "quality-fences"))
    return df.select(
        "doc_id", "lang", "source", "s.*", base_failed("s").alias("base_failed"),
        kept("s").alias("kept"),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The counts are made twice, for the fences and for the verdicts, because texts are dearer to
    move than to count. Columns of any names may be there.
    """
    narrow = with_statistics(documents(docs, "lang", "source"), "text", "s").drop("text")
    limits = written(fences(sketches(narrow, "s")), "quality-fences")
    packed = docs.select(F.struct("*").alias("row"), "text", "lang", "source")
    judged = _joined(with_statistics(packed, "text", "s"), limits)
    return judged.filter(kept("s")).select("row.*")
