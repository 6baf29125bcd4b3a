import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalspan import lookups
from vitalspan.functions import clean, codes
from vitalspan.functions.grains import GRAINS, time_grain
from vitalspan.functions.rates import (
    INFANT_BANDS,
    UNDER_FIVE_BANDS,
    band_label,
    band_ordinal,
    rate_per_thousand,
)


def value(spark, column, **inputs):
    frame = spark.createDataFrame(
        [tuple(inputs.values())], ", ".join(f"{name} string" for name in inputs)
    )
    return frame.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, kept",
    [("07052010", True), ("7052010", False), (None, False), ("0705201x", False), ("", False)],
)
def test_event_date_filter(spark, text, kept):
    frame = spark.createDataFrame([(text,)], "d string")
    assert frame.where(clean.has_event_date(F.col("d"))).count() == int(kept)


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("1155", "1155"),
        ("0000", "0000"),
        ("2359", "2359"),
        ("2400", "0000"),
        ("2575", "0000"),
        ("1260", "0000"),
        ("9H30", "0000"),
        ("915", "0000"),
        (None, "0000"),
    ],
)
def test_valid_times_are_kept(spark, text, cleaned):
    assert value(spark, clean.clock_or_midnight(F.col("t")), t=text) == cleaned


def test_month_is_a_month_and_not_minutes(spark):
    got = value(spark, clean.source_date(F.col("d")), d="07052010")
    assert got == dt.date(2010, 5, 7)


@pytest.mark.parametrize("text", ["32132010", "00000000", "31021980", "abc", None])
def test_impossible_dates_become_null(spark, text):
    assert value(spark, clean.event_timestamp(F.col("d")), d=text) is None


def test_timestamp_of_date_and_time(spark):
    got = value(spark, clean.event_timestamp(F.col("d"), F.col("t")), d="07052010", t="1155")
    assert got == dt.datetime(2010, 5, 7, 11, 55)


def test_dates_and_times_are_those_of_the_pattern(spark):
    """Eight digits are cast, others parsed by the pattern; both give what the pattern alone gives."""
    days = ["29022000", "29021900", "31041999", "01010000", "00011999", "99999999", "31129999"]
    days += ["7051998", "070519981", " 7051998", "07/05/98", "07051998\n", "+7051998", "", None]
    clocks = ["0000", "2359", "2400", "1260", "930", "9H30", "0203\n", "12345", "", None]
    rows = spark.createDataFrame([(d, c) for d in days for c in clocks], "d string, c string")
    text = "concat(lpad(d, 8, '0'), ' ', lpad({}, 4, '0'))"
    timed, dated = (
        F.try_to_timestamp(F.expr(text.format(clock)), F.lit("ddMMyyyy HHmm"))
        for clock in ("coalesce(c, '0000')", "'0000'")
    )
    day = F.try_to_timestamp(F.expr("lpad(d, 8, '0')"), F.lit("ddMMyyyy")).cast("date")
    same = (
        clean.event_timestamp(F.col("d"), F.col("c")).eqNullSafe(timed)
        & clean.event_timestamp(F.col("d")).eqNullSafe(dated)
        & clean.source_date(F.col("d")).eqNullSafe(day)
    )
    assert rows.where(~same).collect() == []
    assert rows.where(clean.event_timestamp(F.col("d"), F.col("c")).isNotNull()).count() > 0


def test_first_valid_date_wins(spark):
    column = clean.first_valid_timestamp(F.col("a"), F.col("b"))
    assert value(spark, column, a="99999999", b="07052010") == dt.datetime(2010, 5, 7)
    assert value(spark, column, a="01012011", b="07052010") == dt.datetime(2011, 1, 1)


def test_numbers_and_decimal_comma(spark):
    assert value(spark, clean.number(F.col("x")), x="07") == 7
    assert value(spark, clean.number(F.col("x")), x="XX") is None
    assert value(spark, clean.decimal_comma(F.col("x"), "double"), x="-9,75") == -9.75


def test_address_without_complement(spark):
    column = clean.address(F.col("a"), F.col("b"), F.col("c"))
    assert value(spark, column, a="RUA X", b="10", c=None) == "RUA X 10"
    assert value(spark, column, a=None, b=None, c=None) is None


@pytest.mark.parametrize(
    "code, concept",
    [("M", 8507), ("1", 8507), ("Feminino", 8532), ("2", 8532), ("I", 8551), (None, 8551)],
)
def test_gender(spark, code, concept):
    assert value(spark, codes.gender_concept(F.col("c")), c=code) == concept


@pytest.mark.parametrize(
    "code, concept",
    [("1", 3212942), ("Branca", 3212942), ("5", 3213694), ("9", 763013), (None, 763013)],
)
def test_race_compares_text_under_ansi(spark, code, concept):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert value(spark, codes.race_concept(F.col("c")), c=code) == concept


@pytest.mark.parametrize(
    "rate, infant, under_five",
    [
        (0.0, 1, 1),
        (10.99, 1, 1),
        (11.0, 1, 2),
        (13.0, 2, 2),
        (13.01, 3, 3),
        (16.0, 3, 3),
        (16.05, None, None),
        (16.1, 4, 4),
        (19.9, 4, 4),
        (19.91, 5, 5),
    ],
)
def test_band_edges(spark, rate, infant, under_five):
    frame = spark.createDataFrame([(rate,)], "r double")
    row = frame.select(
        band_ordinal(F.col("r"), INFANT_BANDS).alias("a"),
        band_ordinal(F.col("r"), UNDER_FIVE_BANDS).alias("b"),
        band_label(F.col("r"), INFANT_BANDS).alias("label"),
    ).first()
    assert (row.a, row.b) == (infant, under_five)
    assert (row.label == "Fora do intervalo") == (infant is None)


def test_rate_without_deaths_or_births(spark):
    frame = spark.createDataFrame([(None, 10), (3, 0), (1, 76)], "n long, d long")
    rates = frame.select(rate_per_thousand(F.col("n"), F.col("d")).alias("v")).collect()
    assert [r.v for r in rates] == [0.0, 0.0, 13.16]


@pytest.mark.parametrize(
    "grain, bucket",
    [
        ("second", dt.datetime(2024, 8, 18, 13, 45, 30)),
        ("minute", dt.datetime(2024, 8, 18, 13, 45)),
        ("hour", dt.datetime(2024, 8, 18, 13)),
        ("day", dt.datetime(2024, 8, 18)),
        ("week", dt.datetime(2024, 8, 12)),
        ("month", dt.datetime(2024, 8, 1)),
        ("quarter", dt.datetime(2024, 7, 1)),
        ("year", dt.datetime(2024, 1, 1)),
        ("week_ending_saturday", dt.datetime(2024, 8, 24)),
        ("week_starting_sunday", dt.datetime(2024, 8, 18)),
    ],
)
def test_grains_of_a_sunday(spark, grain, bucket):
    frame = spark.createDataFrame([(dt.datetime(2024, 8, 18, 13, 45, 30, 5),)], "ts timestamp_ntz")
    assert frame.select(time_grain(F.col("ts"), grain).alias("b")).first().b == bucket


def test_no_grain_and_unknown_grain(spark):
    assert str(time_grain(F.col("ts"), None)) == str(F.col("ts"))
    assert len(GRAINS) == 10
    with pytest.raises(ValueError):
        time_grain(F.col("ts"), "fortnight")


def test_lookups(spark):
    states = lookups.states(spark)
    assert states.count() == states.select("state_code").distinct().count() == 27


def test_source_dates_are_those_of_the_pattern(spark):
    """Eight digits take another way than other texts, and give the same; they see no formatter."""
    from vitalspan.functions.clean import VOCABULARY_DATE, source_date

    texts = ["20000229", "19000229", "31129999", "00000101", "01010000", "1012000", "15821010", "x", "",
             None, "2000 101", "+1231999", "123456789", "20001301", "30022000", "00010101", "٢٠٢٠٠١٠١"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in ("ddMMyyyy", VOCABULARY_DATE):
        old = F.try_to_timestamp(F.lpad("t", 8, "0"), F.lit(pattern)).cast("date")
        both = frame.select("t", source_date(F.col("t"), pattern).cast("string"), old.cast("string"))
        for text, new, expected in both.collect():
            assert new == expected, text
    assert "concat_ws" in source_date(F.col("t"))._jc.toString()
