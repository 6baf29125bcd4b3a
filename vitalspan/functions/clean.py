"""Cleaning and parsing of coded source strings.

Source columns are strings that may hold anything, so every conversion is a ``try_`` one: a value
that does not convert becomes null and is dealt with by the row contract, not by a failed job.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EIGHT_DIGITS = "^[0-9]{8}$"
CLOCK_TIME = "^([01][0-9]|2[0-3])[0-5][0-9]$"
MIDNIGHT = "0000"
SOURCE_DATE = "ddMMyyyy"
VOCABULARY_DATE = "yyyyMMdd"


def has_event_date(date: Column) -> Column:
    """True for a present, eight-digit date. ``isNotNull`` is spelled out so that it is pushed."""
    return date.isNotNull() & date.rlike(EIGHT_DIGITS)


def clock_or_midnight(clock: Column) -> Column:
    """A valid ``HHmm`` as it is; null and everything else becomes midnight."""
    return F.when(clock.rlike(CLOCK_TIME), clock).otherwise(F.lit(MIDNIGHT))


def event_timestamp(date: Column, clock: Column | None = None) -> Column:
    """Timestamp of a ``ddMMyyyy`` date and an optional ``HHmm`` clock time.

    Eight digits and a valid clock time are put in the order that a cast reads, as in
    ``source_date``; other texts are left to the pattern.
    """
    plain, day = date.rlike(EIGHT_DIGITS), _iso_day(date, SOURCE_DATE)
    if clock is None:
        clock, moment = F.lit(MIDNIGHT), day
    else:
        clock = F.coalesce(clock, F.lit(MIDNIGHT))
        plain &= clock.rlike(CLOCK_TIME)
        moment = F.concat(day, F.lit(" "), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2))
    text = F.concat(F.lpad(date, 8, "0"), F.lit(" "), F.lpad(clock, 4, "0"))
    parsed = F.try_to_timestamp(text, F.lit(f"{SOURCE_DATE} HHmm"))
    return F.when(plain, moment.try_cast("timestamp")).otherwise(parsed)


def _iso_day(date: Column, pattern: str) -> Column:
    """Eight digits as a cast reads them."""
    year, month, day = (
        F.substring(date, pattern.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd")
    )
    return F.concat_ws("-", year, month, day)


def source_date(date: Column, pattern: str = SOURCE_DATE) -> Column:
    """Date of a digit string, null where it is no date.

    Eight digits are put in the order that a cast reads, which takes a fraction of the time of a
    pattern; other texts are left to the pattern.
    """
    parsed = F.try_to_timestamp(F.lpad(date, 8, "0"), F.lit(pattern)).cast("date")
    return F.when(
        date.rlike(EIGHT_DIGITS), _iso_day(date, pattern).try_cast("date")
    ).otherwise(parsed)


def with_parsed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column whose expression is evaluated once per row.

    Catalyst copies the expression of an ordinary column into each filter and projection above
    it. For a parsed date that means parsing it for the null check, for every range test and for
    the result again. A generator of one row is not copied.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def first_valid_timestamp(*dates: Column) -> Column:
    """The first of several date strings that parses."""
    return F.coalesce(*[event_timestamp(date) for date in dates])


def date_part_or_zero(part: Column) -> Column:
    """A date part, zero where the date is unknown."""
    return F.coalesce(part, F.lit(0))


def number(text: Column, type_name: str = "int") -> Column:
    """Number of a coded string, null where it is none."""
    return text.try_cast(type_name)


def decimal_comma(text: Column, type_name: str = "float") -> Column:
    """Number written with a decimal comma."""
    return F.regexp_replace(text, ",", ".").try_cast(type_name)


def address(*parts: Column) -> Column:
    """Address line of the parts that are present."""
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def plain_code(code: Column) -> Column:
    """A diagnosis code without its dots."""
    return F.regexp_replace(code, r"\.", "")


def in_year(ts: Column, year: int) -> Column:
    """Year slice as a half-open range, which parquet statistics and partitions can use.

    The bounds are text that Spark reads in the column's type and the session's zone. A Python
    moment would be read in the zone of the driver's process.
    """
    return (ts >= F.lit(f"{year:04}-01-01")) & (ts < F.lit(f"{year + 1:04}-01-01"))


def age_in_days(event: Column, birth: Column) -> Column:
    """Whole days from birth to an event."""
    return F.datediff(event, birth)
