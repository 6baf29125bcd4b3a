"""Rates and bands."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Band(NamedTuple):
    """A labelled range. Bands are tried in order; an absent edge is open."""

    label: str
    ordinal: int
    low: float | None
    high: float | None
    low_closed: bool = True
    high_closed: bool = True

    def holds(self, value: Column) -> Column:
        tests = []
        if self.low is not None:
            tests.append(value >= self.low if self.low_closed else value > self.low)
        if self.high is not None:
            tests.append(value <= self.high if self.high_closed else value < self.high)
        test = tests[0]
        for other in tests[1:]:
            test = test & other
        return test


# fixed values: published thresholds per thousand births, with the gap between 16.0 and 16.1
INFANT_BANDS = (
    Band("< 11,0", 1, None, 11.0),
    Band("11,1 - 13,1", 2, 11.0, 13.0),
    Band("13,1 - 16,0", 3, 13.0, 16.0),
    Band("16,1 - 19,9", 4, 16.1, 19.9),
    Band("19,9 >", 5, 19.9, None, low_closed=False),
)
UNDER_FIVE_BANDS = (
    Band("< 11,0", 1, None, 11.0, high_closed=False),
    Band("11,1 - 13,0", 2, 11.0, 13.0),
    Band("13,1 - 16,0", 3, 13.0, 16.0),
    Band("16,1 - 19,9", 4, 16.1, 19.9),
    Band("19,9 >", 5, 19.9, None, low_closed=False),
)
OUT_OF_RANGE = "Fora do intervalo"


def rate_per_thousand(events: Column, population: Column) -> Column:
    """Events per thousand, two decimals, zero where there were none."""
    rate = F.try_divide(events * F.lit(1000.0), population.cast("double"))
    return F.round(F.coalesce(rate, F.lit(0.0)), 2)


def band_label(value: Column, bands: Sequence[Band]) -> Column:
    """Label of the first band that holds the value."""
    chain = F
    for band in bands:
        chain = chain.when(band.holds(value), F.lit(band.label))
    return chain.otherwise(F.lit(OUT_OF_RANGE))


def band_ordinal(value: Column, bands: Sequence[Band]) -> Column:
    """Ordinal of the first band that holds the value, null outside all of them."""
    chain = F
    for band in bands:
        chain = chain.when(band.holds(value), F.lit(band.ordinal))
    return chain
