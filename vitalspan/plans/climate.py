"""Daily climate and pollution per municipality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalspan import lookups
from vitalspan.functions.clean import number
from vitalspan.operators.conform import conform
from vitalspan.operators.lookup import attach, city_rows
from vitalspan.schemas import CLIMATE_STATISTICS, CLIMATE_VARIABLES, POLLUTANTS, table_schema

_AGGREGATES = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "stdev": F.stddev_samp,
    "sum": F.sum,
}
# fixed values: only these variables have daily sums in the source layout
SUMMED = ("PR", "ETo")


def daily_statistics(
    readings: DataFrame, city: str, day: Column, variables: dict[str, Column]
) -> DataFrame:
    """The source layout (``TMAX_mean``, ...) out of raw readings, one row per city and day.

    Every statistic merges partial results, so a city with most of the readings is reduced
    before the shuffle.
    """
    columns = [value.alias(name) for name, value in variables.items()]
    frame = readings.select(F.col(city).alias("code_muni"), day.alias("date"), *columns)
    aggregates = [
        _AGGREGATES[statistic](name).alias(f"{name}_{statistic}")
        for name in variables
        for statistic in CLIMATE_STATISTICS
        if statistic != "sum" or name in SUMMED
    ]
    return frame.groupBy("code_muni", "date").agg(*aggregates)


def _optional(df: DataFrame, column: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None)


def conform_climate(climate: DataFrame, location: DataFrame) -> DataFrame:
    """``datasus_climate`` rows: city by its code, state and region from source or state list.

    Everything is bound by name, the pollutants too.
    """
    schema = table_schema("datasus_climate")
    columns = {"location_id": "location_id", "city_name": "city", "city_state": "county"}
    code = F.col("location_source_value")
    frame = attach(climate, F.col("code_muni"), city_rows(location), code, columns)
    listed = lookups.states(climate.sparkSession).select(
        F.col("state_code").alias("listed_code"),
        F.col("state_name").alias("listed_name"),
        F.col("region_code").alias("listed_region_code"),
        F.col("region_name").alias("listed_region"),
    )
    frame = frame.join(F.broadcast(listed), F.col("city_state") == F.col("listed_code"), "left")
    values = {
        "location_id": F.col("location_id"),
        "city_code": F.col("code_muni"),
        "city_name": F.col("city_name"),
        "state_code": F.col("code_state"),
        "state_abbreviation": F.col("abbrev_state"),
        "state_name": F.coalesce(_optional(climate, "name_state"), "listed_name"),
        "region_code": F.coalesce(
            number(_optional(climate, "code_region").cast("string"), "float"),
            F.col("listed_region_code").cast("float"),
        ),
        "region_name": F.coalesce(_optional(climate, "name_region"), "listed_region"),
        "measurement_date": F.col("date"),
    }
    for target, source in CLIMATE_VARIABLES.items():
        for statistic in CLIMATE_STATISTICS:
            if statistic != "sum" or source in SUMMED:
                values[f"{target}_{statistic}_value"] = F.col(f"{source}_{statistic}")
    values.update({target: F.col(source) for target, source in POLLUTANTS.items()})
    return conform(frame, schema, values)


# the flat layout: text columns around the day; statistic by statistic, then sums and day counts
FLAT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.TimestampType() if name == "date" else T.StringType())
        for name in [
            "code_muni",
            "abbrev_state",
            "name_state",
            "code_region",
            "name_region",
            "date",
            *[
                f"{variable}_{statistic}"
                for statistic in ("mean", "min", "max", "stdev")
                for variable in ("TMIN", "TMAX", "PR", "ETo", "RH", "Rs", "u2")
            ],
            "PR_sum",
            "ETo_sum",
            "n_days_TN10p",
            "n_days_TX90p",
            "n_days_TX_gd_35",
            "index_level_0__",
        ]
    ]
)


def flat_climate(climate: DataFrame) -> DataFrame:
    """The climate file as it is, under a fixed contract of names and types."""
    missing = set(FLAT_SCHEMA.names) - set(climate.columns)
    if missing:
        raise ValueError(f"source columns missing: {', '.join(sorted(missing))}")
    return conform(climate, FLAT_SCHEMA, {name: F.col(name) for name in FLAT_SCHEMA.names})


def climate_percentiles(climate: DataFrame) -> DataFrame:
    """Per city the 90th percentile of daily maximum and the 10th of daily minimum temperature.

    ``percentile_approx`` keeps a bounded summary per city and merges summaries map-side.
    """
    return climate.groupBy("city_code").agg(
        F.percentile_approx("temperature_max_mean_value", 0.9).alias("tx_90p"),
        F.percentile_approx("temperature_min_mean_value", 0.1).alias("tn_10p"),
    )
