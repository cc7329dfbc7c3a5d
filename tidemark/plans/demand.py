"""Expected turnstile entries per station and hour."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expected_count

DAY_COLUMNS = {"weekday": "avg_weekday_rides", "saturday": "avg_saturday_rides",
               "sunday": "avg_sunday-holiday_rides"}


def day_kind(date: dt.date) -> str:
    """weekday, saturday or sunday."""
    return {5: "saturday", 6: "sunday"}.get(date.weekday(), "weekday")


def hourly(stations: DataFrame, curve: DataFrame) -> DataFrame:
    """Each station once per hour of the day, with the hour's share of the day.

    The hours are generated next to the station and the curve is looked up by
    hour. The curve is first reduced to the 24 hours of a day, one row each, so
    it is always small enough to broadcast.
    """
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    shares = (
        curve.filter(F.col("hour").between(0, 23))
        .groupBy("hour").agg(F.max("ridership_ratio").alias("ridership_ratio"))
    )
    return stations.withColumn("hour", hours).join(F.broadcast(shares), "hour", "inner")


def expected_entries(seed: DataFrame, curve: DataFrame, kind: str = "weekday",
                     steps_per_hour: int = 1) -> DataFrame:
    """Whole entries per station, hour and step on one kind of day."""
    rides = F.col(f"`{DAY_COLUMNS[kind]}`")
    stations = seed.select("station_id", rides.alias("rides"))
    return hourly(stations, curve).select(
        "station_id", "hour",
        expected_count(F.col("rides"), F.col("ridership_ratio"), steps_per_hour)
        .alias("entries"),
    )


def expected_entries_on(seed: DataFrame, curve: DataFrame, date: dt.date,
                        steps_per_hour: int = 1) -> DataFrame:
    """The same for a date, by its kind of day."""
    return expected_entries(seed, curve, day_kind(date), steps_per_hour)
