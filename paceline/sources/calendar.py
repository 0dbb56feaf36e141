"""Season calendars."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.operators.keyed import top_by


def season(calendar: DataFrame) -> DataFrame:
    """Races without test events, in order of their round."""
    return calendar.where(F.coalesce(F.lower("EventFormat"), F.lit("")) != "testing").orderBy("RoundNumber")


def next_race(calendar: DataFrame, as_of: datetime.datetime | str) -> DataFrame:
    """The first race after ``as_of``, or no row."""
    later = calendar.where(F.col("Session5DateUtc") > F.lit(as_of).cast(dict(calendar.dtypes)["Session5DateUtc"]))
    return (later.orderBy("Session5DateUtc", "RoundNumber").limit(1)
            .select(F.col("RoundNumber").alias("round_number"), F.col("EventName").alias("event_name"),
                    F.col("Country").alias("country"), F.col("Location").alias("location"),
                    F.col("Session5DateUtc").alias("race_date"), F.col("EventDate").alias("event_date")))


def next_race_per_season(calendar: DataFrame, as_of: datetime.datetime | str) -> DataFrame:
    """The first race after ``as_of`` of every season in the table."""
    later = calendar.where(F.col("Session5DateUtc") > F.lit(as_of).cast(dict(calendar.dtypes)["Session5DateUtc"]))
    return top_by(later, ["year"], [F.col("Session5DateUtc"), F.col("RoundNumber")], 1).drop("_rn")


def save(calendar: DataFrame, path: str) -> None:
    """Write by season; seasons not in the table stay as they are."""
    (calendar.repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(path))
