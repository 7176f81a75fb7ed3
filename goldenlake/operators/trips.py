"""Validated trips to processed trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenlake.functions.columns import elapsed_seconds
from goldenlake.operators.dedupe import survivor
from goldenlake.schemas import PROCESSED_COLUMNS, TRIP_KEY

SURVIVOR_ORDER = (
    "tpep_dropoff_datetime",
    "dolocationid",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
)


def payable_trips(trips: DataFrame) -> DataFrame:
    """Trips with a known payment type above zero that end after they start."""
    return trips.filter("payment_type > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime")


def dedupe_trips(trips: DataFrame) -> DataFrame:
    return survivor(trips, TRIP_KEY, SURVIVOR_ORDER)


def with_trip_metrics(trips: DataFrame) -> DataFrame:
    """Add trip date, minutes and speed. Seconds are computed once and shared by both measures."""
    seconds = F.col("_seconds")
    hours = seconds / F.lit(3600.0)
    return (
        trips.withColumn("_seconds", elapsed_seconds("tpep_pickup_datetime", "tpep_dropoff_datetime"))
        .select(
            *trips.columns,
            F.to_date("tpep_pickup_datetime").alias("trip_date"),
            (seconds / F.lit(60.0)).alias("trip_duration_minutes"),
            F.when(seconds > 0, F.round(F.col("trip_distance") / hours, 2)).alias("speed_mph"),
        )
    )


def measurable(trips: DataFrame) -> DataFrame:
    """Drop trips shorter than a whole second. Runs after deduplication: the survivor is chosen first."""
    return trips.filter("trip_duration_minutes > 0")


def process_trips_v0(validated: DataFrame) -> DataFrame:
    """The earlier processing: trips of any payment type, with their passengers."""
    trips = validated.filter("tpep_dropoff_datetime > tpep_pickup_datetime")
    return measurable(with_trip_metrics(dedupe_trips(trips))).select(*PROCESSED_COLUMNS, "passenger_count")


def process_trips(validated: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    trips = measurable(with_trip_metrics(dedupe_trips(payable_trips(validated))))
    return trips.select(*PROCESSED_COLUMNS, *extra)
