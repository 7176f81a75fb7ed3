from __future__ import annotations

from datetime import datetime

TRIP_SCHEMA = (
    "vendorid int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, "
    "pulocationid int, dolocationid int, payment_type int, fare_amount double, total_amount double, "
    "passenger_count int"
)


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def trip(**changes):
    """A valid trip with some fields changed."""
    fields = {
        "vendorid": 1,
        "pickup": "2024-01-01 10:00:00",
        "dropoff": "2024-01-01 10:30:00",
        "distance": 5.0,
        "pu": 10,
        "do": 20,
        "payment": 1,
        "fare": 20.0,
        "total": 25.0,
        "passengers": 1,
    } | changes
    fields["pickup"], fields["dropoff"] = ts(fields["pickup"]), ts(fields["dropoff"])
    return tuple(fields.values())


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), TRIP_SCHEMA)


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
