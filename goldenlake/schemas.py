"""Logical schemas. Names are lower case; Spark resolves them case-insensitively."""

from __future__ import annotations

# Types that arriving trips are cast to. "time" keeps either Spark timestamp type and parses text.
TRIP_TYPES = {
    "vendorid": "int",
    "tpep_pickup_datetime": "time",
    "tpep_dropoff_datetime": "time",
    "trip_distance": "double",
    "pulocationid": "int",
    "dolocationid": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "total_amount": "double",
}
TRIP_COLUMNS = tuple(TRIP_TYPES)

# What identifies a trip.
TRIP_KEY = ("vendorid", "tpep_pickup_datetime", "pulocationid")

# The columns of processed trips, in order.
PROCESSED_COLUMNS = (
    "vendorid",
    "pulocationid",
    "dolocationid",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_date",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
    "trip_duration_minutes",
    "speed_mph",
)

# Fields that a complete fact row must carry.
REQUIRED_FACT_FIELDS = ("vendor_key", "pickup_zone_key", "trip_date", "fare_amount", "total_amount")

COMMIT_SCHEMA = (
    "version int, run_id string, run_ts timestamp_ntz, operation string, rows_inserted bigint, "
    "rows_expired bigint, rows_current bigint, metadata string"
)

# One row of a dated table's record: a date, the rows a run left of it and their fingerprint.
DATES_SCHEMA = "part date, rows bigint, content string, run_ts timestamp_ntz"

# One row of a run's ledger: a step that has ended.
STEP_SCHEMA = "step int, name string, rows_in bigint, rows_out bigint, status string"

SCD2_AUDIT_SCHEMA = (
    "run_id string, run_ts timestamp_ntz, rows_in_golden bigint, changed_input_rows bigint, changed_keys bigint, "
    "rows_inserted bigint, rows_expired bigint, note string, commit_version int, commit_operation string, "
    "commit_ts timestamp_ntz, commit_metadata string, source_path string, target_path string"
)

# Fixed values. Serving tables: target column -> source column, in table order.
ZONE_DIM = {
    "zone_key": "zone_key",
    "location_id": "locationid",
    "zone": "zone",
    "borough": "borough",
    "version_number": "version_number",
    "is_current": "is_current",
    "start_date": "start_date",
    "end_date": "end_date",
    "hash_diff": "hash_diff",
}
VENDOR_DIM = {
    "vendor_key": "vendor_key",
    "vendorid": "vendorid",
    "vendor_name": "vendor_name",
    "version_number": "version_number",
    "is_current": "is_current",
    "start_date": "start_date",
    "end_date": "end_date",
    "hash_diff": "hash_diff",
}
FACT_TRIPS = {
    "vendorid": "vendorid",
    "pickup_location_id": "pickup_location_id",
    "dropoff_location_id": "dropoff_location_id",
    "vendor_key": "vendor_key",
    "pickup_zone_key": "pickup_zone_key",
    "trip_date": "trip_date",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
    "trip_duration_minutes": "trip_duration_minutes",
    "speed_mph": "speed_mph",
    "zone_orphan_flag": "zone_orphan_flag",
    "vendor_orphan_flag": "vendor_orphan_flag",
}
