"""The driver's tables seen as the engine's inputs (FIXTURES.md, part B). Every binding covers whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenlake.layout import Run
from goldenlake.sources.readers import read_parquet

# Clock readings of the dimension batches.
BATCHES = {
    1: Run("batch-1", "2024-01-01 00:00:00"),
    2: Run("batch-2", "2024-02-01 00:00:00"),
    3: Run("batch-3", "2024-03-01 00:00:00"),
    4: Run("batch-4", "2024-04-01 00:00:00"),
}
AUDIT_TS = "2024-05-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, with keys in types other than the canonical ones and two extra columns."""
    pickup = "timestampadd(HOUR, l_linenumber, o_orderdate)"
    # Orders meet their customers first: line items, by far the most rows, are shuffled once.
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "CASE WHEN l_orderkey % 499 <> 0 THEN l_suppkey % 8 END AS vendorid",
            f"CASE WHEN l_partkey % 997 <> 0 THEN {pickup} END AS tpep_pickup_datetime",
            f"timestampadd(MINUTE, CAST(l_quantity - 1 AS int), {pickup}) AS tpep_dropoff_datetime",
            "CASE WHEN l_partkey % 500 = 0 THEN -1D WHEN l_partkey % 501 = 0 THEN NULL ELSE l_quantity END "
            "AS trip_distance",
            "CAST(c_nationkey + CASE WHEN l_partkey % 300 = 0 THEN 100 ELSE 0 END AS double) AS pulocationid",
            "l_partkey % 25 AS dolocationid",
            "CAST(l_linenumber - 1 AS string) AS payment_type",
            "c_acctbal + 900 AS fare_amount",
            "l_extendedprice * (1 - l_discount) AS total_amount",
            "CASE WHEN l_partkey % 503 <> 0 THEN CAST(l_suppkey % 5 AS int) END AS passenger_count",
            "l_returnflag AS store_and_fwd_flag",
        )
    )


def zones_raw(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """One zone record per customer, as text. From batch 2 on, nation 3 is closed and every region adds a catch-all
    zone; in batches 2 and 3 the zones of Africa carry another borough."""
    borough = (
        "CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN ' unknown ' "
        "WHEN 4 THEN 'na' ELSE r_name END"
    )
    if batch in (2, 3):
        borough = f"CASE WHEN r_name = 'AFRICA' THEN 'moved' ELSE {borough} END"
    region = table(spark, sf_dir, "region")
    records = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    if batch > 1:
        records = records.filter("n_name <> 'NATION_3'")
    zones = records.selectExpr(
        "CAST(c_nationkey AS string) AS locationid",
        "concat('  ', c_name, repeat(' x', CAST(c_custkey % 9 AS int))) AS zone",
        f"{borough} AS borough",
    )
    if batch > 1:
        zones = zones.unionByName(
            region.selectExpr(
                "CAST(25 + r_regionkey AS string) AS locationid", "concat('all ', r_name) AS zone", "r_name AS borough"
            )
        )
    return zones


def trips_first_delivery(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """What arrived of the trips before the last delivery: those of the two latest pickup dates are late, and on the earliest
    date amounts are one too high. ``trips`` are all trips, where the caller has them as a written table."""
    trips = trips_raw(spark, sf_dir) if trips is None else trips
    day = F.to_date("tpep_pickup_datetime")
    first, last = trips.agg(F.min(day), F.max(day)).first()
    early = day.isNull() | (day < F.date_sub(F.lit(last), 1))
    amount = F.when(day == F.lit(first), F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    return trips.filter(early).withColumn("total_amount", amount)


def zones_in_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Zone records as CSV folders with headers of different order and case. Where
    the name's length leaves 2 when divided by 3, the line has a field too many."""
    records = zones_raw(spark, sf_dir).withColumn("kind", F.pmod(F.length("zone"), F.lit(3)))
    columns = {0: ["locationid", "zone", "borough"], 1: ["BOROUGH", "LocationID", "Zone"]}
    for kind, names in columns.items():
        own = records.filter(F.col("kind") == kind).select(*names)
        own.write.option("header", True).csv(f"{folder}/{kind}")
    lines = records.filter("kind = 2").select(F.concat_ws(",", "locationid", "zone", F.coalesce("borough", F.lit("")), F.lit("more")).alias("value"))
    header = spark.createDataFrame([("locationid,zone,borough",)], "value string")
    header.unionByName(lines).coalesce(1).write.text(f"{folder}/2")
    return folder


def vendors_raw(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """The earlier vendor master, one text record per supplier: padded, empty and missing names, missing flags. In batch 2
    every fifth supplier is gone and flags are dealt otherwise."""
    suppliers = table(spark, sf_dir, "supplier")
    if batch == 2:
        suppliers = suppliers.filter("s_suppkey % 5 <> 0").withColumn("s_nationkey", F.expr("s_nationkey + s_suppkey % 2"))
    return suppliers.selectExpr(
        "CAST(s_suppkey AS string) AS vendor_code",
        "CASE s_suppkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE concat(' ', s_name, ' ') END AS vendor_name",
        "CASE s_nationkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS active_flag",
    )
