"""Golden master records for zones and vendors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.functions.columns import blank
from goldenlake.operators.dedupe import survivor

# The label of a zone without a usable borough (golden spelling and dimension spelling), the borough
# texts that mean "unknown", and the vendor dictionary with its fallback name.
OUTSIDE = "OUTSIDE NYC"
OUTSIDE_MIXED_CASE = "Outside NYC"
UNKNOWN_BOROUGHS = ("UNKNOWN", "N/A", "NA")
VENDOR_NAMES = {
    1: "CREATIVE MOBILE TECHNOLOGIES, LLC",
    2: "CURB MOBILITY, LLC",
    6: "MYLE TECHNOLOGIES INC",
    7: "HELIX",
}
UNKNOWN_VENDOR = "UNKNOWN"

ZONE_TYPES = {"locationid": "int", "zone": "string", "borough": "string"}


def _standard_borough(borough: Column, outside: str) -> Column:
    known = ~blank(borough) & ~F.upper(borough).isin(*UNKNOWN_BOROUGHS)
    return F.when(known, F.upper(borough)).otherwise(F.lit(outside))


def standardize_zones(zones: DataFrame, outside: str = OUTSIDE) -> DataFrame:
    """Trimmed upper-case zone and borough; an absent or null-like borough becomes ``outside``."""
    return zones.select(
        F.col("locationid").try_cast("int").alias("locationid"),
        F.upper(F.trim("zone")).alias("zone"),
        _standard_borough(F.trim("borough"), outside).alias("borough"),
    )


def golden_zones(zones: DataFrame) -> DataFrame:
    """The longest zone name per location survives; ties go to the smaller name, then the smaller borough."""
    longest_first = -F.coalesce(F.length("zone"), F.lit(-1))  # a missing name loses to every other one
    return survivor(standardize_zones(zones), ["locationid"], [longest_first, "zone", "borough"])


def dedupe_zones_by_name(zones: DataFrame) -> DataFrame:
    """The earlier zone master: one location per (borough, zone) name, the smallest survives."""
    return survivor(standardize_zones(zones, OUTSIDE_MIXED_CASE), ["borough", "zone"], ["locationid"])


def vendor_name(vendorid: Column, names: Mapping[int, str] = VENDOR_NAMES) -> Column:
    lookup = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return F.coalesce(F.upper(F.try_element_at(lookup, vendorid)), F.lit(UNKNOWN_VENDOR))


def map_vendor_names(df: DataFrame, names: Mapping[int, str] = VENDOR_NAMES) -> DataFrame:
    return df.withColumn("vendor_name", vendor_name(F.col("vendorid"), names))


def golden_vendors(trips: DataFrame, names: Mapping[int, str] = VENDOR_NAMES) -> DataFrame:
    """The vendors that occur in trips. Keys are made distinct (map side first) before any name is looked up."""
    return map_vendor_names(trips.select(F.col("vendorid").try_cast("int").alias("vendorid")).distinct(), names)


def vendor_defaults(vendors: DataFrame) -> DataFrame:
    """The earlier vendor master: an empty name becomes the fallback, a missing active flag becomes true."""
    name = F.upper(F.trim("vendor_name"))
    return vendors.select(
        F.col("vendor_code").try_cast("int").alias("vendor_code"),
        F.when(blank(name), F.lit(UNKNOWN_VENDOR)).otherwise(name).alias("vendor_name"),
        F.when(F.col("active_flag").isNull(), F.lit(True))
        .otherwise(F.col("active_flag").try_cast("boolean"))
        .alias("active_flag"),
    )
