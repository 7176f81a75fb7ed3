import pytest
from helpers import rows
from pyspark.sql import functions as F

from goldenlake.operators import master as m
from goldenlake.operators.quality import BadKeys, duplicate_keys, golden_audit, key_profile, require_keys, require_known

ZONES = "locationid string, zone string, borough string"


def zones(spark, *data):
    return spark.createDataFrame(list(data), ZONES)


@pytest.mark.parametrize("text", [None, "", "  ", "N/A", " na ", "Unknown", "NA"])
def test_null_like_boroughs(spark, text):
    df = zones(spark, ("1", " Midtown ", text))
    assert rows(m.standardize_zones(df)) == [(1, "MIDTOWN", "OUTSIDE NYC")]
    assert rows(m.standardize_zones(df, m.OUTSIDE_MIXED_CASE)) == [(1, "MIDTOWN", "Outside NYC")]


def test_longest_name_survives_and_ties_are_settled(spark):
    df = zones(
        spark, ("1", "ab", "x"), ("1", " abc ", "q"), ("1", "abd", "p"), ("2", None, "x"), ("2", "", "y"), ("3", None, "z")
    )
    assert rows(m.golden_zones(df)) == [(1, "ABC", "Q"), (2, "", "Y"), (3, None, "Z")]


def test_dedupe_by_name_can_merge_locations(spark):
    df = zones(spark, ("5", "a", "x"), ("2", " A", "X"), ("3", "b", None))
    assert rows(m.dedupe_zones_by_name(df)) == [(2, "A", "X"), (3, "B", "Outside NYC")]


def test_vendor_names(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 6, 7, 3, None)], "vendorid int")
    names = {r.vendorid: r.vendor_name for r in m.map_vendor_names(df).collect()}
    assert names == {**m.VENDOR_NAMES, 3: "UNKNOWN", None: "UNKNOWN"}
    assert rows(m.map_vendor_names(df.filter("vendorid = 3"), {3: "new name"})) == [(3, "NEW NAME")]


def test_golden_vendors_are_distinct_before_they_are_named(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 3).cast("int").alias("vendorid"))
    out = m.golden_vendors(df)
    assert rows(out) == [(0, "UNKNOWN"), (1, m.VENDOR_NAMES[1]), (2, m.VENDOR_NAMES[2])]
    above, below = plan_of(m.golden_vendors(df)).split("Exchange", 1)
    assert "vendor_name" in above and "vendor_name" not in below and "partial" not in above
    assert below.count("HashAggregate") == 1  # keys are made distinct on the map side too


def test_vendor_defaults(spark):
    df = spark.createDataFrame(
        [("1", " ab ", "false"), ("2", " ", None), ("x", None, "maybe")],
        "vendor_code string, vendor_name string, active_flag string",
    )
    assert rows(m.vendor_defaults(df)) == sorted(
        [(1, "AB", False), (2, "UNKNOWN", True), (None, "UNKNOWN", None)], key=repr
    )


def test_key_guards(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    assert tuple(key_profile(df, "k").first()) == (5, 2, 1)
    assert rows(duplicate_keys(df.filter("k IS NOT NULL"), "k")) == [(2, 2)]
    with pytest.raises(BadKeys, match="no k"):
        require_keys(df, "k")
    with pytest.raises(BadKeys, match="more than once"):
        require_keys(df.filter("k IS NOT NULL"), "k")
    with pytest.raises(BadKeys, match="empty"):
        require_keys(df.filter("k = 9"), "k")
    assert require_keys(df.filter("k = 1"), "k") == 1
    with pytest.raises(BadKeys):
        require_known(df, "k")
    require_known(df.filter("k = 2"), "k")


def test_malformed_key_is_a_null_key(spark):
    with pytest.raises(BadKeys, match="1 rows have no locationid"):
        require_keys(m.standardize_zones(zones(spark, ("abc", "z", "b"), ("1", "z", "b"))), "locationid")


def test_golden_audit(spark):
    df = m.standardize_zones(zones(spark, ("1", "a", "x"), ("1", "b", "x"), ("2", "a", "x")))
    row = golden_audit(df, "locationid", {"business_key": "LocationID"}, F.lit("2024-01-01").cast("timestamp_ntz")).first()
    assert (row.rows_in, row.rows_out, row.duplicates_removed, row.business_key) == (3, 2, 1, "LocationID")
