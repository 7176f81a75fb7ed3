import pytest
from helpers import trip, trips
from pyspark.sql import functions as F

from goldenlake.operators.quality import (
    GateFailed,
    enforce,
    validation_audit,
    validation_checks,
    with_gate,
)
from goldenlake.operators.rules import TRIP_RULES, TRIP_RULES_V0, broken_rules, flag_rows, split
from goldenlake.schemas import TRIP_COLUMNS
from goldenlake.sources.readers import read_parquet

BAD = {
    "vendor_known": {"vendorid": None},
    "pickup_known": {"pickup": None},
    "dropoff_known": {"dropoff": None},
    "dropoff_after_pickup": {"dropoff": "2024-01-01 10:00:00"},
    "distance_not_negative": {"distance": -0.1},
    "fare_not_negative": {"fare": -1.0},
    "total_not_negative": {"total": -1.0},
    "pickup_zone_known": {"pu": None},
    "dropoff_zone_known": {"do": None},
}
UNCHECKED = [{"distance": None}, {"fare": None}, {"total": None}, {"distance": 0.0}, {"payment": None}, {"distance": float("nan")}]


def test_every_rule_rejects_its_row_and_is_named(spark):
    df = trips(spark, *[trip(**change) for change in BAD.values()])
    flagged = flag_rows(df, TRIP_RULES).withColumn("broken", broken_rules(TRIP_RULES))
    assert not any(r.is_valid for r in flagged.collect())
    assert {name for r in flagged.collect() for name in r.broken} == set(BAD)
    only = {tuple(r.broken) for r in flagged.collect() if r.tpep_pickup_datetime and r.tpep_dropoff_datetime}
    assert all(len(names) == 1 for names in only)


def test_unknown_measures_are_acceptable(spark):
    df = trips(spark, trip(), *[trip(**change) for change in UNCHECKED])
    assert all(r.is_valid for r in flag_rows(df, TRIP_RULES).collect())


def test_earlier_rules_check_passengers_but_not_keys(spark):
    df = trips(spark, trip(vendorid=None, pu=None, do=None), trip(passengers=0), trip(passengers=None))
    assert [r.is_valid for r in flag_rows(df, TRIP_RULES_V0).collect()] == [True, False, True]


def test_split_keeps_every_row_once(spark):
    df = trips(spark, trip(), trip(), *[trip(**c) for c in (*BAD.values(), *UNCHECKED)])
    valid, rejected = split(df, TRIP_RULES, TRIP_COLUMNS)
    assert valid.columns == list(TRIP_COLUMNS) and rejected.columns == df.columns
    assert (valid.count(), rejected.count()) == (2 + len(UNCHECKED), len(BAD))


def test_valid_rows_are_filtered_in_the_scan(spark, tmp_path, plan_of, set_conf):
    set_conf(spark__sql__maxMetadataStringLength="5000")
    trips(spark, trip()).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "t"))
    valid, _ = split(spark.read.parquet(str(tmp_path / "t")), TRIP_RULES, TRIP_COLUMNS)
    plan = plan_of(valid)
    assert "IsNotNull(vendorid)" in plan and "Or(IsNull(fare_amount),GreaterThanOrEqual(fare_amount,0.0))" in plan
    assert "extra" not in plan.split("ReadSchema")[1]
    assert "Exchange" not in plan


def test_audit_and_gate(spark):
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    df = trips(spark, *[trip()] * 9, trip(fare=-1.0))
    row = validation_audit(df, TRIP_RULES, at).first()
    assert (row.rows_in, row.rows_valid, row.rows_quarantined, row.valid_pct) == (10, 9, 1, 0.9)
    enforce(with_gate(validation_audit(df, TRIP_RULES, at), validation_checks()))
    worse = validation_audit(df.union(trips(spark, trip(pu=None))), TRIP_RULES, at)
    with pytest.raises(GateFailed, match=r"0\.8182 below 0\.90"):
        enforce(with_gate(worse, validation_checks()))


def test_no_rows_pass_the_gate(spark):
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    gated = with_gate(validation_audit(trips(spark), TRIP_RULES, at), validation_checks())
    enforce(gated)
    assert gated.first().valid_pct == 0.0


def test_nothing_is_shuffled_before_validation(spark, tmp_path, plan_of, set_conf):
    set_conf(spark__sql__maxMetadataStringLength="5000")
    trips(spark, trip(), trip(fare=-1.0)).coalesce(1).write.parquet(str(tmp_path / "t"))
    valid, _ = split(read_parquet(spark, str(tmp_path / "t")), TRIP_RULES, TRIP_COLUMNS)
    plan = plan_of(valid)
    assert "Exchange" not in plan and "IsNotNull(vendorid)" in plan and "passenger_count" not in plan
    assert valid.count() == 1
