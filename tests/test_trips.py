import random

from helpers import rows, trip, trips, ts
from pyspark.sql import functions as F

from goldenlake.operators.dedupe import survivor
from goldenlake.operators.quality import process_audit
from goldenlake.operators.trips import dedupe_trips, payable_trips, process_trips
from goldenlake.schemas import PROCESSED_COLUMNS, TRIP_COLUMNS


def test_payment_filter_drops_zero_and_unknown(spark):
    df = trips(spark, trip(payment=0), trip(payment=None), trip(payment=-1), trip(payment=2))
    assert [r.payment_type for r in payable_trips(df).collect()] == [2]


def test_metrics(spark):
    out = process_trips(trips(spark, trip(distance=10.0), trip(pu=11, distance=None)))
    assert out.columns == list(PROCESSED_COLUMNS)
    by_zone = {r.pulocationid: r for r in out.collect()}
    assert str(by_zone[10].trip_date) == "2024-01-01"
    assert (by_zone[10].trip_duration_minutes, by_zone[10].speed_mph) == (30.0, 20.0)
    assert by_zone[11].speed_mph is None


def test_trip_shorter_than_a_second_is_dropped_after_it_won(spark):
    short = trip(pickup="2024-01-01 10:00:00.100", dropoff="2024-01-01 10:00:00.900")
    rival = trip(pickup="2024-01-01 10:00:00.100", dropoff="2024-01-01 10:20:00")
    assert process_trips(trips(spark, short, rival)).count() == 0
    crossing = trip(pickup="2024-01-01 10:00:00.900", dropoff="2024-01-01 10:00:01.100")
    assert [r.trip_duration_minutes for r in process_trips(trips(spark, crossing)).collect()] == [1 / 60.0]


def test_survivor_is_the_same_in_any_order(spark):
    same = [trip(do=d, fare=f, distance=x) for d in (3, 1, None) for f in (2.0, None) for x in (1.0, 4.0)]
    winners = set()
    for seed in range(3):
        random.Random(seed).shuffle(same)
        (winner,) = rows(dedupe_trips(trips(spark, *same).repartition(4).select(*TRIP_COLUMNS)))
        winners.add(winner)
    assert len(winners) == 1
    assert next(iter(winners))[5] is None  # nulls first


def test_survivor_against_brute_force(spark):
    rng = random.Random(7)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), rng.randint(0, 3), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, g string, o int, v double")
    expected = {}
    for row in data:
        key = row[:2]
        if key not in expected or row[2:] < expected[key][2:]:
            expected[key] = row
    assert rows(survivor(df, ["k", "g"], ["o"])) == sorted(expected.values(), key=repr)


def test_hot_key_is_cut_down_before_the_shuffle(spark, plan_of):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = survivor(df.repartition(4), ["k"], ["v"])
    plan = plan_of(out)
    assert "1, Partial" in plan and "1, Final" in plan
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 0").first().v == 0


def test_process_audit(spark):
    df = trips(spark, trip(), trip(do=99), trip(payment=0), trip(pu=2, pickup="2024-01-01 10:29:59.900", dropoff="2024-01-01 10:29:59.950"))
    row = process_audit(df, F.lit("2024-01-01").cast("timestamp_ntz")).first()
    assert (row.rows_in, row.rows_after_dedupe, row.rows_out, row.dedupe_reduction_pct) == (4, 2, 1, 0.5)
    assert row.run_ts == ts("2024-01-01 00:00:00")
    empty = process_audit(trips(spark), F.lit("2024-01-01").cast("timestamp_ntz")).first()
    assert (empty.rows_in, empty.rows_out, empty.dedupe_reduction_pct) == (0, 0, 0.0)
