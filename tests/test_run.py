import pytest
from helpers import rows, trip, trips
from pyspark.sql import functions as F

from goldenlake.layout import Layout, Run
from goldenlake.operators.quality import GateFailed
from goldenlake.plans.run import STEPS, Config, dimension, fact_table, run_all


def lake(spark, root, data, zones):
    layout = Layout(str(root))
    trips(spark, *data).withColumn("payment_type", F.col("payment_type").cast("string")).write.mode("overwrite").parquet(
        layout.path("raw", "trips")
    )
    spark.createDataFrame(zones, "LocationID string, Zone string, Borough string").write.mode("overwrite").option(
        "header", True
    ).csv(layout.path("raw", "zones"))
    return layout


GOOD = [trip(pu=p, vendorid=v) for p in (1, 2) for v in (1, 2, 3)] * 2
SHORT = trip(pu=1, vendorid=9, pickup="2024-01-03 00:00:00.1", dropoff="2024-01-03 00:00:00.2")
ZONES = [("1", "a", "X"), ("1", "abc", None), ("2", "b", "na")]


def test_two_runs(spark, tmp_path):
    layout = lake(spark, tmp_path, [*GOOD, SHORT, trip(fare=-1.0)], ZONES)
    first = Config(layout, Run("one", "2024-02-01 00:00:00"), database="run_test")
    summary = {r.name: (r.rows_in, r.rows_out, r.status) for r in run_all(spark, first).collect()}
    assert summary == {
        "validate": (14, 13, "SUCCESS"),
        "process": (13, 6, "SUCCESS"),
        "master_zones": (3, 2, "SUCCESS"),
        "master_vendors": (6, 3, "SUCCESS"),
        "dim_zones": (2, 2, "first_run"),
        "dim_vendors": (3, 3, "first_run"),
        "fact_trips": (6, 6, "SUCCESS"),
        "load": (6, 6, "SUCCESS"),
        "governance": (6, 6, "PASS"),
    }
    audit = spark.read.json(layout.path("audit", "process")).first()
    assert (audit.rows_in, audit.rows_after_dedupe, audit.rows_out) == (13, 7, 6)
    assert spark.read.parquet(layout.path("quarantine", "trips")).columns[-2:] == ["passenger_count", "run_id"]

    lake(spark, tmp_path, GOOD, [("1", "abc", None), ("2", "longer", "na")])
    second = Config(layout, Run("two", "2024-03-01 00:00:00"), database="run_test")
    again = {r.name: (r.rows_out, r.status) for r in run_all(spark, second).collect()}
    assert again["dim_zones"] == (1, "merge_scd2") and again["dim_vendors"] == (0, "noop_no_changes")
    assert dimension(spark, second, "zones").read().count() == 3
    assert spark.read.parquet(layout.path("backup", "raw_snapshot")).groupBy("run_id").count().count() == 2
    assert spark.table("run_test.zone_dim").count() == 3
    assert spark.table("run_test.curated_daily_revenue").first().revenue == 150.0
    assert spark.read.json(layout.path("audit", "governance")).count() == 2


def test_bad_input_stops_the_run_but_leaves_its_evidence(spark, tmp_path):
    layout = lake(spark, tmp_path, [trip(), trip(fare=-1.0)], ZONES)
    with pytest.raises(GateFailed, match="0.5000"):
        run_all(spark, Config(layout, Run("bad", "2024-02-01 00:00:00"), database="bad_test"))
    assert spark.read.json(layout.path("audit", "validate")).first().valid_pct == 0.5
    assert spark.read.parquet(layout.path("quarantine", "trips")).count() == 1
    assert not (tmp_path / "processed").exists()


def read_back(spark, config):
    """Everything that a run publishes or keeps, without file names."""
    frames = [spark.table(f"{config.database}.{t}") for t in (
        "fact_trips", "zone_dim", "vendor_dim", "agg_daily_zone_revenue", "agg_daily_vendor_perf", "curated_fact_trips",
        "curated_daily_revenue", "zone_dim__runs", "fact_trips__runs",
    )]
    frames += [fact_table(spark, config).records(), dimension(spark, config, "zones").read(), dimension(spark, config, "vendors").history().drop("metadata")]
    audits = ("validate", "process", "master_zones", "master_vendors", "scd2_zones", "scd2_vendors", "fact_trips", "load", "governance")
    frames += [spark.read.json(config.path("audit", a)).drop("targets", "commit_metadata", "source_path", "target_path", "sources") for a in audits]
    return [rows(f) for f in frames]


def test_a_run_that_fails_at_every_step_ends_like_one_that_does_not(spark, tmp_path):
    """Each step dies once after its work is done but before it is noted, so each is repeated in full."""
    data = [*GOOD, SHORT, trip(fare=-1.0)]
    whole, broken = (
        Config(lake(spark, tmp_path / name, data, ZONES), Run("one", "2024-02-01 00:00:00"), database=f"restart_{name}")
        for name in ("whole", "broken")
    )
    wanted = rows(run_all(spark, whole))
    died = set()

    def fragile(step):
        def run(spark, c):
            audit = step.run(spark, c)
            if step.name not in died:
                died.add(step.name)
                raise RuntimeError(f"lost after {step.name}")
            return audit

        return step._replace(run=run)

    steps = tuple(fragile(s) for s in STEPS)
    for number, step in enumerate(STEPS):
        with pytest.raises(RuntimeError, match=f"lost after {step.name}"):
            run_all(spark, broken, steps)
        assert len(died) == number + 1
    summary = run_all(spark, broken, steps)
    assert rows(summary) == wanted and read_back(spark, broken) == read_back(spark, whole)
    # Once more: everything is in the ledger, nothing runs.
    assert rows(run_all(spark, broken, tuple(s._replace(run=None) for s in STEPS))) == wanted


def test_second_run_writes_two_dates(spark, tmp_path):
    """A late date and a correction; the files of other dates keep their names, readers of the first run their rows."""
    late = {"pickup": "2024-01-02 10:00:00", "dropoff": "2024-01-02 11:00:00"}
    third = {"pickup": "2024-01-03 10:00:00", "dropoff": "2024-01-03 11:00:00"}
    first = Config(lake(spark, tmp_path, [*GOOD, trip(pu=1, **third), trip(pu=2, **third)], ZONES), Run("one", "2024-02-01 00:00:00"), database="two_dates")
    run_all(spark, first)
    before = {p.name for p in (tmp_path / "curated").rglob("*.parquet")}
    held = fact_table(spark, first).read()
    held_rows = rows(held)
    lake(spark, tmp_path, [*GOOD, trip(pu=1, total=99.0, **third), trip(pu=2, **third), trip(pu=1, **late)], ZONES)
    second = Config(first.layout, Run("two", "2024-03-01 00:00:00"), database="two_dates")
    run_all(spark, second)
    table = fact_table(spark, second)
    assert {(str(r.part), r.rows) for r in table.touched(second.run).collect()} == {("2024-01-02", 1), ("2024-01-03", 2)}
    assert before <= {p.name for p in (tmp_path / "curated").rglob("*.parquet")}
    assert rows(held) == held_rows  # a reader of the first run is not disturbed
    audit = spark.read.json(second.path("audit", "fact_trips")).filter("run_id = 'two'").first()
    assert (audit.rows_total, audit.dates_written, audit.rows_written) == (9, 2, 3)
    assert rows(spark.table("two_dates.curated_fact_trips").select("trip_date", "total_amount")) == rows(table.read().select("trip_date", "total_amount"))
    assert spark.table("two_dates.curated_daily_revenue").agg(F.sum("revenue")).first()[0] == 6 * 25 + 99 + 25 + 25


def test_moved_zone_touches_its_dates_only(spark, tmp_path):
    day2 = {"pickup": "2024-01-02 10:00:00", "dropoff": "2024-01-02 11:00:00"}
    first = Config(lake(spark, tmp_path, [trip(pu=1), trip(pu=2, **day2)], ZONES), Run("one", "2024-02-01 00:00:00"), database="moved_zone")
    run_all(spark, first, STEPS[:7])
    lake(spark, tmp_path, [trip(pu=1), trip(pu=2, **day2)], [("1", "abc", None), ("2", "other", "na")])
    second = Config(first.layout, Run("two", "2024-03-01 00:00:00"), database="moved_zone")
    run_all(spark, second, STEPS[:7])
    table = fact_table(spark, second)
    assert [str(r.part) for r in table.touched(second.run).collect()] == ["2024-01-02"]
    keys = dimension(spark, second, "zones").current().select("locationid", "zone_key")
    assert rows(table.read().select("pickup_location_id", "pickup_zone_key")) == rows(keys)


def test_malformed_zone_lines_are_set_aside(spark, tmp_path):
    layout = lake(spark, tmp_path, GOOD, ZONES)
    (tmp_path / "raw" / "zones" / "more.csv").write_text("Borough,Zone,LocationID\nX,far longer,1\nX,2\n")
    config = Config(layout, Run("one", "2024-02-01 00:00:00"), database="malformed_zones")
    summary = {r.name: (r.rows_in, r.rows_out) for r in run_all(spark, config, STEPS[:3]).collect()}
    assert summary["master_zones"] == (5, 2)
    assert rows(spark.read.parquet(layout.path("quarantine", "zones")).select("line")) == [("X,2",)]
    audit = spark.read.json(layout.path("audit", "master_zones")).first()
    assert (audit.rows_malformed, audit.duplicates_removed) == (1, 2)
    assert rows(spark.read.parquet(layout.path("master", "zones")).filter("locationid = 1").select("zone")) == [("FAR LONGER",)]


def test_unknown_zone_of_the_lake(tmp_path):
    with pytest.raises(ValueError, match="unknown zone"):
        Layout(str(tmp_path)).path("row", "trips")
