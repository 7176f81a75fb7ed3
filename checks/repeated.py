"""Each step of the run beside the same step with one action per figure and per output.

    python -m checks.repeated [sf_dir] [cpus] [copies]

The repeated variants use the same operators, but count every frame on its own and compute it again for every count and
write. The difference is what counting from written files and one-pass aggregates save. ``copies`` repeats the trips,
each copy shifted by a week, to see how the difference grows. Prints one JSON line.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import AUDIT_TS, trips_raw, zones_raw
from goldenlake.layout import Layout, Run
from goldenlake.operators.fact import conform_fact
from goldenlake.operators.master import golden_vendors
from goldenlake.operators.normalize import normalize_types
from goldenlake.operators.rules import TRIP_RULES, split
from goldenlake.operators.trips import dedupe_trips, payable_trips, process_trips
from goldenlake.plans import run as steps
from goldenlake.schemas import REQUIRED_FACT_FIELDS, TRIP_COLUMNS, TRIP_TYPES
from goldenlake.session import local_session, shared_folder
from goldenlake.sources.writers import export_csv, overwrite


def _write(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)


def validate(spark: SparkSession, c: steps.Config, out: str) -> None:
    typed = normalize_types(spark.read.parquet(c.path("raw", "trips")), TRIP_TYPES)
    frames = [typed, *split(typed, TRIP_RULES, TRIP_COLUMNS)]
    for df in frames:
        df.count()
    for number, df in enumerate(frames):
        _write(df, f"{out}/{number}")


def process(spark: SparkSession, c: steps.Config, out: str) -> None:
    validated = steps.of_run(spark, c, "validated", "trips")
    processed = process_trips(validated)
    for df in (validated, dedupe_trips(payable_trips(validated)), processed):
        df.count()
    _write(processed, out)


def master_vendors(spark: SparkSession, c: steps.Config, out: str) -> None:
    trips = steps.processed_trips(spark, c)
    golden = golden_vendors(trips)
    for df in (trips, trips.filter("vendorid IS NULL"), golden):
        df.count()
    _write(golden, out)


def fact(spark: SparkSession, c: steps.Config, out: str) -> None:
    dims = [steps.dimension(spark, c, name).current() for name in ("zones", "vendors")]
    rows = conform_fact(steps.processed_trips(spark, c), *dims)
    _write(rows, out)
    for df in (rows, rows.filter("zone_orphan_flag"), rows.filter("vendor_orphan_flag")):
        df.count()


def govern(spark: SparkSession, c: steps.Config, out: str) -> None:
    rows = steps.fact_table(spark, c).read()
    incomplete = " OR ".join(f"{f} IS NULL" for f in REQUIRED_FACT_FIELDS)
    for df in (rows, rows.filter("zone_orphan_flag"), rows.filter("vendor_orphan_flag"), rows.filter(incomplete)):
        df.count()
    for name in ("zones", "vendors"):
        steps.dimension(spark, c, name).current().count()


STEPS = {
    "validate": (steps.validate, validate),
    "process": (steps.process, process),
    "master_vendors": (steps.master_vendors, master_vendors),
    "fact": (steps.build_fact, fact),
    "govern": (steps.govern, govern),
}


def copied(trips: DataFrame, copies: int) -> DataFrame:
    shifted = {t: F.expr(f"timestampadd(DAY, 7 * copy, {t})") for t in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    return trips.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumns(shifted).drop("copy")


def main(sf_dir: str = "/root/testdata/sf0.1", cpus: str = "8", copies: str = "1") -> None:
    spark = local_session(cpus, "goldenlake-repeated", **{"spark.sql.shuffle.partitions": cpus})
    tracker = spark.sparkContext.statusTracker()
    folder = shared_folder(spark)
    c = steps.Config(Layout(folder), Run("repeated", AUDIT_TS), fact_partition="trip_month")
    overwrite(copied(trips_raw(spark, sf_dir).repartition(int(cpus)), int(copies)), c.path("raw", "trips"))
    export_csv(zones_raw(spark, sf_dir), c.path("raw", "zones"))
    steps.run_all(spark, c)

    def measure(name: str, action) -> dict[str, float]:
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        action()
        return {"seconds": round(time.perf_counter() - start, 2), "jobs": len(tracker.getJobIdsForGroup(name))}

    figures = {}
    for name, (ours, again) in STEPS.items():
        ours(spark, c), again(spark, c, f"{folder}/again/{name}")
        figures[name] = {
            "ours": measure(f"{name}-ours", lambda ours=ours: ours(spark, c)),
            "repeated": measure(f"{name}-again", lambda name=name, again=again: again(spark, c, f"{folder}/again/{name}")),
        }
    spark.stop()
    print(json.dumps(figures))


if __name__ == "__main__":
    main(*sys.argv[1:])
