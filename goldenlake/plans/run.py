"""The whole run, in order: validate, process, master, dimensions, fact, catalog, serving, governance.

One Spark application calls the operators; datasets are handed over as parquet at each zone boundary, so no lineage is
longer than one step and a lost executor repeats tasks of that step only. Counts come from written files.

A run can be repeated. Every step writes below folders of its own run and reads what the steps before left there, so nothing that a
reader uses is overwritten. A step that has ended is noted in the run's ledger; a run that stopped goes on, under the same
``Config``, with the first step that is not there. A step that was cut short starts anew and replaces its own leavings.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldenlake.layout import Layout, Run
from goldenlake.operators import quality as q
from goldenlake.operators.fact import conform_fact
from goldenlake.operators.master import VENDOR_NAMES, golden_vendors, golden_zones
from goldenlake.operators.normalize import normalize_types
from goldenlake.operators.rules import TRIP_RULES, Rule, split
from goldenlake.operators.scd2 import VENDORS, ZONES
from goldenlake.operators.trips import dedupe_trips, measurable, payable_trips, with_trip_metrics
from goldenlake.schemas import PROCESSED_COLUMNS, STEP_SCHEMA, TRIP_COLUMNS, TRIP_TYPES
from goldenlake.session import prepare
from goldenlake.sources import catalog
from goldenlake.sources.dated import DatedTable
from goldenlake.sources.readers import malformed, read_if_exists, read_parquet, read_text_table, well_formed
from goldenlake.sources.versioned import VersionedTable
from goldenlake.sources.writers import run_folder, snapshot, write_audit


@dataclass(frozen=True)
class Config:
    layout: Layout
    run: Run
    database: str = "goldenlake"
    rules: tuple[Rule, ...] = TRIP_RULES
    min_valid_share: float = q.MIN_VALID_SHARE
    min_completeness: float = q.MIN_COMPLETENESS
    max_orphan_rate: float = q.MAX_ORPHAN_RATE
    fact_partition: str = "trip_date"
    buckets: int = 8  # of the serving fact
    vendor_names: Mapping[int, str] = field(default_factory=lambda: dict(VENDOR_NAMES))

    def path(self, zone: str, dataset: str) -> str:
        return self.layout.path(zone, dataset)


def of_run(spark: SparkSession, c: Config, zone: str, dataset: str) -> DataFrame:
    """What an earlier step of this run wrote."""
    return read_parquet(spark, run_folder(c.path(zone, dataset), c.run))


def validate(spark: SparkSession, c: Config) -> DataFrame:
    """Back up what arrived (before any cast), split it, audit, and stop on a bad share of valid rows."""
    raw = snapshot(read_parquet(spark, c.path("raw", "trips")), c.path("backup", "raw_snapshot"), c.run)
    valid, rejected = split(normalize_types(raw, TRIP_TYPES), c.rules, TRIP_COLUMNS)
    counts = q.row_counts(
        rows_in=raw,
        rows_valid=snapshot(valid, c.path("validated", "trips"), c.run),
        rows_quarantined=snapshot(rejected, c.path("quarantine", "trips"), c.run),
    )
    audit = write_audit(q.validation_shares(counts, c.run.at), c.path("audit", "validate"), c.run)
    q.enforce(q.with_gate(audit, q.validation_checks(c.min_valid_share)))
    return audit


def process(spark: SparkSession, c: Config) -> DataFrame:
    """Write processed trips. Survivors are counted as they pass in the writing stage, before the too short ones drop
    out; Spark counts a task of a writing stage once, also when it had to be repeated."""
    validated = of_run(spark, c, "validated", "trips")
    survivors = with_trip_metrics(dedupe_trips(payable_trips(validated)))
    passed = Observation()
    written = snapshot(
        measurable(survivors.observe(passed, F.count("*").alias("rows"))).select(*PROCESSED_COLUMNS),
        c.path("processed", "trips"),
        c.run,
    )
    counts = q.row_counts(rows_in=validated, rows_out=written).withColumn(
        "rows_after_dedupe", F.lit(passed.get["rows"]).cast("bigint")
    )
    return write_audit(q.process_shares(counts, c.run.at), c.path("audit", "process"), c.run)


def processed_trips(spark: SparkSession, c: Config) -> DataFrame:
    return of_run(spark, c, "processed", "trips")


def master_zones(spark: SparkSession, c: Config) -> DataFrame:
    """Lines that do not fit their header go to quarantine; they count as rows that arrived. Files are parsed once."""
    arrived = read_text_table(spark, c.path("raw", "zones"), ["locationid", "zone", "borough"])
    arrived = snapshot(arrived, c.path("validated", "zones"), c.run)
    lost = snapshot(malformed(arrived), c.path("quarantine", "zones"), c.run)
    zones = well_formed(arrived)
    q.require_known(zones.withColumn("locationid", F.col("locationid").try_cast("int")), "locationid")
    golden = snapshot(golden_zones(zones), c.path("master", "zones"), c.run)
    counts = q.row_counts(well=zones, rows_malformed=lost, rows_out=golden)
    counts = counts.withColumn("rows_in", F.col("well") + F.col("rows_malformed"))
    audit = q.golden_shares(counts, q.ZONE_AUDIT_LABELS, c.run.at)
    return write_audit(audit, c.path("audit", "master_zones"), c.run)


def master_vendors(spark: SparkSession, c: Config) -> DataFrame:
    trips = processed_trips(spark, c)
    golden = golden_vendors(trips, c.vendor_names)
    q.require_known(golden, "vendorid")
    golden = snapshot(golden, c.path("master", "vendors"), c.run)
    audit = q.golden_shares(q.row_counts(rows_in=trips, rows_out=golden), q.VENDOR_AUDIT_LABELS, c.run.at)
    return write_audit(audit, c.path("audit", "master_vendors"), c.run)


def dimension(spark: SparkSession, c: Config, name: str) -> VersionedTable:
    spec = {"zones": ZONES, "vendors": VENDORS}[name]
    return VersionedTable(spark, c.path("scd2", spec.name), spec)


def update_dimension(spark: SparkSession, c: Config, name: str) -> DataFrame:
    audit = dimension(spark, c, name).upsert(of_run(spark, c, "master", name), c.run, c.path("master", name))
    return write_audit(audit, c.path("audit", f"scd2_{name}"), c.run)


def fact_table(spark: SparkSession, c: Config) -> DatedTable:
    return DatedTable(spark, c.path("curated", "fact_trips"), c.fact_partition)


def build_fact(spark: SparkSession, c: Config) -> DataFrame:
    """Conform all processed trips, and write the dates whose rows differ from what runs before left."""
    fact = conform_fact(
        processed_trips(spark, c), dimension(spark, c, "zones").current(), dimension(spark, c, "vendors").current()
    )
    table = fact_table(spark, c)
    touched = table.refill(fact, c.run)
    audit = q.fact_audit(table.read(), c.run.at).withColumns(
        {
            "dates_written": F.lit(len(touched)).cast("bigint"),
            "rows_written": F.lit(sum(r.rows for r in touched)).cast("bigint"),
        }
    )
    return write_audit(audit, c.path("audit", "fact_trips"), c.run)


def register(spark: SparkSession, c: Config) -> str:
    """Bring the catalog up to date; safe to call at any time."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {c.database}")
    table = catalog.attach_dated(spark, f"{c.database}.curated_fact_trips", fact_table(spark, c))
    catalog.create_revenue_view(spark, c.database, table)
    return table


def load(spark: SparkSession, c: Config) -> DataFrame:
    sources = {
        "scd2_zones_path": c.path("scd2", ZONES.name),
        "scd2_vendors_path": c.path("scd2", VENDORS.name),
        "fact_trips_path": c.path("curated", "fact_trips"),
    }
    fact = fact_table(spark, c)
    frames = {
        "zone_dim": dimension(spark, c, "zones").read(),
        "vendor_dim": dimension(spark, c, "vendors").read(),
        "fact_trips": fact.read(),
    }
    return catalog.publish(
        spark,
        c.layout,
        c.run,
        frames,
        c.database,
        sources,
        c.min_completeness,
        c.max_orphan_rate,
        _changed_since_publish(spark, c, fact),
        c.buckets,
    )


def _changed_since_publish(spark: SparkSession, c: Config, fact: DatedTable) -> list:
    """Dates that the fact changed after the last run whose aggregates were refilled, which need not be the last run."""
    told = catalog.aggregate_table(spark, c.layout, "agg_daily_zone_revenue").records()
    last = told.filter(F.col("run_id") != c.run.run_id).agg(F.max("run_ts")).first()[0]
    since = fact.records().filter(F.col("run_ts") <= c.run.at)
    since = since if last is None else since.filter(F.col("run_ts") > F.lit(last))
    return [r.part for r in since.select("part").distinct().collect()]  # one row a date


def govern(spark: SparkSession, c: Config) -> DataFrame:
    metrics = q.governance_metrics(
        fact_table(spark, c).read(),
        dimension(spark, c, "zones").current(),
        dimension(spark, c, "vendors").current(),
        c.run.at,
        c.min_completeness,
        c.max_orphan_rate,
    )
    return write_audit(metrics, c.path("audit", "governance"), c.run)


def register_and_load(spark: SparkSession, c: Config) -> DataFrame:
    register(spark, c)
    return load(spark, c)


class Step(NamedTuple):
    """A step returns its audit row; the others are SQL over it for the run's summary."""

    name: str
    run: Callable[[SparkSession, Config], DataFrame]
    rows_in: str
    rows_out: str
    status: str = "'SUCCESS'"


STEPS = (
    Step("validate", validate, "rows_in", "rows_valid"),
    Step("process", process, "rows_in", "rows_out"),
    Step("master_zones", master_zones, "rows_in", "rows_out"),
    Step("master_vendors", master_vendors, "rows_in", "rows_out"),
    Step("dim_zones", lambda spark, c: update_dimension(spark, c, "zones"), "rows_in_golden", "rows_inserted", "note"),
    Step("dim_vendors", lambda spark, c: update_dimension(spark, c, "vendors"), "rows_in_golden", "rows_inserted", "note"),
    Step("fact_trips", build_fact, "rows_total", "rows_total"),
    Step("load", register_and_load, "fact_trips", "fact_trips", "status"),
    Step("governance", govern, "fact_count", "fact_count", "pipeline_status"),
)


def ledger(spark: SparkSession, c: Config) -> DataFrame:
    """The steps of this run that have ended, one row each."""
    found = read_if_exists(spark, f"{c.path('audit', 'steps')}/run_id={c.run.run_id}", STEP_SCHEMA, "json")
    return spark.createDataFrame([], STEP_SCHEMA) if found is None else found.select("step", "name", "rows_in", "rows_out", "status")


def run_all(spark: SparkSession, c: Config, steps: tuple[Step, ...] = STEPS) -> DataFrame:
    """Run every step that the run's ledger lacks, in order; a failed guard or gate stops the run. Returns the ledger, one row
    per step."""
    prepare(spark)
    done = {r.name for r in ledger(spark, c).select("name").collect()}
    for number, step in enumerate(steps, 1):
        if step.name in done:
            continue
        audit = step.run(spark, c)
        line = audit.select(
            F.lit(number).alias("step"),
            F.lit(step.name).alias("name"),
            F.col(step.rows_in).cast("bigint").alias("rows_in"),
            F.col(step.rows_out).cast("bigint").alias("rows_out"),
            F.expr(step.status).alias("status"),
        )
        line.coalesce(1).write.mode("overwrite").json(
            f"{c.path('audit', 'steps')}/run_id={c.run.run_id}/name={step.name}"
        )
    return ledger(spark, c)
