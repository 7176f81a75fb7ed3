"""One query per operator over the driver's tables. ``checks/oracle.py`` has the same queries in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.bindings import (
    AUDIT_TS,
    BATCHES,
    trips_first_delivery,
    trips_raw,
    vendors_raw,
    zones_in_files,
    zones_raw,
)
from goldenlake.layout import Layout, Run, timestamp_literal
from goldenlake.operators import fact as f
from goldenlake.operators import master as m
from goldenlake.operators import quality as q
from goldenlake.operators import rules as r
from goldenlake.operators import scd2 as s
from goldenlake.operators import serving as v
from goldenlake.operators import trips as t
from goldenlake.operators.normalize import normalize_types
from goldenlake.plans.run import Config, dimension, fact_table, ledger, run_all
from goldenlake.schemas import FACT_TRIPS, TRIP_COLUMNS, TRIP_TYPES, VENDOR_DIM, ZONE_DIM
from goldenlake.session import prepare, shared_folder
from goldenlake.sources import catalog
from goldenlake.sources.dated import DatedTable
from goldenlake.sources.readers import malformed, read_text_table, well_formed
from goldenlake.sources.versioned import VersionedTable
from goldenlake.sources.writers import export_csv, overwrite

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def named(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        return fn

    return register


def query(fn: Query) -> Query:
    return named(fn.__name__)(fn)


def at(batch: int) -> Column:
    return BATCHES[batch].at


def audited() -> Column:
    return timestamp_literal(AUDIT_TS)


#: What queries of one session share: written once for each folder of tables.
_SHARED: dict[tuple[str, str, str], object] = {}


def shared(what: str, spark: SparkSession, sf: str, make: Callable[[], object]) -> object:
    key = (what, spark.sparkContext.applicationId, sf)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


def written(df: DataFrame) -> DataFrame:
    """A table in the shared folder that holds ``df``: what is read more than once is computed once."""
    return overwrite(df, shared_folder(df.sparkSession))


# -- trips


@query
def scan_trips(spark, sf):
    return trips_raw(spark, sf)


@named("normalize_types")
def typed(spark, sf):
    return normalize_types(trips_raw(spark, sf), TRIP_TYPES)


@query
def validate_flags(spark, sf):
    return r.flag_rows(typed(spark, sf).select(*TRIP_COLUMNS), r.TRIP_RULES)


@query
def validate_rules_v0(spark, sf):
    return r.flag_rows(typed(spark, sf).select(*TRIP_COLUMNS, "passenger_count"), r.TRIP_RULES_V0)


@query
def validated_trips(spark, sf):
    return r.split(typed(spark, sf), r.TRIP_RULES, TRIP_COLUMNS)[0]


@query
def quarantined_trips(spark, sf):
    return r.split(typed(spark, sf), r.TRIP_RULES, TRIP_COLUMNS)[1]


@query
def quarantine_reasons(spark, sf):
    return quarantined_trips(spark, sf).select(
        *TRIP_COLUMNS, F.concat_ws(",", r.broken_rules(r.TRIP_RULES)).alias("broken_rules")
    )


@query
def validation_audit(spark, sf):
    audit = q.validation_audit(typed(spark, sf), r.TRIP_RULES, audited())
    return flat_errors(q.with_gate(audit, q.validation_checks()))


def flat_errors(gated: DataFrame) -> DataFrame:
    return gated.withColumn("errors", F.concat_ws("; ", "errors"))


@query
def process_filters(spark, sf):
    return t.payable_trips(validated_trips(spark, sf))


@query
def dedupe_trips(spark, sf):
    return t.dedupe_trips(process_filters(spark, sf))


@query
def derive_trip_metrics(spark, sf):
    return t.measurable(t.with_trip_metrics(process_filters(spark, sf)))


@query
def processed_trips(spark, sf):
    return t.process_trips(validated_trips(spark, sf))


def processed(raw: DataFrame) -> DataFrame:
    return t.process_trips(r.split(normalize_types(raw, TRIP_TYPES), r.TRIP_RULES, TRIP_COLUMNS)[0])


@query
def process_audit(spark, sf):
    return q.process_audit(validated_trips(spark, sf), audited())


# -- master data


@query
def standardize_zones(spark, sf):
    return m.standardize_zones(zones_raw(spark, sf))


@query
def standardize_zones_mixed_case(spark, sf):
    return m.standardize_zones(zones_raw(spark, sf), m.OUTSIDE_MIXED_CASE)


@query
def golden_zones(spark, sf):
    return m.golden_zones(zones_raw(spark, sf))


@query
def golden_zones_audit(spark, sf):
    return q.golden_audit(m.standardize_zones(zones_raw(spark, sf)), "locationid", q.ZONE_AUDIT_LABELS, audited())


@query
def dedupe_zones_by_name(spark, sf):
    return m.dedupe_zones_by_name(zones_raw(spark, sf))


@query
def map_vendor_names(spark, sf):
    return m.map_vendor_names(typed(spark, sf).select("vendorid", "pulocationid"))


@query
def golden_vendors(spark, sf):
    return m.golden_vendors(processed_trips(spark, sf))


@query
def golden_vendors_audit(spark, sf):
    return q.golden_audit(processed_trips(spark, sf), "vendorid", q.VENDOR_AUDIT_LABELS, audited())


@query
def vendor_defaults(spark, sf):
    return m.vendor_defaults(vendors_raw(spark, sf))


@query
def key_profile(spark, sf):
    return q.key_profile(typed(spark, sf), "vendorid")


@query
def duplicate_keys(spark, sf):
    return q.duplicate_keys(m.standardize_zones(zones_raw(spark, sf)), "locationid")


# -- dimensions


def golden_batch(spark, sf, batch: int) -> DataFrame:
    return m.golden_zones(zones_raw(spark, sf, batch))


def known(vendors: DataFrame) -> DataFrame:
    """The first vendor delivery: only vendors of the dictionary. The others arrive later."""
    return vendors.filter(F.col("vendor_name") != m.UNKNOWN_VENDOR)


@query
def hash_diff(spark, sf):
    return s.with_hash_diff(m.standardize_zones(zones_raw(spark, sf)), s.ZONES)


@query
def scd2_initial(spark, sf):
    return s.scd2_initial(golden_batch(spark, sf, 1), s.ZONES, at(1))


@query
def scd2_changes(spark, sf):
    return s.scd2_changes(golden_batch(spark, sf, 2), scd2_initial(spark, sf), s.ZONES)


@query
def scd2_stage(spark, sf):
    return s.scd2_stage(scd2_changes(spark, sf), s.ZONES, at(2))


@query
def scd2_expire(spark, sf):
    return s.scd2_expire(written(scd2_initial(spark, sf)), golden_batch(spark, sf, 2), s.ZONES, at(2))


@query
def scd2_merge(spark, sf):
    return s.scd2_merge(written(scd2_initial(spark, sf)), golden_batch(spark, sf, 2), s.ZONES, at(2))


@query
def scd2_next(spark, sf):
    return s.scd2_next(golden_batch(spark, sf, 2), scd2_initial(spark, sf), s.ZONES, at(2))


def scd2_audit_of(golden: DataFrame, dim: DataFrame, batch: int) -> DataFrame:
    golden = written(golden)
    staged = s.scd2_stage(s.scd2_changes(golden, dim, s.ZONES), s.ZONES, at(batch))
    return s.scd2_audit(staged, F.lit(golden.count()).cast("bigint"), s.ZONES, at(batch))


@query
def scd2_audit(spark, sf):
    return scd2_audit_of(golden_batch(spark, sf, 2), scd2_initial(spark, sf), 2)


@query
def scd2_noop(spark, sf):
    return scd2_audit_of(golden_batch(spark, sf, 3), scd2_merge(spark, sf), 3)


@query
def scd2_vendors(spark, sf):
    golden = written(golden_vendors(spark, sf))
    return s.scd2_merge(written(s.scd2_initial(known(golden), s.VENDORS, at(1))), golden, s.VENDORS, at(2))


@query
def scd2_vendors_v0(spark, sf):
    return s.scd2_initial(vendor_defaults(spark, sf), s.VENDORS_V0, at(1))


@query
def scd2_vendors_v0_merge(spark, sf):
    """A second delivery with other flags and names, and vendors that left."""
    second = m.vendor_defaults(vendors_raw(spark, sf, 2))
    return s.scd2_merge(written(scd2_vendors_v0(spark, sf)), second, s.VENDORS_V0, at(2))


@query
def scd2_violations(spark, sf):
    return s.scd2_violations(scd2_merge(spark, sf), s.ZONES)


def zone_table(spark, sf, batches) -> VersionedTable:
    return shared(f"zones {batches}", spark, sf, lambda: _zone_table(spark, sf, batches))


def _zone_table(spark, sf, batches) -> VersionedTable:
    dim = VersionedTable(spark, f"{shared_folder(spark)}/{s.ZONES.name}", s.ZONES)
    for batch in batches:
        golden = overwrite(golden_batch(spark, sf, batch), f"{dim.path}/golden/{BATCHES[batch].run_id}")
        dim.upsert(golden, BATCHES[batch], f"zones of {BATCHES[batch].run_id}")
    return dim


@query
def dim_current(spark, sf):
    return zone_table(spark, sf, (1, 2, 3, 4)).current()


@query
def dim_latest(spark, sf):
    return zone_table(spark, sf, (1, 2, 3, 4)).read()


@query
def dim_as_of_version(spark, sf):
    """As of the second batch, told from the validity dates of all rows."""
    return s.scd2_as_of(dim_latest(spark, sf), s.ZONES, at(2))


@query
def commit_history(spark, sf):
    return zone_table(spark, sf, (1, 2, 3, 4)).history().drop("metadata")


@query
def commit_details(spark, sf):
    """The metadata that commits carry, read back with a schema."""
    details = F.from_json("metadata", "action string, changed_keys bigint, rows_in_golden bigint, source_path string")
    return zone_table(spark, sf, (1, 2, 3, 4)).history().select("version", details.alias("told")).select("version", "told.*")


# -- fact and what is computed from it


def star(spark, sf, raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact, zone dimension and vendor dimension, as a run leaves them: written tables, made once for a session. ``raw`` are the
    trips, where the caller has them as a written table."""
    return shared("star", spark, sf, lambda: _star(spark, sf, raw))


def _star(spark, sf, raw: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    trips = written(processed_trips(spark, sf) if raw is None else processed(raw))
    zones = written(s.scd2_initial(golden_zones(spark, sf), s.ZONES, at(1)))
    vendors = written(s.scd2_initial(known(m.golden_vendors(trips)), s.VENDORS, at(1)))
    return written(f.conform_fact(trips, zones, vendors)), zones, vendors


@query
def fact_trips(spark, sf):
    return star(spark, sf)[0]


@query
def processed_trips_v0(spark, sf):
    return t.process_trips_v0(r.split(typed(spark, sf), r.TRIP_RULES_V0, (*TRIP_COLUMNS, "passenger_count"))[0])


@query
def fact_trips_v0(spark, sf):
    _, zones, vendors = star(spark, sf)
    return f.conform_fact(processed_trips_v0(spark, sf), zones, vendors, f.FACT_COLUMNS_V0)


@query
def orphan_flags(spark, sf):
    flags = ("zone_orphan_flag", "vendor_orphan_flag")
    return fact_trips(spark, sf).groupBy(*flags).agg(F.count("*").alias("trips"))


@query
def fact_audit(spark, sf):
    return q.fact_audit(fact_trips(spark, sf), audited())


@query
def completeness(spark, sf):
    return q.completeness(fact_trips(spark, sf))


@query
def completeness_amount(spark, sf):
    return q.completeness_amount(fact_trips(spark, sf))


@query
def orphan_rate(spark, sf):
    return q.orphan_rate(fact_trips(spark, sf))


@query
def orphan_rate_join(spark, sf):
    fact, zones, _ = star(spark, sf)
    return q.orphan_rate_join(fact, zones)


@query
def table_counts(spark, sf):
    fact, zones, vendors = star(spark, sf)
    return q.table_counts(fact_trips=fact, zone_dim=zones, vendor_dim=vendors)


def loaded(spark, sf) -> DataFrame:
    return q.load_gate(q.load_metrics(*star(spark, sf)))


@query
def load_gate(spark, sf):
    return flat_errors(loaded(spark, sf))


@query
def load_gate_strict(spark, sf):
    checks = q.load_checks(max_orphan_rate=0.001, min_completeness=0.999)
    return flat_errors(q.load_gate(q.load_metrics(*star(spark, sf)), checks))


@query
def load_gate_counts(spark, sf):
    """The gate without completeness: empty tables and orphans only."""
    return flat_errors(q.load_gate(q.load_metrics(*star(spark, sf)), q.load_checks()))


@query
def metric_points(spark, sf):
    return v.metric_points(loaded(spark, sf))


@query
def governance_metrics(spark, sf):
    return q.governance_metrics(*star(spark, sf), audited())


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals as the doubles next to them."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def as_text(df: DataFrame) -> DataFrame:
    """Exact decimals with all of their digits."""
    return df.withColumns({n: F.col(n).cast("string") for n, t in df.dtypes if t.startswith("decimal")})


@query
def agg_daily_zone_revenue(spark, sf):
    return as_double(v.agg_daily_zone_revenue(fact_trips(spark, sf)), "total_revenue")


@query
def agg_daily_vendor_perf(spark, sf):
    return as_double(v.agg_daily_vendor_perf(fact_trips(spark, sf)), "total_revenue")


@query
def daily_revenue(spark, sf):
    return as_double(v.daily_revenue(fact_trips(spark, sf)), "revenue")


@query
def exact_totals(spark, sf):
    return as_text(v.exact_totals(fact_trips(spark, sf)))


@query
def serving_fact_trips(spark, sf):
    return v.serving_columns(fact_trips(spark, sf), FACT_TRIPS)


@query
def serving_zone_dim(spark, sf):
    return v.serving_columns(scd2_merge(spark, sf), ZONE_DIM)


@query
def serving_vendor_dim(spark, sf):
    return v.serving_columns(scd2_vendors(spark, sf), VENDOR_DIM)


@query
def full_run_summary(spark, sf):
    folder = shared_folder(spark)
    run = Run("full-run", AUDIT_TS)
    # By month: these tables spread few trips over thousands of days. ``fact_by_date`` has the default, by date.
    config = Config(
        Layout(folder), run, database=f"goldenlake_{folder.rsplit('/', 1)[1]}", fact_partition="trip_month"
    )
    overwrite(trips_raw(spark, sf), config.path("raw", "trips"))
    export_csv(zones_raw(spark, sf), config.path("raw", "zones"))
    return run_all(spark, config)


# -- zones as files


@query
def zones_by_header(spark, sf):
    """Zone records from files whose headers differ in order and case, without the lines that do not fit."""
    return well_formed(_zone_files(spark, sf))


@query
def zones_malformed(spark, sf):
    return malformed(_zone_files(spark, sf))


def _zone_files(spark, sf) -> DataFrame:
    return written(read_text_table(spark, f"{zones_in_files(spark, sf, shared_folder(spark))}/*", ["locationid", "zone", "borough"]))


# -- two deliveries: the second one brings late trips and a correction


def dated_fact(spark, sf) -> DatedTable:
    return shared("dated fact", spark, sf, lambda: _dated_fact(spark, sf))


def _dated_fact(spark, sf) -> DatedTable:
    """The fact by date, as both deliveries leave it. Trips are joined once for both, and a delivery's fact, which is read
    for the fingerprints and for the rows, is computed once."""
    raw = written(trips_raw(spark, sf).select(*TRIP_COLUMNS))
    fact, zones, vendors = star(spark, sf, raw)
    arrived = processed(trips_first_delivery(spark, sf, raw))
    table = DatedTable(spark, shared_folder(spark), "trip_date")
    table.refill(written(f.conform_fact(arrived, zones, vendors)), BATCHES[1])
    table.refill(fact, BATCHES[2])
    return table


@query
def fact_by_date(spark, sf):
    """The fact read back; most dates live in the folder of the first run, those that changed in the second's."""
    return dated_fact(spark, sf).read()


@query
def fact_dates_touched(spark, sf):
    """Dates that the second delivery made the table write, and their rows."""
    return dated_fact(spark, sf).touched(BATCHES[2]).select(F.col("part").alias("trip_date"), "rows")


# -- a lake after a whole run of each delivery. By month: these tables spread few trips over thousands of days


def lake(spark, sf, complete: bool = False) -> Config:
    """The lake as both runs leave it. A run that its load gate stopped has published nothing, but what its steps before left is
    whole. With ``complete``, for what later steps leave, the gate's failure is raised."""
    config, stopped = shared("lake", spark, sf, lambda: _lake(spark, sf))
    if complete and stopped:
        raise q.GateFailed(stopped)
    return config


def _lake(spark, sf) -> tuple[Config, str]:
    folder = shared_folder(spark)
    database = f"goldenlake_{folder.rsplit('/', 1)[1]}"
    stopped = []
    for batch, trips in ((1, trips_first_delivery), (2, trips_raw)):
        config = Config(Layout(folder), BATCHES[batch], database=database, fact_partition="trip_month")
        overwrite(trips(spark, sf), config.path("raw", "trips"))
        export_csv(zones_raw(spark, sf), config.path("raw", "zones"))
        try:
            run_all(spark, config)
        except q.GateFailed as failed:
            if ledger(spark, config).filter("name = 'fact_trips'").isEmpty():
                raise
            stopped.append(f"{config.run.run_id}: {failed}")
    return config, "; ".join(stopped)


@query
def fact_incremental(spark, sf):
    """The fact read back; only months that changed were written by the second run."""
    return fact_table(spark, lake(spark, sf)).read().drop("trip_month")


@query
def fact_months_touched(spark, sf):
    """Months that the second run wrote, and their rows."""
    config = lake(spark, sf)
    return fact_table(spark, config).touched(config.run).select(F.col("part").alias("trip_month"), "rows")


@query
def curated_catalog(spark, sf):
    """The fact by way of the catalog, where each month's location is the run it lives in."""
    fact = spark.table(f"{lake(spark, sf).database}.curated_fact_trips")
    return as_text(
        fact.groupBy("trip_month").agg(
            F.count("*").alias("trips"), F.count_distinct("trip_date").alias("dates"), v.exact_sum("total_amount").alias("revenue")
        )
    )


@query
def curated_daily_revenue(spark, sf):
    return as_double(spark.table(f"{lake(spark, sf).database}.curated_daily_revenue"), "revenue")


@query
def published_zone_revenue(spark, sf):
    """The aggregate as readers see it, after the refill of the months that changed."""
    return as_double(spark.table(f"{lake(spark, sf, complete=True).database}.agg_daily_zone_revenue"), "total_revenue")


@query
def published_vendor_perf(spark, sf):
    return as_double(spark.table(f"{lake(spark, sf, complete=True).database}.agg_daily_vendor_perf"), "total_revenue")


@query
def published_fact_trips(spark, sf):
    return spark.table(f"{lake(spark, sf, complete=True).database}.fact_trips")


@query
def published_dimensions(spark, sf):
    database = lake(spark, sf, complete=True).database
    zones, vendors = spark.table(f"{database}.zone_dim"), spark.table(f"{database}.vendor_dim")
    columns = ("version_number", "is_current", "start_date", "end_date", "hash_diff")
    zones = zones.select(F.lit("zone").alias("dimension"), F.col("zone_key").alias("surrogate"), F.col("location_id").alias("key"), *columns)
    vendors = vendors.select(F.lit("vendor").alias("dimension"), F.col("vendor_key").alias("surrogate"), F.col("vendorid").alias("key"), *columns)
    return zones.unionByName(vendors)


@query
def staged_runs(spark, sf):
    """Rows of each serving table by run: those of earlier runs stay until they are vacuumed."""
    database = lake(spark, sf).database
    counts = [
        spark.table(f"{database}.{t}__runs").groupBy("run_id").agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "*")
        for t in catalog.SERVING_TABLES
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def serving_layout(spark, sf):
    """How the serving fact lies on disk: rows that stand out of order in their file, and dates and vendors that share no
    one bucket. Both are 0."""
    config = lake(spark, sf)
    rows = spark.table(f"{config.database}.fact_trips__runs").filter(F.col("run_id") == config.run.run_id)
    rows = rows.select(
        F.struct("trip_date", "vendorid").alias("place"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    # A row's file and number are known; what stood before it is the row with the number before.
    before = F.lag("place").over(Window.partitionBy("file").orderBy("at"))
    disorder = rows.withColumn("before", before).agg(F.count_if(F.col("before") > F.col("place")).alias("out_of_order"), F.count("*").alias("trips"))
    split = rows.groupBy("place").agg(F.count_distinct("file").alias("files")).agg(F.count_if(F.col("files") > 1).alias("split_places"))
    return q.merge_rows(disorder, split)


@query
def backup_snapshots(spark, sf):
    """What arrived, by run, with the types it arrived in."""
    kept = spark.read.parquet(lake(spark, sf).path("backup", "raw_snapshot"))
    return as_text(
        kept.groupBy("run_id").agg(
            F.count("*").alias("rows"), F.count("vendorid").alias("vendors"), F.count("passenger_count").alias("passengers"),
            F.sum(F.try_to_number("payment_type", F.lit("9"))).alias("payment_types"),
        )
    )


AUDITS = {
    "validate": ("rows_in bigint, rows_valid bigint, rows_quarantined bigint", "rows_in", "rows_valid"),
    "process": ("rows_in bigint, rows_after_dedupe bigint, rows_out bigint", "rows_in", "rows_out"),
    "master_zones": ("rows_in bigint, rows_out bigint, duplicates_removed bigint", "rows_in", "rows_out"),
    "master_vendors": ("rows_in bigint, rows_out bigint, duplicates_removed bigint", "rows_in", "rows_out"),
    "scd2_zones": ("rows_in_golden bigint, rows_inserted bigint, note string", "rows_in_golden", "rows_inserted"),
    "scd2_vendors": ("rows_in_golden bigint, rows_inserted bigint, note string", "rows_in_golden", "rows_inserted"),
    "fact_trips": ("rows_total bigint, dates_written bigint, rows_written bigint", "rows_total", "rows_written"),
    "governance": ("fact_count bigint, current_zones bigint, current_vendors bigint", "fact_count", "current_zones"),
}


@query
def audit_log(spark, sf):
    """Every audit of both runs, read back with a schema."""
    config = lake(spark, sf, complete=True)
    rows = None
    for name, (schema, rows_in, rows_out) in AUDITS.items():
        log = spark.read.schema(f"{schema}, run_id string").json(config.path("audit", name))
        own = log.select(F.lit(name).alias("audit"), "run_id", F.col(rows_in).alias("rows_in"), F.col(rows_out).alias("rows_out"))
        rows = own if rows is None else rows.unionByName(own)
    return rows


@query
def load_documents(spark, sf):
    """The nested documents of both publishes, read back with a schema and laid flat."""
    schema = (
        "run_id string, run_ts_utc timestamp_ntz, targets struct<schema: string, tables: array<string>>, "
        "counts struct<zone_dim: bigint, vendor_dim: bigint, fact_trips: bigint>, dq struct<completeness: double, "
        "completeness_min: double, orphan_rate: double, orphan_rate_max: double, failures: array<string>>, status string"
    )
    log = spark.read.schema(schema).json(lake(spark, sf).path("audit", "load"))
    return log.select(
        "run_id", "run_ts_utc", F.concat_ws(",", "targets.tables").alias("tables"), "counts.*", "dq.completeness", "dq.orphan_rate",
        F.size("dq.failures").cast("bigint").alias("failures"), "status",
    )


@query
def metric_points_log(spark, sf):
    schema = "run_id string, run_ts timestamp_ntz, name string, value double, unit string"
    return spark.read.schema(schema).json(lake(spark, sf).path("audit", "metric_points"))


@query
def tables_exist(spark, sf):
    """The probe for a dimension's first use, on two that exist and one that does not."""
    config = lake(spark, sf)
    tables = {name: dimension(spark, config, name) for name in ("zones", "vendors")}
    tables["drivers"] = VersionedTable(spark, config.path("scd2", "dim_drivers"), s.VENDORS)
    rows = [(name, table.exists(), table.current().count() if table.exists() else 0) for name, table in tables.items()]
    return spark.createDataFrame(rows, "dimension string, present boolean, current_rows bigint")


@query
def catalog_evolved(spark, sf):
    """Orders by year in the catalog, after the folder gained a column and a year and lost a year: the table was updated in
    place and reads like the folder."""
    folder = shared_folder(spark)
    name = f"goldenlake_{folder.rsplit('/', 1)[1]}.orders"
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"), "o_totalprice")
    first, last = orders.agg(F.min("order_year"), F.max("order_year")).first()
    orders.drop("o_totalprice").filter(F.col("order_year") < last).write.partitionBy("order_year").parquet(folder)
    catalog.update_table(spark, name, spark.read.parquet(folder).schema, folder, ("order_year",))
    catalog.attach_folder(spark, name, folder)
    orders.filter(F.col("order_year") > first).write.mode("overwrite").partitionBy("order_year").parquet(folder)
    catalog.attach_folder(spark, name, folder)
    return spark.table(name).groupBy("order_year").agg(
        F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.count("o_totalprice").alias("priced")
    )
