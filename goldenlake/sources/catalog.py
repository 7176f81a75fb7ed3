"""Catalog tables over lake folders, and publishing to the serving database.

Tables are brought up to date in place: columns are added, partitions added, moved and dropped, and a table is never away
while that happens. A publish adds its run to each serving table, checks what it wrote, and only then moves the one pointer
that all serving views go by, so readers see all tables of one run or all of another.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldenlake.layout import Layout, Run
from goldenlake.operators.quality import (
    MAX_ORPHAN_RATE,
    MIN_COMPLETENESS,
    enforce,
    load_checks,
    load_gate,
    load_metrics,
)
from goldenlake.operators.serving import (
    agg_daily_vendor_perf,
    agg_daily_zone_revenue,
    exact_sum_sql,
    metric_points,
    serving_columns,
)
from goldenlake.schemas import FACT_TRIPS, VENDOR_DIM, ZONE_DIM
from goldenlake.sources.dated import PARTS, DatedTable
from goldenlake.sources.readers import read_if_exists
from goldenlake.sources.writers import one_row, run_folder, write_audit

SERVING_TABLES = {"zone_dim": ZONE_DIM, "vendor_dim": VENDOR_DIM, "fact_trips": FACT_TRIPS}
AGGREGATES = {"agg_daily_zone_revenue": agg_daily_zone_revenue, "agg_daily_vendor_perf": agg_daily_vendor_perf}
POINTER = "published"


@dataclass(frozen=True)
class Spread:
    """How a serving table lies on disk: sorted, and dealt into buckets by the same columns where ``buckets`` is set.

    The fact goes by date and vendor together. Daily sums by vendor and joins on both then need no shuffle, and a vendor
    with a third of all trips is dealt over all buckets, which it would not be by vendor alone.
    """

    by: tuple[str, ...]
    buckets: int = 0


def serving_spreads(buckets: int = 8) -> dict[str, Spread]:
    return {
        "zone_dim": Spread(("location_id",)),
        "vendor_dim": Spread(("vendorid",)),
        "fact_trips": Spread(("trip_date", "vendorid"), buckets),
    }


# -- tables over folders


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _fits(have: StructType, want: StructType) -> bool:
    """Whether columns can be added to get from one schema to the other."""
    types = {f.name.lower(): f.dataType for f in have}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in want)


def update_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partitions: tuple[str, ...] = (),
    spread: Spread | None = None,
) -> bool:
    """Make ``name`` an external parquet table with at least the columns of ``schema``; returns whether it is new.

    Columns that the schema lacks stay and read as null. Only a column that changed its type makes the table anew, as a
    catalog can't change that in place.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if spark.catalog.tableExists(name):
        have = spark.table(name).schema
        if _fits(have, schema):
            known = {c.lower() for c in have.names}
            if added := [f for f in schema if f.name.lower() not in known]:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(StructType(added))})")
            spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('deprecated')")
            return False
        spark.sql(f"DROP TABLE {name}")
    parted = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    dealt = ""
    if spread and spread.buckets:
        by = ", ".join(spread.by)
        dealt = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {spread.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({_columns(schema)}) USING parquet{parted}{dealt} LOCATION '{path}'")
    return True


def attach_folder(spark: SparkSession, name: str, path: str) -> str:
    """Register a parquet folder, or take over the columns and partitions that it has now."""
    schema = spark.read.parquet(path).schema
    partitions = tuple(c for c in schema.names if c not in _data_columns(spark, path))
    update_table(spark, name, schema, path, partitions)
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def _data_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns inside the files; the others come from folder names."""
    return spark.read.option("recursiveFileLookup", True).parquet(path).columns


def register_curated(
    spark: SparkSession, database: str, datasets: Mapping[str, str], prefix: str = "curated_"
) -> list[str]:
    """Register curated folders, taking over changed schemas. A table whose folder is gone is marked, not dropped, and
    loses the mark when the folder is back."""
    registered = []
    for dataset, path in datasets.items():
        name = f"{database}.{prefix}{dataset}"
        if read_if_exists(spark, path, "_ int") is not None:
            registered.append(attach_folder(spark, name, path))
        elif spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('deprecated' = 'true')")
    return registered


#: Table property with the clock and id of the last run whose dates are attached.
ATTACHED = "goldenlake.attached"


def attach_dated(spark: SparkSession, name: str, table: DatedTable) -> str:
    """Register a dated table: each date is a partition whose location is the folder of the run that it lives in. Only
    dates that moved since the last call are touched."""
    live = {r.part: (str(r.run_ts), r.run_id) for r in table.live().collect()}  # one row a date
    fresh = update_table(spark, name, table.schema(), f"{table.path}/catalog", (table.part,))
    told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(ATTACHED)
    last = ("", "") if told is None else tuple(told.split("|", 1))
    listed = set() if fresh else {date.fromisoformat(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for part in sorted(listed - live.keys()):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({table.part}='{part}')")
    for part in sorted(p for p in live.keys() & listed if live[p] > last):
        spark.sql(f"ALTER TABLE {name} PARTITION ({table.part}='{part}') SET LOCATION '{table.folder(live[part][1], part)}'")
    added = [f"PARTITION ({table.part}='{p}') LOCATION '{table.folder(live[p][1], p)}'" for p in sorted(live.keys() - listed)]
    for first in range(0, len(added), 500):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[first : first + 500])}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{ATTACHED}' = '{'|'.join(max(live.values(), default=last))}')")
    spark.catalog.refreshTable(name)
    return name


def create_revenue_view(spark: SparkSession, database: str, fact_table: str) -> str:
    name = f"{database}.curated_daily_revenue"
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS "
        f"SELECT trip_date, {exact_sum_sql('total_amount')} AS revenue FROM {fact_table} GROUP BY trip_date"
    )
    return name


# -- publishing


def load_document(gated: DataFrame, run: Run, layout: Layout, database: str, sources: Mapping[str, str]) -> DataFrame:
    """The nested audit document of a publish."""
    return gated.select(
        run.at.alias("run_ts_utc"),
        F.from_json(F.lit(json.dumps(dict(sources))), "map<string, string>").alias("sources"),
        F.struct(
            F.lit(database).alias("schema"), F.array(*[F.lit(t) for t in SERVING_TABLES]).alias("tables")
        ).alias("targets"),
        F.struct(*[F.col(t) for t in SERVING_TABLES]).alias("counts"),
        F.struct(
            "completeness",
            F.lit(MIN_COMPLETENESS).alias("completeness_min"),
            F.col("zone_orphan_rate").alias("orphan_rate"),
            F.lit(MAX_ORPHAN_RATE).alias("orphan_rate_max"),
            F.col("errors").alias("failures"),
        ).alias("dq"),
        "zone_orphan_rate",
        "status",
        "errors",
    )


def stage_table(spark: SparkSession, name: str, rows: DataFrame, path: str, run: Run, spread: Spread) -> DataFrame:
    """Add a run's rows to a serving table, which keeps those of other runs, and return them as read back."""
    schema = StructType([*rows.schema]).add("run_id", "string")
    if update_table(spark, name, schema, path, ("run_id",), spread) and read_if_exists(spark, path, "_ int") is not None:
        spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")  # runs that an earlier catalog knew
    if spread.buckets:
        rows = rows.repartition(spread.buckets, *spread.by)  # the hash that buckets go by: one file each
    else:
        rows = rows.sortWithinPartitions(*spread.by)
    table = spark.table(name)
    present = {c.lower() for c in rows.columns}
    filled = [F.col(f.name) if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema[:-1]]
    into = f"INSERT OVERWRITE TABLE {name} PARTITION (run_id = '{run.run_id}') SELECT * FROM {{rows}}"
    spark.sql(into, rows=rows.select(*filled))
    return spark.table(name).filter(F.col("run_id") == run.run_id).select(*rows.columns)


def point_to(spark: SparkSession, database: str, run: Run) -> None:
    """Move the pointer. Replacing a view is one change of the catalog, so there is no state in between."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{POINTER} AS "
        f"SELECT '{run.run_id}' AS run_id, TIMESTAMP_NTZ '{run.run_ts}' AS run_ts"
    )


def _view(spark: SparkSession, name: str, columns: list[str], body: str) -> None:
    if not spark.catalog.tableExists(name) or spark.table(name).columns != columns:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{c}`' for c in columns)} FROM {body}")


def aggregate_table(spark: SparkSession, layout: Layout, name: str) -> DatedTable:
    return DatedTable(spark, layout.path("export", name), "trip_month")


def _attach_aggregate(spark: SparkSession, database: str, name: str, table: DatedTable) -> None:
    """Two tables over an aggregate's rows and record of dates, and the view of what is live as of the pointer's run. The
    view's semi-join is on partition columns, so folders of other runs and dates are pruned."""
    data = table.schema()
    rows = StructType([f for f in data if f.name != table.part]).add("run_id", "string").add(table.part, "date")
    update_table(spark, f"{database}.{name}__rows", rows, table.rows_path, ("run_id", table.part))
    update_table(spark, f"{database}.{name}__dates", table.records().schema, table.dates_path, ("run_id",))
    for each in (f"{database}.{name}__rows", f"{database}.{name}__dates"):
        spark.sql(f"MSCK REPAIR TABLE {each} SYNC PARTITIONS")
        spark.catalog.refreshTable(each)
    live = (
        f"(SELECT part, max_by(run_id, struct(run_ts, run_id)) AS run_id FROM {database}.{name}__dates "
        f"WHERE run_ts <= (SELECT run_ts FROM {database}.{POINTER}) GROUP BY part) d"
    )
    columns = [c for c in data.names if c != table.part]
    body = f"{database}.{name}__rows r LEFT SEMI JOIN {live} ON r.run_id = d.run_id AND r.{table.part} = d.part"
    _view(spark, f"{database}.{name}", columns, body)


def publish(
    spark: SparkSession,
    layout: Layout,
    run: Run,
    frames: Mapping[str, DataFrame],
    database: str,
    sources: Mapping[str, str] | None = None,
    min_completeness: float = MIN_COMPLETENESS,
    max_orphan_rate: float = MAX_ORPHAN_RATE,
    dates: Iterable[date] | None = None,
    buckets: int = 8,
) -> DataFrame:
    """Stage, check, and on success refill the aggregates and move the pointer. Returns the gated load row.

    ``dates`` are those that the fact changed since the last publish: only their months of the aggregates are computed. Without
    them all months are, and those that differ are written. The audit document and the metric points are written whether or
    not the check passes; a failed check raises.
    """
    spreads = serving_spreads(buckets)
    staged = {}
    for table, mapping in SERVING_TABLES.items():
        rows = serving_columns(frames[table], mapping)
        staged[table] = stage_table(spark, f"{database}.{table}__runs", rows, layout.path("export", table), run, spreads[table])
    fact = staged["fact_trips"]

    metrics = load_metrics(fact, staged["zone_dim"], staged["vendor_dim"])
    gated = one_row(load_gate(metrics, load_checks(max_orphan_rate, min_completeness)))
    write_audit(load_document(gated, run, layout, database, sources or {}), layout.path("audit", "load"), run)
    points = metric_points(gated).select(run.at.alias("run_ts"), "*")
    points.coalesce(1).write.mode("overwrite").json(run_folder(layout.path("audit", "metric_points"), run))
    enforce(gated)

    months = None if dates is None else sorted({d.replace(day=1) for d in dates})
    refilled = {name: aggregate_table(spark, layout, name) for name in AGGREGATES}
    for name, table in refilled.items():
        if months is None:
            table.refill(AGGREGATES[name](fact), run)
        else:
            table.replace(AGGREGATES[name](fact.filter(F.expr(PARTS[table.part]).isin(months))), months, run)
    if not spark.catalog.tableExists(f"{database}.{POINTER}"):
        point_to(spark, database, run)  # the views are made on it
    for name, table in refilled.items():
        _attach_aggregate(spark, database, name, table)
    for table, rows in staged.items():
        body = f"{database}.{table}__runs WHERE run_id = (SELECT run_id FROM {database}.{POINTER})"
        _view(spark, f"{database}.{table}", rows.columns, body)
    point_to(spark, database, run)
    return gated
