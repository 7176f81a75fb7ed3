"""Slowly changing dimensions, type 2, as pure DataFrame functions.

A dimension row is: surrogate key, business key, attributes, hash_diff, version_number, is_current, start_date, end_date.
Zones and vendors are two specs of the same operators. The clock is an argument, so a rerun gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.functions.columns import hash_diff, surrogate_key


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    attributes: tuple[str, ...]
    surrogate: str
    types: tuple[str, ...] = ()  # of the attributes; text where not given

    @property
    def columns(self) -> list[str]:
        return [
            self.surrogate,
            self.key,
            *self.attributes,
            "hash_diff",
            "version_number",
            "is_current",
            "start_date",
            "end_date",
        ]

    @property
    def ddl(self) -> str:
        types = self.types or ("string",) * len(self.attributes)
        attributes = "".join(f"{a} {t}, " for a, t in zip(self.attributes, types, strict=True))
        return (
            f"{self.surrogate} string, {self.key} int, {attributes}hash_diff string, version_number int, "
            "is_current boolean, start_date timestamp_ntz, end_date timestamp_ntz"
        )


ZONES = EntitySpec("dim_zones", "locationid", ("zone", "borough"), "zone_key")
VENDORS = EntitySpec("dim_vendors", "vendorid", ("vendor_name",), "vendor_key")
VENDORS_V0 = EntitySpec(
    "dim_vendors_v0", "vendor_code", ("vendor_name", "active_flag"), "vendor_key", ("string", "boolean")
)


def with_hash_diff(golden: DataFrame, spec: EntitySpec) -> DataFrame:
    return golden.select(spec.key, *spec.attributes, hash_diff(spec.key, spec.attributes).alias("hash_diff"))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def _open_version(rows: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    """Complete rows that carry key, attributes, hash and version to current dimension rows that start now."""
    return rows.select(
        surrogate_key(spec.key, at, F.col("version_number")).alias(spec.surrogate),
        spec.key,
        *spec.attributes,
        "hash_diff",
        "version_number",
        F.lit(True).alias("is_current"),
        at.alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
    )


def scd2_initial(golden: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    return _open_version(with_hash_diff(golden, spec).withColumn("version_number", F.lit(1)), spec, at)


def scd2_changes(golden: DataFrame, dim: DataFrame, spec: EntitySpec) -> DataFrame:
    """Golden records that are new or differ from their current version, with the version number they get next."""
    known = current_rows(dim).select(
        F.col(spec.key), F.col("hash_diff").alias("_known_hash"), F.col("version_number").alias("_known_version")
    )
    return (
        with_hash_diff(golden, spec)
        .join(known, spec.key, "left")
        .filter("_known_version IS NULL OR hash_diff <> _known_hash")
        .select(
            spec.key,
            *spec.attributes,
            "hash_diff",
            (F.coalesce("_known_version", F.lit(0)) + 1).alias("version_number"),
        )
    )


def scd2_stage(changes: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    """Two rows per change: an expire row that carries the key to match, and an insert row that must not match."""
    types = dict(changes.dtypes)
    payload = [spec.surrogate, *spec.attributes, "hash_diff", "version_number"]

    def absent(column: str) -> Column:
        return F.lit(None).cast(types.get(column, "string")).alias(column)

    expire = changes.select(
        F.col(spec.key).alias("merge_key"), F.lit("expire").alias("op"), spec.key, *[absent(c) for c in payload]
    )
    insert = changes.select(
        F.lit(None).cast(types[spec.key]).alias("merge_key"),
        F.lit("insert").alias("op"),
        spec.key,
        surrogate_key(spec.key, at, F.col("version_number")).alias(spec.surrogate),
        *payload[1:],
    )
    return expire.unionByName(insert)


def scd2_next(golden: DataFrame, dim: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    """(op, dimension columns): what becomes of the current rows under a golden master, in one full join by key.

    A key that did not change, or vanished from the master, keeps its row (``keep``). A changed one gives two rows: its
    version closed (``expire``) and the next one open (``insert``). A new one opens its first version. History does not
    enter the join.
    """
    old = current_rows(dim).select(F.col(spec.key).alias("_old_key"), F.struct(*spec.columns).alias("old"))
    new = with_hash_diff(golden, spec)
    new = new.select(F.col(spec.key).alias("_new_key"), F.struct(*new.columns).alias("new"))
    paired = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")

    found, known = F.col("_new_key").isNotNull(), F.col("_old_key").isNotNull()
    moved = found & known & (F.col("new.hash_diff") != F.col("old.hash_diff"))
    version = F.coalesce(F.col("old.version_number"), F.lit(0)) + 1
    opened = {
        spec.surrogate: surrogate_key(f"new.{spec.key}", at, version),
        "version_number": version,
        "is_current": F.lit(True),
        "start_date": at,
        "end_date": F.lit(None).cast("timestamp_ntz"),
    }
    closed = {"is_current": F.lit(False), "end_date": at}

    def row(op: str, side: str, changes: dict[str, Column]) -> Column:
        return F.struct(
            F.lit(op).alias("op"), *[changes.get(c, F.col(f"{side}.{c}")).alias(c) for c in spec.columns]
        )

    rows = F.array_compact(
        F.array(
            F.when(known & ~moved, row("keep", "old", {})),
            F.when(moved, row("expire", "old", closed)),
            F.when(moved | ~known, row("insert", "new", opened)),
        )
    )
    return paired.select(F.inline(rows))


def scd2_expire(dim: DataFrame, golden: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    """The dimension with the versions that a golden master replaces closed, before new ones are opened."""
    rest = scd2_next(golden, dim, spec, at).filter("op <> 'insert'").drop("op")
    return dim.filter("NOT is_current").select(*spec.columns).unionByName(rest)


def scd2_merge(dim: DataFrame, golden: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    """The dimension brought up to a golden master. Closed rows pass by."""
    current = scd2_next(golden, dim, spec, at).drop("op")
    return dim.filter("NOT is_current").select(*spec.columns).unionByName(current)


def scd2_as_of(dim: DataFrame, spec: EntitySpec, at: Column) -> DataFrame:
    """The dimension as it was at a time, told from its validity dates: rows that began by then, open where they had not
    ended yet."""
    ended = F.col("end_date") <= at
    return dim.filter(F.col("start_date") <= at).select(
        *[c for c in spec.columns if c not in ("is_current", "start_date", "end_date")],
        (~F.coalesce(ended, F.lit(False))).alias("is_current"),
        "start_date",
        F.when(ended, F.col("end_date")).alias("end_date"),
    ).select(*spec.columns)


def scd2_audit(staged: DataFrame, golden_rows: Column, spec: EntitySpec, run_ts: Column) -> DataFrame:
    """One row, counted from the staged rows: an insert above version 1 closes one current row."""
    inserts = F.col("op") == "insert"
    changed = F.count_if(inserts)
    return staged.agg(
        run_ts.alias("run_ts"),
        golden_rows.alias("rows_in_golden"),
        changed.alias("changed_input_rows"),
        F.count_distinct(F.when(inserts, F.col(spec.key))).alias("changed_keys"),
        changed.alias("rows_inserted"),
        F.count_if(inserts & (F.col("version_number") > 1)).alias("rows_expired"),
        F.when(changed == 0, "noop_no_changes").otherwise("merge_scd2").alias("note"),
    )


def scd2_violations(dim: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per broken invariant with the number of keys that break it; all zero on a sound dimension."""
    per_key = dim.groupBy(spec.key).agg(
        F.count_if("is_current").alias("current"),
        F.count("*").alias("rows"),
        F.min("version_number").alias("first"),
        F.max("version_number").alias("last"),
        F.count_distinct("version_number").alias("versions"),
        F.count_if(F.col("is_current") != F.col("end_date").isNull()).alias("open_mismatch"),
        F.count_if(F.col("start_date") > F.col("end_date")).alias("backwards"),
    )
    checks = {
        "more_than_one_current": "current > 1",
        "versions_not_contiguous": "first <> 1 OR last <> versions",
        "version_repeated": "rows <> versions",
        "open_end_not_current": "open_mismatch > 0",
        "ends_before_start": "backwards > 0",
    }
    counted = per_key.agg(*[F.count_if(F.expr(test)).alias(name) for name, test in checks.items()])
    return counted.unpivot([], list(checks), "invariant", "keys")
