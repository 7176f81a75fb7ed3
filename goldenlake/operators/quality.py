"""Profiles, audits, rates and gates. Each is one row, computed in one pass per input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.functions.columns import share
from goldenlake.operators.rules import Rule, is_valid
from goldenlake.operators.trips import dedupe_trips, payable_trips, with_trip_metrics
from goldenlake.schemas import REQUIRED_FACT_FIELDS

# The quality thresholds.
MIN_VALID_SHARE = 0.90
MIN_COMPLETENESS = 0.99
MAX_ORPHAN_RATE = 0.01


class Check(NamedTuple):
    """``fails`` is a SQL predicate over a metrics row, ``message`` the SQL text expression reported when it holds."""

    fails: str
    message: str


class GateFailed(RuntimeError):
    pass


def merge_rows(*rows: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row with a count column per frame. On a parquet table Spark counts from the footers."""
    return merge_rows(*[df.agg(F.count("*").alias(name)) for name, df in frames.items()])


def table_counts(**frames: DataFrame) -> DataFrame:
    """The same counts as (table_name, row_count) rows."""
    return row_counts(**frames).unpivot([], list(frames), "table_name", "row_count")


# -- gates


def with_gate(metrics: DataFrame, checks: Sequence[Check], passed: str = "SUCCESS", failed: str = "FAILED") -> DataFrame:
    errors = F.array_compact(F.array(*[F.when(F.expr(c.fails), F.expr(c.message)) for c in checks]))
    return metrics.withColumn("errors", errors).withColumn(
        "status", F.when(F.size("errors") > 0, failed).otherwise(passed)
    )


def enforce(gated: DataFrame) -> None:
    """Raise when the (one-row) gated frame holds errors."""
    row = gated.select("errors").first()
    if row and row.errors:
        raise GateFailed("; ".join(row.errors))


def validation_checks(min_share: float = MIN_VALID_SHARE) -> list[Check]:
    return [
        Check(
            f"rows_in > 0 AND valid_pct < {min_share}D",
            f"format_string('valid share %.4f below %.2f', valid_pct, {min_share}D)",
        )
    ]


def load_checks(
    max_orphan_rate: float = MAX_ORPHAN_RATE, min_completeness: float | None = None, tables: Sequence[str] = ()
) -> list[Check]:
    names = tables or ("zone_dim", "vendor_dim", "fact_trips")
    checks = [Check(f"{t} = 0", f"'{t} empty'") for t in names]
    if min_completeness is not None:
        checks.append(
            Check(f"completeness < {min_completeness}D", f"format_string('completeness %.4f', completeness)")
        )
    checks.append(
        Check(
            f"zone_orphan_rate > {max_orphan_rate}D", "format_string('zone orphan rate %.4f', zone_orphan_rate)"
        )
    )
    return checks


# -- keys


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, rows without a key and keys that occur more than once. Counts per key combine before the shuffle."""
    known = F.col(key).isNotNull()
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(known & (F.col("n") > 1)).alias("duplicate_keys"),
        )
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("row_count")).filter("row_count > 1")


class BadKeys(ValueError):
    pass


def require_keys(df: DataFrame, key: str) -> int:
    """The number of rows of a master with exactly one row per key; raises on null or repeated keys or no rows."""
    profile = key_profile(df, key).first()
    if profile.null_keys:
        raise BadKeys(f"{profile.null_keys} rows have no {key}")
    if profile.duplicate_keys:
        raise BadKeys(f"{profile.duplicate_keys} values of {key} occur more than once")
    if not profile.row_count:
        raise BadKeys("the master is empty")
    return profile.row_count


def require_known(df: DataFrame, key: str) -> None:
    """Raise when any row has no key; stops at the first such row."""
    if not df.filter(F.col(key).isNull()).isEmpty():
        raise BadKeys(f"rows without {key}")


# -- audits


def validation_shares(counts: DataFrame, run_ts: Column) -> DataFrame:
    """Audit row from ``rows_in``, ``rows_valid`` and ``rows_quarantined``."""
    return counts.select(
        run_ts.alias("run_ts"),
        "rows_in",
        "rows_valid",
        "rows_quarantined",
        share(F.col("rows_valid"), F.col("rows_in")).alias("valid_pct"),
    )


def validation_audit(df: DataFrame, rules: Sequence[Rule], run_ts: Column) -> DataFrame:
    ok = is_valid(rules)
    counts = df.agg(
        F.count("*").alias("rows_in"), F.count_if(ok).alias("rows_valid"), F.count_if(~ok).alias("rows_quarantined")
    )
    return validation_shares(counts, run_ts)


def process_shares(counts: DataFrame, run_ts: Column) -> DataFrame:
    return counts.select(
        run_ts.alias("run_ts"),
        "rows_in",
        "rows_after_dedupe",
        "rows_out",
        share(F.col("rows_in") - F.col("rows_after_dedupe"), F.col("rows_in")).alias("dedupe_reduction_pct"),
    )


def process_audit(validated: DataFrame, run_ts: Column) -> DataFrame:
    """Counts around the deduplication; the deduplication itself runs once for both of its counts."""
    deduped = with_trip_metrics(dedupe_trips(payable_trips(validated))).agg(
        F.count("*").alias("rows_after_dedupe"), F.count_if(F.col("trip_duration_minutes") > 0).alias("rows_out")
    )
    return process_shares(merge_rows(validated.agg(F.count("*").alias("rows_in")), deduped), run_ts)


def _malformed_rows(counts: DataFrame) -> Column:
    return F.col("rows_malformed") if "rows_malformed" in counts.columns else F.lit(0)


def golden_shares(counts: DataFrame, labels: Mapping[str, str], run_ts: Column) -> DataFrame:
    """Audit row from ``rows_in`` and ``rows_out`` and, where a source has them, ``rows_malformed``. ``labels`` are constant text columns, such as the business key."""
    return counts.select(
        run_ts.alias("run_ts"),
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out") - _malformed_rows(counts)).alias("duplicates_removed"),
        *(["rows_malformed"] if "rows_malformed" in counts.columns else []),
        *[F.lit(text).alias(name) for name, text in labels.items()],
    )


def golden_audit(source: DataFrame, key: str, labels: Mapping[str, str], run_ts: Column) -> DataFrame:
    """The audit of a master with one golden record per key, in one pass over its source."""
    per_key = source.groupBy(key).agg(F.count("*").alias("n"))
    counts = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.count("*").alias("rows_out"))
    return golden_shares(counts, labels, run_ts)


# The constant columns of the two master audits.
ZONE_AUDIT_LABELS = {
    "business_key": "LocationID",
    "matching_type": "deterministic",
    "survivorship": "longest zone name",
}
VENDOR_AUDIT_LABELS = {
    "business_key": "VendorID",
    "matching_type": "deterministic",
    "mapping_source": "TLC data dictionary",
}


def fact_audit(fact: DataFrame, run_ts: Column) -> DataFrame:
    rows = F.count("*")
    return fact.agg(
        run_ts.alias("run_ts"),
        rows.alias("rows_total"),
        share(F.count_if("zone_orphan_flag"), rows).alias("zone_orphan_rate"),
        share(F.count_if("vendor_orphan_flag"), rows).alias("vendor_orphan_rate"),
    )


# -- fact quality


def completeness(fact: DataFrame, fields: Sequence[str] = REQUIRED_FACT_FIELDS) -> DataFrame:
    """Share of rows in which every required field is known; 1 for no rows."""
    return fact.agg(F.count("*").alias("fact_count"), _incomplete(fields).alias("null_rows")).select(
        "fact_count", "null_rows", (1.0 - share(F.col("null_rows"), F.col("fact_count"))).alias("completeness_pct")
    )


def _incomplete(fields: Sequence[str]) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, (F.col(f).isNull() for f in fields)))


def completeness_amount(fact: DataFrame, field: str = "total_amount") -> DataFrame:
    """Share of rows with a known amount; 0 for no rows."""
    return fact.agg(share(F.count(field), F.count("*")).alias("completeness"))


def orphan_rate(fact: DataFrame, flag: str = "zone_orphan_flag") -> DataFrame:
    return fact.agg(share(F.count_if(flag), F.count("*")).alias("zone_orphan_rate"))


def orphan_rate_join(fact: DataFrame, zone_dim: DataFrame) -> DataFrame:
    """Share of facts whose zone key is in no version of the dimension.

    Facts are counted per key first, so what meets the dimension is one row per key, however hot a key is.
    """
    per_key = fact.groupBy("pickup_zone_key").agg(F.count("*").alias("n"))
    keys = zone_dim.select(F.col("zone_key").alias("pickup_zone_key"), F.lit(True).alias("known"))
    n = F.coalesce(F.sum("n"), F.lit(0))
    lost = F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0))
    return per_key.join(keys, "pickup_zone_key", "left").agg(share(lost, n).alias("orphan_rate"))


def load_metrics(fact: DataFrame, zone_dim: DataFrame, vendor_dim: DataFrame) -> DataFrame:
    """Everything the load gate looks at, with one pass over the fact."""
    rows = F.count("*")
    return merge_rows(
        zone_dim.agg(F.count("*").alias("zone_dim")),
        vendor_dim.agg(F.count("*").alias("vendor_dim")),
        fact.agg(
            rows.alias("fact_trips"),
            share(F.count("total_amount"), rows).alias("completeness"),
            share(F.count_if("zone_orphan_flag"), rows).alias("zone_orphan_rate"),
        ),
    )


def load_gate(metrics: DataFrame, checks: Sequence[Check] | None = None) -> DataFrame:
    return with_gate(metrics, load_checks(min_completeness=MIN_COMPLETENESS) if checks is None else checks)


def governance_metrics(
    fact: DataFrame,
    zones: DataFrame,
    vendors: DataFrame,
    run_ts: Column,
    min_completeness: float = MIN_COMPLETENESS,
    max_orphan_rate: float = MAX_ORPHAN_RATE,
) -> DataFrame:
    rows = F.count("*")
    counted = merge_rows(
        fact.agg(
            rows.alias("fact_count"),
            (1.0 - share(_incomplete(REQUIRED_FACT_FIELDS), rows)).alias("completeness_pct"),
            share(F.count_if("zone_orphan_flag"), rows).alias("zone_orphan_rate"),
            share(F.count_if("vendor_orphan_flag"), rows).alias("vendor_orphan_rate"),
        ),
        zones.agg(F.count_if("is_current").alias("current_zones")),
        vendors.agg(F.count_if("is_current").alias("current_vendors")),
    )
    healthy = (
        (F.col("completeness_pct") >= min_completeness)
        & (F.col("zone_orphan_rate") <= max_orphan_rate)
        & (F.col("vendor_orphan_rate") <= max_orphan_rate)
    )
    return counted.select(
        run_ts.alias("run_ts_utc"), "*", F.when(healthy, "PASS").otherwise("FAIL").alias("pipeline_status")
    )
