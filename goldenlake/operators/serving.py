"""Serving aggregates and metric points.

Sums are exact: each amount becomes a decimal of a stated number of digits behind the point, and decimals add up to the same
number in any order, so a result does not depend on how the rows were dealt over tasks. A number that has more digits
before the point than fit, or is none, raises an error instead of disappearing; so does a sum beyond ten digits more.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits of an amount in all, and behind the point: the grid that amounts and distances lie on.
DIGITS, MONEY_SCALE, DISTANCE_SCALE = 18, 4, 6


def exact_sql(column: str, scale: int = MONEY_SCALE, digits: int = DIGITS) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN NULL "
        f"WHEN abs({column}) < 1e{digits - scale}D THEN CAST({column} AS decimal({digits}, {scale})) "
        f"ELSE raise_error(concat('{column} does not fit decimal({digits},{scale}): ', CAST({column} AS string))) END"
    )


def exact_sum_sql(column: str, scale: int = MONEY_SCALE, digits: int = DIGITS) -> str:
    return f"sum({exact_sql(column, scale, digits)})"


def exact_sum(column: str, scale: int = MONEY_SCALE, digits: int = DIGITS) -> Column:
    """The sum as a decimal; null where all numbers are."""
    return F.expr(exact_sum_sql(column, scale, digits))


def exact_avg(column: str, scale: int = MONEY_SCALE, digits: int = DIGITS) -> Column:
    """The exact sum divided by the count, as a double."""
    return exact_sum(column, scale, digits).cast("double") / F.nullif(F.count(column), F.lit(0))


def agg_daily_zone_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trip_date", "pickup_zone_key").agg(
        F.count("*").alias("trip_count"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("fare_amount").alias("avg_fare"),
    )


def agg_daily_vendor_perf(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trip_date", F.col("vendorid").alias("vendor_code")).agg(
        F.count("*").alias("trip_count"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("trip_distance", DISTANCE_SCALE).alias("avg_trip_distance"),
    )


def daily_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trip_date").agg(exact_sum("total_amount").alias("revenue"))


def exact_totals(fact: DataFrame) -> DataFrame:
    """One row per vendor: counts and exact sums of every measure, each on its own grid."""
    return fact.groupBy("vendorid").agg(
        F.count("*").alias("trips"),
        exact_sum("total_amount").alias("total_amount"),
        exact_sum("fare_amount").alias("fare_amount"),
        exact_sum("trip_distance", DISTANCE_SCALE).alias("trip_distance"),
        exact_sum("trip_duration_minutes", 2).alias("trip_duration_minutes"),
    )


def serving_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Columns of a serving table by name; the order of the source columns does not matter."""
    return df.select(*[F.col(source).alias(target) for target, source in mapping.items()])


# Published metric, the SQL over a gated load row that gives it, and its unit.
METRIC_POINTS = (
    ("FactRowCount", "fact_trips", "Count"),
    ("ZoneDimRowCount", "zone_dim", "Count"),
    ("VendorDimRowCount", "vendor_dim", "Count"),
    ("CompletenessPct", "completeness * 100", "Percent"),
    ("OrphanRatePct", "zone_orphan_rate * 100", "Percent"),
    ("PipelineDQStatus", "if(status = 'SUCCESS', 1, 0)", "Count"),
)


def metric_points(gated: DataFrame) -> DataFrame:
    """One (name, value, unit) row per metric of a gated load row."""
    points = ", ".join(f"'{name}', CAST({value} AS double), '{unit}'" for name, value, unit in METRIC_POINTS)
    return gated.selectExpr(f"stack({len(METRIC_POINTS)}, {points}) AS (name, value, unit)")
