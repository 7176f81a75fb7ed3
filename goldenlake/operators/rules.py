"""Row validation by named predicates.

Each rule says in SQL what an acceptable row looks like, so that the conjunction of a rule list splits into filters the
parquet scan can apply. A predicate that evaluates to null counts as broken.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    name: str
    ok: str


_TIMES = (
    Rule("pickup_known", "tpep_pickup_datetime IS NOT NULL"),
    Rule("dropoff_known", "tpep_dropoff_datetime IS NOT NULL"),
    Rule("dropoff_after_pickup", "tpep_dropoff_datetime > tpep_pickup_datetime"),
)
# An unknown measure is acceptable, a negative one is not.
_MEASURES = (
    Rule("distance_not_negative", "trip_distance IS NULL OR trip_distance >= 0"),
    Rule("fare_not_negative", "fare_amount IS NULL OR fare_amount >= 0"),
    Rule("total_not_negative", "total_amount IS NULL OR total_amount >= 0"),
)

TRIP_RULES = (
    Rule("vendor_known", "vendorid IS NOT NULL"),
    *_TIMES,
    *_MEASURES,
    Rule("pickup_zone_known", "pulocationid IS NOT NULL"),
    Rule("dropoff_zone_known", "dolocationid IS NOT NULL"),
)

# The earlier rule list: keys unchecked, passengers checked.
TRIP_RULES_V0 = (*_TIMES, Rule("has_passenger", "passenger_count IS NULL OR passenger_count >= 1"), *_MEASURES)


def acceptable(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, (F.expr(f"({r.ok})") for r in rules))


def is_valid(rules: Sequence[Rule]) -> Column:
    """Like :func:`acceptable`, but never null."""
    return F.coalesce(acceptable(rules), F.lit(False))


def flag_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("is_valid", is_valid(rules))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, for reading a quarantine."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(F.expr(f"({r.ok})"), F.lit(False)), F.lit(r.name)) for r in rules])
    )


def split(df: DataFrame, rules: Sequence[Rule], keep: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows with the columns in ``keep``, and all other rows with every column.

    Both are filters over the same input: each writes its own scan, with only its own columns, and no row is counted,
    cached or shuffled on the way.
    """
    return df.filter(acceptable(rules)).select(*keep), df.filter(~is_valid(rules))
