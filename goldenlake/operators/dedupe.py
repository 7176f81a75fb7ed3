"""One surviving row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def survivor(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the first row of each key under a total order: ``order``, then every remaining column, nulls first.

    ``row_number() = 1`` makes Spark keep one row per key and task before the shuffle (WindowGroupLimit), so a key that
    holds a large share of all rows reaches its reducer as one row per map task.
    """
    ranked = [c if isinstance(c, Column) else F.col(c) for c in order]
    named = {c.lower() for c in (*keys, *order) if isinstance(c, str)}
    ties = [F.col(c) for c in df.columns if c.lower() not in named]
    window = Window.partitionBy(*keys).orderBy(*[c.asc_nulls_first() for c in (*ranked, *ties)])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
