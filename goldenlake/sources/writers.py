"""Sinks. A path that is written is never read by the same plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from goldenlake.layout import Run


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace a dataset and return it as read back: later steps scan files instead of repeating the plan."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_folder(path: str, run: Run) -> str:
    return f"{path}/run_id={run.run_id}"


def snapshot(df: DataFrame, path: str, run: Run) -> DataFrame:
    """Add this run's copy of a dataset. Repeating a run replaces its own copy and no other, so readers of earlier copies
    are not disturbed."""
    return overwrite(df, run_folder(path, run))


class NotOneRow(ValueError):
    pass


def one_row(df: DataFrame) -> DataFrame:
    """``df``, which must have exactly one row, as a local frame of the same schema."""
    rows = df.take(2)
    if len(rows) != 1:
        raise NotOneRow(f"expected one row, found {'more' if rows else 'none'}")
    return df.sparkSession.createDataFrame(rows, df.schema)


def write_audit(audit: DataFrame, path: str, run: Run) -> DataFrame:
    """Add this run's one-row audit as JSON and return the row as a local frame. Repeating a run replaces its own row."""
    local = one_row(audit)
    local.coalesce(1).write.mode("overwrite").json(run_folder(path, run))
    return local


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, in as many files as Spark writes or, if asked for, in one, which one task then writes."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
