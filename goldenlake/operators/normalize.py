"""Types and columns of arriving data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise MissingColumns(f"missing required columns: {', '.join(missing)}")
    return df


def _as_type(name: str, have: str, want: str) -> Column:
    column = F.col(f"`{name}`")
    if want == "time":
        if have in ("timestamp", "timestamp_ntz"):
            return column
        want = "timestamp_ntz"
    # A column that already has its type stays bare, so that filters on it still reach the scan.
    return column if have == want else column.try_cast(want)


def normalize_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in one projection, malformed values to null. Other columns pass through."""
    require_columns(df, types)
    return df.select(
        *[
            _as_type(name, have, types[name.lower()]).alias(name.lower())
            if name.lower() in types
            else F.col(f"`{name}`")
            for name, have in df.dtypes
        ]
    )
