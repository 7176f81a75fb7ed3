"""Column expressions shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"


def hash_diff(key: str, attributes: Iterable[str]) -> Column:
    """Fingerprint of a master record; a null attribute and an empty one give the same fingerprint."""
    parts = [F.coalesce(F.col(a).cast("string"), F.lit("")) for a in attributes]
    return F.sha2(F.concat_ws(SEPARATOR, F.col(key).cast("string"), *parts), 256)


def surrogate_key(key: str, at: Column, version: Column) -> Column:
    return F.sha2(F.concat_ws(SEPARATOR, F.col(key).cast("string"), at.cast("string"), version.cast("string")), 256)


def share(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """``part / whole``, or ``empty`` where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))


def blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def elapsed_seconds(start: str, end: str) -> Column:
    """Whole seconds; fractions are cut from both ends before the difference is taken."""
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
