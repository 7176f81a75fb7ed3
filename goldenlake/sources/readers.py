"""Scans."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenlake.operators.normalize import require_columns

#: Column of the lines that do not have as many fields as the header of their file.
MALFORMED = "_malformed"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _csv(spark: SparkSession):
    # The schema is held against the header of every file; lines that do not fit it are kept as text.
    return spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", MALFORMED)


def read_text_table(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """CSV with a header, every column as text, names in lower case, plus ``MALFORMED`` with lines that have too few or too
    many fields. No pass over the data to infer types.

    Columns go by name: files whose headers differ in order, case, padding or columns are read each by its own header, and a column that
    a file lacks is null in its rows. One line of each file is looked at beforehand, so this suits deliveries of master
    data, not folders of very many files.
    """
    files = sorted(spark.read.text(path).inputFiles())
    headers = defaultdict(list)
    for file in files:
        headers[tuple(spark.read.option("header", True).csv(file).columns)].append(file)
    headers.pop((), None)  # empty files have no header
    if not headers:
        raise ValueError(f"{path} has no file with a header")
    parts = []
    for header, own in headers.items():
        names = [c.strip().lower() for c in header]
        if len(set(names)) < len(names):
            raise ValueError(f"repeated column in the header of {own[0]}: {', '.join(header)}")
        schema = ", ".join(f"`{c}` string" for c in (*header, MALFORMED))
        rows = _csv(spark).schema(schema).csv(own)
        parts.append(require_columns(rows.toDF(*names, MALFORMED), required))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_uniform_text_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The same for a folder whose files must all have the header ``columns``, in this order: without a look at any file
    beforehand. A file with another header fails the scan instead of being read by position."""
    schema = ", ".join(f"`{c}` string" for c in (*columns, MALFORMED))
    return _csv(spark).schema(schema).csv(path).toDF(*[c.strip().lower() for c in columns], MALFORMED)


def _line() -> Column:
    # Not a plain test for null: Spark hands such a test to the parser, which knows malformed lines only afterwards.
    return F.coalesce(MALFORMED, F.lit(""))


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.filter(_line() == "").drop(MALFORMED)


def malformed(rows: DataFrame) -> DataFrame:
    """The lines, as text, that do not fit the header. Spark refuses to scan a CSV for these alone: this is for a written copy
    of the rows."""
    return rows.filter(_line() != "").select(F.col(MALFORMED).alias("line"))


def read_if_exists(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame | None:
    """None where the path does not exist. Any other failure is raised: it must not pass for a first run."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
