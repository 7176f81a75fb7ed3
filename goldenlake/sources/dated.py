"""Tables laid out by date (or month), of which a run replaces only the dates that changed.

``rows/run_id=R/<part>=D`` holds the rows of date D as run R left them, ``dates/run_id=R`` one row for each date that R
touched, with its number of rows and a fingerprint of their content. What a date holds now is told by the last run that
touched it. Which dates a run has to touch follows from the fingerprints of what arrived: new and corrected rows, rows that
vanished and rows whose surrogate keys moved with a dimension all change them. Files of other dates keep their names.

The record of dates is written last: a run that dies before is invisible, and repeating it replaces its own folder and no
other. Runs follow each other by clock; a run older than the last one is refused. One writer per table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldenlake.layout import Run
from goldenlake.schemas import DATES_SCHEMA
from goldenlake.sources.readers import read_if_exists

# Partition columns a table may be laid out by, as SQL over its own columns. Days suit tables with many rows a day.
PARTS = {"trip_date": "trip_date", "trip_month": "CAST(trunc(trip_date, 'MM') AS date)"}


#: Tasks put their files in place themselves. What a job leaves that dies meanwhile is not read, as no record names it.
_WRITE_ONCE = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def contents(df: DataFrame, part: str) -> DataFrame:
    """(part, rows, content): a fingerprint of the rows of each date that does not depend on their order.

    Sums of two hashes of whole rows, exact in decimals; tasks add up their own rows before the shuffle, however hot a
    date is.
    """
    columns = sorted(df.columns)
    hashes = (F.xxhash64(*columns), F.xxhash64(F.lit("again"), *columns))
    sums = [F.sum(h.cast("decimal(28, 0)")).cast("string") for h in hashes]
    return df.groupBy(F.expr(PARTS[part]).alias("part")).agg(
        F.count("*").alias("rows"), F.concat_ws(":", F.count("*").cast("string"), *sums).alias("content")
    )


def _latest(records: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("run_ts", "run_id", "rows", "content"), F.struct("run_ts", "run_id"))
    return records.groupBy("part").agg(last.alias("last")).select("part", "last.*")


class DatedTable:
    def __init__(self, spark: SparkSession, path: str, part: str = "trip_date", file_rows: int = 5_000_000):
        self.spark, self.path, self.part, self.file_rows = spark, path.rstrip("/"), part, file_rows

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def dates_path(self) -> str:
        return f"{self.path}/dates"

    @property
    def _columns_path(self) -> str:
        """An empty frame from the first run, which tells the columns of a table that holds no rows yet."""
        return f"{self.path}/columns"

    # -- reading

    def records(self) -> DataFrame:
        """Every date of every run."""
        schema = f"{DATES_SCHEMA}, run_id string"
        found = read_if_exists(self.spark, self.dates_path, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def touched(self, run: Run) -> DataFrame:
        """(part, rows) of the dates that a run replaced; 0 rows where nothing was left."""
        return self.records().filter(F.col("run_id") == run.run_id).select("part", "rows")

    def live(self) -> DataFrame:
        """(part, run_ts, run_id, rows, content) of the dates that hold rows."""
        return _latest(self.records()).filter("rows > 0")

    def read(self) -> DataFrame:
        """All rows. Dates are picked by partition filters, so only live folders are scanned."""
        folders = defaultdict(list)
        for r in self.live().select("run_id", "part").collect():  # one row a date
            folders[r.run_id].append(r.part)
        if not folders:
            return self.spark.createDataFrame([], self.schema())
        paths = [f"{self.rows_path}/run_id={run}" for run in folders]
        data = self.schema()
        schema = StructType([*data]).add("run_id", "string")
        rows = self.spark.read.schema(schema).option("basePath", self.rows_path).parquet(*paths)
        wanted: Column | None = None
        for run, dates in folders.items():
            one = (F.col("run_id") == run) & F.col(self.part).isin(dates)
            wanted = one if wanted is None else wanted | one
        return rows.filter(wanted).select(*data.names)

    def schema(self) -> StructType:
        """Columns as the last run wrote them, the date last; one folder is looked at."""
        last = self.records().filter("rows > 0").agg(F.max_by(F.struct("run_id", "part"), F.struct("run_ts", "run_id"))).first()[0]
        if last is None:
            if read_if_exists(self.spark, self._columns_path, "_ int") is None:
                raise ValueError(f"{self.path} was never written")
            return self.spark.read.parquet(self._columns_path).schema
        inside = self.spark.read.parquet(self.folder(last.run_id, last.part)).schema
        return StructType([*inside]).add(self.part, "date")

    # -- writing

    def changed(self, df: DataFrame, run: Run) -> DataFrame:
        """(part, rows, content) of the dates whose rows differ from what the runs before left; rows is 0 where none are left."""
        earlier = (F.col("run_ts") < run.at) | ((F.col("run_ts") == run.at) & (F.col("run_id") < run.run_id))
        old = _latest(self.records().filter(earlier)).filter("rows > 0")
        old = old.select("part", F.col("content").alias("old"))
        return (
            contents(df, self.part)
            .join(old, "part", "full")
            .filter(~F.equal_null("content", "old"))
            .select("part", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.coalesce("content", F.lit("")).alias("content"))
        )

    def refill(self, df: DataFrame, run: Run) -> list[Row]:
        """Bring the table up to ``df``, writing only dates that changed; returns (part, rows, content) of these."""
        self._in_order(run)
        return self._write(df, self.changed(df, run).collect(), run)  # one row a date

    def replace(self, df: DataFrame, dates: Iterable[date], run: Run) -> list[Row]:
        """Replace the given dates by what ``df`` holds of them, without looking at others."""
        self._in_order(run)
        dates = sorted(set(dates))
        asked = self.spark.createDataFrame([(d,) for d in dates], "part date")
        own = df.filter(F.expr(PARTS[self.part]).isin(dates))
        held = asked.join(contents(own, self.part), "part", "left")
        held = held.select("part", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.coalesce("content", F.lit("")).alias("content"))
        return self._write(own, held.collect(), run)

    def _in_order(self, run: Run) -> None:
        later = (F.col("run_ts") > run.at) | ((F.col("run_ts") == run.at) & (F.col("run_id") > run.run_id))
        if not self.records().filter(later).isEmpty():
            raise ValueError(f"{self.path} holds later runs than {run.run_id}")

    def _write(self, df: DataFrame, dates: list[Row], run: Run) -> list[Row]:
        if any(r.part is None for r in dates):
            raise ValueError(f"rows without {self.part}")
        typed = df.withColumn(self.part, F.expr(PARTS[self.part])).select(*[c for c in df.columns if c != self.part], self.part)
        self.spark.createDataFrame([], typed.schema).write.mode("ignore").parquet(self._columns_path)
        filled = {r.part: r.rows for r in dates if r.rows}
        if filled:
            placed = df.withColumn(self.part, F.expr(PARTS[self.part])).filter(F.col(self.part).isin(list(filled)))
            self._dealt(placed, filled).write.mode("overwrite").options(**_WRITE_ONCE).partitionBy(self.part).parquet(
                f"{self.rows_path}/run_id={run.run_id}"
            )
        record = self.spark.createDataFrame([(r.part, r.rows, r.content, run.clock) for r in dates], DATES_SCHEMA)
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.dates_path}/run_id={run.run_id}")
        return dates

    def _dealt(self, placed: DataFrame, rows: Mapping[date, int]) -> DataFrame:
        """Rows dealt over tasks by date. Dates with more rows than a file shall hold are cut into pieces, so a hot date
        isn't left to one task; a small one is one file."""
        pieces = {d: -(-n // self.file_rows) for d, n in rows.items() if n > self.file_rows}
        keys = [F.col(self.part)]
        if pieces:
            number = F.create_map(*[F.lit(x) for pair in pieces.items() for x in pair])
            own = F.coalesce(F.try_element_at(number, F.col(self.part)), F.lit(1))
            keys.append(F.pmod(F.xxhash64(*placed.columns), own))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return placed.repartition(max(tasks, sum(pieces.values())), *keys)

    def folder(self, run_id: str, part: date) -> str:
        return f"{self.rows_path}/run_id={run_id}/{self.part}={part.isoformat()}"
