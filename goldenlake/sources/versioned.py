"""Versioned dimension tables on plain parquet.

``rows/run_id=R/slice=current`` holds all current rows as of run R, ``rows/run_id=R/slice=closed`` the rows that run R
closed, ``commits`` one JSON row per committed run. Version N is the current slice of commit N plus the closed slices of
all commits up to N, so a commit writes O(current rows) and never reads or rewrites history.

The commit row is appended last and readers follow commit rows only: a run that dies half way stays invisible and may be
repeated under the same run id. One writer per table is assumed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from goldenlake.layout import Run
from goldenlake.operators.quality import require_keys
from goldenlake.operators.scd2 import EntitySpec, scd2_next
from goldenlake.schemas import COMMIT_SCHEMA, SCD2_AUDIT_SCHEMA
from goldenlake.sources.readers import read_if_exists


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, spec: EntitySpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    # -- reading

    def history(self) -> DataFrame:
        return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")

    def last_commit(self, up_to: int | None = None) -> Row | None:
        commits = self.history()
        if up_to is not None:
            commits = commits.filter(F.col("version") <= up_to)
        return commits.agg(F.max_by(F.struct("*"), "version").alias("commit")).first().commit

    def exists(self) -> bool:
        log = read_if_exists(self.spark, f"{self.path}/commits", COMMIT_SCHEMA, "json")
        return log is not None and not log.isEmpty()

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{self.spec.ddl}, run_id string, slice string").parquet(f"{self.path}/rows")

    def _current_as_of(self, commit: Row) -> DataFrame:
        one = (F.col("slice") == "current") & (F.col("run_id") == commit.run_id)
        return self._rows().filter(one).select(*self.spec.columns)

    def _known(self, commit: Row | None, version: int | None = None) -> Row:
        if commit is None or (version is not None and commit.version != version):
            raise ValueError(f"{self.path} has no version {'yet' if version is None else version}")
        return commit

    def current(self) -> DataFrame:
        """Current rows of the latest version; reads one slice of one run."""
        return self._current_as_of(self._known(self.last_commit()))

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the latest by default."""
        commit = self._known(self.last_commit(version), version)
        committed = self.history().filter(F.col("version") <= commit.version).select("run_id")
        closed = self._rows().filter(F.col("slice") == "closed").join(committed, "run_id", "left_semi")
        return self._current_as_of(commit).unionByName(closed.select(*self.spec.columns))

    # -- writing

    def _audit_of(self, commit: Row, run: Run, source: str) -> DataFrame:
        """The audit row that was returned when ``commit`` was made."""
        told = json.loads(commit.metadata)
        counts = (told["rows_in_golden"], commit.rows_inserted, told["changed_keys"], commit.rows_inserted, commit.rows_expired)
        return self._audit(run, counts, told["action"], commit, source)

    def _audit(self, run: Run, counts: tuple[int, ...], note: str, commit: Row, source: str) -> DataFrame:
        facts = (commit.version, commit.operation, commit.run_ts, commit.metadata)
        row = (run.run_id, run.clock, *counts, note, *facts, source, self.path)
        return self.spark.createDataFrame([row], SCD2_AUDIT_SCHEMA)

    def upsert(self, golden: DataFrame, run: Run, source: str = "") -> DataFrame:
        """Bring the dimension up to a golden master and return the audit row.

        Current rows and master are joined once, and what comes of it is written once, to the run's own folder; rows are
        counted as they are written. A run without changes leaves no commit, and its folder is never read. A run that is
        already committed is not repeated: it gets the audit that it got then.
        """
        spec = self.spec
        # An empty log on first use, so that a missing one is always an error to a reader.
        self.spark.createDataFrame([], COMMIT_SCHEMA).write.mode("ignore").json(f"{self.path}/commits")
        log = self.history().agg(
            F.max_by(F.struct("*"), "version").alias("last"),
            F.max(F.when(F.col("run_id") == run.run_id, F.struct("*"))).alias("own"),
        ).first()
        if log.own is not None:
            return self._audit_of(log.own, run, source)
        before = log.last
        in_golden = require_keys(golden, spec.key)
        empty = self.spark.createDataFrame([], spec.ddl)
        current = empty if before is None else self._current_as_of(before)
        seen = Observation()
        ops = {op: F.count_if(F.col("op") == op).alias(op) for op in ("insert", "expire")}
        sliced = (
            scd2_next(golden, current, spec, run.at)
            .observe(seen, *ops.values())
            .withColumn("slice", F.when(F.col("is_current"), "current").otherwise("closed"))
            .drop("op")
        )
        sliced.write.mode("overwrite").partitionBy("slice").parquet(f"{self.path}/rows/run_id={run.run_id}")
        inserted, expired = seen.get["insert"], seen.get["expire"]
        counts = (in_golden, inserted, inserted, inserted, expired)
        if before is not None and not inserted:
            return self._audit(run, counts, "noop_no_changes", before, source)
        note = "first_run" if before is None else "merge_scd2"
        details = {
            "action": note,
            "changed_keys": inserted,
            "rows_in_golden": in_golden,
            "source_path": source,
            "target_path": self.path,
        }
        commit = Row(
            version=0 if before is None else before.version + 1,
            run_id=run.run_id,
            run_ts=run.clock,
            operation="WRITE" if before is None else "MERGE",
            rows_inserted=inserted,
            rows_expired=expired,
            rows_current=(0 if before is None else before.rows_current) + inserted - expired,
            metadata=json.dumps(details, sort_keys=True),
        )
        line = self.spark.createDataFrame([commit], COMMIT_SCHEMA)
        line.coalesce(1).write.mode("append").json(f"{self.path}/commits")
        return self._audit(run, counts, note, commit, source)
