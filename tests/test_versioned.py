import json

import pytest
from helpers import rows, ts

from goldenlake.layout import Run
from goldenlake.operators import scd2 as s
from goldenlake.operators.quality import BadKeys
from goldenlake.sources.versioned import VersionedTable

RUNS = [Run(f"r{n}", f"2024-0{n}-01 00:00:00") for n in range(1, 6)]


@pytest.fixture
def dim(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "dim"), s.ZONES)


def golden(spark, **boroughs):
    return spark.createDataFrame([(int(k[1:]), "Z", b) for k, b in boroughs.items()], "locationid int, zone string, borough string")


def state(df):
    return sorted((r.locationid, r.version_number, r.borough, r.is_current) for r in df.collect())


def test_life_of_a_dimension(spark, dim):
    assert not dim.exists()
    first = dim.upsert(golden(spark, k1="A", k2="B"), RUNS[0], "here").first()
    assert dim.exists()
    assert (first.note, first.rows_inserted, first.rows_expired, first.commit_version) == ("first_run", 2, 0, 0)

    quiet = dim.upsert(golden(spark, k1="A", k2="B"), RUNS[1]).first()
    assert (quiet.note, quiet.rows_inserted, quiet.commit_version) == ("noop_no_changes", 0, 0)

    merged = dim.upsert(golden(spark, k1="A2", k3="C"), RUNS[2]).first()
    assert (merged.note, merged.rows_inserted, merged.rows_expired, merged.commit_version) == ("merge_scd2", 2, 1, 1)
    assert (merged.commit_operation, merged.commit_ts) == ("MERGE", ts(RUNS[2].run_ts))
    assert json.loads(merged.commit_metadata)["changed_keys"] == 2

    dim.upsert(golden(spark, k1="A"), RUNS[3])
    assert state(dim.read()) == [
        (1, 1, "A", False), (1, 2, "A2", False), (1, 3, "A", True), (2, 1, "B", True), (3, 1, "C", True),
    ]
    assert state(dim.current()) == [(1, 3, "A", True), (2, 1, "B", True), (3, 1, "C", True)]
    assert state(dim.read(0)) == [(1, 1, "A", True), (2, 1, "B", True)]
    assert state(dim.read(1)) == [(1, 1, "A", False), (1, 2, "A2", True), (2, 1, "B", True), (3, 1, "C", True)]
    log = [(c.version, c.run_id, c.operation, c.rows_inserted, c.rows_expired, c.rows_current) for c in dim.history().collect()]
    assert sorted(log) == [(0, "r1", "WRITE", 2, 0, 2), (1, "r3", "MERGE", 2, 1, 3), (2, "r4", "MERGE", 1, 1, 3)]
    assert {r.keys for r in s.scd2_violations(dim.read(), s.ZONES).collect()} == {0}
    with pytest.raises(ValueError, match="no version 9"):
        dim.read(9)


def test_stored_equals_in_memory(spark, dim):
    dim.upsert(golden(spark, k1="A", k2="B"), RUNS[0])
    before = spark.createDataFrame(dim.read().collect(), s.ZONES.ddl)
    dim.upsert(golden(spark, k1="A2", k2="B", k3="C"), RUNS[1])
    merged = s.scd2_merge(before, golden(spark, k1="A2", k2="B", k3="C"), s.ZONES, RUNS[1].at)
    assert rows(dim.read()) == rows(merged)


def test_run_that_died_before_its_commit_is_invisible_and_can_be_repeated(spark, dim, monkeypatch):
    dim.upsert(golden(spark, k1="A", k2="B"), RUNS[0])
    before = state(dim.read())
    original = spark.createDataFrame
    with monkeypatch.context() as patch:

        def die_at_the_log(data, schema=None, *rest, **more):
            if data and getattr(data[0], "operation", None) == "MERGE":
                raise RuntimeError("lost")
            return original(data, schema, *rest, **more)

        patch.setattr(spark, "createDataFrame", die_at_the_log)
        with pytest.raises(RuntimeError, match="lost"):
            dim.upsert(original([(1, "Z", "A9")], "locationid int, zone string, borough string"), RUNS[1])
    assert state(dim.read()) == before and dim.history().count() == 1
    dim.upsert(golden(spark, k1="A2"), RUNS[1])
    assert state(dim.read()) == [(1, 1, "A", False), (1, 2, "A2", True), (2, 1, "B", True)]


def test_committed_run_gets_the_audit_it_got(spark, dim):
    audits = []
    for run, key in ((RUNS[0], "A"), (RUNS[1], "B")):
        audits.append(dim.upsert(golden(spark, k1=key), run, "there").first())
    before = state(dim.read())
    assert dim.upsert(golden(spark, k1="B"), RUNS[1], "there").first() == audits[1]
    assert dim.upsert(golden(spark, k1="A"), RUNS[0], "there").first() == audits[0]
    assert state(dim.read()) == before and dim.history().count() == 2


def test_guards_stop_before_anything_is_committed(spark, dim):
    bad = golden(spark, k1="A").unionByName(golden(spark, k1="B"))
    with pytest.raises(BadKeys):
        dim.upsert(bad, RUNS[0])
    assert not dim.exists()


def test_current_reads_one_slice(spark, dim, plan_of):
    dim.upsert(golden(spark, k1="A"), RUNS[0])
    dim.upsert(golden(spark, k1="B"), RUNS[1])
    plan = plan_of(dim.current())
    assert "PartitionFilters" in plan and "run_id" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
