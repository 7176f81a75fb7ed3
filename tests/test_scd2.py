import hashlib
import random

from helpers import rows, ts
from pyspark.sql import functions as F

from goldenlake.layout import timestamp_literal
from goldenlake.operators import scd2 as s

GOLDEN = "locationid int, zone string, borough string"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def golden(spark, data):
    return spark.createDataFrame([(k, *v) for k, v in data.items()], GOLDEN)


def step(spark, dim, data, at):
    return s.scd2_merge(dim, golden(spark, data), s.ZONES, timestamp_literal(at))


def versions(dim):
    return sorted(
        (r.locationid, r.version_number, r.zone, r.is_current, r.start_date, r.end_date) for r in dim.collect()
    )


def sha(*parts):
    return hashlib.sha256("||".join(parts).encode()).hexdigest()


def test_first_load(spark):
    dim = s.scd2_initial(golden(spark, {1: ("A", "X"), 2: (None, "")}), s.ZONES, timestamp_literal(T1))
    assert dim.columns == s.ZONES.columns
    by_key = {r.locationid: r for r in dim.collect()}
    assert by_key[1].zone_key == sha("1", T1, "1") and by_key[1].hash_diff == sha("1", "A", "X")
    assert by_key[2].hash_diff == sha("2", "", "")
    assert (by_key[1].version_number, by_key[1].is_current, by_key[1].start_date, by_key[1].end_date) == (1, True, ts(T1), None)


def test_change_new_and_vanished_keys(spark):
    dim = s.scd2_initial(golden(spark, {1: ("A", "X"), 2: ("B", "X"), 3: ("C", "X")}), s.ZONES, timestamp_literal(T1))
    out = step(spark, dim, {1: ("A", "X"), 2: ("B2", "X"), 4: ("D", "X")}, T2)
    assert versions(out) == [
        (1, 1, "A", True, ts(T1), None),
        (2, 1, "B", False, ts(T1), ts(T2)),
        (2, 2, "B2", True, ts(T2), None),
        (3, 1, "C", True, ts(T1), None),  # vanished from the master, still current
        (4, 1, "D", True, ts(T2), None),
    ]


def test_changing_back_is_a_third_version(spark):
    dim = s.scd2_initial(golden(spark, {1: ("A", "X")}), s.ZONES, timestamp_literal(T1))
    dim = step(spark, step(spark, dim, {1: ("B", "X")}, T2), {1: ("A", "X")}, T3)
    assert [(v[1], v[2], v[3]) for v in versions(dim)] == [(1, "A", False), (2, "B", False), (3, "A", True)]


def test_null_and_empty_attribute_are_no_change(spark):
    dim = s.scd2_initial(golden(spark, {1: (None, "X")}), s.ZONES, timestamp_literal(T1))
    assert s.scd2_changes(golden(spark, {1: ("", "X")}), dim, s.ZONES).isEmpty()


def test_stage_and_audit(spark):
    dim = s.scd2_initial(golden(spark, {1: ("A", "X"), 2: ("B", "X")}), s.ZONES, timestamp_literal(T1))
    staged = s.scd2_stage(
        s.scd2_changes(golden(spark, {1: ("A1", "X"), 2: ("B", "X"), 3: ("C", "X")}), dim, s.ZONES), s.ZONES, timestamp_literal(T2)
    )
    assert {(r.merge_key, r.op, r.locationid, r.version_number) for r in staged.collect()} == {
        (1, "expire", 1, None),
        (3, "expire", 3, None),
        (None, "insert", 1, 2),
        (None, "insert", 3, 1),
    }
    row = s.scd2_audit(staged, F.lit(3).cast("bigint"), s.ZONES, timestamp_literal(T2)).first()
    assert (row.rows_in_golden, row.changed_input_rows, row.changed_keys, row.rows_inserted, row.rows_expired, row.note) == (
        3, 2, 2, 2, 1, "merge_scd2",
    )
    quiet = s.scd2_audit(staged.filter("false"), F.lit(3).cast("bigint"), s.ZONES, timestamp_literal(T2)).first()
    assert (quiet.rows_inserted, quiet.note) == (0, "noop_no_changes")


def test_other_entities_use_the_same_operators(spark):
    v0 = spark.createDataFrame([(1, "A", True), (2, "B", None)], "vendor_code int, vendor_name string, active_flag boolean")
    dim = s.scd2_initial(v0, s.VENDORS_V0, timestamp_literal(T1))
    assert {r.hash_diff for r in dim.collect()} == {sha("1", "A", "true"), sha("2", "B", "")}
    changed = s.scd2_changes(v0.withColumn("active_flag", F.lit(True)), dim, s.VENDORS_V0)
    assert rows(changed.select("vendor_code", "version_number")) == [(2, 2)]


def test_history_does_not_enter_the_merge_join(spark, tmp_path, plan_of, set_conf):
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    dim = s.scd2_initial(golden(spark, {1: ("A", "X")}), s.ZONES, timestamp_literal(T1))
    step(spark, dim, {1: ("B", "X")}, T2).write.partitionBy("is_current").parquet(str(tmp_path / "dim"))
    stored = spark.read.schema(s.ZONES.ddl).parquet(str(tmp_path / "dim")).select(*s.ZONES.columns)
    plan = plan_of(s.scd2_merge(stored, golden(spark, {1: ("C", "X")}), s.ZONES, timestamp_literal(T3)))
    history = plan.split("Union")[1].split("SortMergeJoin")[0].split("Generate")[0]
    assert "PartitionFilters: [isnotnull(is_current" in history and "Exchange" not in history
    # Current rows and master meet once.
    assert plan.count("SortMergeJoin") == 1 and plan.count("FileScan") == 2


def test_next_versions_tell_what_happened(spark):
    dim = s.scd2_initial(golden(spark, {1: ("A", "X"), 2: ("B", "X"), 4: ("D", "X")}), s.ZONES, timestamp_literal(T1))
    after = s.scd2_next(golden(spark, {1: ("A1", "X"), 2: ("B", "X"), 3: ("C", "X")}), dim, s.ZONES, timestamp_literal(T2))
    assert sorted((r.op, r.locationid, r.version_number, r.is_current) for r in after.collect()) == [
        ("expire", 1, 1, False), ("insert", 1, 2, True), ("insert", 3, 1, True), ("keep", 2, 1, True), ("keep", 4, 1, True),
    ]
    nothing = s.scd2_next(golden(spark, {}), dim.limit(0), s.ZONES, timestamp_literal(T2))
    assert nothing.isEmpty()


def test_dimension_as_of_a_time(spark):
    states, dim = {}, None
    for at, data in ((T1, {1: ("A", "X"), 2: ("B", "X")}), (T2, {1: ("A1", "X"), 3: ("C", "X")}), (T3, {1: ("A", "X"), 2: ("Q", "X")})):
        dim = s.scd2_initial(golden(spark, data), s.ZONES, timestamp_literal(at)) if dim is None else step(spark, dim, data, at)
        states[at] = rows(dim)
    for at, state in states.items():
        assert rows(s.scd2_as_of(dim, s.ZONES, timestamp_literal(at))) == state
    assert s.scd2_as_of(dim, s.ZONES, timestamp_literal("2023-01-01 00:00:00")).isEmpty()


def test_random_batches_against_brute_force(spark):
    rng = random.Random(11)
    dim, expected = None, []
    for number in range(4):
        at = f"2024-0{number + 1}-01 00:00:00"
        data = {k: (rng.choice("AB"), rng.choice(["X", "Y"])) for k in range(12) if rng.random() < 0.8}
        current = {v[0]: v for v in expected if v[4]}
        for key, (zone, borough) in data.items():
            known = current.get(key)
            if known and known[2:4] == (zone, borough):
                continue
            if known:
                expected.remove(known)
                expected.append((*known[:4], False, known[5], ts(at)))
            expected.append((key, known[1] + 1 if known else 1, zone, borough, True, ts(at), None))
        g = golden(spark, data)
        if dim is None:
            dim = s.scd2_initial(g, s.ZONES, timestamp_literal(at))
        else:
            dim = step(spark, dim, data, at)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    got = dim.select("locationid", "version_number", "zone", "borough", "is_current", "start_date", "end_date")
    assert rows(got) == sorted(expected, key=repr)
    assert {r.keys for r in s.scd2_violations(dim, s.ZONES).collect()} == {0}


def test_violations_are_found(spark):
    bad = spark.createDataFrame(
        [
            ("a", 1, "Z", "B", "h", 1, True, ts(T1), None),
            ("b", 1, "Z", "B", "h", 1, True, ts(T1), None),
            ("c", 2, "Z", "B", "h", 2, False, ts(T2), ts(T1)),
            ("d", 3, "Z", "B", "h", 1, True, ts(T1), ts(T2)),
        ],
        s.ZONES.ddl,
    )
    assert {r.invariant: r["keys"] for r in s.scd2_violations(bad, s.ZONES).collect()} == {
        "more_than_one_current": 1,
        "versions_not_contiguous": 1,
        "version_repeated": 1,
        "open_end_not_current": 1,
        "ends_before_start": 1,
    }
