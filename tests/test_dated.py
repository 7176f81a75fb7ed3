from datetime import date
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from goldenlake.layout import Run
from goldenlake.sources import catalog
from goldenlake.sources.dated import DatedTable, contents

RUNS = [Run(f"r{n}", f"2024-0{n}-01 00:00:00") for n in range(1, 6)]
SCHEMA = "k int, v double, trip_date date"


def frame(spark, *data):
    return spark.createDataFrame([(k, v, date(2024, 1, d)) for k, v, d in data], SCHEMA)


def files(table):
    return {str(p) for p in Path(table.rows_path).rglob("*.parquet")}


def days(touched):
    return {(r.part.day, r.rows) for r in touched}


@pytest.fixture
def table(spark, tmp_path):
    return DatedTable(spark, str(tmp_path / "t"))


def test_only_changed_dates_are_written(spark, table):
    first = frame(spark, (1, 1.0, 1), (2, 2.0, 1), (3, 3.0, 2), (4, None, 3))
    assert days(table.refill(first, RUNS[0])) == {(1, 2), (2, 1), (3, 1)}
    before = files(table)
    # Date 1 in another order, date 2 corrected, date 3 gone, date 4 new.
    second = frame(spark, (2, 2.0, 1), (1, 1.0, 1), (3, 3.5, 2), (5, 5.0, 4)).repartition(3)
    assert days(table.refill(second, RUNS[1])) == {(2, 1), (3, 0), (4, 1)}
    assert before <= files(table) and {f.split("trip_date=")[1][:10] for f in files(table) - before} == {"2024-01-02", "2024-01-04"}
    assert rows(table.read()) == rows(second)
    assert {r.run_id for r in table.live().filter("part = DATE '2024-01-01'").collect()} == {"r1"}
    assert days(table.refill(second, RUNS[2])) == set() and rows(table.read()) == rows(second)
    assert days(table.touched(RUNS[1]).collect()) == {(2, 1), (3, 0), (4, 1)}
    with pytest.raises(ValueError, match="later runs"):
        table.refill(second, RUNS[0])


def test_repeated_and_broken_runs(spark, table, monkeypatch):
    first, second = frame(spark, (1, 1.0, 1), (2, 2.0, 2)), frame(spark, (1, 9.0, 1), (2, 2.0, 2))
    table.refill(first, RUNS[0])
    with monkeypatch.context() as patch:  # dies after the rows, before the record
        patch.setattr(table, "spark", Broken(spark))
        with pytest.raises(RuntimeError, match="lost"):
            table.refill(second, RUNS[1])
    assert rows(table.read()) == rows(first)
    for _ in range(2):
        assert days(table.refill(second, RUNS[1])) == {(1, 1)} and rows(table.read()) == rows(second)


class Broken:
    def __init__(self, spark):
        self.spark = spark

    def createDataFrame(self, data, schema):
        if data and len(data[0]) == 4:
            raise RuntimeError("lost")
        return self.spark.createDataFrame(data, schema)

    def __getattr__(self, name):
        return getattr(self.spark, name)


def test_repeated_rows_and_swapped_values_count(spark):
    pairs = [
        (frame(spark, (1, 1.0, 1)), frame(spark, (1, 1.0, 1), (1, 1.0, 1))),
        (frame(spark, (1, 2.0, 1), (2, 1.0, 1)), frame(spark, (1, 1.0, 1), (2, 2.0, 1))),
        (frame(spark, (1, None, 1)), frame(spark, (1, 0.0, 1))),
    ]
    for a, b in pairs:
        assert contents(a, "trip_date").first().content != contents(b, "trip_date").first().content


def test_replace_given_dates(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "m"), "trip_month")
    table.refill(frame(spark, (1, 1.0, 1), (2, 2.0, 2)), RUNS[0])
    month = date(2024, 1, 1)
    assert days(table.replace(frame(spark, (7, 7.0, 7)), [month, month], RUNS[1])) == {(1, 1)}
    assert rows(table.read().drop("trip_month")) == rows(frame(spark, (7, 7.0, 7)))
    assert days(table.replace(frame(spark, (8, 8.0, 8)), [date(2024, 2, 1)], RUNS[2])) == {(1, 0)}  # nothing of that month
    assert table.read().count() == 1


def test_rows_without_a_date_are_refused(spark, table):
    with pytest.raises(ValueError, match="rows without trip_date"):
        table.refill(spark.createDataFrame([(1, 1.0, None)], SCHEMA), RUNS[0])
    with pytest.raises(ValueError, match="never written"):
        table.read()


def test_table_without_rows(spark, table):
    nothing = frame(spark)
    assert days(table.refill(nothing, RUNS[0])) == set()
    assert table.read().columns == nothing.columns and table.read().isEmpty()
    catalog.attach_dated(spark, "dated_test.nothing", table)
    assert spark.table("dated_test.nothing").isEmpty()
    some = frame(spark, (1, 1.0, 1))
    table.refill(some, RUNS[1])
    catalog.attach_dated(spark, "dated_test.nothing", table)
    assert rows(spark.table("dated_test.nothing")) == rows(some)
    table.refill(nothing, RUNS[2])
    catalog.attach_dated(spark, "dated_test.nothing", table)
    assert table.read().isEmpty() and spark.table("dated_test.nothing").isEmpty()


def test_dates_are_pruned(spark, table, plan_of):
    table.refill(frame(spark, (1, 1.0, 1), (2, 2.0, 2)), RUNS[0])
    table.refill(frame(spark, (1, 1.0, 1), (2, 3.0, 2)), RUNS[1])
    plan = plan_of(table.read().filter("trip_date = DATE '2024-01-02'"), executed=True)
    assert "PartitionFilters" in plan and "run_id" in plan.split("PartitionFilters")[1]
    assert rows(table.read().filter("trip_date = DATE '2024-01-02'")) == rows(frame(spark, (2, 3.0, 2)))


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "hot"), file_rows=1000)
    hot = spark.range(9000).select(F.col("id").cast("int").alias("k"), F.rand(5).alias("v"), F.lit(date(2024, 1, 1)).alias("trip_date"))
    cold = frame(spark, (1, 1.0, 2), (2, 2.0, 3))
    table.refill(overwrite_once(hot.unionByName(cold), tmp_path), RUNS[0])
    sizes = [spark.read.parquet(f).count() for f in files(table) if "2024-01-01" in f]
    assert len(sizes) > 2 and sum(sizes) == 9000 and max(sizes) < 4500
    assert sum("2024-01-02" in f for f in files(table)) == 1


def overwrite_once(df, tmp_path):
    df.write.parquet(str(tmp_path / "source"))
    return df.sparkSession.read.parquet(str(tmp_path / "source"))


def test_catalog_follows_without_leaving(spark, table, monkeypatch):
    name = "dated_test.facts"
    states = [frame(spark, (1, 1.0, 1), (2, 2.0, 2), (3, 3.0, 3)), frame(spark, (1, 1.0, 1), (2, 5.0, 2), (4, 4.0, 4))]
    states.append(states[1].withColumn("more", F.lit(1)))
    table.refill(states[0], RUNS[0])
    catalog.attach_dated(spark, name, table)
    assert rows(spark.table(name)) == rows(states[0])
    for number, state in enumerate(states[1:], 1):
        statements, original = [], spark.sql
        table.refill(state, RUNS[number])
        with monkeypatch.context() as patch:
            patch.setattr(spark, "sql", lambda text, *more: statements.append(text) or original(text, *more))
            catalog.attach_dated(spark, name, table)
        assert rows(spark.table(name).select(*state.columns)) == rows(state)
        assert not any(w in s for s in statements for w in ("DROP TABLE", "CREATE TABLE"))
        if number == 1:  # date 1 did not move
            assert not any("2024-01-01'" in s and "SET LOCATION" in s for s in statements)
            assert sum("SET LOCATION" in s for s in statements) == 1
    spark.sql(f"DROP TABLE {name}")  # a catalog that lost the table gets it back
    catalog.attach_dated(spark, name, table)
    assert rows(spark.table(name).select(*states[2].columns)) == rows(states[2])
