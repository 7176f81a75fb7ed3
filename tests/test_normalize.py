import pytest
from helpers import rows

from goldenlake.operators.normalize import MissingColumns, normalize_types, require_columns
from goldenlake.schemas import TRIP_COLUMNS, TRIP_TYPES
from goldenlake.sources.readers import (
    MALFORMED,
    malformed,
    read_if_exists,
    read_text_table,
    read_uniform_text_table,
    well_formed,
)
from goldenlake.sources.writers import overwrite


def test_malformed_values_become_null_and_extras_stay(spark):
    raw = spark.sql(
        "SELECT '7' AS VendorID, '2024-01-01 00:00:00' AS tpep_pickup_datetime, 'soon' AS tpep_dropoff_datetime, "
        "'far' AS trip_distance, 3.0D AS PULocationID, 'abc' AS DOLocationID, 2L AS payment_type, '1.5' AS fare_amount, "
        "NULL AS total_amount, 'N' AS flag"
    )
    out = normalize_types(raw, TRIP_TYPES)
    assert out.columns == [*TRIP_COLUMNS, "flag"]
    types = dict(out.dtypes)
    assert types["vendorid"] == "int" and types["fare_amount"] == "double" and types["tpep_pickup_datetime"] == "timestamp_ntz"
    row = out.first()
    assert (row.vendorid, row.pulocationid, row.payment_type, row.fare_amount, row.flag) == (7, 3, 2, 1.5, "N")
    assert row.tpep_dropoff_datetime is None and row.trip_distance is None and row.dolocationid is None


def test_missing_columns_fail_before_any_work(spark):
    with pytest.raises(MissingColumns, match="borough"):
        require_columns(spark.createDataFrame([(1, "a")], "LocationID int, Zone string"), ["locationid", "zone", "borough"])


def test_text_table_is_read_as_text(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Zone,Borough\n1, a ,\nabc,b,N/A\n")
    df = read_text_table(spark, str(tmp_path), ["locationid", "zone", "borough"])
    assert df.dtypes == [("locationid", "string"), ("zone", "string"), ("borough", "string"), (MALFORMED, "string")]
    assert well_formed(df).columns == ["locationid", "zone", "borough"] and df.count() == 2


def test_header_only_text_table_is_empty(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Zone,Borough\n")
    assert read_text_table(spark, str(tmp_path), ["locationid"]).count() == 0


def test_columns_go_by_the_header_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("LocationID,Zone,Borough\n1,a,x\n2,b\n")
    (tmp_path / "b.csv").write_text(" borough ,ZONE,locationid,more\ny,c,3,!\nz,d,4\nz,d,5,!,?\n")
    written = overwrite(read_text_table(spark, str(tmp_path), ["locationid", "zone", "borough"]), str(tmp_path / "copy"))
    known = well_formed(written).select("locationid", "zone", "borough", "more")
    assert rows(known) == [("1", "a", "x", None), ("3", "c", "y", "!")]
    assert rows(malformed(written)) == [("2,b",), ("z,d,4",), ("z,d,5,!,?",)]


def test_bad_headers_raise(spark, tmp_path):
    for name, text in (("missing", "LocationID,Zone\n"), ("empty", "")):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(ValueError):
            read_text_table(spark, str(tmp_path / f"{name}.csv"), ["locationid", "borough"])


def test_uniform_table_fails_on_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,a\n")
    assert rows(well_formed(read_uniform_text_table(spark, str(tmp_path), ["k", "v"]))) == [("1", "a")]
    (tmp_path / "b.csv").write_text("v,k\nb,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_uniform_text_table(spark, str(tmp_path), ["k", "v"]).collect()


def test_probe_tells_absent_from_broken(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing"), "a int") is None
    (tmp_path / "bad.parquet").write_text("this is no parquet file")
    with pytest.raises(Exception, match="(?i)parquet|read"):
        read_if_exists(spark, str(tmp_path / "bad.parquet"), "a int").collect()
