import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyhall.sources import io


def _write_csv(lines, name="raw.csv"):
    d = tempfile.mkdtemp(prefix="tallyhall-test-")
    p = os.path.join(d, name)
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return d, p


def test_read_raw_lineage_exact_over_many_splits(spark):
    n = 5000
    lines = ["id,amount,note"] + [f"{i},{i}.5,row {i}" for i in range(n)]
    _, p = _write_csv(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = io.read_raw(spark, p)
        assert df.rdd.getNumPartitions() > 5
        rows = df.select(F.col("id").cast("int").alias("id"), "_raw_row", "_source_file").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == n
    assert all(r["_raw_row"] == r["id"] + 2 for r in rows)
    assert {r["_source_file"] for r in rows} == {"raw.csv"}


def test_files_of_one_name_and_with_other_headers(spark):
    root = tempfile.mkdtemp(prefix="tallyhall-test-")
    for folder, lines in {"a": ["x,y", "1,2", "", "3,4"], "b": ["y,x,z", "20,10,\"p,q\""], "c": ["z,,x,x", "n,b,5,6"]}.items():
        os.makedirs(f"{root}/{folder}")
        with open(f"{root}/{folder}/data.csv", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    for multiline in (False, True):
        df = io.read_raw(spark, f"{root}/*/data.csv", multiline=multiline)
        assert sorted(df.columns) == ["_raw_row", "_source_file", "column_2", "x", "x.1", "y", "z"]
        got = df.select("x", "y", "z", "column_2", "`x.1`", "_source_file", "_raw_row").collect()
        assert sorted(map(tuple, got), key=str) == sorted([
            ("1", "2", None, None, None, "data.csv", 2), ("3", "4", None, None, None, "data.csv", 3),
            ("10", "20", "p,q", None, None, "data.csv", 2), ("5", None, "n", "b", "6", "data.csv", 2)], key=str)


def test_quoted_newlines_quoted_header_and_empty_files(spark):
    _, p = _write_csv(['a,"b,c",d', '1,"two', 'lines",3', '4,5'])
    rows = io.read_raw(spark, p, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines", "3", "raw.csv", 2), ("4", "5", None, "raw.csv", 3)]
    assert io.read_raw(spark, p).columns == ["a", "b,c", "d", "_source_file", "_raw_row"]
    _, p = _write_csv(["", ""])
    assert io.read_raw(spark, p).count() == 0 and io.read_raw(spark, p, columns=["k"]).columns[0] == "k"


def test_stage_drops_blank_rows_and_columns_and_parses(spark):
    lines = ["booking_id,check_in,room_rate,prop_code",
             "B1,04/03/2025,\"1.234,56\",", "  ,  ,  ,  ", "B2,2025-03-05,NA,"]
    _, p = _write_csv(lines)
    job = io.SourceJob("bookings", p, date_cols=["check_in"], num_cols=["room_rate"])
    df = io.stage(io.read_raw(spark, p), job)
    assert "prop_code" not in df.columns
    rows = sorted(df.collect(), key=lambda r: r["booking_id"])
    assert [r["booking_id"] for r in rows] == ["B1", "B2"]
    assert str(rows[0]["check_in"]) == "2025-03-04" and rows[0]["room_rate"] == 1234.56
    assert rows[1]["room_rate"] is None
    assert [r["_raw_row"] for r in rows] == [2, 4]


def test_load_table_by_name_and_publish_roundtrip(spark):
    df = spark.createDataFrame([("a", 1.5, None)], "x string, y double, z string")
    schema = StructType([StructField("y", DoubleType()), StructField("name", StringType()),
                         StructField("extra", StringType())])
    out = io.load_table(df, schema, renames={"x": "name"}, defaults={"extra": "d"})
    assert out.columns == ["y", "name", "extra"]
    assert out.first().asDict() == {"y": 1.5, "name": "a", "extra": "d"}
    root = tempfile.mkdtemp(prefix="tallyhall-pub-")
    io.publish(df, root, "tab")
    back = io.read_published(spark, root, "tab").first()
    assert back["z"] == ""


def test_seed_dim_and_run_log(spark):
    d = io.seed_dim(spark, ["Coffee", "Tea"], "C", 3)
    assert [tuple(r) for r in d.collect()] == [("C001", "Coffee"), ("C002", "Tea")]
    log = io.RunLog(spark)
    tracked, obs = log.track(spark.range(7), "stage1")
    tracked.write.format("noop").mode("overwrite").save()
    log.record("stage1", obs, rows_in=7)
    assert log.frame().first()["rows_out"] == 7
