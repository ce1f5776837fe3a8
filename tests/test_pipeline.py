import tempfile

import pytest

from conftest import SMALL_SF_DIR
from tallyhall.operators.quality import GateFailed
from tallyhall.plans import marts
from tallyhall.plans.pipeline import build_warehouse
from tallyhall.plans.roles import Star


def test_pipeline_writes_warehouse_and_marts_match_direct(spark):
    out = tempfile.mkdtemp(prefix="tallyhall-wh-")
    res = build_warehouse(spark, SMALL_SF_DIR, out)
    direct = marts.kpi_daily(Star(spark, SMALL_SF_DIR))
    a = res["mart_kpi_daily"].select("date_key", "property_id", "total_revenue", "ebitda")
    b = direct.select("date_key", "property_id", "total_revenue", "ebitda")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
    log = spark.read.parquet(f"{out}/reports/run_log").collect()
    assert {r["stage"] for r in log} >= {"fact_room_sales", "fact_fnb_sales"}
    assert all(r["rows_out"] > 0 for r in log)
    feed = spark.read.json(f"{out}/feed/monthly")
    assert feed.count() > 0


def test_pipeline_gate_enforced(spark):
    # (transaction_id, line_no) repeats in the driver data, so the gate fails
    with pytest.raises(GateFailed):
        build_warehouse(spark, SMALL_SF_DIR, tempfile.mkdtemp(prefix="tallyhall-wh-"), enforce_gate=True)


def test_load_conformed_gates_then_loads_by_month(spark, tmp_path, monkeypatch):
    """Log, gate and manifest add up; a second run changes nothing; a failed
    check stops the run before the warehouse is touched."""
    from pyspark.sql import functions as F
    from tallyhall.operators.quality import GateFailed
    from tallyhall.plans import cleaning, pipeline

    only = ["bookings", "inventory"]
    got = pipeline.load_conformed(spark, SMALL_SF_DIR, str(tmp_path), only=only)
    assert got["gate"].where("ok = 0").count() == 0 and {r["source"] for r in got["log"].collect()} == set(only)
    rows = {r["source"]: (r["n"], round(r["t"], 2)) for r in got["manifest"].groupBy("source").agg(F.sum("rows").alias("n"), F.sum("total").alias("t")).collect()}
    for name in only:
        back = spark.read.parquet(str(tmp_path / "warehouse" / name))
        assert rows[name] == (back.count(), round(float(back.agg(F.sum(pipeline.MEASURES[name])).first()[0]), 2))
        last = max(got["log"].where(F.col("source") == name).collect(), key=lambda r: r["log_id"])
        assert last["rows_after"] == rows[name][0]
    first = sorted(map(tuple, got["manifest"].collect()))
    # a reload of one month replaces that month alone
    path = str(tmp_path / "warehouse" / "bookings")
    month = spark.read.parquet(path).agg(F.min("month_key")).first()[0]
    part = spark.read.parquet(path).where(F.col("month_key") == month).limit(3)
    from tallyhall.session import written_table
    from tallyhall.sources import io
    manifest = io.load_partitions(written_table(part, "month"), path, "month_key", "room_revenue").collect()
    assert [(r["partition"], r["rows"]) for r in manifest] == [(month, 3)]
    old = next(r[2] for r in first if r[0] == "bookings" and r[1] == month)
    assert spark.read.parquet(path).count() == rows["bookings"][0] - old + 3
    again = pipeline.load_conformed(spark, SMALL_SF_DIR, str(tmp_path), only=only)
    assert sorted(map(tuple, again["manifest"].collect())) == first

    monkeypatch.setattr(cleaning, "CALENDAR", ("1995-01-01", "1996-12-31"))
    with pytest.raises(GateFailed):
        pipeline.load_conformed(spark, SMALL_SF_DIR, str(tmp_path / "bad"), only=["bookings"])
    assert not (tmp_path / "bad" / "warehouse").exists()
