"""End-to-end medallion run: star facts -> quality gate -> written warehouse ->
marts read from the written tables -> published feed.

Writing the warehouse and reading it back is also the lineage cut: every
later stage plans against parquet files in the output folder (a shared
location on a cluster), not against the raw-table lineage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import round_half_even
from ..operators import quality as qa
from ..sources import io
from . import marts
from .roles import Star

DIMS = ["dim_property", "dim_date", "dim_account", "dim_department", "dim_product"]
FACTS = ["fact_room_sales", "fact_fnb_sales", "fact_expense", "fact_budget", "fact_purchase",
         "fact_inventory"]


class WarehouseStar(Star):
    """A :class:`Star` whose dimensions and facts are the written tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, warehouse_dir: str, **kw):
        super().__init__(spark, sf_dir, **kw)
        self.warehouse_dir = warehouse_dir

    def _w(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(os.path.join(self.warehouse_dir, name))
        return df.drop("month_key") if "month_key" in df.columns else df


for _name in DIMS + FACTS:
    def _make(n):
        return property(lambda self: self._w(n))
    setattr(WarehouseStar, _name, _make(_name))


def build_warehouse(spark: SparkSession, sf_dir: str, out_dir: str,
                    enforce_gate: bool = False) -> dict[str, DataFrame]:
    """Run the pipeline; returns the written marts as DataFrames.

    The gate result is always written to ``out_dir/reports/gate``; with
    ``enforce_gate`` a failed check stops the run before anything else is
    written (the reference wrote cleaned data before its gate).
    """
    from .catalog import _gate  # shared gate definition
    star = Star(spark, sf_dir)
    log = io.RunLog(spark)
    gate = _gate(star).result()
    io.write_report(gate, os.path.join(out_dir, "reports", "gate"))
    gate = spark.read.json(os.path.join(out_dir, "reports", "gate"))
    if enforce_gate:
        qa.enforce(gate)
    wh = os.path.join(out_dir, "warehouse")
    for name in DIMS:
        io.write_table(getattr(star, name), os.path.join(wh, name))
    for name in FACTS:
        df = getattr(star, name)
        tracked, obs = log.track(io.with_month_partition(df, "date_id"), name)
        io.write_table(tracked, os.path.join(wh, name), partition_by="month_key")
        log.record(name, obs)
    w = WarehouseStar(spark, sf_dir, wh)
    out = {}
    mdir = os.path.join(out_dir, "marts")
    daily = marts.kpi_daily(w)
    io.write_table(daily, os.path.join(mdir, "mart_kpi_daily"), partition_by="year")
    daily = io.read_table(spark, os.path.join(mdir, "mart_kpi_daily"))
    out["mart_kpi_daily"] = daily
    builders = {
        "mart_hotel_monthly": lambda: marts.hotel_monthly(w, daily),
        "mart_fnb_monthly": lambda: marts.fnb_monthly(w),
        "mart_finance_monthly": lambda: marts.finance_monthly(w),
        "mart_budget_vs_actual": lambda: marts.budget_vs_actual(w),
    }
    for name, build in builders.items():
        io.write_table(build(), os.path.join(mdir, name))
        out[name] = io.read_table(spark, os.path.join(mdir, name))
    feed = os.path.join(out_dir, "feed")
    monthly = (daily.groupBy("year", "month")
               .agg(round_half_even(F.sum("total_revenue")).alias("total_revenue"),
                    round_half_even(F.sum("room_revenue")).alias("room_revenue"),
                    round_half_even(F.sum("fnb_net_revenue")).alias("fnb_net_revenue")))
    io.publish(monthly, feed, "monthly")
    io.publish(out["mart_hotel_monthly"], feed, "hotel_monthly")
    io.write_table(log.frame(), os.path.join(out_dir, "reports", "run_log"))
    return out


#: The amount that each table's manifest adds up.
MEASURES = {"bookings": "room_revenue", "pos": "net_sales", "ledger": "amount", "inventory": "stock_value", "purchases": "total_amount",
            "budget": "budget_amount"}


def load_conformed(spark: SparkSession, sf_dir: str, out_dir: str, enforce_gate: bool = True, only=None) -> dict[str, DataFrame]:
    """Extract -> clean -> gate -> load, for the sources in ``only`` (all).

    Each source is evaluated once: its flagged rows are written with the log
    counted on the way. The gate reads the cleaned tables; a failed check
    stops the run (:class:`GateFailed`) before the warehouse is touched.
    Passing tables are loaded by month, replacing just the months they have.
    Returns the log, the gate, the quarantine counts and the manifest.
    """
    from ..operators import gate
    from . import cleaning
    star = Star(spark, sf_dir)
    at = lambda *parts: os.path.join(out_dir, *parts)
    logs, left_out, tables = [], [], {}
    for name in only or cleaning.CLEANERS:
        kept, out, log = cleaning.CLEANERS[name](spark, star).write(at("flagged", name))
        logs.append(log)
        left_out.append(out.groupBy("_rule").agg(F.count("*").alias("rows")).withColumn("source", F.lit(name)))
        io.write_table(cleaning.numbered(name, kept).select(*cleaning.COLUMNS[name]), at("cleaned", name))
        tables[name] = io.read_table(spark, at("cleaned", name))
    io.write_report(cleaning.cleansing_log(logs), at("reports", "cleansing_log"))
    found = [c for c in cleaning.checks(star, tables, only)]
    io.write_report(gate.run(found), at("reports", "gate"))
    result = spark.read.json(at("reports", "gate"))
    if enforce_gate:
        qa.enforce(result)
    loaded = None
    for name, df in tables.items():
        m = io.load_partitions(io.with_month_partition(df, "date_id"), at("warehouse", name), "month_key", MEASURES[name])
        m = m.select(F.lit(name).alias("source"), "partition", "rows", F.col("total").cast("double").alias("total"))
        loaded = m if loaded is None else loaded.unionByName(m)
    io.write_table(loaded, at("reports", "manifest"))
    quarantined = left_out[0]
    for d in left_out[1:]:
        quarantined = quarantined.unionByName(d)
    return {"log": spark.read.json(at("reports", "cleansing_log")), "gate": result, "quarantined": quarantined,
            "manifest": io.read_table(spark, at("reports", "manifest"))}
