"""Behaviour goldens, one per defect decision worth pinning (FIXTURES §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhall.operators import clean, combine, lookup as lk, timeseries as ts


def D(s):
    return dt.date.fromisoformat(s)


def test_exact_dedup_ignores_lineage(spark):
    df = spark.createDataFrame([("x", 1.0, "f.csv", 3), ("x", 1.0, "f.csv", 2), ("y", 2.0, "f.csv", 4)],
                               "a string, b double, _source_file string, _raw_row int")
    out = clean.dedup_exact(df).orderBy("a").collect()
    assert [(r["a"], r["_raw_row"]) for r in out] == [("x", 2), ("y", 4)]
    again = clean.dedup_exact(clean.dedup_exact(df))
    assert again.count() == 2  # idempotent


def test_dedup_first_keeps_first_by_order(spark):
    df = spark.createDataFrame([("k", 5, "late"), ("k", 1, "early"), ("j", 2, "only")],
                               "k string, _raw_row int, v string")
    out = {r["k"]: r["v"] for r in clean.dedup_first(df, ["k"], ["_raw_row"]).collect()}
    assert out == {"k": "early", "j": "only"}


def test_ambiguous_map_errors_or_quarantines(spark):
    mp = spark.createDataFrame([("The Long Table", "H001"), ("The Long Table", "H007"),
                                ("Lobby", "H003")], "alias string, id string")
    df = spark.createDataFrame([("The Long Table",), ("Lobby",)], "outlet string")
    with pytest.raises(lk.AmbiguousKeyError):
        lk.lookup(df, "outlet", mp, "alias", "id", "property_id")
    q = lk.lookup(df, "outlet", mp, "alias", "id", "property_id", on_ambiguous="quarantine")
    ok, bad = clean.quarantine(q, F.col("_ambiguous") == 1, "ambiguous_outlet")
    assert [r["outlet"] for r in bad.collect()] == ["The Long Table"]
    assert [r["property_id"] for r in ok.collect()] == ["H003"]
    assert ok.count() + bad.count() == df.count()


def test_blank_column_dropped(spark):
    df = spark.createDataFrame([("a", "  ", 1), ("b", None, 2)], "x string, prop_code string, _raw_row int")
    assert clean.drop_blank_columns(df).columns == ["x", "_raw_row"]


def test_normalized_department_lookup(spark):
    dim = spark.createDataFrame([("D003", "Kitchen"), ("D001", "Rooms")], "id string, name string")
    df = spark.createDataFrame([("KITCHEN ",)], "dept string")
    r = lk.normalized_lookup(df, "dept", dim, "name", "id", "department_id").first()
    assert r["department_id"] == "D003"


def test_unknown_supplier_default_member_passes_ri(spark):
    dim = spark.createDataFrame([("S001", "Acme"), ("S999", "Unknown")], "id string, name string")
    df = spark.createDataFrame([("Acme",), ("Nobody",)], "supplier string")
    m = lk.default_bucket(lk.normalized_lookup(df, "supplier", dim, "name", "id", "supplier_id"),
                          "supplier_id", "S999")
    assert sorted(r["supplier_id"] for r in m.collect()) == ["S001", "S999"]
    assert lk.orphans(m, "supplier_id", dim, "id").count() == 0


def test_monthly_actuals_join_counts_every_day(spark):
    exp = spark.createDataFrame([(D("2025-01-03"), 10.0), (D("2025-01-20"), 5.0)], "d date, amount double")
    bud = spark.createDataFrame([(D("2025-01-01"), 20.0)], "month date, budget double")
    act = exp.groupBy(F.trunc("d", "month").alias("month")).agg(F.sum("amount").alias("actual"))
    r = bud.join(act, "month", "left").first()
    assert r["actual"] == 15.0


def test_top_anomalies_ordered_by_abs_z(spark):
    vals = [(-1.0) ** i for i in range(400)] + [20.0 + i if i % 2 else -20.0 - i for i in range(12)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    z = ts.zscores(df, "v").filter(F.abs("z") > 2)
    assert z.count() == 12
    top = z.orderBy(F.desc(F.abs("z")), "i").limit(10).collect()
    assert len(top) == 10
    assert [abs(r["v"]) for r in top] == sorted([abs(r["v"]) for r in top], reverse=True)


def test_alias_collision_reported_and_resolved_by_priority(spark):
    dim = spark.createDataFrame([("H001", "Grand Jakarta", "Jakarta", 1), ("F001", "Food Hall", "Jakarta", 2)],
                                "id string, name string, city string, prio int")
    seeds = lk.alias_seeds(dim, "id", "name", ["city"], prefix="HQ", priority_col="prio")
    resolved, collisions = lk.resolve_seeds(seeds)
    col = {r["alias_key"]: r["ids"] for r in collisions.collect()}
    assert col["HQ JAKARTA"] == ["F001", "H001"]
    res = {r["alias_key"]: r["id"] for r in resolved.collect()}
    assert res["HQ JAKARTA"] == "H001"


def test_null_date_key_quarantined(spark):
    df = spark.createDataFrame([(1, None), (2, 20250101)], "id int, date_id int")
    ok, bad = clean.quarantine(df, F.col("date_id").isNull(), "null_date_key")
    assert [r["id"] for r in bad.collect()] == [1] and ok.count() == 1


def test_interval_swap_and_los(spark):
    df = spark.createDataFrame([(D("2025-01-05"), D("2025-01-02")), (D("2025-01-07"), D("2025-01-07"))],
                               "ci date, co date")
    r = clean.fix_interval(df, "ci", "co").withColumn("los", clean.length_of_stay("ci", "co")).collect()
    assert (r[0]["ci"], r[0]["co"], r[0]["los"]) == (D("2025-01-02"), D("2025-01-05"), 3)
    assert r[1]["los"] == 1


def test_window_guard_null_passes(spark):
    df = spark.createDataFrame([(1, D("2024-12-31")), (2, None), (3, D("2025-02-01"))], "i int, d date")
    out = sorted(r["i"] for r in clean.window_guard(df, "d", "2025-01-01", "2026-12-31").collect())
    assert out == [2, 3]


def test_unit_price_guard(spark):
    df = spark.createDataFrame([(0.0, 100.0), (4.0, 100.0)], "q double, g double")
    assert [r[0] for r in df.select(clean.guarded_unit_price("g", "q")).collect()] == [0.0, 25.0]


def test_rolling_mean_needs_seven_points(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(8)], "d int, v double")
    r = [x["rolling_mean"] for x in ts.rolling_mean(df, "v", "d", n=7).orderBy("d").collect()]
    assert r[:6] == [None] * 6 and r[6:] == [3.0, 4.0]


def test_prior_month_gap_is_null(spark):
    df = spark.createDataFrame([(D("2025-01-01"), 10.0), (D("2025-03-01"), 30.0)], "m date, rev double")
    out = {r["m"]: r["rev_lm"] for r in combine.prior_period(df, "m", [], ["rev"], 1, "_lm").collect()}
    assert out[D("2025-03-01")] is None


def test_gate_collects_all_failures(spark):
    from tallyhall.operators import quality as qa
    df = spark.createDataFrame([(1, 5.0), (1, -1.0)], "id int, amount double")
    g = qa.Gate().rows(df, "t", {"amount_non_negative": F.col("amount") >= 0}).unique(df, "t", "id")
    res = {r["check_name"]: r["failures"] for r in g.result().collect()}
    assert res == {"t.amount_non_negative": 1, "t.unique(id)": 1}
    with pytest.raises(qa.GateFailed):
        qa.enforce(g.result())


def test_seasonal_forecast_picks_a_model(spark):
    rows = [("s1", D("2025-01-01") + dt.timedelta(days=i), 100.0 + 10 * (i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "s string, d date, y double")
    out = ts.seasonal_forecast(df, "s", "d", "y", horizon=14, holdout=28)
    chosen = out.filter("chosen = 1").collect()
    assert len(chosen) == 14
    assert chosen[0]["forecast_date"] == D("2025-07-20")


def test_line_numbers_split_hot_group_matches_window(spark):
    rows = [(0, i) for i in range(3000)] + [(k, i) for k in range(1, 50) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, o int").repartition(7)
    plain = {(g, o): o + 1 for g, o in rows}
    split = clean.line_numbers(df, "g", "o", "n", ranges=6)
    got = {(r["g"], r["o"]): r["n"] for r in split.collect()}
    assert got == plain
    assert got[(0, 2999)] == 3000


def test_line_numbers_of_a_null_group_in_several_ranges(spark):
    df = spark.createDataFrame([(None, i) for i in range(500)] + [(1, 7)], "g int, o int").repartition(5)
    got = clean.line_numbers(df, "g", "o", "n", ranges=4).collect()
    assert sorted(r["n"] for r in got if r["g"] is None) == list(range(1, 501))
    assert [r["n"] for r in got if r["g"] == 1] == [1]


def test_quantiles_leave_nan_out_by_either_method(spark):
    from tallyhall.operators.describe import describe_series
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(float("nan"),)] * 3 + [(None,)], "v double")
    got = [describe_series(df, "v", method=m).first() for m in ("distributed", "percentile")]
    assert got[0] == got[1]
    assert (got[0]["median"], got[0]["p95"]) == (5.5, 9.55)


def test_distributed_quantiles_match_percentile(spark):
    import random
    from tallyhall.operators.describe import describe_series, exact_quantiles
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 5000))) for _ in range(20000)]
    rows += [(f"g{k}", rnd.random() * 10) for k in range(30) for _ in range(7)] + [("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    a = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "v", probs, "g", n_ranges=6).collect()}
    b = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    assert a.keys() == b.keys()
    for g in b:
        assert a[g] == pytest.approx(b[g], rel=1e-12, abs=1e-12)
    d1 = describe_series(df, "v", "g", method="distributed").orderBy("g").collect()
    d2 = describe_series(df, "v", "g", method="percentile").orderBy("g").collect()
    assert [r.asDict() for r in d1] == [r.asDict() for r in d2]


def test_size_checked_broadcast(spark):
    small = spark.range(10)
    assert lk.estimated_bytes(small) is not None
    j = spark.range(1000).join(lk.maybe_broadcast(small), "id")
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    j2 = spark.range(1000).join(lk.maybe_broadcast(small, max_bytes=1), "id")
    assert lk.maybe_broadcast(small, max_bytes=1) is small
