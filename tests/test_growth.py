"""Steps whose work must grow no faster than their input: what is read, sorted
and moved, by the plans, and the results of the forms that do it."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_move_no_rows_and_hold_for_any_bounds(spark):
    from tallyhall.operators.describe import exact_quantiles
    rows = [("a", float(v % 3)) for v in range(900)] + [("b", 10.0 ** (k % 40)) for k in range(501)] + [(None, 5.0), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.5, 0.95, 1.0]
    want = {r["g"]: r["q"] for r in df.where(~F.isnan("v")).groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    for n in (None, 7):
        got = exact_quantiles(df, "v", probs, "g", n_ranges=n)
        assert {r["g"]: pytest.approx(r["quantiles"], rel=1e-12) for r in got.collect()} == want
    # no rows are ordered for bounds and searched by them
    assert "TakeOrderedAndProject" not in _plan(got) and "shiftright" not in _plan(got)
    assert exact_quantiles(df.limit(0), "v", probs).collect() == [] and exact_quantiles(df.limit(0), "v", probs, "g").collect() == []


def test_parsers_that_trim_in_a_step_give_the_same(spark):
    from tallyhall.functions.text import parse_mixed_date, parse_mixed_number
    from tallyhall.operators import clean
    texts = ["2024-02-03", " 03/02/2024\t", "02-03-2024", "13-02-2024", "03-feb-2024", "20240203", "2024/02/03", "n/a", "", None, "20240231", "1,234.50",
             "- 1.234,5", "+7", "1,234", "1.234", "12.34.5", "--3", " 5 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert clean.parse_dates(df, ["t"]).collect() == df.select(parse_mixed_date("t").alias("t")).collect()
    assert clean.parse_numbers(df, ["t"]).collect() == df.select(parse_mixed_number("t").alias("t")).collect()
    assert [str(r[0]) for r in clean.parse_dates(df, ["t"]).collect()[:7]] == ["2024-02-03"] * 2 + ["2024-02-03", "None", "2024-02-03", "2024-02-03", "None"]
    # the signs are taken off once, not wherever the parser names its text
    plan = clean.parse_numbers(df, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[-+]") == 1


@pytest.mark.parametrize("name", ["pos", "purchases", "bookings", "ledger", "inventory"])
def test_an_extract_reads_its_facts_once(spark, name):
    from tallyhall.plans.extracts import EXTRACTS, TABLES, extract
    from tallyhall.plans.roles import Star
    star = Star(spark, SMALL_SF_DIR)
    got = extract(spark, star, name)
    used = {t: star.t(t) for t in TABLES if f"{{{t}}}" in EXTRACTS[name]} | ({"accounts": star.dim_account} if "{accounts}" in EXTRACTS[name] else {})
    want = spark.sql(EXTRACTS[name], **used)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    fact = {"pos": "l_orderkey", "purchases": "l_orderkey", "inventory": "event_id"}.get(name, "o_orderkey")
    assert got._jdf.queryExecution().optimizedPlan().toString().count(f"Relation [{fact}") == 1


def test_equal_rows_are_combined_without_sorting(spark):
    from tallyhall.operators.cleanse import Cleanse
    df = spark.createDataFrame([("a", "x", 3), ("a", "x", 2), ("b", None, 1), ("b", None, None)], "k string, t string, _raw_row int")
    c = Cleanse(df, "s").dedup("duplicate")
    assert sorted(tuple(r)[:4] for r in c.df.collect()) == [("a", "x", 2, 2), ("b", None, 1, 2)]
    assert "SortAggregate" not in _plan(c.df)


def test_only_large_groups_are_split(spark):
    from tallyhall.operators import clean
    from tallyhall.operators.ranges import large_groups
    df = spark.createDataFrame([(0, i) for i in range(300)] + [(None, i) for i in range(200)] + [(k, 1) for k in range(1, 100)], "g int, o int")
    assert {r[0] for r in large_groups(df, ["g"], 4).collect()} == {0, None}
    got = clean.line_numbers(df, "g", "o", "n", ranges=4).collect()
    assert all(r["n"] == (r["o"] + 1 if r["g"] in (0, None) else 1) for r in got) and len(got) == 599


@pytest.mark.parametrize("name,columns", [("pos", 17), ("purchases", 10)])
def test_lines_move_once_and_are_not_stored_unless_a_transaction_is_large(spark, name, columns, monkeypatch):
    from tallyhall.plans import cleaning
    from tallyhall.plans.roles import Star
    star = Star(spark, SMALL_SF_DIR)
    stored = []
    keep = cleaning.written_table
    monkeypatch.setattr(cleaning, "written_table", lambda df, n: stored.append(n) or keep(df, n))
    got = cleaning.cleaned(spark, star, name)
    # dealt by transaction for the duplicates, and numbered where they are
    assert not stored and len(got.columns) == columns and _plan(got).count(f"hashpartitioning({cleaning._LINE_GROUP[name]}") == 1
    assert "_raw_row" not in got.columns and "SortMergeJoin" not in _plan(got)
    monkeypatch.setattr(cleaning, "has_large_groups", lambda *a: True)
    want = cleaning.cleaned(spark, star, name)
    assert stored and want.columns == got.columns and sorted(want.collect()) == sorted(got.collect())


def test_large_groups_are_seen_in_few_counters(spark):
    from tallyhall.operators.ranges import has_large_groups
    even = spark.range(5000).select((F.col("id") % 1000).alias("g"))
    hot = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("g"))
    none = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("g"))
    assert [has_large_groups(d, ["g"], 8) for d in (even, hot, none, even.limit(0))] == [False, True, True, False]


def test_flags_alone_are_kept_from_the_filter(spark):
    """Columns that nobody reads are not made, and kept rows stay dealt."""
    from tallyhall.operators.cleanse import Cleanse
    df = spark.createDataFrame([("a", "1", 1), ("a", "1", 2), ("b", "x", 3)], "k string, t string, _raw_row int")
    c = Cleanse(df, "s").dedup("duplicate", within="k").derive(unread=F.sha2("t", 256), n=F.col("t").try_cast("int")).quarantine("no number", F.col("n").isNull())
    assert [r["k"] for r in c.clean().collect()] == ["a"] and [r["_rule"] for r in c.quarantined().collect()] == ["no number"]
    assert "sha2" not in c.clean().select("k", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert _plan(c.clean().groupBy("k").count()).count("Exchange hashpartitioning") == 1


def test_the_gate_stores_no_cleaned_table(spark):
    from tallyhall.plans.catalog import QUERIES
    plan = QUERIES["gate_full"](spark, SMALL_SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 2 and plan.count("Relation [o_orderkey") == 3 and "Relation [booking_id" not in plan


@pytest.mark.parametrize("name", ["pos", "purchases", "bookings", "ledger"])
def test_parts_of_a_source_are_cleaned_like_the_whole(spark, name):
    from tallyhall.plans import cleaning
    from tallyhall.plans.roles import Star
    star = Star(spark, SMALL_SF_DIR)
    parts = [cleaning.cleaned(spark, star, name, (k, 3)).collect() for k in range(3)]
    assert all(parts) and sorted(map(str, sum(parts, []))) == sorted(map(str, cleaning.cleaned(spark, star, name).collect()))


def test_large_tables_are_checked_in_parts_that_leave_no_files(spark, monkeypatch):
    import time
    from tallyhall.operators import gate
    from tallyhall.plans import cleaning
    from tallyhall.plans.catalog import QUERIES
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    want = QUERIES["gate_full"](spark, SMALL_SF_DIR)
    monkeypatch.setattr(cleaning, "PART_ROWS", 2000)
    seen, count = [], gate.failures
    monkeypatch.setattr(gate, "failures", lambda tables: seen.append([t.table for t in tables]) or count(tables))
    before, conf = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    got = QUERIES["gate_full"](spark, SMALL_SF_DIR)
    for _ in range(50):  # files are deleted in the background
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    # has_large_groups counts once, before the parts
    assert len(left) <= 4 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == conf
    # 6,000 lines, 1,500 orders, 1,000 events
    assert [t for t, in seen] == ["bookings", *["pos"] * 3, "ledger", "inventory", *["purchases"] * 3, "budget"]
    assert got.schema == want.schema and sorted(got.collect()) == sorted(want.collect())


def test_failures_of_parts_add_up(spark):
    from tallyhall.operators import gate
    df = spark.createDataFrame([(k % 40, k % 7, k - 5) for k in range(60)] + [(None, None, 3)] * 2, "a int, r int, v int")
    dim = spark.range(5).select(F.col("id").cast("int").alias("r"))

    def check(d):
        return [gate.Checks(d, "t").unique("a").refers("r", dim, "r").rule(positive=F.col("v") >= 0)]
    want = sorted(gate.run(check(df)).collect())
    part = F.pmod(F.xxhash64("a"), F.lit(3))
    got = gate.run_parts(spark, (check(df.where(part == k)) for k in range(3)))
    assert sorted(got.collect()) == want and {r["check_name"]: r["failures"] for r in want}["t.unique(a)"] == 21


def test_digit_dates_need_no_formatter(spark):
    from tallyhall.functions.text import parse_trimmed_date
    texts = ["2024-02-29", "2023-02-29", "29/02/2024", "31/04/2024", "02-29-2024", "13-01-2024", "20240229", "20230229", "0000-01-01", "9999-12-31",
             "00000000", "2024-00-10", "10-feb-2024", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [str(r[0]) for r in df.select(parse_trimmed_date("t").cast("string")).collect()]
    assert got == ["2024-02-29", "None", "2024-02-29", "None", "2024-02-29", "None", "2024-02-29", "None", "0000-01-01", "9999-12-31", "None", "None",
                   "2024-02-10", "None"]
    assert df.select(parse_trimmed_date("t", True))._jdf.queryExecution().optimizedPlan().toString().count("try_to_timestamp") <= 1


def test_texts_do_not_move_to_meet_the_tops_of_the_buckets(spark):
    from tallyhall.llm.fingerprint import in_order
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = in_order(docs)
        assert "SortMergeJoin" not in _plan(got) and got.where("not extra").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
