"""Cleaning stage: rules, quarantine and log on small rows and whole extracts."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from tallyhall.operators.cleanse import Cleanse
from tallyhall.plans import cleaning
from tallyhall.plans.roles import Star


def _small(spark):
    rows = [("a", 1, "5", 1), ("a", 2, "6", 2), ("b", -3, None, 3), ("c", None, "x", 4), ("d", -4, "x", 5), (None, 1, "7", 6), (None, 1, "8", 7)]
    c = Cleanse(spark.createDataFrame(rows, "k string, v int, t string, _raw_row int"), "s").dedup("duplicate", "k")
    c.quarantine("bad text", F.col("t") == "x")
    c.repair("negative", F.col("v") < 0, "absolute value", v=F.abs("v"))
    return c.quarantine("too large", F.col("v") > 2)


def test_rules_see_rows_as_earlier_steps_left_them(spark):
    c = _small(spark)
    assert sorted(c.clean().select("k", "v", "t").collect(), key=str) == sorted([("a", 1, "5"), (None, 1, "7")], key=str)
    out = {r["k"]: (r["v"], r["_rule"]) for r in c.quarantined().collect()}
    # a quarantined row keeps its values and is not looked at again
    assert out == {"c": (None, "bad text"), "d": (-4, "bad text"), "b": (3, "too large")}
    log = [tuple(r)[2:] for r in c.log().orderBy("log_id").collect()]
    assert log == [("duplicate", "first kept", 2, 7, 5), ("bad text", "quarantined", 2, 5, 3), ("negative", "absolute value", 1, 3, 3),
                   ("too large", "quarantined", 1, 3, 2)]


def test_log_counted_while_writing_is_the_same(spark, tmp_path):
    c = _small(spark)
    clean, out, log = c.write(str(tmp_path / "flagged"))
    assert log.collect() == c.log().collect()
    assert sorted(map(str, clean.collect())) == sorted(map(str, c.clean().collect())) and out.count() == 3


def test_empty_source_and_order_of_steps(spark, tmp_path):
    c = Cleanse(spark.createDataFrame([], "k string, _raw_row int"), "s").dedup("duplicate")
    c.quarantine("none", F.col("k").isNull())
    assert [tuple(r)[4:] for r in c.log().collect()] == [(0, 0, 0), (0, 0, 0)]
    assert c.write(str(tmp_path / "none"))[2].collect() == c.log().collect()
    with pytest.raises(ValueError):
        c.dedup("again")


@pytest.mark.parametrize("name", sorted(cleaning.CLEANERS))
def test_every_row_is_kept_or_quarantined_and_the_log_adds_up(spark, name):
    star = Star(spark, SMALL_SF_DIR)
    c = cleaning.CLEANERS[name](spark, star)
    log = c.log().orderBy("log_id").collect()
    kept, out = cleaning.cleaned(spark, star, name).count(), c.quarantined()
    by_rule = {r["_rule"]: r["count"] for r in out.groupBy("_rule").count().collect()}
    assert {r["rule"]: r["records_affected"] for r in log if r["action"] == "quarantined" and r["records_affected"]} == by_rule
    assert log[0]["rows_before"] == cleaning.extract(spark, star, name).count()
    assert log[0]["rows_after"] == kept + sum(by_rule.values()) and log[-1]["rows_after"] == kept
    for a, b in zip(log, log[1:]):
        assert a["rows_after"] == b["rows_before"]
    # no parsed date or name is evaluated again for the filter on flags
    plan = c.clean()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate inline")


def test_numbers_keep_their_declared_digits(spark):
    df = spark.createDataFrame([("12345678901234.56", "1.125"), (" 7.5 ", "0.001"), ("x", "")], "m string, q string")
    got = [tuple(map(str, r)) for r in df.select(cleaning.number("m"), cleaning.number("q", 3)).collect()]
    assert got == [("12345678901234.56", "1.125"), ("7.50", "0.001"), ("None", "None")]
