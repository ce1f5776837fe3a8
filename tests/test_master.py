"""Alias resolver and null-safe merge against a plain statement of them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyhall.operators import aliases
from tallyhall.operators.combine import outer_merge
from tallyhall.operators.lookup import contains_match


def _norm(s):
    return " ".join(re.sub(r"[^A-Z0-9 ]+", " ", (s or "").upper()).split())


def _brute(raws, levels, dim):
    out = {}
    for raw in {r for r in raws if r is not None}:
        key, row = _norm(raw), (None, "unmapped", 0)
        for method, keys in levels:
            ids = sorted((p, i) for k, i, p in keys if k == key and k and i is not None)
            if ids:
                row = (ids[0][1], method, len({i for _, i in ids}))
                break
        else:
            squeezed = key.replace(" ", "")
            hits = [i for i, name in dim if _norm(name) and _norm(name).replace(" ", "") in squeezed]
            if hits:
                row = (min(hits), "contains", 1)
        out[raw] = row
    return out


def _frame(spark, keys):
    return spark.createDataFrame(keys, "alias_key string, id int, priority int")


def test_levels_and_fallback_equal_brute_force(spark):
    rnd = random.Random(8)
    names = ["Bay", "Old Town", "North Bay", "Spa", "Lake", ""]
    dim = list(enumerate(names))
    first = [(_norm(rnd.choice([*names, "MG Bay", "HQ"])), rnd.randint(0, 5), rnd.randint(0, 1)) for _ in range(12)] + [("HQ", None, 0)]
    second = [(_norm(n), i, 0) for i, n in dim]
    raws = [rnd.choice(["", " ", "the ", "MG ", "x-"]) + rnd.choice([*names, "HQ", "unknown"]) + rnd.choice(["", " ", "!", " annex"])
            for _ in range(300)] + [None, "", "???", "OLDTOWN", "old-town"]
    d = spark.createDataFrame(dim, "id int, name string")
    got = aliases.resolve(spark.createDataFrame([(r,) for r in raws], "raw string"), "raw",
                          {"seed": _frame(spark, first), "exact": _frame(spark, second)},
                          ("contains", lambda rest: contains_match(rest, "raw", d, "name", "id", "id", "id")))
    got = {r["raw"]: (r["id"], r["method"], r["n_ids"]) for r in got.collect()}
    want = _brute(raws, [("seed", first), ("exact", second)], dim)
    assert got == want
    assert {m for _, m, _ in want.values()} == {"seed", "exact", "contains", "unmapped"}
    assert max(n for _, _, n in want.values()) > 1


def test_no_fallback_and_empty_frames(spark):
    none = _frame(spark, [])
    strings = spark.createDataFrame([("a",), ("a",), (None,)], "raw string")
    assert [tuple(r) for r in aliases.resolve(strings, "raw", {"exact": none}).collect()] == [("a", "A", None, "unmapped", 0)]
    assert aliases.resolve(strings.where("false"), "raw", {"exact": none}).count() == 0


def test_coverage_counts_collisions_and_a_sample(spark):
    keys = _frame(spark, [("A", 1, 0), ("A", 2, 0), ("B", 3, 0)])
    strings = spark.createDataFrame([(x,) for x in ["a", "A!", "b", *(f"z{i}" for i in range(10))]], "raw string")
    row = aliases.coverage(aliases.resolve(strings, "raw", {"exact": keys}), "m", 3).first()
    assert tuple(row) == ("m", 13, 3, 10, 2, "z0 | z1 | z2")


def test_a_key_that_all_ids_claim_makes_one_row(spark):
    n = 20_000
    keys = spark.range(n).select(F.lit("HOT").alias("alias_key"), "id", F.lit(0).alias("priority"))
    strings = spark.range(n).select(F.lit("hot").alias("raw"))
    assert [tuple(r) for r in aliases.resolve(strings, "raw", {"seed": keys}).collect()] == [("hot", "HOT", 0, "seed", n)]


def test_outer_merge_takes_null_keys_as_one_group(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, left_sum int")
    b = spark.createDataFrame([(None, 5), ("y", 7)], "k string, right_sum int")
    assert {tuple(r) for r in outer_merge(a, b, "k").collect()} == {(None, 1, 5), ("x", 2, 0), ("y", 0, 7)}
    with pytest.raises(ValueError):
        outer_merge(a, a, "k")
