"""Containment matching (J8) against a brute-force pairing on a small fixture."""

import re

from tallyhall.operators import lookup as lk


def _norm(s):
    s = re.sub(r"[^A-Z0-9 ]+", " ", (s or "").upper())
    return re.sub(r"\s+", " ", s).strip()


def _brute(raws, dim):
    out = {}
    for r in raws:
        k = _norm(r)
        hits = [(o, i) for i, name, o in dim if _norm(name) and (
            _norm(name) in k or _norm(name).replace(" ", "") in k.replace(" ", ""))]
        if hits:
            out[r] = min(hits)[1]
    return out


def test_contains_match_equals_brute_force(spark):
    dim = [("C1", "Bandung", 2), ("C2", "Jakarta", 1), ("C3", "Bali", 3),
           ("C4", "Nusa Dua", 4), ("C5", "Ban", 5), ("C6", "Very Long Canonical Name", 6)]
    raws = ["HQ Bandung", "jakarta-selatan", "  bali!! ", "NusaDua resort", "Nusa  Dua",
            "bandungjakarta", "Ba", "nothing here", "", "B A L I", "xx ban xx"]
    d = spark.createDataFrame(dim, "id string, name string, ord int")
    s = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r["raw"]: r["matched_id"] for r in
           lk.contains_match(s, "raw", d, "name", "id", "ord").collect()}
    assert got == _brute(raws, dim)


def _best_by_tokens(raws, dim, least):
    from collections import Counter  # noqa: F401
    import re

    def toks(x):
        return {t for t in re.sub(r"[^A-Z0-9 ]+", " ", (x or "").upper()).split(" ") if t}

    out = {}
    for raw in set(raws):
        best = None
        for i, o, text in dim:
            n = len(toks(raw) & toks(text))
            if raw is not None and n >= least and (best is None or (-n, o, i) < best):
                best = (-n, o, i)
        if best:
            out[raw] = (best[2], -best[0])
    return out


def test_token_overlap_equals_brute_force(spark):
    import random
    from tallyhall.operators.lookup import token_overlap_match
    rnd = random.Random(4)
    words = ["GRAND", "HOTEL", "PARK", "plaza", "bay", "old-town", "Nº1", "sea", "x", "palm", "spa", "lake"]
    dim = [(k, k % 7, "hotel " + " ".join(rnd.sample(words, rnd.randint(0, 5)))) for k in range(60)] + [(99, 0, None), (98, 0, "")]
    raws = [" ".join(rnd.sample([*words, "unknown", "hotel!"], rnd.randint(0, 6))) for _ in range(250)] + [None, "", "hotel", "HOTEL", "grand hotel"]
    d = spark.createDataFrame(dim, "id int, ord int, name string")
    s = spark.createDataFrame([(r,) for r in raws], "raw string")
    for least in (1, 2, 3):
        got = {r["raw"]: (r["matched_id"], r["shared_tokens"]) for r in token_overlap_match(s, "raw", d, "name", "id", "ord", least).collect()}
        assert got == _best_by_tokens(raws, dim, least)


def test_a_token_of_all_names_makes_no_pairs(spark):
    from pyspark.sql import functions as F
    from tallyhall.operators.lookup import overlap_candidates, token_overlap_match
    n = 2000
    d = spark.range(n).select(F.col("id").alias("__id"), F.col("id").alias("__ord"), F.format_string("The Hotel number%d", "id").alias("__text"))
    s = spark.range(n).select(F.format_string("the hotel NUMBER%d", F.col("id") + 5).alias("__raw")).withColumn("__text", F.col("__raw"))
    assert overlap_candidates(s, d).count() <= 8 * n  # 4,000,000 by the common tokens
    got = token_overlap_match(s, "__raw", d, "__text", "__id", "__ord", 1)
    assert got.where("shared_tokens = 3").count() == n - 5 and got.where("shared_tokens = 2 and matched_id = 0").count() == 5
