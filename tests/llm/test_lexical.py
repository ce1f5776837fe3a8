"""Lexical search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SMALL_SF_DIR
from tallyhall.llm import lexical
from tallyhall.llm.common import read_table
from tallyhall.session import checkpoint_dir

TERM = re.compile(lexical.TERM)


def _terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def _want(docs, items, k):
    counts = [(d, Counter(_terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i].update(_terms(t))
    out = set()
    for i, ts in asked.items():
        found = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in ts if t in c)
            if s > 0:
                found.append((-s, lexical.NO_ID if d is None else d))
        for rank, (s, d) in enumerate(sorted(found)[:k], 1):
            out.add((i, rank, None if d == lexical.NO_ID else d, -s))
    return out


def _got(docs, items, k):
    rows = [tuple(r) for r in lexical.lexical_search(docs, items, k).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


@pytest.mark.parametrize("block_terms", [1 << 16, 60])
def test_every_item_equals_brute_force(spark, monkeypatch, block_terms):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(lexical, "CHUNK_CELLS", 1 << 14)
    checkpoint_dir(spark)
    docs, items = read_table(spark, SMALL_SF_DIR, "documents"), read_table(spark, SMALL_SF_DIR, "benchmark")
    if block_terms < 100:
        items = items.where("item_id < 4")
    want = _want([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()], 50)
    assert _got(docs, items, 50) == want and len(want) > 100


def test_odd_rows(spark, monkeypatch):
    """Nulls, empty and long texts, ties, repeated rows, items of one id,
    columns of clashing names, empty tables."""
    monkeypatch.setattr(lexical, "LEAF", 4)
    checkpoint_dir(spark)
    rnd = random.Random(2)
    some = ["alpha", "BETA", "gamma9", "ÉTÉ", "été", "x", "İı", "中文", "don't", "a-b", "\x00z", "🙂"]
    docs = [(k if k % 9 else None, " ".join(rnd.choices(some, k=rnd.randint(0, 12)))) for k in range(80)]
    docs += [(500, None), (501, ""), (502, " .,"), (503, "alpha beta " * 50_000), (504, "alpha"), (504, "alpha"), (3, "alpha")]
    items = [(1, "Alpha beta, alpha"), (1, "gamma9"), (None, "ÉTÉ 中文"), (2, None), (3, ""), (4, "nowhere"), (5, " ".join(some)), (1, "gamma9")]
    d = spark.createDataFrame([(*r, 1, "s") for r in docs], "doc_id long, text string, score int, cols string").repartition(5)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    assert _got(d, i, 7) == _want(docs, items, 7)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert _got(none, i, 7) == set() and _got(d, i.limit(0), 7) == set()


def test_trees_prune_and_lose_nothing():
    rnd = np.random.default_rng(4)
    near = rnd.integers(0, 400_000, (40, 60)) * (rnd.random((40, 60)) < 0.2)
    vectors = np.maximum(0, np.repeat(near, 50, axis=0) + rnd.integers(-300, 300, (2000, 60)) * (np.repeat(near, 50, axis=0) > 0))
    w = rnd.integers(0, 20_000, 60)
    tree = lexical.BallTree(vectors * np.sqrt(w), 32)
    ids, scored, leaves = np.arange(2000), 0, sum(not c for c in tree.children)
    assert sorted(tree.order.tolist()) == list(range(2000))
    for _ in range(30):
        cols = rnd.choice(60, 6, replace=False)
        bounds = tree.bounds(cols, np.sqrt(w[cols]))
        exact = vectors[:, cols] @ w[cols]
        for (s, e), bound in zip(tree.spans, bounds):
            assert exact[tree.order[s:e]].max() <= bound
        best = lexical.Best(10)
        scored += lexical.search(tree, bounds, vectors, cols, w[cols], ids, best)
        assert sorted(best.heap, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(exact) if s), reverse=True)[:10]
    assert scored < 0.5 * 30 * leaves
