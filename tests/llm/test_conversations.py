"""Conversation repair against exhaustive search, and on odd input."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from conftest import SMALL_SF_DIR
from tallyhall.llm import conversations as cv
from tallyhall.llm.common import read_table
from tallyhall.session import checkpoint_dir

ROWS = "conv_id long, turn long, role string, text string"
SOUND = re.compile(r"(s?(ua)+)?")
NAME = {"u": "user", "a": "assistant"}


def _damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def _faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def _cheapest(rows, faults):
    """Least (cost, audit, lines) by a table over rows read and roles so far."""
    to = {(p, i): q for p, i, q in cv.ARCS}
    best = {(0, 0): (0, "", [])}
    for row in range(len(rows) + 1):
        for _ in range(3):  # insertions
            for state in range(4):
                if (row, state) in best:
                    c, a, t = best[row, state]
                    for i in "ua":
                        if (state, i) in to:
                            _keep(best, (row, to[state, i]), (c + 5, a + "I", [*t, NAME[i] + ":"]))
        if row == len(rows):
            break
        _, role, text = rows[row]
        more = 5 if faults[row] == "truncated" else 0
        for state in range(4):
            if (row, state) not in best:
                continue
            c, a, t = best[row, state]
            _keep(best, (row + 1, state), (c + 2, a + "D", t))
            if faults[row] not in ("blank", "duplicate"):
                if (state, role[:1]) in to:
                    _keep(best, (row + 1, to[state, role[:1]]), (c + more, a + "K", [*t, f"{role}:{text}"]))
                for i in "ua":
                    if (state, i) in to:
                        _keep(best, (row + 1, to[state, i]), (c + 1 + more, a + "R", [*t, f"{NAME[i]}:{text}"]))
    return min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)


def _keep(best, key, value):
    if key not in best or value[:2] < best[key][:2]:
        best[key] = value


def _exhaustive(kinds, inserts=3):
    """Least (cost, audit) over all sequences of edits with a few insertions."""
    choices = [["D"] if k == "d" else ["D", "K", "R"] for k in kinds]
    found = []
    for edits in itertools.product(*choices):
        for n in range(inserts + 1):
            for spots in itertools.combinations_with_replacement(range(len(kinds) + 1), n):
                audit, options = "", [""]
                cost = 0
                for at in range(len(kinds) + 1):
                    for _ in range(spots.count(at)):
                        audit, cost = audit + "I", cost + 5
                        options = [o + i for o in options for i in "ua"]
                    if at < len(kinds):
                        e, k = edits[at], kinds[at]
                        audit += e
                        cost += {"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and k.isupper() else 0)
                        if e == "K":
                            options = [o + k.lower() for o in options]
                        if e == "R":
                            options = [o + i for o in options for i in "ua"]
                if any(SOUND.fullmatch(o) for o in options):
                    found.append((cost, audit))
    return min(found)


def _want(rows):
    out = {}
    after = _damage(rows)
    for conv in {r[0] for r in rows}:
        r = after.get(conv, [])
        f = _faults(r)
        turns = {t for t, _, _ in r if t is not None}
        cost, audit, lines = _cheapest(r, f)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(r, r[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"),
                     f.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _got(df):
    rows = [tuple(r) for r in cv.damage_and_repair(df).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_cells_equal_exhaustive_search_and_every_split_is_the_same():
    rnd = random.Random(3)
    for n in (0, 1, 2, 3, 4):
        for _ in range(25):
            kinds = "".join(rnd.choice("suaxSUAXd") for _ in range(n))
            assert cv.best(cv.parse(kinds)) == _exhaustive(kinds)
    for _ in range(40):
        kinds = "".join(rnd.choice("suaxSUAXd") for _ in range(rnd.randint(2, 30)))
        whole = cv.parse(kinds)
        assert all(cv.join(cv.parse(kinds[:k]), cv.parse(kinds[k:])) == whole for k in range(1, len(kinds)))
        assert cv.combine([cv.parse(kinds[k:k + 3]) for k in range(0, len(kinds), 3)]) == whole


def test_every_conversation_equals_brute_force(spark):
    checkpoint_dir(spark)
    df = read_table(spark, SMALL_SF_DIR, "conversations")
    assert _got(df) == _want([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_odd_rows_and_a_hot_conversation(spark, monkeypatch):
    """A conversation with a third of all rows in many pieces; nulls in every
    column, repeated rows, ties of a turn, unknown roles, a long text, other
    columns of clashing names."""
    monkeypatch.setattr(cv, "PIECE", 7)
    checkpoint_dir(spark)
    rnd = random.Random(9)
    rows = []
    for k in range(700):
        conv = 1 if rnd.random() < 0.35 else rnd.choice([None, *range(2, 60)])
        rows.append((conv, rnd.choice([None, *range(40)]) if conv in (None, 1) else rnd.randint(0, 7),
                     rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                     rnd.choice([None, "", " \t\n", "a.", "b", "é中🙂!", "line\nline?", f"t{k}.", f"t{k}.", f"t{k}", "x" * 100_000 + "."])))
    rows += rows[:80] + [(60, 0, "user", "a.")] * 50 + [(61, 0, None, None)]
    df = spark.createDataFrame([(*r, 1.5, "z", 3) for r in rows], ROWS + ", cost double, kind string, n long").repartition(13)
    got = _got(df)
    assert got == _want(rows)
    parts = cv.pieces(cv.faults(cv.damaged(df)))
    assert parts.where("conv_id = 1").count() > 10 and parts.where("ended").count() > 10


def test_empty_tables_and_conversations_without_rows_left(spark):
    checkpoint_dir(spark)
    assert _got(spark.createDataFrame([], ROWS)) == {}
    gone = [(c, t, "user", "a.") for c in range(40) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    assert set(_got(spark.createDataFrame(gone, ROWS)).values()) == {(0, 0, 0, 0, 0, 0, "", cv.EMPTY)}


def test_more_inserts_than_one_pair_never_pay():
    assert cv.NOTHING[0, 3] == (10, "II") and cv.NOTHING[2, 3] == (5, "I") and (0, 1) not in cv.NOTHING
    with pytest.raises(KeyError):
        cv.NOTHING[1, 0]
