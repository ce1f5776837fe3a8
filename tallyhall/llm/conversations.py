"""Conversation repair by weighted interval parsing.

A conversation is sound if its role initials read ``(s?(ua)+)?``. Rows are
kept, given another role, or deleted, and empty rows inserted, each at a
cost. The grammar is in Chomsky normal form: ``N[p,q]`` derives what leads
the roles' order from state p to state q, by the rules ``N[p,q] -> N[p,r]
N[r,q]`` and one rule for each edit of a row. A cell of a span of rows holds
the least (cost, audit) of every N[p,q], closed under insertions before and
after the span. Cells are combined bottom-up by span length. As a
nonterminal names the states at both its ends, every split of a span gives
the same cell, and one split a span is enough.

Two audits of one cell and of equal cost never begin one with the other (the
longer would hold further insertions, which cost), so the least audit of a
span is made of the least audits of its parts.

Rows are dealt by ranges of (conv_id, turn), so a conversation that holds a
third of all rows is parsed in pieces of at most ``PIECE`` rows by many
tasks. Only cells, one letter a row and nonterminal, meet in one task; texts
never do: the digest of a long repaired text is taken from its pieces one
after another.

Nulls: a null role or text is one space, a null conv_id is a conversation,
null turns come first. Rows of one turn are in the order of role, then text.
Repeated rows are rows. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyhall.llm.common import scratch_table

#: Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: (from, role initial, to): the order of roles, from state 0 to 0 or 3.
ARCS = [(0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2)]
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Rows of a piece at most.
PIECE = 1024

_SPACES = " \t\n\x0b\f\r"
EMPTY = hashlib.sha256(b"").hexdigest()

Cell = dict[tuple[int, int], tuple[int, str]]


# -- grammar ---------------------------------------------------------------

def _put(cell: Cell, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cell or value < cell[key]:
        cell[key] = value


def join(a: Cell, b: Cell) -> Cell:
    """N[p,q] -> N[p,r] N[r,q], of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in a.items():
        for (r1, q), (more, rest) in b.items():
            if r == r1:
                _put(out, (p, q), (cost + more, audit + rest))
    return out


def _inserted() -> Cell:
    """The cell of no rows: insertions that lead from state to state."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    once: Cell = {(p, q): (INSERT, "I") for p, initial, q in ARCS if initial in ROLES}
    for _ in range(4):
        for key, value in join(cell, once).items():
            _put(cell, key, value)
    return cell


NOTHING = _inserted()


@lru_cache(None)
def _tuple_leaf(kind: str) -> tuple:
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if kind != "d":
        more = TRUNCATED if kind.isupper() else 0
        for p, initial, q in ARCS:
            if initial == kind.lower():
                _put(cell, (p, q), (KEEP + more, "K"))
            if initial in ROLES:
                _put(cell, (p, q), (REROLE + more, "R"))
    return tuple(join(join(NOTHING, cell), NOTHING).items())


def leaf(kind: str) -> Cell:
    """The cell of one row: ``s u a x`` (any other initial), in capitals if
    truncated; ``d`` must be deleted."""
    return dict(_tuple_leaf(kind))


@lru_cache(20_000)
def _short(kinds: str) -> tuple:
    return tuple(_joined(kinds).items())


def _joined(kinds: str) -> Cell:
    if len(kinds) == 1:
        return leaf(kinds)
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return join(parse(kinds[:half]), parse(kinds[half:]))


def parse(kinds: str) -> Cell:
    """The cell of a span of rows, each given by its ``leaf`` kind."""
    if not kinds:
        return NOTHING
    return dict(_short(kinds)) if len(kinds) <= 16 else _joined(kinds)


def combine(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans: ever longer spans of two."""
    while len(cells) > 1:
        cells = [join(*cells[k:k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else NOTHING


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[0, q] for q in ACCEPTED if (0, q) in cell)


# -- rows ------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage, n times each."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"), text.alias("text"),
                        kind.alias("kind"))
            .where(F.col("kind") != 0)
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("n")))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, n), equal ones as one, with
    ``kind`` of the first of the n (the others are duplicates)."""
    r = (rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
         .withColumn("h", F.sha2("text", 256)))
    end = F.rtrim("text", F.lit(_SPACES))
    r = r.withColumn("blank", end == "").withColumn("cut", ~F.right(end, F.lit(1)).isin(".", "!", "?"))
    seen = (r.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("h1"))
            .agg(F.max(F.col("turn").isNull()).alias("null_first"), F.min("turn").alias("first")))
    r = r.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("h1")))
    first = F.when(F.col("null_first"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    initial = F.substring("role", 1, 1)
    sound = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    return r.select("conv_id", "turn", "role", "text", "n",
                    F.when(F.col("blank"), "b").when(~first, "d").when(F.col("cut"), F.upper(sound)).otherwise(sound).alias("kind"))


COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_TURNS = ["min_turn", "max_turn", "n_turns", "first_turn", "last_turn"]
PIECES = ("conv_id bigint, part int, seq int, ended boolean, first_initial string, last_initial string, "
          + ", ".join(f"{c} bigint" for c in COUNTS + _TURNS)
          + ", kinds string, roles array<string>, texts array<string>, "
          "cells array<struct<p: int, q: int, cost: bigint, audit: string>>, cost bigint, audit string, sha string")


class Piece:
    """Successive rows of a conversation: their kinds, counts, and the roles
    and texts of those that may stay."""

    def __init__(self, conv_id):
        self.conv_id, self.kinds, self.roles, self.texts = conv_id, [], [], []
        self.first = self.last = None
        self.counts = dict.fromkeys(COUNTS, 0)
        self.turns = dict.fromkeys(_TURNS)
        self.turns["n_turns"] = 0

    def add(self, turn, role: str, text: str, kind: str):
        initial, t = role[:1], self.turns
        if self.kinds:
            self.counts["illegal"] += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None:
            t["min_turn"] = turn if t["min_turn"] is None else min(turn, t["min_turn"])
            t["max_turn"] = turn if t["max_turn"] is None else max(turn, t["max_turn"])
            if t["first_turn"] is None:
                t["first_turn"] = turn
            if turn != t["last_turn"]:
                t["last_turn"] = turn
                t["n_turns"] += 1
        fault = {"b": "blank", "d": "duplicate"}.get(kind) or ("truncated" if kind.isupper() else None)
        if fault:
            self.counts[fault] += 1
        self.kinds.append("d" if kind == "b" else kind)
        if kind not in "bd":
            self.roles.append(role)
            self.texts.append(text)


def repaired(audit: str, kinds: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """The lines that an audit leaves, from a state on, and the state after."""
    out, row, at = [], 0, 0
    to = {(p, initial): q for p, initial, q in ARCS}
    for edit in audit:
        if edit != "I":
            own, row = kinds[row], row + 1
            if own != "d":
                role, text = roles[at], texts[at]
                at += 1
        if edit == "D":
            continue
        if edit == "K":
            initial = role[:1]
        else:
            initial = "a" if state == 2 else "u"
            role, text = ROLES[initial], "" if edit == "I" else text
        out.append(f"{role}:{text}")
        state = to[state, initial]
    return out, state


def _digest(lines: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "replace")).hexdigest()


def _piece_row(p: Piece, part: int, seq: int, ended: bool) -> dict:
    kinds = "".join(p.kinds)
    cell = parse(kinds)
    row = {"conv_id": p.conv_id, "part": part, "seq": seq, "ended": ended, "first_initial": p.first, "last_initial": p.last,
           **p.counts, **p.turns}
    if ended:
        cost, audit = best(cell)
        return row | {"cost": cost, "audit": audit, "sha": _digest(repaired(audit, kinds, p.roles, p.texts, 0)[0])}
    return row | {"kinds": kinds, "roles": p.roles, "texts": p.texts,
                  "cells": [{"p": a, "q": b, "cost": c, "audit": s} for (a, b), (c, s) in cell.items()]}


def _arrow(fields: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(fields))


def pieces(rows: DataFrame) -> DataFrame:
    """The rows of ``faults``, dealt by ranges of their order, as ``PIECES``.
    A conversation that lies within a range and in one piece is ended."""
    schema = _arrow(PIECES)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]

    def each(batches) -> Iterator[tuple]:
        """Row by row, equal rows one after another."""
        for b in batches:
            for conv, turn, role, text, n, kind in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "kind"))):
                yield conv, turn, role, text, kind
                if n > 1:
                    yield from repeat((conv, turn, role, text, "b" if kind == "b" else "d"), n - 1)

    def run(batches):
        part = TaskContext.get().partitionId()
        out, piece, seq, runs = [], None, 0, 0
        for conv, turn, role, text, kind in each(batches):
            if piece is not None and (conv != piece.conv_id or len(piece.kinds) == PIECE):
                more = conv == piece.conv_id
                out.append(_piece_row(piece, part, seq, not more and seq == 0 and runs > 0))
                seq, runs, piece = (seq + 1, runs, None) if more else (0, runs + 1, None)
                if len(out) == PIECE:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if piece is None:
                piece = Piece(conv)
            piece.add(turn, role, text, kind)
        if piece is not None:
            out.append(_piece_row(piece, part, seq, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    # the bounds of ranges are sampled rows: they take the beginning of a text only
    return (rows.repartitionByRange(*order, F.left("text", F.lit(64))).sortWithinPartitions(*order, "text")
            .mapInArrow(run, PIECES))


WHOLE = ("conv_id bigint, part int, seq int, state int, gaps bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
         + ", cost bigint, audit string")


def _gaps(low, high, n) -> int:
    return 0 if low is None else high - low + 1 - n


def whole(parts: DataFrame) -> DataFrame:
    """Conversations of several pieces, as ``WHOLE``: one row with part null
    for each, and one a piece with the audit and the state it starts from."""
    schema = _arrow(WHOLE)

    def cut(audit: str, sizes: list[int]) -> Iterator[str]:
        at = 0
        for k, size in enumerate(sizes):
            start = at
            while size or (k == len(sizes) - 1 and at < len(audit)):
                size -= audit[at] != "I"
                at += 1
            yield audit[start:at]

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        cost, audit = best(combine([{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in r["cells"]} for r in rows]))
        total = {c: sum(r[c] for r in rows) for c in COUNTS}
        total["illegal"] += sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in zip(rows, rows[1:]))
        dated = [r for r in rows if r["min_turn"] is not None]
        n = sum(r["n_turns"] for r in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        gaps = _gaps(dated[0]["min_turn"], dated[-1]["max_turn"], n) if dated else 0
        conv = rows[0]["conv_id"]
        out = [{"conv_id": conv, "gaps": gaps, **total, "cost": cost, "audit": audit}]
        state = 0
        for r, own in zip(rows, cut(audit, [len(r["kinds"]) for r in rows])):
            out.append({"conv_id": conv, "part": r["part"], "seq": r["seq"], "state": state, "audit": own})
            state = after(own, r["kinds"], state)
        return pa.Table.from_pylist(out, schema)

    light = parts.select("conv_id", "part", "seq", "first_initial", "last_initial", *COUNTS, *_TURNS, "cells", "kinds")
    return light.groupBy("conv_id").applyInArrow(run, WHOLE)


def after(audit: str, kinds: str, state: int) -> int:
    """The state behind an audited piece that starts in ``state``."""
    to = {(p, initial): q for p, initial, q in ARCS}
    at = 0
    for edit in audit:
        initial = "a" if state == 2 else "u"
        if edit != "I":
            initial, at = kinds[at].lower() if edit == "K" else initial, at + 1
        if edit != "D":
            state = to[state, initial]
    return state


def digests(parts: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, sha) of conversations of several pieces: the repaired text
    of each piece is made where the piece is, and taken in order."""
    a = audits.where(F.col("part").isNotNull()).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("seq").alias("s"),
                                                       F.col("audit").alias("own"), "state")
    both = parts.drop("audit").join(a, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")))

    def lines(batches):
        for b in batches:
            got = [repaired(*x)[0] for x in zip(*(b.column(c).to_pylist() for c in ("own", "kinds", "roles", "texts", "state")))]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("part"), b.column("seq"),
                 pa.array(["\n".join(x).encode("utf-8", "replace") if x else None for x in got], pa.binary())],
                names=["conv_id", "part", "seq", "lines"])

    text = (both.select("conv_id", "part", "seq", "own", "kinds", "roles", "texts", "state")
            .mapInArrow(lines, "conv_id bigint, part int, seq int, lines binary")
            .repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seq"))

    def run(batches):
        now, sha, some = None, None, False
        for b in chain(batches, [None]):
            out = []
            for conv, data in zip(b.column("conv_id").to_pylist(), b.column("lines").to_pylist()) if b is not None else [((), None)]:
                if sha is not None and conv != now:
                    out.append((now, sha.hexdigest()))
                    sha = None
                if sha is None:
                    now, sha, some = conv, hashlib.sha256(), False
                if data is not None:
                    if some:
                        sha.update(b"\n")
                    sha.update(data)
                    some = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())],
                                                 names=["conv_id", "sha"])

    return text.mapInArrow(run, "conv_id bigint, sha string")


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of the conversations of ``rows`` (conv_id, turn, role,
    text, n)."""
    made = scratch_table(pieces(faults(rows)), "conversation-pieces")
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    columns = ["conv_id", "gaps", *COUNTS, "cost", "audit"]
    short = made.where("ended").select("conv_id", gaps, *COUNTS, "cost", "audit", F.col("sha").alias("repaired_sha256"))
    parts = made.where("not ended")
    audits = scratch_table(whole(parts), "conversation-audits")
    sha = digests(parts, audits).select(F.col("conv_id").alias("c"), F.col("sha").alias("repaired_sha256"))
    long = (audits.where(F.col("part").isNull()).join(sha, F.col("conv_id").eqNullSafe(F.col("c"))).select(*columns, "repaired_sha256"))
    return short.unionByName(long)


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, for every conv_id that there was."""
    fixed = repair(damaged(rows)).withColumnRenamed("conv_id", "c")
    ids = rows.select(F.col("conv_id").cast("bigint")).distinct()
    zero = {**dict.fromkeys(["gaps", *COUNTS, "cost"], 0), "audit": "", "repaired_sha256": EMPTY}
    return (ids.join(fixed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select("conv_id", *[F.coalesce(F.col(k), F.lit(v).cast("bigint") if v == 0 else F.lit(v)).alias(k) for k, v in zero.items()]))
