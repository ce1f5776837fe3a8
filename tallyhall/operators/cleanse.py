"""Cleaning stage with its log (Q3, S11): rules as bits of one mask a row.

A :class:`Cleanse` is a declared order of steps on one source. Each rule that
fires on a row sets its bit in ``_flags``; a rule that quarantines a row keeps
the row, marked, so kept and quarantined rows come from one evaluation and
nothing is lost. A rule sees the row as the earlier steps left it, and not at
all once it is quarantined. Duplicates are combined before the rules (partial
aggregation, so a hot key is reduced in every task) and counted in ``_copies``.

The log needs no pass of its own: its counts are sums over ``_flags`` and
``_copies``, taken by ``observe`` while the flagged table is written
(:meth:`Cleanse.write`), or by one aggregate (:meth:`Cleanse.log`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .clean import LINEAGE, data_columns

FLAGS, COPIES, HIT = "_flags", "_copies", "__hit"
LOG_SCHEMA = ("log_id int, source string, rule string, action string, records_affected bigint, "
              "rows_before bigint, rows_after bigint")


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    quarantines: bool


class Cleanse:
    """Steps on the rows of one source, in order."""

    def __init__(self, df: DataFrame, source: str):
        self.source, self.rules, self.duplicates = source, [], None
        self.df = df.withColumn(COPIES, F.lit(1).cast("bigint")).withColumn(FLAGS, F.lit(0).cast("bigint"))

    # -------------------------------------------------------------- steps
    def dedup(self, rule: str, keys=None, order=LINEAGE[1], ignore=LINEAGE, within: str | None = None) -> "Cleanse":
        """Keep the first row of each key by ``order`` (``keys`` None: of equal
        rows, lineage aside). Comes before all rules. Rows are dealt by
        ``within``, one of the keys, if it is given: a later step by that column
        then moves them no more. For columns without large groups only."""
        if self.rules or self.duplicates:
            raise ValueError("duplicates are combined once, before the rules")
        self.duplicates = rule
        cols = [c for c in self.df.columns if c not in (COPIES, FLAGS)]
        keys = data_columns(self.df.select(*cols), ignore) if keys is None else [keys] if isinstance(keys, str) else list(keys)
        rest = [c for c in cols if c not in keys]
        # only the order is left of a row: its least value alone needs no sorting
        first = F.struct(F.min(order).alias(order)) if rest == [order] else F.min_by(F.struct(*rest), F.col(order)) if rest else F.first(F.lit(None))
        dealt = self.df.repartition(within) if within else self.df
        self.df = (dealt.groupBy(*keys).agg(first.alias("__first"), F.sum(COPIES).alias(COPIES))
                   .select(*[F.col(f"__first.{c}").alias(c) if c in rest else F.col(c) for c in cols], COPIES,
                           F.lit(0).cast("bigint").alias(FLAGS)))
        return self

    def derive(self, **columns) -> "Cleanse":
        """Columns from columns, without a rule."""
        self.df = self.df.withColumns(columns)
        return self

    def using(self, step) -> "Cleanse":
        """Any step that keeps every row once (a lookup)."""
        self.df = step(self.df)
        return self

    def repair(self, rule: str, when: Column, action: str, **fixes) -> "Cleanse":
        """Where ``when`` holds, set the columns ``fixes``; null is false. All
        fixes see the row as it was before."""
        hit = F.col(HIT)
        out = {c: F.when(hit, v).otherwise(F.col(c)) for c, v in fixes.items()}
        self.df = self._hit(when).withColumns(out | {FLAGS: self._flag(hit)}).drop(HIT)
        self.rules.append(Rule(rule, action, False))
        return self

    def quarantine(self, rule: str, when: Column, action: str = "quarantined") -> "Cleanse":
        self.df = self._hit(when).withColumn(FLAGS, self._flag(F.col(HIT))).drop(HIT)
        self.rules.append(Rule(rule, action, True))
        return self

    def _hit(self, when: Column) -> DataFrame:
        """With whether the rule fires, as a column: it is used several times."""
        return self.df.withColumn(HIT, self.alive() & F.coalesce(when, F.lit(False)))

    def _flag(self, hit: Column) -> Column:
        if len(self.rules) > 61:
            raise ValueError("a mask holds 62 rules")
        return F.col(FLAGS).bitwiseOR(F.when(hit, F.lit(1 << len(self.rules))).otherwise(F.lit(0)).cast("bigint"))

    # ------------------------------------------------------------ results
    def alive(self) -> Column:
        mask = sum(1 << i for i, r in enumerate(self.rules) if r.quarantines)
        return F.col(FLAGS).bitwiseAND(F.lit(mask).cast("bigint")) == 0

    def flagged(self) -> DataFrame:
        """All rows with their flags. A filter on these would be pushed below
        the steps and evaluate every parsed column once more; it is not pushed
        through a generated value. The other columns pass by it: those that are
        not used later are not made, and rows stay dealt as they are."""
        rest = [c for c in self.df.columns if c != FLAGS]
        return self.df.select(*rest, F.inline(F.array(F.struct(FLAGS)))).select(*self.df.columns)

    def clean(self, df: DataFrame | None = None) -> DataFrame:
        df = self.flagged() if df is None else df
        return df.where(self.alive()).drop(FLAGS, COPIES)

    def quarantined(self, df: DataFrame | None = None) -> DataFrame:
        """Rows left out, with the rule that did it (``_rule``)."""
        df = self.flagged() if df is None else df
        name = F.coalesce(*[F.when(F.col(FLAGS).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(r.name))
                            for i, r in enumerate(self.rules) if r.quarantines] or [F.lit(None).cast("string")])
        return df.where(~self.alive()).withColumn("_rule", name).drop(FLAGS, COPIES)

    def counts(self) -> list[Column]:
        """Rows in, rows after the duplicates, and one count a rule."""
        hits = [F.coalesce(F.count_if(F.col(FLAGS).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0), F.lit(0)).alias(f"r{i}")
                for i in range(len(self.rules))]
        return [F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_kept"), *hits]

    def log(self) -> DataFrame:
        """The log by one aggregate over the flagged rows."""
        return self._log(self.df.agg(*self.counts()))

    def _log(self, one: DataFrame) -> DataFrame:
        rows, before = [], F.col("rows_kept")
        if self.duplicates:
            rows.append((self.duplicates, "first kept", F.col("rows_in") - F.col("rows_kept"), F.col("rows_in"), before))
        for i, r in enumerate(self.rules):
            after = before - F.col(f"r{i}") if r.quarantines else before
            rows.append((r.name, r.action, F.col(f"r{i}"), before, after))
            before = after
        each = [F.struct(F.lit(k + 1).alias("log_id"), F.lit(self.source).alias("source"), F.lit(name).alias("rule"),
                         F.lit(action).alias("action"), n.cast("bigint").alias("records_affected"),
                         b.cast("bigint").alias("rows_before"), a.cast("bigint").alias("rows_after"))
                for k, (name, action, n, b, a) in enumerate(rows)]
        return one.select(F.inline(F.array(*each)))

    def write(self, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(clean, quarantined, log) of one evaluation: the flagged table is
        written to ``path`` and its log counted on the way."""
        spark, seen = self.df.sparkSession, Observation()
        self.df.observe(seen, *self.counts()).write.mode("overwrite").parquet(path)
        got = seen.get
        names = ["rows_in", "rows_kept", *[f"r{i}" for i in range(len(self.rules))]]
        one = spark.createDataFrame([tuple(int(got.get(n) or 0) for n in names)], ", ".join(f"{n} bigint" for n in names))
        back = spark.read.parquet(path)
        return self.clean(back), self.quarantined(back), self._log(one)


def cleansing_log(logs: list[DataFrame]) -> DataFrame:
    """The logs of several sources, each in the order of its rules."""
    out = logs[0]
    for d in logs[1:]:
        out = out.unionByName(d)
    return out
