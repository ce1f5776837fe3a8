"""Data quality: profiling, findings, the gate, source health, reconciliation
and domain checks (Q1-Q9, A18, A19).

Checks are evaluated as ``count_if`` aggregates so a whole family of rules on
one table costs one scan; the gate result is a small DataFrame and only
:func:`enforce` looks at it on the driver (a handful of rows).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.stats import dq_tier
from .combine import with_scalars
from .lookup import maybe_broadcast


class GateFailed(RuntimeError):
    pass


def profile(df: DataFrame, table: str, approx_distinct: bool = False,
            approx_quantiles: bool = False, quantile_method: str = "distributed") -> DataFrame:
    """One row per column with null count and %, distinct count,
    numeric summary, plus the table's duplicate-row count (null-equal)."""
    cols = df.columns
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    aggs = [F.count("*").alias("__n")]
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs.append(F.count(x).alias(f"nn{i}"))
        aggs.append((F.approx_count_distinct(x) if approx_distinct else F.countDistinct(x))
                    .alias(f"nd{i}"))
        if c in numeric:
            xd = x.cast("double")
            aggs += [F.avg(xd).alias(f"mean{i}"), F.stddev_samp(xd).alias(f"std{i}"),
                     F.min(xd).alias(f"min{i}"), F.max(xd).alias(f"max{i}")]
            if approx_quantiles:
                aggs.append(F.percentile_approx(xd, [0.25, 0.5, 0.75], 10000).alias(f"qs{i}"))
    wide = df.agg(*aggs)
    num_idx = [i for i, c in enumerate(cols) if c in numeric]
    if num_idx and not approx_quantiles:
        # exact quartiles of every numeric column in one distributed job:
        # stack (column, value) and group the quantiles by column
        from .describe import quantiles
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("ci"), F.col(f"`{cols[i]}`").cast("double").alias("v"))
            for i in num_idx])).alias("s")).select("s.ci", "s.v")
        q = quantiles(long, "v", [0.25, 0.5, 0.75], "ci", quantile_method)
        qrow = q.agg(*[F.max(F.when(F.col("ci") == i, F.col("quantiles"))).alias(f"qs{i}")
                       for i in num_idx])
        wide = with_scalars(wide, qrow)
    wide = wide.select("*", *[F.col(f"qs{i}")[j].alias(f"{n}{i}") for i in num_idx
                              for j, n in enumerate(["q1", "med", "q3"])])
    dup = duplicate_rows(df).withColumnRenamed("duplicate_rows", "__dup")
    wide = with_scalars(wide, dup)
    structs = []
    for i, c in enumerate(cols):
        num = c in numeric

        def g(name):
            return F.col(f"{name}{i}") if num else F.lit(None).cast("double")

        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"nn{i}").alias("non_null"),
            F.col(f"nd{i}").cast("bigint").alias("n_distinct"),
            g("mean").alias("mean"), g("std").alias("std"), g("min").alias("min"),
            g("q1").alias("q1"), g("med").alias("median"), g("q3").alias("q3"),
            g("max").alias("max")))
    out = wide.select("__n", "__dup", F.explode(F.array(*structs)).alias("s"))
    return out.select(
        F.lit(table).alias("table_name"), "s.column_name", F.col("__n").alias("n_rows"),
        (F.col("__n") - F.col("s.non_null")).alias("null_count"),
        F.round((F.col("__n") - F.col("s.non_null")) / F.nullif(F.col("__n"), F.lit(0)) * 100, 6)
        .alias("null_pct"),
        "s.n_distinct",
        *[F.round(F.col(f"s.{m}"), 6).alias(m) for m in
          ["mean", "std", "min", "q1", "median", "q3", "max"]],
        F.col("__dup").alias("duplicate_rows"))


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Rows minus distinct rows over ``cols`` (nulls compare equal, so
    not ``count(distinct a, b)``, which skips null tuples). One-row frame."""
    cols = cols or df.columns
    g = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count("*").alias("__c"))
    return g.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("bigint")
                 .alias("duplicate_rows"))


def findings(df: DataFrame, source: str, rules: dict[str, Column]) -> DataFrame:
    """Q2: one pass of ``count_if`` per rule -> rows (rule, source, records_affected)."""
    wide = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"r{i}")
                    for i, c in enumerate(rules.values())])
    arr = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("n"))
                    for i, n in enumerate(rules)])
    return wide.select(F.explode(arr).alias("s")).select(
        "s.rule", F.lit(source).alias("source"), F.col("s.n").alias("records_affected"))


@dataclass
class Check:
    name: str
    failures: DataFrame  # one row, column ``failures``


@dataclass
class Gate:
    """Q4: collect every check, evaluate all of them, fail once at the end."""
    checks: list[Check] = field(default_factory=list)

    def rows(self, df: DataFrame, table: str, rules: dict[str, Column]) -> "Gate":
        """Row-level rules on one table in a single pass; a rule is the
        condition a *good* row satisfies (null counts as failure)."""
        wide = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"c{i}")
                        for i, c in enumerate(rules.values())])
        for i, n in enumerate(rules):
            self.checks.append(Check(f"{table}.{n}", wide.select(F.col(f"c{i}").alias("failures"))))
        return self

    def unique(self, df: DataFrame, table: str, keys) -> "Gate":
        """Number of key values that occur more than once."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        d = (df.groupBy(*keys).count().filter("count > 1")
             .agg(F.count("*").alias("failures")))
        self.checks.append(Check(f"{table}.unique({','.join(keys)})", d))
        return self

    def references(self, df: DataFrame, table: str, col: str, dim: DataFrame, key: str) -> "Gate":
        """Q5f: fact rows whose key has no dimension row (nulls included)."""
        d = dim.select(F.col(key).alias("__k")).distinct()
        orphans = df.select(col).join(maybe_broadcast(d), F.col(col) == F.col("__k"), "left_anti")
        self.checks.append(Check(f"{table}.{col}->dim", orphans.agg(F.count("*").alias("failures"))))
        return self

    def result(self) -> DataFrame:
        out = None
        for c in self.checks:
            r = c.failures.select(F.lit(c.name).alias("check_name"),
                                  F.col("failures").cast("bigint").alias("failures"))
            out = r if out is None else out.unionByName(r)
        return out.withColumn("ok", (F.col("failures") == 0).cast("int"))


def enforce(gate_result: DataFrame) -> DataFrame:
    """Raise :class:`GateFailed` listing every failed check (collects only the
    failed rows of the small gate table)."""
    failed = gate_result.filter("ok = 0").collect()
    if failed:
        raise GateFailed("; ".join(f"{r['check_name']}: {r['failures']}" for r in failed))
    return gate_result


@dataclass
class SourceSpec:
    """Q6 definition of one source: the conditions a good row satisfies."""
    name: str
    system: str
    df: DataFrame
    pk: list
    date_col: str
    mandatory: list
    validity: Column
    consistency: Column
    integrity: Column
    mapped: Column


def source_health(specs: list[SourceSpec], weights=None) -> DataFrame:
    """Q6/A9 ``mart_dq_source_health``: per-source percentages, score (equal
    weights unless given), tier and status; freshness is measured against the
    latest record over all sources."""
    w = weights or [1.0] * 6
    frames = []
    for s in specs:
        complete = F.lit(True)
        for c in s.mandatory:
            complete = complete & F.col(c).isNotNull()
        good = (complete & F.coalesce(s.validity, F.lit(False))
                & F.coalesce(s.consistency, F.lit(False)) & F.coalesce(s.integrity, F.lit(False))
                & F.coalesce(s.mapped, F.lit(False)))
        rows = s.df.agg(
            F.count("*").alias("records_total"),
            F.count_if(complete).alias("n_complete"),
            F.count_if(F.coalesce(s.validity, F.lit(False))).alias("n_valid"),
            F.count_if(F.coalesce(s.consistency, F.lit(False))).alias("n_consistent"),
            F.count_if(F.coalesce(s.integrity, F.lit(False))).alias("n_integral"),
            F.count_if(F.coalesce(s.mapped, F.lit(False))).alias("n_mapped"),
            F.count_if(good).alias("records_clean"),
            F.max(s.date_col).alias("latest_record_date"))
        keys = s.df.groupBy(*s.pk).count().agg(F.count("*").alias("n_keys"))
        frames.append(with_scalars(rows, keys).select(
            F.lit(s.name).alias("source"), F.lit(s.system).alias("source_system"), "*"))
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    tot = F.col("records_total")

    def pct(c):
        return F.round(F.col(c) / F.nullif(tot, F.lit(0)) * 100, 6)

    u = u.select(
        "source", "source_system", "records_total", "records_clean",
        pct("n_complete").alias("completeness_pct"), pct("n_keys").alias("uniqueness_pct"),
        pct("n_valid").alias("validity_pct"), pct("n_consistent").alias("consistency_pct"),
        pct("n_integral").alias("integrity_pct"),
        F.round((tot - F.col("n_keys")) / F.nullif(tot, F.lit(0)) * 100, 6).alias("duplicate_rate_pct"),
        pct("n_mapped").alias("mapping_completion_pct"),
        (tot - F.col("records_clean")).alias("failed_records"),
        F.to_date("latest_record_date").alias("latest_record_date"))
    latest = u.agg(F.max("latest_record_date").alias("__asof"))
    dims = ["completeness_pct", "uniqueness_pct", "validity_pct", "consistency_pct",
            "integrity_pct", "mapping_completion_pct"]
    score = sum(F.col(d) * wt for d, wt in zip(dims, w)) / float(sum(w))
    return (with_scalars(u, latest)
            .withColumn("freshness_days", F.datediff("__asof", "latest_record_date"))
            .withColumn("quality_score", F.round(score, 6))
            .withColumn("dq_tier", dq_tier("quality_score"))
            .withColumn("status", F.when(F.col("dq_tier").isin("A", "B"), "Healthy")
                        .when(F.col("dq_tier") == "C", "Warning").otherwise("Critical"))
            .drop("__asof"))


def reconcile(a: DataFrame, b: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Q7: join two long KPI frames (metric, value) from independent paths."""
    j = (a.select("metric", F.col("value").alias("value_a"))
         .join(b.select("metric", F.col("value").alias("value_b")), "metric", "full"))
    diff = F.col("value_a") - F.col("value_b")
    return j.select("metric", "value_a", "value_b", F.round(diff, 6).alias("diff"),
                    F.when(F.abs(diff) <= tolerance, "match").otherwise("mismatch").alias("status"))


def domain_check(df: DataFrame, domain: str, col: str, allowed) -> DataFrame:
    """Q8: every observed value of ``col`` with its row count and validity."""
    return (df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("n_rows"))
            .select(F.lit(domain).alias("domain"), "value", "n_rows",
                    F.coalesce(F.col("value").isin(list(allowed)), F.lit(False)).cast("int")
                    .alias("is_valid")))


def evidence(df: DataFrame, bad: Column, value, rule: str, source: str, k: int = 10) -> DataFrame:
    """The first ``k`` sorted distinct offending values of a rule, as rows
    (rule, source, rank, value). ``orderBy(...).limit(k)`` runs as a top-k
    inside every task before the merge, so no task sees all values; the rank
    is then numbered over the at most ``k`` survivors."""
    from pyspark.sql import Window
    v = (F.col(value) if isinstance(value, str) else value).cast("string")
    d = (df.filter(F.coalesce(bad, F.lit(False))).select(v.alias("value")).distinct()
         .orderBy("value").limit(k))
    w = Window.orderBy("value")  # over <= k rows
    return d.select(F.lit(rule).alias("rule"), F.lit(source).alias("source"),
                    F.row_number().over(w).alias("rank"), "value")
