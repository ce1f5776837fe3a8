"""Combining frames: drill-across, outer merge, prior period, set operations
(J13, J16, J19, J20, U1-U4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import maybe_broadcast


def with_scalars(df: DataFrame, one_row: DataFrame, cols=None) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate) to every row
    of ``df`` as scalar subqueries. Each is computed once and the optimizer
    merges subqueries over the same aggregate into one; no join, no pairing."""
    cols = list(cols or one_row.columns)
    return df.withColumns({c: one_row.select(F.col(f"`{c}`")).scalar() for c in cols})


def outer_merge(left: DataFrame, right: DataFrame, keys, fill=0) -> DataFrame:
    """Full outer merge of two aggregates (one row per key each) on
    ``keys``; missing measures become ``fill``. Rows are united and merged by
    one aggregation, in which null keys are a group like any other."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if shared := sorted(set(left.columns) & set(right.columns) - set(keys)):
        raise ValueError(f"measures of both sides: {shared}")
    both = left.unionByName(right, allowMissingColumns=True)
    measures = [c for c in both.columns if c not in keys]
    merged = both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
    return merged.select(*keys, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in measures])


def drill_across(spine: DataFrame, facts: list[DataFrame], keys, fill=0) -> DataFrame:
    """Left-join pre-aggregated facts (one row per key) onto a spine."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = spine
    measures = []
    for f in facts:
        measures += [c for c in f.columns if c not in keys]
        out = out.join(f, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in measures})


def prior_period(df: DataFrame, period: str, keys, measures, months: int, suffix: str) -> DataFrame:
    """Attach each measure's value from ``months`` earlier by a self join
    on ``add_months(period, months)`` (a gap yields null, unlike ``lag``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    prev = df.select(F.add_months(F.col(period), months).alias(period), *keys,
                     *[F.col(m).alias(m + suffix) for m in measures])
    return df.join(prev, [period] + keys, "left")


def attach_global_stats(df: DataFrame, col: str, by=None) -> DataFrame:
    """Attach mean and sample std of ``col`` (per ``by`` group, or
    global) to every row: a small aggregate joined back, never a
    single-partition window."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    stats = (df.groupBy(*by) if by else df).agg(F.avg(col).alias("_mean"),
                                                F.stddev_samp(col).alias("_std"))
    if by:
        return df.join(maybe_broadcast(stats), by, "left")
    return with_scalars(df, stats)


def union_distinct(frames, col: str) -> DataFrame:
    """Distinct values of one column across sources."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(col) for f in frames]).distinct()


def set_difference(observed: DataFrame, allowed: DataFrame, col: str) -> DataFrame:
    """Distinct observed values not in the allowed set."""
    return observed.select(col).distinct().join(
        maybe_broadcast(allowed.select(col).distinct()), col, "left_anti")


def append_rows(frames) -> DataFrame:
    """U4: append heterogeneous evidence rows (missing columns -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
