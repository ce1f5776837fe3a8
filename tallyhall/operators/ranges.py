"""Ranges of a row order, as a function of the row.

Splitting a table into ranges of (group, order) lets a group of any size be
numbered or accumulated by many tasks. The range of a row must not depend on
which task saw it, or a second evaluation (another branch, a lost executor)
would disagree with the first. Here the bounds are taken from the rows with
the least hashes of their keys - a sample that is a function of the data alone
- and held as one small array; a row's range is a binary search in it. So no
copy of the table has to be pinned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .combine import with_scalars

#: Sampled rows for each range.
SAMPLE = 64
RANGE, BOUNDS = "__range", "__bounds"


def _key(keys) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def bounds(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """One row: up to ``n`` - 1 sorted keys that split ``df`` into ranges of
    about equal size. The sample is at most ``SAMPLE`` * ``n`` rows (a top-k
    in every task)."""
    sample = df.select(_key(keys).alias("k"), F.xxhash64(*keys).alias("h")).orderBy("h").limit(SAMPLE * n).select("k")
    step = F.greatest(F.lit(1), F.ceil(F.size("s") / n)).cast("int")
    return (sample.agg(F.sort_array(F.collect_list("k")).alias("s")).select("s", step.alias("step"))
            .select(F.filter("s", lambda x, i: (i > 0) & (i % F.col("step") == 0)).alias(BOUNDS)))


def with_range(df: DataFrame, keys: list[str], n: int, at: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """``df`` with its range: from 0, in the order of ``keys``, nulls first.
    ``at`` are its ``bounds``, if they are known. Rows for which ``where`` does
    not hold are in range 0 and cost no search."""
    # the key is named twice, so that it is made once a row and not at every step
    mid = "shiftright(s.lo + s.hi, 1)"
    search = f"""if(__key IS NULL, 0, aggregate(sequence(1, {max(1, n.bit_length())}), named_struct('lo', 0, 'hi', size({BOUNDS})),
        (s, x) -> if(s.lo >= s.hi, s, if(get({BOUNDS}, {mid}) <= __key,
                     named_struct('lo', {mid} + 1, 'hi', s.hi), named_struct('lo', s.lo, 'hi', {mid}))),
        s -> s.lo))"""
    d = with_scalars(df, bounds(df, keys, n) if at is None else at).withColumn("__key", _key(keys) if where is None else F.when(where, _key(keys)))
    return d.withColumn(RANGE, F.expr(search)).drop(BOUNDS, "__key")


def large_groups(df: DataFrame, group: list[str], n: int) -> DataFrame:
    """The groups (``__g0``...) that have more than an ``n``-th of the rows, so
    fewer than ``n``."""
    sizes = df.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)]).agg(F.count("*").alias("__n"))
    return with_scalars(sizes, df.agg(F.count("*").alias("__all"))).where(F.col("__n") * n > F.col("__all")).drop("__n", "__all")


#: Buckets of ``has_large_groups`` for each of the ``n``.
BUCKETS = 64


def has_large_groups(df: DataFrame, group: list[str], n: int) -> bool:
    """False only if no group has more than an ``n``-th of the rows. Groups are
    counted by a hash in ``BUCKETS`` * ``n`` counters, so that each task sends a
    few counts and not its groups; a bucket is at least as large as its groups."""
    bucket = F.pmod(F.xxhash64(*group), F.lit(BUCKETS * n)).alias("b")
    sizes = df.groupBy(bucket).agg(F.count("*").alias("n"))
    most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) * n > (rows or 0)
