"""Distribution summaries, histograms and counts.

Quantiles are exact (linear interpolation, the same definition as pandas and
DuckDB ``quantile_cont``) and distributed: no group is held in one task. Spark's
``percentile`` and the bounded ``percentile_approx`` sketch are there by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import corrected_skew
from ..session import written_table
from .combine import with_scalars

# The quantiles reported by describe_series, with their names.
QUANTILES = [("p01", 0.01), ("p05", 0.05), ("q1", 0.25), ("median", 0.5), ("q3", 0.75),
             ("p95", 0.95), ("p99", 0.99)]


def quantiles(df: DataFrame, value: str, probs, by=None, method: str = "distributed") -> DataFrame:
    """``by`` columns plus ``quantiles`` (aligned with ``probs``); null and NaN
    are left out. ``method``: as in :func:`describe_series`."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    if method == "distributed":
        return exact_quantiles(df, value, probs, by)
    x = F.col(value).cast("double")
    d = df.select(*by, x.alias("__x")).filter(F.col("__x").isNotNull() & ~F.isnan("__x"))
    agg = F.percentile_approx("__x", list(probs), 10000) if method == "approx" else \
        F.percentile("__x", list(probs))
    return (d.groupBy(*by) if by else d).agg(agg.alias("quantiles"))


def _q(c, p, approx, accuracy):
    if approx:
        return F.percentile_approx(c, p, accuracy)
    return F.percentile(c, p)


def describe_series(df: DataFrame, col: str, by=None, method: str = "distributed",
                    accuracy: int = 10000, places: int = 6) -> DataFrame:
    """Count, mean, std, min, p01, p05, q1, median, q3, p95, p99, max,
    skew (bias-corrected) per ``by`` group (or globally); nulls and NaN skipped.

    ``method``: ``'distributed'`` (exact, :func:`exact_quantiles`, no group
    in one task), ``'percentile'`` (Spark's exact buffer, a group in one task)
    or ``'approx'`` (bounded sketch).
    """
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    x = F.col(col).cast("double")
    d = df.select(*by, x.alias("__x")).filter(F.col("__x").isNotNull() & ~F.isnan("__x"))
    probs = [p for _, p in QUANTILES]
    aggs = [F.count("__x").alias("count"), F.avg("__x").alias("mean"),
            F.stddev_samp("__x").alias("std"), F.min("__x").alias("min"),
            F.max("__x").alias("max"), corrected_skew("__x").alias("skew")]
    if method != "distributed":
        aggs.append(_q("__x", probs, method == "approx", accuracy).alias("__qs"))
    else:
        d = written_table(d, "series")  # read by the sums and by every pass of the quantiles
    g = (d.groupBy(*by) if by else d).agg(*aggs)
    if method == "distributed":
        qs = exact_quantiles(d, "__x", probs, by).withColumnRenamed("quantiles", "__qs")
        g = g.join(qs, by, "left") if by else with_scalars(g, qs)
    g = g.select(*by, "count", "mean", "std", "min",
                 *[F.col("__qs")[i].alias(n) for i, (n, _) in enumerate(QUANTILES)], "max", "skew")
    return g.select(*by, "count", *[F.round(c, places).alias(c) for c in g.columns
                                    if c not in by and c != "count"])


def histogram(df: DataFrame, col: str, bins: int = 40, clip_q: float = 0.99,
              places: int = 6, method: str = "distributed") -> DataFrame:
    """Equal-width histogram after clipping at the ``clip_q`` quantile;
    every bin is reported, empty ones with count 0."""
    x = F.col(col).cast("double")
    d = df.select(x.alias("__x")).filter(F.col("__x").isNotNull() & ~F.isnan("__x"))
    clip = quantiles(d, "__x", [clip_q], None, method).select(F.col("quantiles")[0].alias("__hi"))
    stats = with_scalars(d.agg(F.min("__x").alias("__lo")), clip)
    w = (F.col("__hi") - F.col("__lo"))
    clipped = F.least(F.col("__x"), F.col("__hi"))
    b = F.when(w > 0, F.least(F.floor((clipped - F.col("__lo")) / w * bins), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    counts = with_scalars(d, stats).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    edges = stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                         "__lo", "__hi")
    ww = (F.col("__hi") - F.col("__lo")) / bins
    return (edges.join(counts, "bin", "left")
            .select("bin",
                    F.round(F.col("__lo") + F.col("bin") * ww, places).alias("bin_lo"),
                    F.round(F.col("__lo") + (F.col("bin") + 1) * ww, places).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def row_counts(tables: dict) -> DataFrame:
    """One row per named table with its row count (one job per table,
    results unioned lazily)."""
    frames = [df.select(F.lit(name).alias("table_name")).groupBy("table_name")
              .agg(F.count("*").alias("n_rows")) for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def long_kpis(row: DataFrame, metrics, context: str | None = None) -> DataFrame:
    """One wide KPI row -> long (metric, value[, context]) rows."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    out = row.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, value)")
    if context:
        out = out.withColumn("context", F.lit(context))
    return out


#: Rows of a group that may lie between a sketched quantile and the exact one: 1 in so many.
SKETCH = 2000


def exact_quantiles(df: DataFrame, value: str, probs, by=None, n_ranges: int | None = None
                    ) -> DataFrame:
    """Exact linearly-interpolated quantiles without putting a group in one task
    and without moving its rows.

    1. a sketch of each group gives two bounds about each quantile, and with
       them ranges of values: narrow ones that hold the quantiles, wide ones
       between them. ``n_ranges`` more bounds, if given, divide the wide ones;
    2. every row is counted in its range (partial aggregation in every task);
    3. each wanted rank is in the range that the counts say, whatever the
       sketch was worth; only the rows of these ranges are taken, as value ->
       count, and ranked.

    Returns ``by`` columns plus ``quantiles`` (array aligned with ``probs``).
    """
    from pyspark.sql import Window
    from .combine import with_scalars
    from .lookup import maybe_broadcast
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    probs = list(probs)
    x = (df.select(*by, F.col(value).cast("double").alias("__x"))
         .filter(F.col("__x").isNotNull() & ~F.isnan("__x")))
    eps = 1 / SKETCH
    at = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-eps, eps)} | {k / n_ranges for k in range(1, n_ranges or 1)})
    groups = x.groupBy(*by) if by else x
    sketch = groups.agg(F.percentile_approx("__x", at, 5 * SKETCH).alias("__b"))

    def same(right: str):
        """Null groups are groups like any other."""
        test = F.lit(True)
        for i, c in enumerate(by):
            test &= F.col(c).eqNullSafe(F.col(f"__{right}{i}"))
        return test

    def renamed(d: DataFrame, right: str) -> DataFrame:
        return d.withColumnsRenamed({c: f"__{right}{i}" for i, c in enumerate(by)})

    d = x.join(maybe_broadcast(renamed(sketch, "s")), same("s")).select(*by, "__x", "__b") if by else with_scalars(x, sketch)
    inside = sum((F.col("__x") >= F.get("__b", F.lit(i))).cast("int") for i in range(len(at)))
    d = d.select(*by, "__x", inside.alias("__pid"))
    # a row a group: the counts of its ranges in their order
    tot = d.groupBy(*by, "__pid").agg(F.count("*").alias("__t"))
    per = (tot.groupBy(*by) if by else tot).agg(F.sort_array(F.collect_list(F.struct("__pid", "__t"))).alias("__r"), F.sum("__t").alias("__n"))
    pos = F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("__n") - 1) * F.lit(float(p))).alias("pos")) for i, p in enumerate(probs)])
    t = per.where("__n > 0").select(*by, "__r", F.explode(pos).alias("q")).select(
        *by, "__r", "q.i", "q.pos", F.explode(F.array(F.floor("q.pos"), F.ceil("q.pos"))).alias("k"))
    # the range of a rank: the last one with no more rows before it
    ranges = F.transform("__r", lambda r, i: F.struct(
        r["__pid"].alias("pid"), F.aggregate(F.slice("__r", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, y: a + y["__t"]).alias("off")))
    t = t.select(*by, "i", "pos", "k", F.element_at(F.filter(ranges, lambda r: r["off"] <= F.col("k")), -1).alias("r")).select(
        *by, "i", "pos", "k", F.col("r.pid").alias("__in"), F.col("r.off").alias("__off"))
    wanted = renamed(t.select(*by, "__in", "__off").distinct(), "w")
    h = (d.join(maybe_broadcast(wanted), same("w") & (F.col("__pid") == F.col("__in")))
         .groupBy(*by, "__pid", "__off", "__x").agg(F.count("*").alias("__c")))
    local = Window.partitionBy(*by, "__pid").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("__hi", F.col("__off") + F.sum("__c").over(local)).withColumn("__lo", F.col("__hi") - F.col("__c"))
    ranks = renamed(t.select(*by, "i", "pos", "k", "__in"), "w")
    picked = h.join(ranks, same("w") & (F.col("__pid") == F.col("__in"))).where("k >= __lo AND k < __hi")
    per_q = picked.groupBy(*by, "i", "pos").agg(
        F.max(F.when(F.col("k") == F.floor("pos"), F.col("__x"))).alias("vlo"),
        F.max(F.when(F.col("k") == F.ceil("pos"), F.col("__x"))).alias("vhi"))
    lo_k, hi_k = F.floor("pos"), F.ceil("pos")
    qv = F.when(lo_k == hi_k, F.col("vlo")).otherwise(
        (hi_k - F.col("pos")) * F.col("vlo") + (F.col("pos") - lo_k) * F.col("vhi"))
    each = per_q.withColumn("qv", qv)
    out = (each.groupBy(*by) if by else each).agg(F.sort_array(F.collect_list(F.struct("i", "qv"))).alias("__qs"))
    return out.where(F.size("__qs") > 0).select(*by, F.transform("__qs", lambda s: s["qv"]).alias("quantiles"))
