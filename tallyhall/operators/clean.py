"""Row repairs, quarantine and deterministic deduplication.

All cleaners are lazy column expressions or aggregations; keep-first
deduplication is a ``min_by`` aggregate (partial aggregation on the map
side), so a key holding a third of the rows is combined before the shuffle
instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import is_blank, norm_key, number_body, parse_number_body, parse_trimmed_date, trim_ws

LINEAGE = ("_source_file", "_raw_row")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def data_columns(df: DataFrame, ignore=LINEAGE) -> list[str]:
    return [c for c in df.columns if c not in set(ignore)]


def drop_blank_rows(df: DataFrame, ignore=LINEAGE) -> DataFrame:
    """Drop rows that are null or whitespace in every data column."""
    cols = data_columns(df, ignore)
    if not cols:
        return df
    all_blank = F.lit(True)
    for c in cols:
        all_blank = all_blank & is_blank(c)
    return df.filter(~all_blank)


def blank_columns(df: DataFrame, ignore=LINEAGE) -> list[str]:
    """Columns blank in every row: one aggregate pass, one small row back."""
    cols = data_columns(df, ignore)
    if not cols:
        return []
    row = df.agg(*[F.max((~is_blank(c)).cast("int")).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if not row[f"c{i}"]]


def drop_blank_columns(df: DataFrame, ignore=LINEAGE) -> DataFrame:
    """Drop columns that are blank in every row (for real)."""
    return df.drop(*blank_columns(df, ignore))


def trim_all(df: DataFrame, cols=None, blank_as_null: bool = False) -> DataFrame:
    """Strip whitespace (tabs included) from every text column."""
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    exprs = {}
    for c in names:
        t = trim_ws(c)
        exprs[c] = F.when(t == "", F.lit(None).cast("string")).otherwise(t) if blank_as_null else t
    return df.withColumns(exprs)


def parse_dates(df: DataFrame, cols, day_first_fallback: bool = False) -> DataFrame:
    """Parse mixed-format date columns in place."""
    # trimmed in a step of its own: the parser names its text many times
    trimmed = df.withColumns({c: trim_ws(F.col(c).cast("string")) for c in cols})
    return trimmed.withColumns({c: parse_trimmed_date(c, day_first_fallback) for c in cols})


def parse_numbers(df: DataFrame, cols) -> DataFrame:
    """Parse mixed-locale numeric columns in place."""
    parts = {c: number_body(c) for c in cols}
    split = df.withColumns({f"__{k}_{c}": x for c in cols for k, x in zip(("neg", "body"), parts[c])})
    parsed = split.withColumns({c: parse_number_body(f"__neg_{c}", f"__body_{c}") for c in cols})
    return parsed.drop(*[f"__{k}_{c}" for c in cols for k in ("neg", "body")])


def quarantine(df: DataFrame, bad: Column, rule: str) -> tuple[DataFrame, DataFrame]:
    """P5: split rows failing ``bad`` into a quarantine frame tagged with the
    rule; ok + quarantined = input (null conditions count as ok)."""
    flag = F.coalesce(bad, F.lit(False))
    return df.filter(~flag), df.filter(flag).withColumn("_rule", F.lit(rule))


def window_guard(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Keep rows whose date lies in [lo, hi]; null dates pass."""
    c = F.col(col)
    return df.filter(c.isNull() | c.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def fix_interval(df: DataFrame, start: str, end: str, flag: str | None = None) -> DataFrame:
    """Swap start and end where end < start (both in one projection)."""
    inv = F.coalesce(F.col(end) < F.col(start), F.lit(False))
    out = {start: F.when(inv, F.col(end)).otherwise(F.col(start)),
           end: F.when(inv, F.col(start)).otherwise(F.col(end))}
    if flag:
        out[flag] = inv.cast("int")
    return df.withColumns(out)


def fix_negative(df: DataFrame, col: str, mode: str = "zero", out: str | None = None) -> DataFrame:
    """Floor negatives at 0 (``mode='zero'``) or take |x| (``'abs'``)."""
    c = F.col(col)
    e = F.abs(c) if mode == "abs" else F.when(c < 0, F.lit(0)).otherwise(c)
    return df.withColumn(out or col, e)


def length_of_stay(check_in, check_out) -> Column:
    """Nights between two dates, at least 1."""
    return F.greatest(F.datediff(_c(check_out), _c(check_in)), F.lit(1))


def status_flags(status, mapping: dict[str, str]) -> dict[str, Column]:
    """P10: one 0/1 flag column per status value, e.g.
    ``{'is_cancelled': 'Cancelled', 'is_no_show': 'No-Show'}``."""
    s = _c(status)
    return {name: F.coalesce((s == value).cast("int"), F.lit(0)) for name, value in mapping.items()}


def default_zero(df: DataFrame, cols) -> DataFrame:
    """Null measure -> 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols})


def guarded_unit_price(gross, qty) -> Column:
    """Gross / qty when qty > 0 else 0 (never divides by zero)."""
    q = _c(qty)
    return F.when(q > 0, F.try_divide(_c(gross).cast("double"), q.cast("double"))).otherwise(F.lit(0.0))


def whitelist(df: DataFrame, col: str, values, default: str = "Other",
              out: str | None = None) -> DataFrame:
    """Canonical display value by normalized key; unknown -> default.

    The whitelist is a literal map (bounded by the caller), so this is a
    map lookup inside the projection rather than a join.
    """
    pairs = []
    for v in values:
        pairs += [F.lit(_norm_py(v)), F.lit(v)]
    m = F.create_map(*pairs)
    return df.withColumn(out or col, F.coalesce(m[norm_key(col)], F.lit(default)))


def _norm_py(s: str) -> str:
    import re
    s = re.sub(r"[^A-Z0-9 ]+", " ", str(s).upper())
    return re.sub(r" +", " ", s).strip()


def dedup_first(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row per key by ``order`` (deterministic).

    Expressed as ``min_by(row, order)`` so it aggregates map-side: a hot key
    is reduced in every task before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c).alias(c) for c in rest])
    o = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    g = df.groupBy(*keys).agg(F.min_by(row, o).alias("__first"))
    return g.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in rest]).select(*df.columns)


def dedup_exact(df: DataFrame, ignore=LINEAGE, order=None) -> DataFrame:
    """Drop exact duplicates over the data columns (lineage ignored),
    keeping the first by ``order`` (default: the lineage columns). Nulls
    compare equal, as in grouping."""
    keys = data_columns(df, ignore)
    order = order or [c for c in ignore if c in df.columns]
    if not order:
        return df.dropDuplicates(keys)
    return dedup_first(df, keys, order)


def line_numbers(df: DataFrame, group, order, out: str = "line_no", base: int = 1,
                 ranges: int | None = None, split: bool = True) -> DataFrame:
    """Running number within ``group`` in ``order`` (1-based by default;
    ``base=0`` for the suffix style). ``split`` False: groups are known to be
    no larger than a task's share (``has_large_groups``), so the rows are read
    once and each group is numbered whole.

    A group that has more than a task's share of the rows is split by ranges of
    (group, order), so it spreads over many tasks in order; it is numbered
    inside each range, and the row counts of its earlier ranges are added.
    Groups are counted by their keys alone; every other group stays whole, and
    its rows meet no bounds.
    """
    from .ranges import RANGE, bounds, large_groups, with_range
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    if not split:
        number = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1 + base
        return df.withColumn(out, number.cast("int"))
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, names = [*group, *order], [f"__g{i}" for i in range(len(group))]
    large = F.broadcast(large_groups(df, group, n).withColumn("__large", F.lit(True)))  # fewer than n rows
    same = F.lit(True)
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"__g{i}"))
    long = df.select(*keys).join(large, same, "left_semi")
    at = bounds(long, keys, n)
    counts = (with_range(long, keys, n, at)
              .groupBy(*[F.col(g).alias(x) for g, x in zip(group, names)], F.col(RANGE).alias("__p")).agg(F.count("*").alias("__n")))
    before = Window.partitionBy(*names).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("__off", F.sum("__n").over(before)).where("__off > 0")
    local = Window.partitionBy(*group, RANGE).orderBy(*order)
    rows = df.join(large, same, "left").select(*df.columns, "__large")
    return (with_range(rows, keys, n, at, F.col("__large")).withColumn("__local", F.row_number().over(local))
            .join(F.broadcast(offs), same & (F.col(RANGE) == F.col("__p")), "left")  # fewer than 2 n rows
            .withColumn(out, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local") - 1 + base).cast("int"))
            .select(*df.columns, out))


def composite_key(id_col, n_col, sep: str = "-") -> Column:
    """Text key ``id-n``."""
    return F.concat_ws(sep, _c(id_col).cast("string"), _c(n_col).cast("string"))


def reorder_signal(df: DataFrame, opening: str, consumption: str, coverage_days: int = 5,
                   out: str = "needs_reorder") -> DataFrame:
    """Opening stock below ``coverage_days`` of consumption."""
    return df.withColumn(out, (F.col(opening) < F.col(consumption) * coverage_days).cast("int"))
