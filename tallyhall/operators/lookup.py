"""Lookups, alias maps and integrity joins.

Dimension sides are broadcast only behind a size check (``maybe_broadcast``);
beyond the bound the join is left to Catalyst/AQE as a shuffle join. Fuzzy
matching (J8/J9) always runs on the *distinct* raw strings, never per fact row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_key

# Largest estimated plan size that is broadcast by the helpers below.
BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (file sizes × projection), or None."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def maybe_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is within the bound."""
    bound = BROADCAST_BYTES if max_bytes is None else max_bytes
    n = estimated_bytes(df)
    return F.broadcast(df) if n is not None and n <= bound else df


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             max_bytes: int | None = None) -> DataFrame:
    """Fact ⋈ dimension with a size-checked broadcast of the dimension."""
    return fact.join(maybe_broadcast(dim, max_bytes), on, how)


class AmbiguousKeyError(ValueError):
    pass


def _dedup_map(mp: DataFrame, key: str, value_cols: list[str]) -> DataFrame:
    """One row per key; ``_n_ids`` > 1 marks an ambiguous key (several ids:
    the least is not the greatest)."""
    first = value_cols[0]
    n_ids = F.when(F.min(first).isNull(), 0).when(F.min(first) == F.max(first), 1).otherwise(2)
    return mp.groupBy(key).agg(n_ids.alias("_n_ids"), *[F.min(c).alias(c) for c in value_cols])


# Ids listed per colliding key in collision reports (evidence, not the count).
EVIDENCE_IDS = 10


def id_collisions(mp: DataFrame, key: str, value: str, k: int = EVIDENCE_IDS) -> DataFrame:
    """Keys claimed by more than one id: ``n_ids`` (exact) and ``ids``, the
    first ``k`` ids in sorted order. The ``row_number() <= k`` filter is
    applied inside each task before the shuffle (window group limit), so a
    key claimed by a huge number of ids never lands whole in one task."""
    from pyspark.sql import Window
    pairs = mp.select(key, value).filter(F.col(value).isNotNull()).distinct()
    n = pairs.groupBy(key).agg(F.count("*").alias("n_ids")).filter("n_ids > 1")
    w = Window.partitionBy(key).orderBy(value)
    first = (pairs.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k)
             .groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("ids")))
    return n.join(first, key)


def ambiguous_keys(mp: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that map to more than one id."""
    return id_collisions(mp, key, value)


def lookup(df: DataFrame, col, mp: DataFrame, key: str, value, out=None,
           on_ambiguous: str = "error", max_bytes: int | None = None) -> DataFrame:
    """Map raw text -> id through a two-column alias map; unmatched -> null.

    ``value`` may be one column name or a list (J5 attribute lookup). With
    ``on_ambiguous='error'`` a key mapping to several ids raises; with
    ``'quarantine'`` such rows get null ids and ``_ambiguous`` = 1 so that
    :func:`~tallyhall.operators.clean.quarantine` can split them off.
    """
    values = [value] if isinstance(value, str) else list(value)
    outs = values if out is None else ([out] if isinstance(out, str) else list(out))
    probe = F.col(col) if isinstance(col, str) else col
    m = _dedup_map(mp, key, values)
    if on_ambiguous == "error":
        bad = m.filter("_n_ids > 1").select(key).limit(5).collect()
        if bad:
            raise AmbiguousKeyError(f"alias map key(s) with several ids: {[r[0] for r in bad]}")
    kname = "__lk_key"
    m = m.select(F.col(key).alias(kname), "_n_ids",
                 *[F.when(F.col("_n_ids") == 1, F.col(v)).alias(f"__lk_{i}")
                   for i, v in enumerate(values)])
    j = df.join(maybe_broadcast(m, max_bytes), probe == F.col(kname), "left")
    j = j.select(*df.columns,
                 *[F.col(f"__lk_{i}").alias(o) for i, o in enumerate(outs)],
                 *([(F.coalesce(F.col("_n_ids"), F.lit(0)) > 1).cast("int").alias("_ambiguous")]
                   if on_ambiguous == "quarantine" else []))
    return j


def normalized_lookup(df: DataFrame, col, mp: DataFrame, key: str, value, out=None,
                      on_ambiguous: str = "error", max_bytes: int | None = None) -> DataFrame:
    """J1 on ``norm_key`` of both sides."""
    m = mp.select(norm_key(key).alias("__nk"), *([value] if isinstance(value, str) else value))
    return lookup(df, norm_key(col), m, "__nk", value, out, on_ambiguous, max_bytes)


def two_stage_lookup(df: DataFrame, code_col: str, name_col: str, dim: DataFrame,
                     dim_code: str, dim_name: str, dim_id: str, out: str) -> DataFrame:
    """Look up by code first, then by normalized name where the code failed."""
    by_code = normalized_lookup(df, code_col, dim, dim_code, dim_id, "__by_code")
    by_name = normalized_lookup(by_code, name_col, dim, dim_name, dim_id, "__by_name")
    return (by_name.withColumn(out, F.coalesce("__by_code", "__by_name"))
            .drop("__by_code", "__by_name"))


def default_bucket(df: DataFrame, col: str, default) -> DataFrame:
    """Unmatched lookups go to a named default member (e.g. ``S999``)."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def orphans(fact: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension (null keys
    included)."""
    d = dim.select(F.col(key).alias("__ri_key")).distinct()
    return fact.join(maybe_broadcast(d), F.col(col) == F.col("__ri_key"), "left_anti")


def members(fact: DataFrame, col: str, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the allowed set (left semi join)."""
    d = allowed.select(F.col(key).alias("__sm_key")).distinct()
    return fact.join(maybe_broadcast(d), F.col(col) == F.col("__sm_key"), "left_semi")


def contains_match(strings: DataFrame, col: str, dim: DataFrame, dim_text: str,
                   dim_id: str, dim_order: str, out: str = "matched_id") -> DataFrame:
    """Canonical text contained in the normalized raw string (also with
    spaces removed); the first dim entry in ``dim_order`` wins.

    A match with spaces is also one without, so the test is containment of
    the space-free canonical key in the space-free raw key. It runs as an
    equi-join: each distinct raw key yields its substrings of exactly the
    lengths that occur among the canonical keys (a small array taken as a
    scalar subquery), joined on equality. No string x entry pairs are formed;
    work grows with text length x distinct key lengths.
    """
    nospace = F.replace(norm_key("__raw"), F.lit(" "), F.lit(""))
    s = strings.select(F.col(col).alias("__raw")).distinct().withColumn("__k", nospace)
    d = (dim.select(F.replace(norm_key(dim_text), F.lit(" "), F.lit("")).alias("__ck"),
                    F.col(dim_id).alias("__id"), F.col(dim_order).alias("__ord"))
         .filter(F.col("__ck") != ""))
    lengths = d.select(F.array_sort(F.collect_set(F.length("__ck")))).scalar()
    n = F.length("__k")
    cand = (s.select("__raw", "__k", F.explode(lengths).alias("__w"))
            .filter(F.col("__w") <= n)
            .select("__raw", "__k", "__w", F.explode(F.sequence(F.lit(1), n - F.col("__w") + 1))
                    .alias("__i"))
            .select("__raw", F.expr("substring(__k, __i, __w)").alias("__ck")))
    pairs = cand.join(maybe_broadcast(d), "__ck")
    best = pairs.groupBy("__raw").agg(F.min_by("__id", F.struct("__ord", "__id")).alias(out))
    return best.withColumnRenamed("__raw", col)


def tokens(c) -> Column:
    """Distinct tokens of the normalized key."""
    return F.array_distinct(F.split(norm_key(c), " "))


#: Most frequent tokens of a text that pair it with no one.
HOT_TOKENS = 2


def _ranked_tokens(texts: DataFrame, keys: list[str], freq: DataFrame) -> DataFrame:
    """``keys`` and ``t``, the text's tokens that the dimension has, the
    rarest first."""
    t = texts.select(*keys, F.explode(tokens("__text")).alias("__tok")).join(maybe_broadcast(freq), "__tok")
    return (t.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__f", "__tok"))).alias("t"))
            .select(*keys, F.transform("t", lambda x: x["__tok"]).alias("t")))


def _rare(t: str) -> Column:
    return F.explode(F.slice(t, F.lit(1), F.greatest(F.size(t) - HOT_TOKENS, F.lit(0))))


def _few(t: str) -> Column:
    """Every token alone and every two of them, in their order."""
    ones = F.transform(t, lambda x: F.array(x))
    twos = F.flatten(F.transform(t, lambda x, i: F.transform(F.slice(t, i + 2, F.size(t)), lambda y: F.array(x, y))))
    return F.explode(F.concat(ones, twos))


def overlap_candidates(strings: DataFrame, dim: DataFrame) -> DataFrame:
    """(__raw, t, __id, __ord, dt): for each string (``__raw``, ``__text``)
    dimension entries (``__id``, ``__ord``, ``__text``) among which is its
    best by shared tokens; ties by (__ord, __id).

    A prefix filter: tokens are ordered by how many entries have them. Who
    shares more than ``HOT_TOKENS`` tokens shares one that is not among the
    ``HOT_TOKENS`` most frequent of either, so only the others are joined.
    Who shares fewer is, at best, the first entry that has that one token, or
    those two: one row for each, found by an aggregate. So a token that every
    name has is never a join key, and no pairs are formed for it.
    """
    freq = (dim.select("__id", F.explode(tokens("__text")).alias("__tok")).where("__tok != ''")
            .groupBy("__tok").agg(F.count("*").alias("__f")))
    s = _ranked_tokens(strings, ["__raw"], freq)
    d = _ranked_tokens(dim, ["__id", "__ord"], freq)
    rare = (s.select("__raw", "t", _rare("t").alias("__k"))
            .join(maybe_broadcast(d.select("__id", "__ord", F.col("t").alias("dt"), _rare("t").alias("__k"))), "__k")
            .select("__raw", "t", "__id", "__ord", "dt"))
    first = (d.select("__id", "__ord", "t", _few("t").alias("__k")).groupBy("__k")
             .agg(F.min_by(F.struct("__id", "__ord", F.col("t").alias("dt")), F.struct("__ord", "__id")).alias("__e")))
    few = s.select("__raw", "t", _few("t").alias("__k")).join(maybe_broadcast(first), "__k").select("__raw", "t", "__e.*")
    return rare.unionByName(few)


def token_overlap_match(strings: DataFrame, col: str, dim: DataFrame, dim_text: str,
                        dim_id: str, dim_order: str, min_overlap: int = 1,
                        out: str = "matched_id") -> DataFrame:
    """Best dimension entry by number of shared tokens (>= ``min_overlap``);
    ties go to the first entry in ``dim_order``. A shuffle join on rare
    tokens (:func:`overlap_candidates`) that scales past any broadcast limit.
    """
    s = strings.select(F.col(col).alias("__raw")).where(F.col(col).isNotNull()).distinct().withColumn("__text", F.col("__raw"))
    d = dim.select(F.col(dim_id).alias("__id"), F.col(dim_order).alias("__ord"), F.col(dim_text).alias("__text")).distinct()
    found = (overlap_candidates(s, d).withColumn("__n", F.size(F.array_intersect("t", "dt")).cast("bigint"))
             .where(F.col("__n") >= min_overlap))
    best = found.groupBy("__raw").agg(
        F.min_by(F.struct("__id", "__n"),
                 F.struct((-F.col("__n")).alias("a"), F.col("__ord").alias("b"),
                          F.col("__id").alias("c"))).alias("__b"))
    return best.select(F.col("__raw").alias(col), F.col("__b.__id").alias(out),
                       F.col("__b.__n").alias("shared_tokens"))


def alias_seeds(dim: DataFrame, id_col: str, name_col: str, extra_cols=(),
                prefix: str | None = None, priority_col: str | None = None) -> DataFrame:
    """Candidate aliases of each canonical name -> (alias_key, id, priority).

    Variants: the name, its dashed form, its last token, and for each extra
    column (city, code...) the value itself and ``prefix + value``.
    """
    name = F.col(name_col)
    variants = [name, F.regexp_replace(name, " ", "-"), F.element_at(F.split(name, " "), -1)]
    for c in extra_cols:
        variants.append(F.col(c).cast("string"))
        if prefix:
            variants.append(F.concat(F.lit(prefix + " "), F.col(c).cast("string")))
    pr = F.col(priority_col) if priority_col else F.lit(0)
    return (dim.select(F.col(id_col).alias("id"), pr.alias("priority"),
                       F.explode(F.array(*variants)).alias("alias"))
            .select(norm_key("alias").alias("alias_key"), "id", "priority")
            .filter(F.col("alias_key") != "").distinct())


def resolve_seeds(seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split seeded aliases into a one-id-per-key map (lowest priority, then
    lowest id wins) and a collision report of keys claimed by several ids."""
    collisions = id_collisions(seeds, "alias_key", "id")
    resolved = (seeds.groupBy("alias_key")
                .agg(F.min_by("id", F.struct("priority", "id")).alias("id")))
    return resolved, collisions


def build_alias_map(observed: DataFrame, col: str, dim: DataFrame, dim_text: str,
                    dim_id: str, dim_order: str, seeds: DataFrame | None = None,
                    fallback: str = "tokens", min_overlap: int = 1):
    """Map every distinct observed string to a canonical id.

    Order: seeded alias (normalized), exact normalized canonical text, then the
    fallback (``'contains'`` = J8, ``'tokens'`` = J9) on the remainder.
    Returns ``(alias_map, unmapped)``; alias_map has columns
    (raw, alias_key, id, method).
    """
    obs = (observed.select(F.col(col).alias("raw")).filter(F.col("raw").isNotNull())
           .distinct().withColumn("alias_key", norm_key("raw")))
    exact = (dim.select(norm_key(dim_text).alias("alias_key"), F.col(dim_id).alias("id"),
                        F.col(dim_order).alias("__ord"))
             .groupBy("alias_key").agg(F.min_by("id", F.struct("__ord", "id")).alias("id")))
    cands = [exact.withColumn("__rank", F.lit(2)).withColumn("method", F.lit("exact"))]
    if seeds is not None:
        resolved, _ = resolve_seeds(seeds)
        cands.insert(0, resolved.withColumn("__rank", F.lit(1)).withColumn("method", F.lit("seed")))
    direct = cands[0]
    for c in cands[1:]:
        direct = direct.unionByName(c)
    direct = direct.groupBy("alias_key").agg(
        F.min_by(F.struct("id", "method"), "__rank").alias("__m"))
    hit = (obs.join(maybe_broadcast(direct), "alias_key", "left")
           .select("raw", "alias_key", F.col("__m.id").alias("id"),
                   F.col("__m.method").alias("method")))
    rest = hit.filter(F.col("id").isNull()).select("raw")
    if fallback == "contains":
        fb = contains_match(rest, "raw", dim, dim_text, dim_id, dim_order, "fb_id")
    else:
        fb = token_overlap_match(rest, "raw", dim, dim_text, dim_id, dim_order,
                                 min_overlap, "fb_id").drop("shared_tokens")
    out = (hit.join(fb, "raw", "left")
           .select("raw", "alias_key",
                   F.coalesce("id", "fb_id").alias("id"),
                   F.when(F.col("id").isNotNull(), F.col("method"))
                   .when(F.col("fb_id").isNotNull(), F.lit(fallback)).alias("method")))
    alias_map = out.filter(F.col("id").isNotNull())
    unmapped = out.filter(F.col("id").isNull()).select("raw", "alias_key")
    return alias_map, unmapped
