"""Alias resolution by levels of precedence.

A level is a frame (alias_key, id, priority) of keys that it claims for ids.
The levels are one tagged union; one chain of aggregates keeps, for each key,
the first level that claims it, the id of least (priority, id) there, and how
many ids claim it, so collisions cost no pass of their own. Only strings that
no level claims go to a fallback. The map has a row for every observed string,
unmapped ones included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_key
from .combine import with_scalars
from .lookup import maybe_broadcast

UNMAPPED = "unmapped"
#: Unmapped strings that a coverage report shows, the first in their order.
SAMPLE = 8


def exact_keys(dim: DataFrame, text: str, id_col: str, priority=None) -> DataFrame:
    """A level of the canonical texts themselves."""
    return dim.select(norm_key(text).alias("alias_key"), F.col(id_col).alias("id"),
                      (F.lit(0) if priority is None else F.col(priority)).alias("priority"))


def claims(levels: dict[str, DataFrame]) -> DataFrame:
    """(alias_key, id, n_ids, method): for each key the first level that
    claims it. Ids of a key are counted after a partial aggregate on (key,
    id), so a key claimed by very many ids stays spread."""
    tagged = None
    for rank, (method, keys) in enumerate(levels.items()):
        k = keys.select("alias_key", "id", "priority", F.lit(rank).alias("rank"), F.lit(method).alias("method"))
        tagged = k if tagged is None else tagged.unionByName(k)
    return (tagged.where("alias_key != '' AND id IS NOT NULL")
            .groupBy("alias_key", "rank", "method", "id").agg(F.min("priority").alias("priority"))
            .groupBy("alias_key", "rank", "method")
            .agg(F.min_by("id", F.struct("priority", "id")).alias("id"), F.count("*").alias("n_ids"))
            .groupBy("alias_key").agg(F.min_by(F.struct("id", "n_ids", "method"), "rank").alias("m"))
            .select("alias_key", "m.id", "m.n_ids", "m.method"))


def resolve(observed: DataFrame, col: str, levels: dict[str, DataFrame],
            fallback: tuple[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """(raw, alias_key, id, method, n_ids) for every distinct non-null string.

    ``fallback`` is (method, function): the function takes the frame (raw) of
    strings that no level claims and returns (raw, id) for those it maps.
    ``n_ids`` is 1 for those and 0 for unmapped strings, whose id is null."""
    raw = (observed.select(F.col(col).alias("raw")).where("raw IS NOT NULL").distinct()
           .withColumn("alias_key", norm_key("raw")))
    hit = raw.join(maybe_broadcast(claims(levels)), "alias_key", "left")
    none = F.lit(0).cast("bigint")
    if fallback is None:
        return hit.select("raw", "alias_key", "id", F.coalesce("method", F.lit(UNMAPPED)).alias("method"),
                          F.coalesce("n_ids", none).alias("n_ids"))
    name, match = fallback
    found = match(hit.where("id IS NULL").select("raw")).select("raw", F.col("id").alias("other"))
    late = F.col("other").isNotNull()
    return (hit.join(found, "raw", "left")
            .select("raw", "alias_key", F.coalesce("id", "other").alias("id"),
                    F.coalesce("method", F.when(late, name), F.lit(UNMAPPED)).alias("method"),
                    F.coalesce("n_ids", F.when(late, F.lit(1).cast("bigint")), none).alias("n_ids")))


def coverage(amap: DataFrame, name: str, k: int = SAMPLE) -> DataFrame:
    """Q9: one row (map_name, observed, mapped, unmapped, collisions,
    unmapped_sample) for a map of :func:`resolve`; the sample is the first
    ``k`` unmapped strings, joined by `` | ``."""
    open_ = F.col("method") == UNMAPPED
    counts = amap.agg(F.count("*").alias("observed"), F.count_if(~open_).alias("mapped"),
                      F.count_if(open_).alias("unmapped"), F.count_if(F.col("n_ids") > 1).alias("collisions"))
    first = amap.where(open_).select("raw").orderBy("raw").limit(k)
    sample = first.agg(F.array_join(F.array_sort(F.collect_list("raw")), " | ").alias("unmapped_sample"))
    return with_scalars(counts, sample).select(F.lit(name).alias("map_name"), "*")
