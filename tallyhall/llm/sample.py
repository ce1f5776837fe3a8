"""A bounded sample of labelled documents, for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str,
                    max_docs: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(text, label) of at most ``max_docs`` training documents.

    Training rows are those whose ``fold`` is not 0. The sample is the rows
    with the smallest hash of the id, so it does not depend on the order or
    the partitioning of the input. An id that is labelled several times
    takes its largest label; null ids and null labels are not used. The ids
    (at most ``max_docs`` longs) are small by that bound and are broadcast.
    An id that several documents have gives one row, the text of the least
    hash (then the least ``n_chars``), taken in every task before rows move:
    no more than ``max_docs`` rows are returned, whatever a hot id has.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 0))
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
           .orderBy(F.xxhash64("__id"), "__id").limit(max_docs))
    kept = [c for c in docs.columns if c in (text_col, "n_chars")]
    found = docs.select(F.col(id_col).alias("__id"), *kept).join(F.broadcast(ids), "__id")
    order = F.struct(F.xxhash64(text_col), *[c for c in kept if c != text_col])
    return (found.groupBy("__id", "__label").agg(F.min_by(F.struct(*kept), order).alias("__d"))
            .select("__id", *[f"__d.{c}" for c in kept], "__label"))
