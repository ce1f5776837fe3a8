"""The training-data pipeline: toxicity, quality, near-duplicates, repeated
passages, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
it kept, and is written to the cluster's shared folder before the next reads
it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.llm import neardup, packing, passages, quality, toxicity
from tallyhall.llm.common import free_name, read_table, scratch_table, small_batches
from tallyhall.llm.tokens import public_path


def stage(fn):
    """A stage, in small batches: workers go from one to the next."""
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, docs, sf_dir)
    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    name = free_name(docs.columns, "score")
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).drop(name)


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    name = free_name(docs.columns, "score")
    return quality.score(docs, model, name).where(F.col(name) >= 0.3).drop(name)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep_first(docs, shingle=3, distance=3)


@stage
def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each repeated passage in its first document only."""
    return passages.remove_passages(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids."""
    return packing.pack(packing.document_pieces(docs, public_path("word_bpe_49k.json"), 2048, 0), 2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_passages),
    ("best-fit packing", pack_sequences),
]

#: Trained models and alignments have no SQL form; the tests check the stages'
#: columns, counts and bounds, and each operator by itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch_table(docs, f"stage-{k}")
    return docs
