"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.session import checkpoint_dir

#: A side of at most this many estimated bytes may be broadcast.
BROADCAST_BYTES = 32 << 20
#: Bytes of an Arrow batch, about.
BATCH_BYTES = 4 << 20
#: What a Python worker keeps between tasks, by name.
_KEPT: dict = {}


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by ``BATCH_BYTES``, unless the session does: ten
    thousand texts, the usual bound, lie several times over in the memory of
    the JVM and of its Python workers, which both keep it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | F.Column = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 5 (null id: as the empty string)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and reread it: the lineage is cut
    and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_table(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``scratch_table``, in as many buckets of ``key`` as the session
    shuffles to: joins on ``key`` read it where it lies, without an exchange."""
    spark = df.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).option("path", path).format("parquet").saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: the files lie in the shared folder
    return found


def bounded_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast ``df`` if ``rows`` (counted by the caller) times
    ``row_bytes`` stays small; otherwise leave the join to shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def with_columns(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` followed by ``extra`` columns."""
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *extra.values()], names=[*batch.schema.names, *extra])


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it (case-insensitively)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept(name, make):
    """What ``make()`` gives, kept by the Python worker for its next tasks."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def drop_kept(*names) -> None:
    """Forget all that is ``kept`` but ``names``."""
    for name in _KEPT.keys() - set(names):
        del _KEPT[name]


def release_memory() -> None:
    """Give freed memory back to the system: Arrow's pool and the C library
    keep it otherwise, for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def in_worker(run, *names):
    """``run`` for mapInArrow. Python workers live on from job to job, so
    what other operators ``kept`` goes before, freed memory afterwards."""
    def task(batches):
        drop_kept(*names)
        try:
            yield from run(batches)
        finally:
            release_memory()
    return task


def on_group(run):
    """``run`` for applyInArrow, likewise."""
    def task(table: pa.Table) -> pa.Table:
        drop_kept()
        try:
            return run(table)
        finally:
            release_memory()
    return task
