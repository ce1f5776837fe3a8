"""Session construction and lineage cutting.

Cluster settings (checkpoint folder, shuffle partitions) are read from the
session; defaults are only filled in where the session leaves them unset,
as in local tests.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces partitions
# at runtime; skew-join splitting handles a key that holds a third of a table.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A method of over 8000 bytes of code is never compiled by the JVM: the wide
    # cleaning projections then run interpreted, so they are split up instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python call-site capture for error messages costs several JVM round
    # trips per column function while plans are built; off for batch jobs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tallyhall",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a configured one if needed."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL settings that are safe to set on a live session."""
    for k, v in DEFAULT_CONF.items():
        if (k.startswith("spark.sql.") or k.startswith("spark.python.sql.")) \
                and k != "spark.sql.session.timeZone":
            try:
                if spark.conf.get(k, None) is None:
                    spark.conf.set(k, v)
            except Exception:  # static conf on a shared session
                pass
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: functions
    that run in Python workers import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="tallyhall-zip-"), "tallyhall")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session leaves it unset (local tests) is a fresh scratch
    folder created and registered; on a cluster an unset folder is an error,
    as executors do not share a machine's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="tallyhall-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    The eager form persists first: the checkpoint write is a second job over
    the same data, and without the cached blocks it would recompute it. The
    cache is released once the files are written; readers use the files."""
    checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(eager=False)
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist(blocking=False)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: a stage
    boundary for rows that several later steps read."""
    path = os.path.join(checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries made and run inside delete the files of their shuffles as they
    end; otherwise those stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
