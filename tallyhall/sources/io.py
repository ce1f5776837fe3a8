"""Raw sources, staged tables and report sinks.

Raw CSV is read with an explicit all-string schema (no inference pass), the
lineage columns ``_source_file`` and ``_raw_row`` are derived on the
executors, and every sink is a distributed write: nothing is collected.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.text import trim_ws
from ..operators.clean import drop_blank_columns, drop_blank_rows, parse_dates, parse_numbers, trim_all
from ..operators.lookup import BROADCAST_BYTES

# Text tokens read as missing (pandas' default NA strings).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


_AT = ["__path", "__blk"]


def header_names(line: str) -> list[str]:
    """Column names of a header line: trimmed, ``column_<n>`` where blank, a
    repeated name with the number of its earlier uses."""
    names: list[str] = []
    uses: dict[str, int] = {}
    for i, text in enumerate(next(csv.reader([line])), start=1):
        name = text.strip() or f"column_{i}"
        uses[name] = uses.get(name, 0) + 1
        names.append(name if uses[name] == 1 else f"{name}.{uses[name] - 1}")
    return names


def raw_index(lines: DataFrame) -> DataFrame:
    """One row for each split of the files: its position in the tasks
    (``__first``), the lines of its file before it (``__off``) and the file's
    header line, which its first split begins with."""
    splits = lines.groupBy(*_AT).agg(F.min("__mid").alias("__first"), F.count("*").alias("__n"),
                                     F.min_by("value", "__mid").alias("__line"))
    file = Window.partitionBy("__path").orderBy("__blk")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(*_AT, "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                         F.first("__line").over(file).alias("__header"))


def read_raw(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
             na_tokens=NA_TOKENS, multiline: bool = False) -> DataFrame:
    """Raw CSV, every column text, NA tokens -> null, plus lineage.

    Files may have different headers: a column is matched by its name in each
    file's own header, never by its place, and is null where a file lacks it.
    The columns are those of all headers, in the order in which they are first
    named. ``columns`` replaces every header by these names, by place. The
    driver sees the distinct header lines: as many as there are layouts.

    ``_raw_row`` is the 1-based row of the file, blank lines left out (header =
    1, first data row = 2). It comes from the full path of the file and from
    the split in which a line stands, so files of one name do not mix and a
    file may be split across many tasks. Lines are indexed as text; the small
    index, one row a split, is broadcast if its counted size is within the
    bound for it. ``multiline=True`` keeps quoted newlines (then a file is read
    unsplit); a header itself is one line. No file, or only empty ones: no rows.
    """
    at = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__blk"),
          F.col("_metadata.file_name").alias("_source_file")]
    lines = (spark.read.text(path).where(F.trim("value") != "")
             .select("value", *at, F.monotonically_increasing_id().alias("__mid")))
    index = raw_index(lines)
    layouts = (index.groupBy("__header").agg(F.min("__path").alias("at"), F.sum(F.length("__path") + 64).alias("size"))
               .orderBy("at").collect())
    named = {r["__header"]: list(columns) if columns else header_names(r["__header"]) for r in layouts}
    cols = list(columns) if columns else list(dict.fromkeys(n for names in named.values() for n in names))
    if not layouts:
        fields = [StructField(c, StringType()) for c in [*cols, "_source_file"]]
        return spark.createDataFrame([], StructType([*fields, StructField("_raw_row", LongType())]))
    width = max(map(len, named.values()))
    # where each column stands in the file's own lines, null where it does not
    place = F.create_map(*[F.lit(x) for header, names in named.items()
                           for x in (header, ",".join(str(names.index(c)) if c in names else "" for c in cols))])
    index = index.select(*_AT, "__first", "__off", F.transform(
        F.split(F.element_at(place, F.col("__header")), ",", -1), lambda x: F.nullif(x, F.lit("")).cast("int")).alias("__place"))
    small = sum(r["size"] for r in layouts) + 8 * len(cols) * len(layouts) <= BROADCAST_BYTES
    record = StructType([StructField(f"c{i}", StringType()) for i in range(width)])
    if multiline:
        rows = (spark.read.schema(record).option("multiLine", True).csv(path)
                .select(F.struct(*record.names).alias("__r"), *at, F.monotonically_increasing_id().alias("__mid")))
        # a file is one split here, with its own positions
        own = rows.groupBy("__path").agg(F.min("__mid").alias("__first"), F.lit(0).alias("__off"))
        index = own.join(index.groupBy("__path").agg(F.first("__place").alias("__place")), "__path")
    else:
        rows = lines.withColumn("__r", F.from_csv("value", record.simpleString()[7:-1].replace(":", " ")))
    keys = ["__path"] if multiline else _AT
    number = (F.col("__off") + F.col("__mid") - F.col("__first") + 1).cast("long")
    rows = rows.join(F.broadcast(index) if small else index, keys).withColumn("_raw_row", number).where("_raw_row > 1")
    if len(named) == 1:
        at_place = {c: F.col(f"__r.c{named[layouts[0]['__header']].index(c)}") for c in cols}
    else:
        rows = rows.withColumn("__f", F.array(*[f"__r.{c}" for c in record.names]))
        at_place = {c: F.get("__f", F.get("__place", F.lit(k))) for k, c in enumerate(cols)}
    tokens = list(na_tokens)
    return rows.select(*[F.when(~trim_ws(x).isin(tokens), x).alias(c) for c, x in at_place.items()],
                       "_source_file", "_raw_row")


@dataclass
class SourceJob:
    """One declared source."""
    name: str
    path: str
    date_cols: list = field(default_factory=list)
    num_cols: list = field(default_factory=list)


def stage(df: DataFrame, job: SourceJob, drop_empty_columns: bool = True) -> DataFrame:
    """Typed staging: drop blank rows (and, for real, blank columns), trim
    text, parse dates and numbers."""
    df = drop_blank_rows(df)
    if drop_empty_columns:
        df = drop_blank_columns(df)
    df = trim_all(df, [c for c in df.columns if not c.startswith("_")])
    df = parse_dates(df, [c for c in job.date_cols if c in df.columns])
    return parse_numbers(df, [c for c in job.num_cols if c in df.columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) and len(fs.globStatus(p)) > 0


def ingest(spark: SparkSession, jobs: list[SourceJob], out_dir: str | None = None) -> dict:
    """Stage every declared source that exists; optionally write each to
    ``out_dir/<name>`` as parquet. Returns {name: DataFrame}."""
    out = {}
    for job in jobs:
        if not path_exists(spark, job.path):
            continue
        df = stage(read_raw(spark, job.path), job)
        if out_dir:
            write_table(df, f"{out_dir}/{job.name}")
            df = read_table(spark, f"{out_dir}/{job.name}")
        out[job.name] = df
    return out


def write_table(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """S3: parquet sink (optionally partitioned, e.g. by month of date_id)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: parquet scan (column pruning and filter pushdown by Catalyst)."""
    return spark.read.parquet(path)


def load_table(df: DataFrame, schema: StructType, renames: dict | None = None,
               defaults: dict | None = None) -> DataFrame:
    """Project to a declared schema *by name* (never by position): rename,
    cast, fill defaulted columns, drop extras."""
    renames = renames or {}
    defaults = defaults or {}
    src = {renames.get(c, c): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if f.name in src:
            cols.append(F.col(f"`{src[f.name]}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def with_month_partition(df: DataFrame, date_key: str = "date_id") -> DataFrame:
    """Facts on disk are partitioned by month of their yyyymmdd key."""
    return df.withColumn("month_key", (F.col(date_key) / 100).cast("int"))


def load_partitions(df: DataFrame, path: str, partition: str, measure: str) -> DataFrame:
    """Idempotent load. Only the partitions that ``df`` has are replaced
    (a rerun of one month touches that month), in one write; returns their
    manifest (partition, rows, total), read back from what was written."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    touched = df.select(F.col(partition).alias("__p")).distinct()
    return (df.sparkSession.read.parquet(path).join(touched, F.col(partition) == F.col("__p"), "left_semi")
            .groupBy(F.col(partition).cast("int").alias("partition")).agg(F.count("*").alias("rows"), F.sum(measure).alias("total")))


def load_csv_table(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, int]:
    """CSV with a declared schema and its row count."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df, df.count()


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Register named frames as temp views and run SQL over them."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def write_report(df: DataFrame, path: str) -> None:
    """JSON report sink (one file for a small result)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def publish(df: DataFrame, root: str, name: str) -> None:
    """Replace a named published dataset; null text -> empty string."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    df.na.fill("", subset=text).write.mode("overwrite").json(f"{root}/{name}")


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read a published dataset back as records."""
    return spark.read.json(f"{root}/{name}")


def cleansing_log(rule_counts: DataFrame, order: str = "rule_order") -> DataFrame:
    """Sequential ``log_id`` over the rule order of a (small) rule table."""
    w = Window.orderBy(order)
    return rule_counts.withColumn("log_id", F.row_number().over(w))


class RunLog:
    """Batch-run log from ``DataFrame.observe`` metrics (no extra job)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.rows: list[tuple] = []

    def track(self, df: DataFrame, stage_name: str) -> tuple[DataFrame, Observation]:
        obs = Observation(stage_name)
        return df.observe(obs, F.count(F.lit(1)).alias("rows_out")), obs

    def record(self, stage_name: str, obs: Observation, rows_in: int | None = None,
               status: str = "ok") -> None:
        self.rows.append((stage_name, rows_in, int(obs.get.get("rows_out", 0)), status))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(
            self.rows, "stage string, rows_in long, rows_out long, status string")


def seed_dim(spark: SparkSession, names: list[str], id_prefix: str, width: int,
             name_col: str = "name", id_col: str = "id", start: int = 1) -> DataFrame:
    """Small dimension from constants with generated ids (``P001``...)."""
    rows = [(f"{id_prefix}{i:0{width}d}", n) for i, n in enumerate(names, start=start)]
    return spark.createDataFrame(rows, f"{id_col} string, {name_col} string")
