"""Near-duplicates by SimHash and deletion-variant signatures.

A fingerprint has 64 bits: bit i is 1 if it is set in more than half of the
XXH64 hashes (seed 42) of the text's word shingles. Two fingerprints are
linked if they differ in at most ``DISTANCE`` = 3 bits.

Search. The fingerprint is cut into two segments of 32 bits. Of three
differing bits, one segment has at most one, so linked fingerprints share,
in one segment, the variant that leaves out one bit. All 64 variants of a
distinct fingerprint are indexed and joined by equality, and what meets is
verified. A variant that only two fingerprints share is an edge already; up to ``BUCKET``
are linked among themselves by as many edges as connect them. Fingerprints
of fuller variants take an exact other way, linear in their number: they are
indexed under every pair (one bit flipped, another left out). Two
fingerprints have such a key in common just if they differ in three bits or
fewer, so all that share a key are linked to the least of them without
comparing pairs.

Nulls: a null text is an empty one; texts without words have fingerprint 0
and are linked like any other. A null id is kept, and is not the smallest id
of a component unless all are null. Repeated rows are linked. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import free_name, in_worker, scratch_table, texts, with_columns
from tallyhall.llm.components import connected_components

DISTANCE = 3
#: Fingerprints that one variant may hold to be compared with one another.
BUCKET = 512
_LOW32 = (1 << 32) - 1


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the uint64 ``hashes`` have each bit set."""
    planes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 2000:
        return np.unpackbits(planes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    return np.concatenate([np.bincount(planes[:, k], minlength=256) @ bits for k in range(8)])


_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def simhash(text: str, shingle: int = 3) -> int:
    """Unsigned fingerprint of a text; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    h64 = xxhash.xxh64_intdigest
    hashes = np.fromiter([h64(g, 42) for g in grams], np.uint64)
    return int(_POWERS[bit_votes(hashes) * 2 > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, name: str = "fp", text_col: str = "text", shingle: int = 3,
                 keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: doc_id) and the fingerprint
    as a signed long. Copies that stand together are hashed once."""
    from pyspark.sql.types import LongType, StructField, StructType
    keep = ["doc_id"] if keep is None else keep
    out = StructType([*(docs.schema[c] for c in keep), StructField(name, LongType())])
    text = free_name(keep, "__text")

    def run(batches):
        for b in batches:
            known: dict[str, int] = {}
            fp = []
            for t in texts(b, text):
                if t not in known:
                    known[t] = simhash(t, shingle)
                fp.append(known[t])
            yield with_columns(b.select(keep), {name: pa.array(np.array(fp, np.uint64).view(np.int64), pa.int64())})

    return docs.select(*keep, F.col(text_col).cast("string").alias(text)).mapInArrow(in_worker(run), out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(fps: DataFrame) -> DataFrame:
    """(v, key, fp): bit v is left out of its segment; the other segment's
    bits are not part of the key."""
    masks = [_signed((_LOW32 << 32 * (v // 32)) & ~(1 << v)) for v in range(64)]
    rows = F.posexplode(F.array(*map(F.lit, masks))).alias("v", "mask")
    return fps.select("fp", rows).select(F.col("v").cast("tinyint").alias("v"),
                                         F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _spanning(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges between fingerprints at most ``distance`` apart, as many as it
    takes to connect those that such links connect."""
    left = fp
    edges = []
    while len(left):
        reached, todo, left = [], [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= distance
            edges += [(int(at), int(x)) for x in left[near]]
            todo += list(left[near])
            left = left[~near]
            reached.append(at)
    return edges


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fps`` (column fp) that
    connect just those that links of at most ``distance`` <= 3 bits connect."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments and one left-out bit reach 3 bits")
    # 64 rows a fingerprint follow: a small table is spread out first
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = variants(fps.repartition(tasks))
    shared = (v.groupBy("v", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
              .where("n > 1").checkpoint())
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    twos = shared.where("n = 2").where(close).select("a", "b").distinct()

    few = (v.join(shared.where((F.col("n") > 2) & (F.col("n") <= BUCKET)).select("v", "key"), ["v", "key"])
           .groupBy("v", "key").agg(F.collect_list("fp").alias("fps")))  # at most BUCKET each

    def run(batches):
        for b in batches:
            found = set()
            for fps_ in b.column("fps").to_pylist():
                found.update(_spanning(np.sort(np.array(fps_, np.int64)), distance))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    some = few.select("fps").mapInArrow(in_worker(run), "a bigint, b bigint").distinct()
    return twos.union(some).union(_clique_links(v, shared, distance))


def _clique_links(v: DataFrame, shared: DataFrame, distance: int) -> DataFrame:
    """Edges among the fingerprints of variants fuller than ``BUCKET``."""
    full = shared.where(F.col("n") > BUCKET).select("v", "key")
    hot = v.join(full, ["v", "key"]).select("fp").distinct()
    bits = F.array(*[F.lit(_signed(1 << i)) for i in range(64)])
    none = F.array(F.lit(0).cast("bigint"))
    if distance == 0:
        return hot.where(F.lit(False)).select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    # distance 3: one bit flipped, one left out; 2: one bit flipped; 1: one left out
    flips = F.concat(none, bits) if distance >= 2 else none
    holes = bits if distance != 2 else none
    keys = (hot.repartition("fp").select("fp", F.explode(holes).alias("hole"))
            .select("fp", "hole", F.explode(flips).alias("flip"))
            .where("flip = 0 or flip <> hole")
            .select("hole", F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.bitwise_not(F.col("hole"))).alias("key"), "fp"))
    least = Window.partitionBy("hole", "key")
    return (keys.select(F.min("fp").over(least).alias("a"), F.col("fp").alias("b")).where("a <> b").distinct())


def classes(fp_rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable, for every distinct one."""
    fps = fp_rows.select("fp").distinct()
    found = connected_components(links(fps, distance))
    return (fps.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left")
            .select("fp", F.coalesce("component", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row: ``component_id`` is the
    smallest doc_id that links of at most ``distance`` bits reach."""
    rows = scratch_table(fingerprints(docs, shingle=shingle), "fingerprints")
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = classes(rows, distance).join(first, "fp")
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch_table(roots.join(ids, "root").select("fp", "component_id"), "classes")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with
    the smallest doc_id (null last), then the smallest text hash; of rows
    that agree in both, one."""
    n = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                 F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("hash"))
    marked = free_name(docs.columns, "__row")
    fp = free_name(docs.columns, "fp")
    ids = docs.select(n.alias(marked), "text")
    rows = scratch_table(fingerprints(ids, "fp", "text", shingle, keep=[marked]), "fingerprints")
    rows = rows.select(F.col(marked).alias("row"), "fp")
    first = rows.groupBy("fp").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    roots = classes(rows, distance).join(first, "fp")
    best = roots.groupBy("root").agg(F.min("row").alias("row"))
    # how often the best row occurs: only then are equal rows to be told apart
    chosen = scratch_table(best.join(rows.groupBy("row").agg(F.count("*").alias("times")), "row").select("row", "times"),
                           "kept-rows")
    out = docs.withColumn(marked, n).join(
        chosen.select(F.col("row").alias(marked), F.col("times").alias(fp)), marked)
    once = out.where(F.col(fp) == 1)
    again = out.where(F.col(fp) > 1).dropDuplicates([marked])
    return once.unionByName(again).select(*docs.columns)
