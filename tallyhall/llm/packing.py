"""Best-fit packing of token sequences by minimum bin slack.

Lengths are at most ``capacity``, so the histogram of lengths has at most
``capacity`` rows whatever the corpus holds. The packing is planned on that
histogram: the longest length left opens a bin, a bitset subset-sum dynamic
programme over the lengths still available finds the fullest combination for
the rest of the bin, and the combination is removed as often as the counts
allow. Pieces are then numbered within their length by Spark and take their
place from the plan, so no task sees more than its share of the rows.

Nulls: a null text is an empty one; a null id is kept. Empty texts give one
piece that holds the end id. Repeated rows are packed as often as they occur.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import in_worker, scratch_table, texts
from tallyhall.llm.tokens import encoder

#: Rows of one numbering task at most, about.
BUCKET_ROWS = 50_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048,
                    end_id: int = 0) -> DataFrame:
    """Token sequences of whole texts, ``end_id`` added, cut every
    ``capacity`` ids: (doc_id, piece, start, length, ids_crc32)."""
    end = np.array([end_id], "<i4").tobytes()
    step = 4 * capacity

    def run(batches):
        enc = encoder(tokenizer)
        for b in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts(b)):
                data = enc.encode(text) + end
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    ids.append(doc_id)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(in_worker(run, tokenizer), PIECES)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination that holds the longest length left."""
    lengths = sorted(counts, reverse=True)
    first = lengths[0]
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        left = min(counts[length] - (length == first), room // length)
        take = 1
        while left > 0 and not reach >> room:
            n = min(take, left)
            steps.append((length, n, reach))
            reach |= reach << (n * length) & mask
            left -= n
            take *= 2
        if reach >> room:
            break
    target = reach.bit_length() - 1
    chosen = {first: 1}
    for length, n, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + n
            target -= n * length
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(bins, {length: pieces in each of these bins})] that uses up ``counts``."""
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    if left and (max(left) > capacity or min(left) < 1):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = []
    while left:
        chosen = fullest(left, capacity)
        bins = min(left[k] // n for k, n in chosen.items())
        plan.append((bins, chosen))
        for k, n in chosen.items():
            left[k] -= bins * n
            if not left[k]:
                del left[k]
    return plan


def _segments(plan) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces a bin, offset in the bin),
    by length and first rank. Bounded by the lengths and the plan's patterns."""
    rows, used, bin0 = [], {}, 0
    for bins, chosen in plan:
        offset = 0
        for length, n in chosen.items():
            rows.append((length, used.get(length, 0), bin0, n, offset))
            used[length] = used.get(length, 0) + bins * n
            offset += n * length
        bin0 += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``__rank``, 0, 1, ... within each length. A length that a third of
    all rows have is numbered in buckets, whose first ranks come from counts."""
    buckets = max(16, -(-rows // BUCKET_ROWS))
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    p = pieces.withColumn("__bucket", key)
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (p.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
             .select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")))
    w = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (p.withColumn("__at", F.row_number().over(w) - 1)
            .join(first, ["length", "__bucket"])
            .withColumn("__rank", F.col("__at") + F.col("__first")))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to (doc_id, piece, start, length,
    ids_crc32): pieces of a sequence follow one another without gaps and fill
    at most ``capacity``."""
    spark = pieces.sparkSession
    pieces = scratch_table(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    schema = PIECES + ", sequence_id bigint, offset bigint"
    if not counts:
        return spark.createDataFrame([], schema)
    seg = _segments(minimum_bin_slack(counts, capacity))
    key = (seg[:, 0] << 48) + seg[:, 1]

    def place(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "__rank"))
            s = seg[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(s[:, 2] + k // s[:, 3], pa.int64()),
                 pa.array(s[:, 4] + k % s[:, 3] * length, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranks = ranked(pieces, sum(counts.values()))
    return ranks.select("doc_id", "piece", "start", "length", "ids_crc32",
                        F.col("__rank").cast("bigint").alias("__rank")).mapInArrow(place, schema)
