"""Document fingerprints in SQL functions only: SimHash and its search.

Every word of a text votes with its 64-bit hash: its weight goes to each bit
that is set, against each that is not. A word weighs as much as it is long,
``WEIGHT`` at most, so that the short words all texts share decide little.
A bit of the fingerprint is 1 if the votes for it outweigh those against it.
Four of the 64 sums share one long, in lanes of 16 bits: sixteen sums are
kept for a piece of ``PIECE`` words, whose votes cannot overflow a lane nor
reach the long's sign, and are added up by document. Words of a document are
summed before they move.

Search. ``BLOCKS`` blocks of bits make permuted tables: in each, another
choice of ``BLOCKS`` - radius blocks leads and is the key. Fingerprints that
differ in ``radius`` bits or fewer agree in one key at least and are found by
equality and verified; a pair is reported by the first table that has it.

Nulls: a null text is an empty one, with fingerprint 0; a null doc_id comes
after all others. Repeated rows are documents of their own, which follow one
another. An empty table gives no rows; the only document is its own next.
Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.operators.ranges import RANGE, with_range

WEIGHT = 15
#: Words of a piece. Its votes stay under 2^15: the top lane ends in the long's
#: sign, and a sum that reaches it is an overflow, which ends the query.
PIECE = 2048
BLOCKS = 6
#: Documents that are put in order by one task at most, about.
BUCKET_ROWS = 2000
#: Beyond so many buckets they grow instead; a bucket is sorted with spilling.
MAX_BUCKETS = 4096

_SPACE = r"[ \t\n\x0B\f\r]+"
_LANES = 0x0001000100010001


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def weighted_votes(texts: DataFrame, keys: list[str], text: str, carry: dict[str, Column]) -> DataFrame:
    """(keys, carry, fp) of ``texts``, one row for each value of the long
    columns ``keys``; ``carry`` are numeric values that depend on the keys."""
    words = F.array_remove(F.split(F.col(text), _SPACE), "")
    w = texts.select(*keys, *[c.alias(k) for k, c in carry.items()], words.alias("__w"))
    w = w.select(*keys, *carry, F.posexplode_outer("__w").alias("__at", "__word"))
    weight = F.least(F.length(F.coalesce("__word", F.lit(""))), F.lit(WEIGHT)).cast("long")
    w = w.select(*keys, *carry, F.floor(F.col("__at") / PIECE).alias("__piece"), weight.alias("__n"),
                 F.xxhash64("__word").alias("__h"))
    lanes = [F.sum(F.shiftrightunsigned("__h", i).bitwiseAND(F.lit(_LANES)) * F.col("__n")).alias(f"__s{i}")
             for i in range(16)]
    piece = w.groupBy(*keys, "__piece").agg(F.sum("__n").alias("__n"), *lanes, *[F.max(k).alias(k) for k in carry])
    low = F.lit(0xFFFF)
    sums = [F.sum(F.shiftrightunsigned(f"__s{b % 16}", b // 16 * 16).bitwiseAND(low)).alias(f"__b{b}") for b in range(64)]
    total = piece.groupBy(*keys).agg(F.sum("__n").alias("__n"), *sums, *[F.max(k).alias(k) for k in carry])
    bits = [F.when(2 * F.col(f"__b{b}") > F.col("__n"), F.lit(_signed(1 << b))).otherwise(F.lit(0).cast("long"))
            for b in range(64)]
    # an expression tree of little depth: pairs, then pairs of pairs
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return total.select(*keys, *carry, bits[0].alias("fp"))


def in_order(docs: DataFrame) -> DataFrame:
    """(bucket, at, extra, doc_id, text, next): documents by descending
    doc_id, numbered in their bucket of neighbouring ids, each with the text
    of the next; after the last comes the first. Buckets are ranges of (doc_id,
    text hash) with bounds from the data, so clustered, outlying, equal or null
    ids share out like others. Extra rows repeat the first
    document of the bucket that comes next, for what is compared with it."""
    d = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = min(MAX_BUCKETS, max(1, -(-d.count() // BUCKET_ROWS)))
    d = d.withColumn("__h", F.xxhash64("text"))
    d = with_range(d, ["doc_id", "__h"], n).withColumn("bucket", F.col(RANGE).cast("long")).drop(RANGE)
    # one row a bucket
    tops = d.groupBy("bucket").agg(F.max(F.struct("doc_id", "__h")).alias("top"))
    up = Window.orderBy("bucket")
    to = F.coalesce(F.lead("bucket").over(up),
                    F.min("bucket").over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    tops = tops.select(F.col("bucket").alias("__from"), F.col("top.doc_id").alias("__top"), F.col("top.__h").alias("__top_h"),
                       to.alias("__to"))
    tops = F.broadcast(tops)  # at most MAX_BUCKETS rows: the texts need not move to meet them
    at_top = d["doc_id"].eqNullSafe(tops["__top"]) & (d["__h"] == tops["__top_h"]) & (d["bucket"] == tops["__from"])
    # repeated rows at the top have one text
    firsts = (d.join(tops, at_top).groupBy(F.col("__to").alias("bucket"), "doc_id", "__h").agg(F.first("text").alias("text"))
              .select("doc_id", "text", "__h", "bucket", F.lit(True).alias("extra")))
    rows = d.select("doc_id", "text", "__h", "bucket", F.lit(False).alias("extra")).unionByName(firsts)
    w = Window.partitionBy("bucket").orderBy("extra", F.desc_nulls_last("doc_id"), F.desc("__h"))
    return rows.select("bucket", F.row_number().over(w).cast("long").alias("at"), "extra", "doc_id", "text",
                       F.lead("text").over(w).alias("next"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp): a text, the
    text whose last half is replaced by the beginning of the next one, and
    the next one."""
    r = in_order(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    r = r.select("bucket", "at", "extra", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = r.select("bucket", "at", "extra", "doc_id", "n_chars", F.sha2("edited", 256).alias("sha"),
                    F.posexplode(F.array("text", "edited")).alias("kind", "t")).where("not extra or kind = 0")
    # the digest travels as four numbers, so that the sums stay of fixed size
    carry = {"extra": F.col("extra").cast("int"), "doc_id": F.col("doc_id"), "n_chars": F.col("n_chars")}
    carry |= {f"sha{k}": F.conv(F.substring("sha", 16 * k + 1, 16), 16, -10).cast("long") for k in range(4)}
    votes = weighted_votes(both.withColumn("kind", F.col("kind").cast("long")), ["bucket", "at", "kind"], "t", carry)
    own = F.max(F.when(F.col("kind") == 0, F.col("fp")))
    rows = votes.groupBy("bucket", "at").agg(*[F.max(k).alias(k) for k in carry], own.alias("fp"),
                                             F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    rows = rows.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("bucket").orderBy("at"))).where("extra = 0")
    sha = F.concat(*[F.lpad(F.lower(F.hex(f"sha{k}")), 16, "0") for k in range(4)])
    return rows.select("doc_id", "n_chars", sha.alias("edited_sha256"), "fp", "edited_fp", "next_fp")


def likeness(a: str, b: str) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / 64


def _tables(radius: int) -> list[tuple[int, list[int], list[int]]]:
    """(mask, blocks of the key, blocks before its last that are not in it)."""
    edges = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    out = []
    for chosen in combinations(range(BLOCKS), BLOCKS - radius):
        skipped = [masks[k] for k in range(chosen[-1]) if k not in chosen]
        out.append((sum(masks[k] for k in chosen), skipped))
    return out


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = 3) -> DataFrame:
    """(q, fp) of every distinct fingerprint q of ``queries`` and every
    distinct one of ``fps`` (column fp each) that differ in at most
    ``radius`` < ``BLOCKS`` bits."""
    tables = _tables(radius)
    masks = F.array(*[F.lit(_signed(m)) for m, _ in tables])

    def indexed(df, name):
        d = df.select(F.col("fp").alias(name)).where(F.col(name).isNotNull()).distinct()
        d = d.select(name, F.posexplode(masks).alias("t", "mask"))
        return d.select(name, "t", F.col(name).bitwiseAND(F.col("mask")).alias("key"))

    # a side is taken for as small as it was before its rows were multiplied, so
    # it would be broadcast: neither is to meet in one memory
    q, f = indexed(queries, "q"), indexed(fps, "fp").hint("merge")
    x = F.col("q").bitwiseXOR(F.col("fp"))
    first = F.lit(True)  # no earlier table has the pair: every block left out so far differs
    for t, (_, skipped) in enumerate(tables):
        for m in skipped:
            first = first & ((F.col("f.t") != t) | (x.bitwiseAND(F.lit(_signed(m))) != 0))
    near = F.bit_count(x) <= radius
    return (q.alias("q_").join(f.alias("f"), (F.col("q_.t") == F.col("f.t")) & (F.col("q_.key") == F.col("f.key")) & near & first)
            .select("q", "fp"))


def fingerprints(docs: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """``edited_fingerprints`` with likenesses, and for ids that ``every``
    divides ``n_near``: how many other documents' fingerprints are within
    ``radius`` bits (null for the rest)."""
    rows = edited_fingerprints(docs).checkpoint()
    asks = F.col("doc_id") % every == 0
    counted = rows.groupBy("fp").agg(F.count("*").alias("n"))
    found = (within_radius(rows.where(asks), rows, radius).join(counted, "fp")
             .groupBy("q").agg(F.sum("n").alias("__near")))
    return (rows.join(found, rows["fp"] == found["q"], "left")
            .select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp",
                    likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"),
                    F.when(asks, F.col("__near") - 1).alias("n_near")))
