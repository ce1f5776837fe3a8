"""Ranked lexical search: exact inner products by sparse ball trees.

A document is a sparse vector: for a term, the whole number ``(10^9 tf) div
(1000 tf + 20 m)``, where m grows with the document's length. An item's score
of a document is the sum of these over the item's terms, each times the
term's whole-number weight w. One pass over the texts keeps, of each
document, its length and the counts of the items' terms, and gives the
corpus statistics (over all documents). The vectors of a chunk of documents
make a ball tree: every node has the mean of its documents and the greatest
distance from it. With the weights split evenly between query and document
(a square root each), no document of a node scores more than

    <query, centre> + |query| * radius,

rounded up by more than all float operations can lose. Each item takes the
nodes best-first, and stops at the first bound below its k-th best score so
far; that is carried over from chunk to chunk of a task. Leaves are scored
in 64-bit whole numbers. Each task gives k rows an item at most, and a ranked
window merges them.

Items are taken in blocks of bounded size, each against all documents, so
neither side is ever broadcast or collected whole.

Nulls: a null text has no term; a null item_id is an item, a null doc_id
comes last among equal scores. Rows of one item_id are one item. Repeated
documents are documents. Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import scratch_table, texts

K = 50
#: Items' terms that are searched for at once, at most (an item more is taken
#: whole), and different ones among them.
BLOCK_TERMS = 1 << 16
#: Cells (documents x terms) of a chunk that makes a tree; documents of a leaf.
CHUNK_CELLS = 1 << 22
LEAF = 64

NO_ID = (1 << 63) - 1
#: The bytes of a term: ASCII letters in lower case, digits, and all that is
#: not ASCII; others separate.
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_BYTES).split(b" ")


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their different terms, in blocks of about ``BLOCK_TERMS``."""
    term = F.explode(F.array_distinct(F.regexp_extract_all(_low("text"), F.lit(TERM), F.lit(0))))
    each = (items.select(F.col("item_id").cast("bigint"), term.alias("term")).groupBy("item_id")
            .agg(F.sort_array(F.collect_set("term")).alias("terms")).orderBy(F.col("item_id").asc_nulls_first()))
    block, size = [], 0
    for r in each.toLocalIterator():
        if block and size + len(r["terms"]) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], [t.encode() for t in r["terms"]]))
        size += len(r["terms"])
    if block:
        yield block


#: The characters of a term, as a pattern.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _low(name: str):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(name).cast("string"), upper, upper.lower())


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(id, n, cols, tfs) of documents with a term: its number of terms, and
    which of the vocabulary (sorted) it holds how often."""
    def run(batches):
        at = {t: k for k, t in enumerate(vocabulary)}
        for b in batches:
            ids, ns, cols, tfs = [], [], [], []
            for doc_id, text in zip(b.column("id").to_pylist(), texts(b)):
                words = terms(text.encode("utf-8", "replace"))
                n = len(words) - words.count(b"")
                if n:
                    known = np.fromiter(filter(lambda k: k is not None, map(at.get, words)), np.int32)
                    col, tf = np.unique(known, return_counts=True)
                    ids.append(doc_id)
                    ns.append(n)
                    cols.append(col)
                    tfs.append(tf.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(cols, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["id", "n", "cols", "tfs"])

    d = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string"))
    return d.mapInArrow(run, "id bigint, n bigint, cols array<int>, tfs array<int>")


def statistics(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents, their terms, documents that hold each of the vocabulary)."""
    n, total = rows.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(size, np.int64)
    # one row a term of the block
    for r in rows.select(F.explode("cols").alias("c")).groupBy("c").agg(F.count("*").alias("n")).collect():
        df[r["c"]] = r["n"]
    return n, total or 0, df


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    m = 100 - 50 + (50 * length * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class BallTree:
    """Nodes over the rows of a dense matrix of non-negative numbers; the
    rows of a node are neighbours in ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.spans, self.children, centres, radii = [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            s, e, parent = todo.pop()
            here = points[self.order[s:e]]
            centre = here.mean(axis=0)
            away = np.sqrt(((here - centre) ** 2).sum(axis=1))
            node = len(self.spans)
            self.spans.append((s, e))
            self.children.append(())
            centres.append(centre)
            radii.append(away.max())
            if parent >= 0:
                self.children[parent] += (node,)
            if e - s > leaf and radii[-1] > 0:
                # by the nearer of two far points, half of the rows each
                a = here[away.argmax()]
                far = ((here - a) ** 2).sum(axis=1)
                side = far - ((here - here[far.argmax()]) ** 2).sum(axis=1)
                half = (e - s) // 2
                self.order[s:e] = self.order[s:e][np.argpartition(side, half)]
                todo += [(s, s + half, node), (s + half, e, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.reach = np.sqrt((self.centres ** 2).sum(axis=1)) + self.radii

    def bounds(self, cols: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Of each node: no row of it has a greater inner product with the
        query that has ``values`` in ``cols``. A float sum of v products is
        off by less than v units in the last place of its value, a centre or
        a radius by less than the rows or columns it was summed over; the
        slack is far above all of these together."""
        size = np.sqrt((values ** 2).sum())
        off = 16 * (self.centres.shape[1] + len(self.order) + 16) * 2.0 ** -52
        return self.centres[:, cols] @ values + (self.radii + off * self.reach) * size + 1


class Best:
    """The k best (score, -id) of an item."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        """A document that scores less is of no use."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray):
        for at in np.flatnonzero(scores >= self.least()).tolist():
            entry = (int(scores[at]), -int(ids[at]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def search(tree: BallTree, bounds: np.ndarray, vectors: np.ndarray, cols: np.ndarray, w: np.ndarray, ids: np.ndarray,
           best: Best) -> int:
    """Put the documents of a tree that may be among an item's best there;
    ``bounds`` are the nodes' for this item. Returns the leaves scored."""
    heap, scored = [(-bounds[0], 0)], 0
    while heap and -heap[0][0] >= best.least():
        _, node = heapq.heappop(heap)
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(heap, (-bounds[child], child))
        else:
            rows = tree.order[slice(*tree.spans[node])]
            best.add(vectors[np.ix_(rows, cols)] @ w, ids[rows])
            scored += 1
    return scored


def ranked(rows: DataFrame, block: list[tuple[int | None, list[int]]], w: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """(item_id, id, score): each task's ``k`` best documents of every item."""
    size = len(w)
    root = np.sqrt(w.astype(np.float64))
    least_rows = max(1, CHUNK_CELLS // max(1, size))

    def run(batches):
        best = [Best(k) for _ in block]

        def take(chunk: pa.Table):
            cols = chunk.column("cols").combine_chunks()
            held = np.diff(cols.offsets.to_numpy())
            doc = np.repeat(np.arange(len(held)), held)
            length = chunk.column("n").to_numpy()
            tf = chunk.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            vectors = np.zeros((len(held), size), np.int64)
            vectors[doc, cols.flatten().to_numpy()] = impacts(tf, length[doc], n, total)
            ids = chunk.column("id").to_numpy()
            tree = BallTree(vectors * root)
            for q, (_, own) in enumerate(block):
                search(tree, tree.bounds(own, root[own]), vectors, own, w[own], ids, best[q])

        waiting, count = [], 0
        for b in batches:
            for part in (b.slice(s, least_rows) for s in range(0, b.num_rows, least_rows)):
                waiting.append(part)
                count += part.num_rows
                if count >= least_rows:
                    chunk = pa.Table.from_batches(waiting)
                    take(chunk.slice(0, least_rows))
                    rest = chunk.slice(least_rows).combine_chunks()
                    waiting, count = rest.to_batches(), rest.num_rows
        if count:
            take(pa.Table.from_batches(waiting))
        found = [(block[q][0], -i, s) for q, b in enumerate(best) for s, i in b.heap]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)],
                                             names=["item_id", "id", "score"])

    return rows.where(F.size("cols") > 0).mapInArrow(run, "item_id bigint, id bigint, score bigint")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``k`` best documents."""
    spark, out = docs.sparkSession, None
    for block in item_blocks(items):
        vocabulary = sorted({t for _, ts in block for t in ts})
        at = {t: c for c, t in enumerate(vocabulary)}
        rows = scratch_table(counted(docs, vocabulary), "term-counts")
        n, total, df = statistics(rows, len(vocabulary))
        if n:
            own = [(item, np.array([at[t] for t in ts])) for item, ts in block]
            found = ranked(rows, own, weights(n, df), n, total, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "item_id bigint, id bigint, score bigint")
    first = Window.partitionBy("item_id").orderBy(F.desc("score"), "id")
    return (out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("item_id", "rank", F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "score"))


SEARCH_SQL = f"""
with d as materialized (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') as ts from documents),
sizes as (select r, len(ts)::bigint as n from d where len(ts) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as total from sizes),
asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) as term from benchmark),
tf as (
  select r, doc_id, term, count(*)::bigint as tf from (select r, doc_id, unnest(ts) as term from d)
  where term in (select term from asked) group by all),
w as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
  from tf, totals group by term, docs),
scored as (
  select a.item_id, t.doc_id, t.r,
    sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (100 - 50 + (50 * s.n * z.docs) // z.total))))::bigint as score
  from asked a join tf t using (term) join w using (term) join sizes s on s.r = t.r, totals z group by all),
placed as (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank from scored where score > 0)
select item_id, rank, doc_id, score from placed where rank <= {K}
"""
