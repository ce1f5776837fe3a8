"""Passages that repeat across documents, by collinear chaining.

Seeds are all five-word k-mers, and some ``LONG``-word ones (of every nine
successive ones that with the least hash, so two documents that share 50
words in a row share one). A seed is joined to its first occurrence (smallest
doc_id, then place), not to all others, so a k-mer that a third of all
documents have makes one match for each of them; a long seed finds the first
document of the longer stretch where its short seeds lie scattered over
others. The matches of two documents are chained: the best ordered chain by
number of seeds less a cost for gaps, through a Fenwick tree over the places
in the earlier document. Chains are aligned word by word between and beyond
their seeds; an alignment of at least ``MIN_WORDS`` words and a similarity
(equal words by aligned places) of 0.8 or more is a passage.

Seeds meet in buckets of about ``BUCKET_WORDS`` places, their number taken
from the data. Texts move once, compressed; a chain takes only a window
around it along, and is aligned anew in a wider one if it reaches the window's
end.

Words are separated by ASCII white space and compared with A-Z in lower
case. Nulls: a null text has no passages; a null doc_id counts as the
largest. Repeated rows (equal id and text) are one document. Texts shorter
than ``MIN_WORDS`` words and an empty table give no rows. Other columns are
ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import BROADCAST_BYTES, bounded_broadcast, free_name, in_worker, on_group, scratch_table, texts

K = 5
MIN_WORDS = 50
SIMILARITY = 0.8
#: Cost of a word between two seeds, in seeds' words; longest gap in words.
GAP_COST = 0.1
MAX_GAP = 64
#: Words of the documents that are packed together; places of a bucket.
CHUNK = 1 << 20
BUCKET_WORDS = 1 << 20
#: Words that are hashed at once.
STEP = 1 << 16
#: Words of a long seed; successive ones of which one is taken.
LONG, WINDOW = 42, 9
#: Places that two documents share, at least, if no long seed does.
LEAST_PLACES = 4
#: Words taken along before and after a chain, at first.
AROUND = 64

NO_ID = (1 << 63) - 1
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
              np.uint64)
_WORD = re.compile(rb"[^ \t-\r]+")


def tag(raw: bytes) -> int:
    """31 bits of the text; tells rows of one id apart."""
    return xxhash.xxh3_64_intdigest(raw) & 0x7FFFFFFF


def word_hashes(raw: bytes) -> np.ndarray:
    words = raw.lower().split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def kmer_hashes(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``K`` successive words."""
    out = np.zeros(max(0, len(words) - K + 1), np.uint64)
    for s in range(0, len(out), STEP):
        w = words[s:s + STEP + K - 1].astype(np.uint64)
        n = len(w) - K + 1
        h = w[:n] * _C[0]
        for j in range(1, K):
            h += (w[j:n + j] ^ (h >> np.uint64(29))) * _C[j]
        h ^= h >> np.uint64(32)
        h *= _C[2]
        h ^= h >> np.uint64(29)
        out[s:s + n] = h
    return out


def long_seeds(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``words``, hashes) of the long seeds of the documents that
    follow one another in ``words``."""
    last = len(words) - LONG - WINDOW + 2  # first places of WINDOW successive ones
    found = [_long_seeds(words[s:min(s + STEP, last) + LONG + WINDOW - 2], s, start, size) for s in range(0, last, STEP)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, k = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
    return at, np.concatenate([f[1] for f in found])[k]


def _long_seeds(words: np.ndarray, base_at: int, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those in ``words``, which begin at ``base_at``."""
    n = len(words) - LONG + 1
    # a polynomial in an odd base, whose powers have inverses
    base = np.full(len(words), _C[0])
    base[0] = 1
    power = np.multiply.accumulate(base)
    inverse = np.full(n, np.uint64(pow(int(_C[0]), -1, 1 << 64)))
    inverse[0] = 1
    w = (words.astype(np.uint64) + np.uint64(1)) * _C[3]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((w ^ (w >> np.uint64(31))) * power)])
    h = (sums[LONG:] - sums[:n]) * np.multiply.accumulate(inverse)
    h ^= h >> np.uint64(32)
    h *= _C[2]
    h ^= h >> np.uint64(29)
    least = h
    for reach in (1, 2, 4):
        least = np.minimum(least[:-reach], least[reach:])
    least = np.minimum(least[:-1], h[WINDOW - 1:])  # of every WINDOW = 1 + 2 * 4 successive ones
    first = base_at + np.arange(n - WINDOW + 1)
    doc = np.searchsorted(start, first, "right") - 1
    inside = first + (WINDOW - 1) + LONG <= start[doc] + size[doc]
    taken = np.zeros(n, bool)
    for k in range(WINDOW):
        taken[k:k + len(least)] |= inside & (h[k:k + len(least)] == least)
    at = np.flatnonzero(taken)
    return at + base_at, h[at]


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers from 0 on as byte planes, each column as wide as its
    greatest number."""
    cols = [c.astype(np.uint64) for c in columns]
    widths = [(int(c.max()).bit_length() + 7) // 8 for c in cols]
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for c, w in zip(cols, widths)]
    head = b"".join(struct.pack("<IB", len(c), w) for c, w in zip(cols, widths))
    return bytes([len(cols)]) + head + zstandard.compress(b"".join(planes), 1)


def _unpack(data: bytes) -> list[np.ndarray]:
    heads = [struct.unpack_from("<IB", data, 1 + 5 * k) for k in range(data[0])]
    raw = np.frombuffer(zstandard.decompress(data[1 + 5 * data[0]:]), np.uint8)
    cols, at = [], 0
    for size, width in heads:
        c = np.zeros((size, 8), np.uint8)
        c[:, :width] = raw[at:at + size * width].reshape(width, size).T
        at += size * width
        cols.append(c.view(np.int64).ravel())
    return cols


def _dealt(bucket: np.ndarray, ids: np.ndarray, tags: np.ndarray, docs: list[np.ndarray], rest: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """(bucket, blob) of rows sorted by bucket: the documents that occur, the
    columns that number them (``docs``), the other columns."""
    out = []
    for s, e in pairwise(np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()):
        used, at = np.unique(np.concatenate([d[s:e] for d in docs]), return_inverse=True)
        out.append((int(bucket[s]), _pack(ids[used], tags[used], *at.reshape(len(docs), -1), *(r[s:e] for r in rest))))
    return out


def _gathered(blobs: list[bytes], docs: int, steps: int | None = None) -> list[np.ndarray]:
    """All documents of the blobs, each once and in order, and the columns
    of ``_dealt``; that at ``steps`` is summed up within each blob."""
    parts = [_unpack(b) for b in blobs]
    if steps is not None:
        for p in parts:
            np.cumsum(p[2 + steps], out=p[2 + steps])
    ids, tags = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.lexsort((tags, ids))
    new = np.append(True, (np.diff(ids[order]) != 0) | (np.diff(tags[order]) != 0))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum(new) - 1
    size = np.array([len(p[0]) for p in parts])
    base = np.cumsum(size) - size
    cols = []
    for k in reversed(range(2, len(parts[0]))):  # what is gathered goes at once: the parts are as large as the whole
        own = [p.pop() for p in parts]
        cols.append(np.concatenate([rank[c + o] for c, o in zip(own, base)] if k < 2 + docs else own))
    return [ids[order][new], tags[order][new], *reversed(cols)]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ``BLOBS``."""
    kinds = [pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["bucket", "data"])


BLOBS = "bucket int, data binary"


def _by_hash(h: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray, tags: np.ndarray,
             buckets: int) -> list[tuple[int, bytes]]:
    """Places packed by 48 bits of their hash, which is overwritten. (The few
    places alike in these only are told apart when their words are aligned.)"""
    h >>= np.uint64(16)
    h = h.view(np.int64)
    order = np.argsort(h)
    doc, place, h = doc[order], place[order], h[order]
    del order
    bucket = (h // ((1 << 48) // buckets + 1)).astype(np.int32)
    starts = np.flatnonzero(np.diff(bucket, prepend=np.int32(-1)))
    first = h[starts]
    h[1:] -= h[:-1].copy()
    h[starts] = first
    return _dealt(bucket, ids, tags, [doc], [h, place])


def seeds(docs: DataFrame, buckets: int) -> DataFrame:
    """Every seed of every document, packed by its hash; a place is doubled,
    and one more for a long seed."""
    def blobs(part):
        ids, tags, words = zip(*part)
        size = np.array([len(w) for w in words])
        start = np.cumsum(size) - size
        words = np.concatenate(words)
        kind = np.int32 if len(words) < 1 << 30 else np.int64  # one text may be longer
        doc = np.repeat(np.arange(len(size), dtype=kind), size)
        place = np.arange(len(words), dtype=kind) - start.astype(kind)[doc]
        far, far_h = long_seeds(words, start, size)
        h = kmer_hashes(words)
        del words
        own = place[:len(h)] <= size.astype(kind)[doc[:len(h)]] - K
        h = np.append(h[own], far_h)
        place = np.append(2 * place[:len(own)][own], 2 * place[far] + 1)
        doc = np.append(doc[:len(own)][own], doc[far])
        return _table(_by_hash(h, doc, place, np.array(ids), np.array(tags), buckets))

    def run(batches):
        part, total = [], 0
        for b in batches:
            for doc_id, text in zip(b.column("id").to_pylist(), texts(b)):
                raw = text.encode("utf-8", "replace")
                words = word_hashes(raw)
                if len(words) >= MIN_WORDS:
                    part.append((doc_id, tag(raw), words))
                    total += len(words)
                    if total >= CHUNK:
                        yield blobs(part)
                        part, total = [], 0
        if part:
            yield blobs(part)

    return _plain(docs).mapInArrow(in_worker(run), BLOBS)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string"))


def repeats(found: DataFrame, buckets: int) -> DataFrame:
    """Every place whose hash two documents have, with the first of all
    places that have it (by document, then place), packed by the document."""
    def run(table: pa.Table) -> pa.Table:
        blobs = table.column("data").to_pylist()
        ids, tags, doc, h, place = _gathered(blobs, 1, steps=1)
        order = np.argsort(h)
        sorted_h = h[order]
        same = sorted_h[1:] == sorted_h[:-1]
        order = order[np.append(False, same) | np.append(same, False)]
        del sorted_h, same
        h, doc, place = h[order], doc[order], place[order]
        order = np.lexsort((place, doc, h))
        h, doc, place = h[order], doc[order], place[order]
        start = np.flatnonzero(np.diff(h, prepend=-1))
        size = np.diff(np.append(start, len(h)))
        two = np.repeat(doc[start] != doc[start + size - 1], size)
        first = np.repeat(start, size)[two]
        bucket = ((((ids ^ tags).astype(np.uint64) * _C[0]) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)[doc[two]]
        order = np.lexsort((place[two], doc[two], bucket))
        rows = _dealt(bucket[order], ids, tags, [doc[two][order], doc[first][order]], [place[two][order], place[first][order]])
        return pa.Table.from_batches([_table(rows)])

    return found.groupBy("bucket").applyInArrow(on_group(run), BLOBS)


def _matches(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(ids, tags, doc, first_doc, x, y) of a bucket of ``repeats``, by
    document and place, each place once."""
    ids, tags, doc, first, x, y = _gathered(table.column("data").to_pylist(), 2)
    order = np.lexsort((x, doc))
    doc, first, x, y = doc[order], first[order], x[order], y[order]
    new = (np.diff(doc, prepend=-1) != 0) | (np.diff(x, prepend=-1) != 0)
    return ids, tags, doc[new], first[new], x[new], y[new]


def _diagonals(doc: np.ndarray, first: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """The matches with another document, by documents and diagonal, whether
    each is of a long seed, and whether each starts and ends a run of
    neighbours. Documents that share few places and no long seed are left
    out. Of a place that matches again and again within ``MIN_WORDS`` words
    (a periodic text) one is kept, and the last: each is extended over all
    that is equal around it."""
    other = np.flatnonzero(doc != first)
    strong = x[other] & 1
    d, f, x, y = doc[other], first[other], x[other] >> 1, y[other] >> 1
    order = np.lexsort((1 - strong, x, y, f, d))
    d, f, x, y, strong = d[order], f[order], x[order], y[order], strong[order]
    once = np.append(True, (d[1:] != d[:-1]) | (f[1:] != f[:-1]) | (y[1:] != y[:-1]) | (x[1:] != x[:-1]))[:len(x)]
    d, f, x, y, strong = d[once], f[once], x[once], y[once], strong[once]
    if len(x):
        pair = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (f[1:] != f[:-1])))
        size = np.diff(np.append(pair, len(x)))
        enough = np.repeat((size >= LEAST_PLACES) | (np.add.reduceat(strong, pair) > 0), size)
        d, f, x, y, strong = d[enough], f[enough], x[enough], y[enough], strong[enough]
    same = (d[1:] == d[:-1]) & (f[1:] == f[:-1]) & (y[1:] == y[:-1])
    near = same & (x[1:] - x[:-1] <= MIN_WORDS)
    keep = np.append(True, ~(near & (x[1:] // MIN_WORDS == x[:-1] // MIN_WORDS)))[:len(x)] | np.append(~near, True)[:len(x)]
    d, f, x, y, strong = d[keep], f[keep], x[keep], y[keep], strong[keep]
    order = np.lexsort((x, x - y, f, d))
    d, f, x, y, strong = d[order], f[order], x[order], y[order], strong[order]
    on = (d[1:] == d[:-1]) & (f[1:] == f[:-1]) & (x[1:] - x[:-1] == 1) & (y[1:] - y[:-1] == 1)
    return d, f, x, y, strong, np.append(True, ~on)[:len(x)], np.append(~on, True)[:len(x)]


class Fenwick:
    """Greatest (value, item) among the first ranks."""

    def __init__(self, n: int):
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, rank: int, value: float, item: int):
        k = rank + 1
        while k < len(self.best):
            if value > self.best[k][0]:
                self.best[k] = (value, item)
            k += k & -k

    def before(self, rank: int) -> tuple[float, int]:
        """Over ranks below ``rank``."""
        out = (-1e18, -1)
        while rank > 0:
            if self.best[rank][0] > out[0]:
                out = self.best[rank]
            rank -= rank & -rank
        return out


def chains(x: list[int], y: list[int], least: int = 2) -> list[tuple[list[int], list[int]]]:
    """Ordered chains of at least ``least`` seeds, the best first; a seed is
    in one chain. f(i) = K + max(0, f(j) - GAP_COST (dx + dy)) over all j
    with smaller x and smaller y; a chain is cut at gaps over ``MAX_GAP``."""
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    rank = {v: r for r, v in enumerate(sorted(set(y)))}
    tree = Fenwick(len(rank))
    score, back = [0.0] * len(x), [-1] * len(x)
    waiting: list[int] = []
    for i in order:
        if waiting and x[waiting[0]] != x[i]:
            for j in waiting:
                tree.put(rank[y[j]], score[j] + GAP_COST * (x[j] + y[j]), j)
            waiting = []
        value, j = tree.before(rank[y[i]])
        gain = value - GAP_COST * (x[i] + y[i])
        score[i], back[i] = (K + gain, j) if gain > 0 else (float(K), -1)
        waiting.append(i)
    used, out = [False] * len(x), []
    for i in sorted(order, key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        path.reverse()
        part: list[int] = []
        for i in path:
            if part and max(x[i] - x[part[-1]], y[i] - y[part[-1]]) > MAX_GAP:
                out.append(part)
                part = []
            part.append(i)
        out.append(part)
    return [([x[i] for i in p], [y[i] for i in p]) for p in out if len(p) >= least]


CHAIN = "id bigint, tag bigint, first_id bigint, first_tag bigint, xs array<int>, ys array<int>"
_KINDS = {"id": pa.int64(), "tag": pa.int64(), "first_id": pa.int64(), "first_tag": pa.int64(),
          "xs": pa.list_(pa.int32()), "ys": pa.list_(pa.int32()), "start": pa.int32(), "end": pa.int32(), "first_start": pa.int32(), "first_end": pa.int32(), "similarity": pa.float64()}


def _rows(rows: list[tuple], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _KINDS[n]) for k, n in enumerate(names)], names=names)


def chained(found: DataFrame) -> DataFrame:
    """Chains of the matches of every two documents, one row each. Of a run
    of neighbours the ends and every sixteenth are chained."""
    def run(table: pa.Table) -> pa.Table:
        ids, tags, *cols = _matches(table)
        d, f, x, y, strong, starts, ends = _diagonals(*cols)
        at = np.arange(len(x))
        since = at - np.maximum.accumulate(np.where(starts, at, 0))
        keep = starts | ends | (since % 16 == 0)
        d, f, x, y, strong = d[keep], f[keep], x[keep], y[keep], strong[keep]
        edges = np.flatnonzero((np.diff(d, prepend=-1, append=-1) != 0) | (np.diff(f, prepend=-1, append=-1) != 0)).tolist()
        rows = []
        for s, e in pairwise(edges):
            sure = set(zip(x[s:e][strong[s:e] > 0].tolist(), y[s:e][strong[s:e] > 0].tolist()))
            if e - s >= 2 or sure:
                a, b = d[s], f[s]
                rows += [(ids[a], tags[a], ids[b], tags[b], xs, ys) for xs, ys in chains(x[s:e].tolist(), y[s:e].tolist(), least=1)
                         if len(xs) >= 2 or (xs[0], ys[0]) in sure]
        return pa.Table.from_batches([_rows(rows, "id", "tag", "first_id", "first_tag", "xs", "ys")])

    return found.groupBy("bucket").applyInArrow(on_group(run), CHAIN)


def _extend(a: np.ndarray, b: np.ndarray, edits: int = 8, after: int = 2) -> list[tuple[int, int, int, int]]:
    """Stretches of ``a`` and ``b`` from their starts: words of either, equal
    words and aligned places, in turn equal and not. A difference of up to
    ``edits`` words on either side is passed if ``after`` equal words follow
    it, as long as 0.8 of all that comes after some stretch is equal, less
    ``MIN_WORDS`` / 5 words."""
    out, i, j, score, best = [], 0, 0, 0.0, 0.0
    while True:
        n = min(len(a) - i, len(b) - j)
        eq = a[i:i + n] == b[j:j + n]
        run = n if eq.all() else int(eq.argmin())
        out.append((run, run, run, run))
        i, j, score = i + run, j + run, score + run * (1 - SIMILARITY)
        best = max(best, score)
        u, v = a[i:i + edits + after], b[j:j + edits + after]
        jump = None
        if len(u) >= after and len(v) >= after and best - score <= MIN_WORDS * (1 - SIMILARITY):
            like = u[:, None] == v
            follow = like[:-1, :-1] & like[1:, 1:]
            da, db = np.nonzero(follow)
            if len(da):
                k = int(np.lexsort((da + db, np.maximum(da, db)))[0])
                jump = int(da[k]), int(db[k])
        if jump is None:
            return out
        same, places = _between(u[:jump[0]], v[:jump[1]])
        out.append((*jump, same, places))
        i, j, score = i + jump[0], j + jump[1], score + same - SIMILARITY * places


def _between(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Equal words and places of the best alignment of two short runs."""
    if len(a) == len(b):
        eq = int((a == b).sum())
        if eq >= len(a) - 1:
            return eq, len(a)
    row = [(j, 0) for j in range(len(b) + 1)]  # (edits, -equal words)
    for x in a.tolist():
        new = [(row[0][0] + 1, 0)]
        for j, z in enumerate(b.tolist()):
            d, s = row[j]
            new.append(min((d, s - 1) if x == z else (d + 1, s), (row[j + 1][0] + 1, row[j + 1][1]),
                           (new[j][0] + 1, new[j][1])))
        row = new
    edits, same = row[-1]
    return -same, edits - same


def _alike(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int]) -> bool:
    """Whether ``MIN_WORDS`` words either side of a chain share words enough
    for a passage."""
    u, v = (w[max(0, at[0] - MIN_WORDS):at[-1] + K + MIN_WORDS] for w, at in ((a, xs), (b, ys)))
    return np.isin(u, v).sum() >= MIN_WORDS * SIMILARITY


def align(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int]) -> tuple[list[tuple[int, int, int, int, float]], int, int]:
    """(start, end) in ``a``, (start, end) in ``b`` and the similarity of the
    passages around a chain: the longest stretch from equal words to equal
    words that is long and alike enough, then the same on either side of it.
    Also the words of ``a`` that the alignment goes from and to."""
    parts = _extend(a[:xs[0]][::-1], b[:ys[0]][::-1])[::-1]
    at, bt = xs[0] - sum(p[0] for p in parts), ys[0] - sum(p[1] for p in parts)
    for (x, y), (x1, y1) in pairwise(zip(xs, ys)):
        n = min(x1 - x, y1 - y)
        eq = a[x:x + n] == b[y:y + n]
        run = n if eq.all() else int(eq.argmin())
        parts.append((run, run, run, run))
        if x + run < x1 or y + run < y1:
            parts.append((x1 - x - run, y1 - y - run, *_between(a[x + run:x1], b[y + run:y1])))
    parts += _extend(a[xs[-1]:], b[ys[-1]:])
    sums = np.cumsum([(0, 0, 0, 0), *parts], axis=0)
    equal = np.array([p[0] > 0 and p[0] == p[1] == p[2] == p[3] for p in parts])
    slack = sums[:, 2] - SIMILARITY * sums[:, 3]
    out, todo = [], [(0, len(parts))]
    while todo:
        s, e = todo.pop()
        start = s + np.flatnonzero(equal[s:e])
        best = None
        if len(start) and sums[e, 0] - sums[s, 0] >= MIN_WORDS:
            stop = start[::-1] + 1
            for i in start.tolist():
                if sums[stop[0], 0] - sums[i, 0] < max(MIN_WORDS, best[0] + 1 if best else 0):
                    break
                good = stop[(slack[stop] - slack[i] >= -1e-9) & (sums[stop, 0] - sums[i, 0] >= MIN_WORDS)]
                if len(good) and (best is None or sums[good[0], 0] - sums[i, 0] > best[0]):
                    best = int(sums[good[0], 0] - sums[i, 0]), i, int(good[0])
        if best:
            _, i, j = best
            like = (sums[j, 2] - sums[i, 2]) / (sums[j, 3] - sums[i, 3])
            out.append((int(at + sums[i, 0]), int(at + sums[j, 0]), int(bt + sums[i, 1]), int(bt + sums[j, 1]), float(like)))
            todo += [(s, i), (j, e)]
    return out, int(at), int(at + sums[-1, 0])


SPAN = "id bigint, tag bigint, start int, `end` int, first_id bigint, first_start int, first_end int, similarity double"


def passages(docs: DataFrame) -> DataFrame:
    """Every passage that an earlier document has too: (doc_id, tag, start,
    end, first_doc_id, first_start, first_end, similarity); start and end
    count words, end excluded. A passage of several earlier documents is
    given with the first of them: one that adds fewer than ``K`` words to
    those of documents before its own is left out."""
    found = aligned(docs).groupBy("id", "tag").agg(F.collect_list(F.struct("first_id", "start", "end", "first_start", "first_end", "similarity")).alias("s"))

    def run(batches):
        for b in batches:
            rows = []
            for i, t, spans in zip(*(c.to_pylist() for c in b.columns)):
                seen = np.zeros(max(s["end"] for s in spans), bool)
                for s in sorted(spans, key=lambda s: (s["first_id"], s["start"] - s["end"], s["start"], s["first_start"])):
                    own = seen[s["start"]:s["end"]]
                    if len(own) - own.sum() >= K:
                        rows.append((i, t, s["start"], s["end"], s["first_id"], s["first_start"], s["first_end"], s["similarity"]))
                        own[:] = True
            yield _rows(rows, "id", "tag", "start", "end", "first_id", "first_start", "first_end", "similarity")

    return found.mapInArrow(run, SPAN).select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "tag", "start", "end",
        F.nullif("first_id", F.lit(NO_ID)).alias("first_doc_id"), "first_start", "first_end", "similarity")


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids`` (column id); all, where these
    are too many to be broadcast: they do no harm."""
    ids = ids.distinct()
    return df.join(F.broadcast(ids), "id", "left_semi") if ids.count() * 16 <= BROADCAST_BYTES else df


def packed_texts(docs: DataFrame) -> DataFrame:
    """(id, tag, data): the words of each different text, compressed."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column("id").to_pylist(), texts(b)):
                raw = t.encode("utf-8", "replace")
                words = raw.lower().split()
                if len(words) >= MIN_WORDS:
                    rows.append((i, tag(raw), zstandard.compress(b" ".join(words), 6)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in
                                              enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["id", "tag", "data"])

    return docs.mapInArrow(in_worker(run), "id bigint, tag bigint, data binary").dropDuplicates(["id", "tag"])


def _unpacked(keys: list, data: list[bytes]):
    """The words of each row; successive rows of one document are read once."""
    last, words = None, []
    for key, raw in zip(keys, data):
        if key != last:
            last, words = key, zstandard.decompress(raw).split()
        yield words


def windows(chain: DataFrame, packed: DataFrame, around: int) -> DataFrame:
    """``chain`` with the words from ``around`` before to ``around`` after
    each chain: which is the first, whether they are all, the words."""
    def run(batches):
        for b in batches:
            rows = []
            cols = [b.column(c).to_pylist() for c in ("id", "tag", "first_id", "first_tag", "xs", "ys", "data")]
            for (*row, _), words in zip(zip(*cols), _unpacked(list(zip(*cols[:2])), cols[-1])):
                xs = row[4]
                lo, hi = max(0, xs[0] - around), min(len(words), xs[-1] + K + around)
                rows.append((*row, lo, lo == 0, hi == len(words), zstandard.compress(b" ".join(words[lo:hi]), 6)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([*(pa.int64(),) * 4, *(pa.list_(pa.int32()),) * 2,
                                                                                pa.int32(), pa.bool_(), pa.bool_(), pa.binary()])],
                names=["id", "tag", "first_id", "first_tag", "xs", "ys", "from", "starts", "ends", "window"])

    return chain.join(packed, ["id", "tag"]).mapInArrow(in_worker(run), f"{CHAIN}, `from` int, starts boolean, ends boolean, window binary")


def aligned(docs: DataFrame) -> DataFrame:
    """The passages of every two documents that are chained, as ``SPAN``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(parts, -(-chars // (6 * BUCKET_WORDS)))
    chain = scratch_table(chained(repeats(seeds(docs, buckets), buckets)), "chains")
    needed = chain.select("id").union(chain.select("first_id"))
    packed = scratch_table(packed_texts(_only(_plain(docs), needed)), "texts")
    around, found = AROUND, None
    while True:
        # (plain exchanges on both sides, so that a first document of very many chains is split)
        first = _only(packed, chain.select(F.col("first_id").alias("id"))).toDF("first_id", "first_tag", "data")
        both = windows(chain, _only(packed, chain.select("id")), around).join(first, ["first_id", "first_tag"])
        made = scratch_table(_aligned(both), "passages")
        spans = made.where(F.col("xs").isNull()).select("id", "tag", "start", "end", "first_id", "first_start", "first_end", "similarity")
        found = spans if found is None else found.unionByName(spans)
        chain = made.where(F.col("xs").isNotNull()).select("id", "tag", "first_id", "first_tag", "xs", "ys")
        if chain.isEmpty():
            return found.distinct()
        around *= 16


def _aligned(both: DataFrame) -> DataFrame:
    """Passages as ``SPAN``; a chain that comes near an end of its window is
    given back instead, with its seeds."""
    near = 16  # more words than a step beyond a difference looks at

    def run(batches):
        last, words, done = None, None, {}
        for b in batches:
            out, again = set(), []
            cols = [b.column(c).to_pylist() for c in ("id", "tag", "first_id", "first_tag", "xs", "ys", "from", "starts", "ends", "window")]
            for row, data in zip(zip(*cols), b.column("data").to_pylist()):
                i, t, fi, ft, xs, ys, lo, starts, ends, window = row
                if (fi, ft) != last:
                    last, words, done = (fi, ft), word_hashes(zstandard.decompress(data)), {}
                # within a passage of the two that is found already, at about the same shift
                if any(s <= xs[0] and xs[-1] + K <= e and fs <= ys[0] and ys[-1] + K <= fe
                       and abs((xs[0] - s) - (ys[0] - fs)) <= near for s, e, fs, fe in done.get((i, t), ())):
                    continue
                a = word_hashes(zstandard.decompress(window))
                own = [x - lo for x in xs]
                if not _alike(a, words, own, ys):
                    continue
                got, low, high = align(a, words, own, ys)
                if (low < near and not starts) or (high > len(a) - near and not ends):
                    again.append((i, t, fi, ft, xs, ys))
                else:
                    out.update((i, t, s + lo, e + lo, fi, fs, fe, like) for s, e, fs, fe, like in got)
                    done.setdefault((i, t), []).extend((s + lo, e + lo, fs, fe) for s, e, fs, fe, _ in got)
            rows = [(i, t, fi, None, None, None, s, e, fs, fe, like) for i, t, s, e, fi, fs, fe, like in sorted(out)]
            rows += [(*r, *(None,) * 5) for r in again]
            yield _rows(rows, "id", "tag", "first_id", "first_tag", "xs", "ys", "start", "end", "first_start", "first_end", "similarity")

    return both.mapInArrow(in_worker(run), f"{CHAIN}, start int, `end` int, first_start int, first_end int, similarity double")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans``, their white space included."""
    raw = text.encode("utf-8", "replace")
    words = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for s, e in sorted(spans):
        a, z = words[s][0], words[e][0] if e < len(words) else len(raw)
        out.append(raw[at:max(at, a)])
        at = max(at, z)
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace").rstrip(" ") if spans else text


def remove_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with every passage left in its first document only. A column
    n_chars follows the text. Documents of which nothing is left are dropped;
    a document without words stays as it is."""
    by_doc = scratch_table(aligned(docs).groupBy(F.col("id").alias("k"))
                           .agg(F.collect_list(F.struct("tag", "start", "end")).alias("s")), "spans")
    size = by_doc.agg(F.count("*"), F.sum(F.size("s"))).first()
    key, has = free_name(docs.columns, "__key"), free_name(docs.columns, "__spans")
    by_doc = bounded_broadcast(by_doc.toDF(key, has), (size[0] or 0) + (size[1] or 0), 64)
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))).join(by_doc, key, "left")
    columns = docs.columns
    counts = [c for c in columns if c == "n_chars"]

    def run(batches):
        for b in batches:
            old, keep = texts(b), []
            new = b.column("text").to_pylist()
            for k, s in enumerate(b.column(has).to_pylist()):
                raw_tag = tag(old[k].encode("utf-8", "replace"))
                mine = [(x["start"], x["end"]) for x in s or [] if x["tag"] == raw_tag]
                if mine:
                    new[k] = cut(old[k], mine)
                if not mine or new[k].split():
                    keep.append(k)
            out = {c: b.column(c) for c in columns}
            out["text"] = pa.array(new, pa.string())
            if counts:
                was = out["n_chars"].to_pylist()
                out["n_chars"] = pa.array([len(t) if s else n for t, s, n in zip(new, b.column(has).to_pylist(), was)],
                                          out["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=columns).take(pa.array(keep, pa.int64()))

    untouched = marked.where(F.col(has).isNull()).select(*columns)
    changed = marked.where(F.col(has).isNotNull()).mapInArrow(in_worker(run), docs.schema)
    return untouched.unionByName(changed)
