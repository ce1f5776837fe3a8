"""Language-model scores by deleted interpolation.

The chance of a token is a mixture of n-gram maximum-likelihood estimates,

    P(w | h) = l_n c(h_n w) / c(h_n) + ... + l_1 c(w) / N + l_0 / (V + 1),

whose weights depend on the bucket of the context's frequency. Weights are
learned by expectation-maximisation on training documents held out of the
counts (one fold in five); the final counts take them in again.

Counting. Documents are gathered in chunks of about ``CHUNK`` tokens, each
with its own list of distinct n-grams as sorted 64-bit keys. A chunk asks for
the counts of its keys and brings its own: requests are cut by key range and
sent to the range's task, which adds them up and answers every chunk in the
order it asked. A word that every document has is sent once a chunk, so no
range is hot, and the ranges are as many as keep a task's keys bounded. What
is exchanged grows with the corpus; the driver sees only the histogram that
the weights are learned from, whose size does not depend on the input.

Tokens: A-Z in lower case, words between ASCII white space, then one end.
Nulls: a null text is an empty one (one end token). A null doc_id is kept; it
folds as an empty id. Repeated rows are scored, and counted, as often as they
occur. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.blobs import pack_counts, pack_sorted, unpack_counts, unpack_sorted
from tallyhall.llm.common import fold, scratch_table, texts

CHUNK = 1_000_000
#: Requested keys that one task adds up, about.
RANGE_KEYS = 2_000_000
#: Words whose hashes a worker keeps.
CACHE_WORDS = 400_000
#: Steps a doubling of a likelihood ratio in the histogram for the weights.
STEPS = 4
HELD, TUNED, COUNTED = 0, 1, 2

_START = 0x5851F42D4C957F2D
_END = xxhash.xxh3_64_intdigest(b" ") & ~3  # no word holds a space
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TAG = np.uint64(3)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word) & ~3
        return h


def _tokens(text: str, hashes: _Hashes) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = _END
    return out


CHUNKS = "chunk bigint, kind int, ids array<bigint>, sizes array<int>, words binary, tokens binary"


def chunks(docs: DataFrame, kind) -> DataFrame:
    """Documents of one kind gathered as (chunk, kind, ids, sizes, words,
    tokens): the distinct words' keys and every token's place among them."""
    def run(batches):
        hashes = _Hashes()
        part, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list] = {}

        def flush(k):
            nonlocal made
            ids, toks = zip(*held.pop(k))
            words, places = np.unique(np.concatenate(toks), return_inverse=True)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part + made], pa.int64()), pa.array([k], pa.int32()), pa.array([list(ids)], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in toks]], pa.list_(pa.int32())), pa.array([pack_sorted(words)], pa.binary()),
                 pa.array([pack_counts(places)], pa.binary())],
                names=["chunk", "kind", "ids", "sizes", "words", "tokens"])

        size = dict.fromkeys((HELD, TUNED, COUNTED), 0)
        for b in batches:
            for doc_id, k, text in zip(b.column("doc_id").to_pylist(), b.column("kind").to_pylist(), texts(b)):
                t = _tokens(text, hashes)
                held.setdefault(k, []).append((doc_id, t))
                size[k] += len(t)
                if size[k] >= CHUNK:
                    yield flush(k)
                    size[k] = 0
        for k in sorted(held):
            yield flush(k)

    return docs.select(F.col("doc_id").cast("bigint"), kind.alias("kind"), F.col("text").cast("string")).mapInArrow(run, CHUNKS)


def _keys(words: bytes, tokens: bytes, sizes: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The key of the n-gram that ends at every token, for n = 1 to
    ``order``, and which tokens begin a document. The two low bits of a key
    hold n - 1. Before a document stand start marks."""
    token = unpack_sorted(words)[unpack_counts(tokens)]
    begin = np.zeros(len(token), bool)
    begin[np.cumsum(sizes) - sizes] = True
    out, start = [token], _START
    for n in range(1, order):
        before = np.empty_like(token)
        before[1:] = out[-1][:-1]
        before[begin] = np.uint64(start)
        h = (before ^ (before >> np.uint64(31))) * _M1 + token * _M2
        h ^= h >> np.uint64(29)
        h *= _M1
        h ^= h >> np.uint64(32)
        out.append((h & ~_TAG) | np.uint64(n))
        start = (start * int(_M2) + n) & (1 << 64) - 1
    return out, begin


def _bounds(ranges: int) -> np.ndarray:
    """First keys of ``ranges`` equal ranges of all keys."""
    return np.array([(k << 64) // ranges for k in range(ranges)], np.uint64)


def requests(chunked: DataFrame, order: int, ranges: int) -> DataFrame:
    """(range, chunk, kind, keys, counts): a chunk's distinct n-grams in a
    range of keys and how often it has them."""
    def run(batches):
        first = _bounds(ranges)
        for b in batches:
            for chunk, kind, sizes, words, tokens in zip(*(b.column(c).to_pylist() for c in ("chunk", "kind", "sizes", "words", "tokens"))):
                keys, counts = np.unique(np.concatenate(_keys(words, tokens, np.array(sizes), order)[0]), return_counts=True)
                cut = np.append(np.searchsorted(keys, first), len(keys))
                rows = [(r, pack_sorted(keys[a:z]), pack_counts(counts[a:z]))
                        for r, (a, z) in enumerate(zip(cut, cut[1:])) if z > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
                     pa.array([kind] * len(rows), pa.int32()), pa.array([k for _, k, _ in rows], pa.binary()),
                     pa.array([c for _, _, c in rows], pa.binary())], names=["range", "chunk", "kind", "keys", "counts"])

    return chunked.mapInArrow(run, "range int, chunk bigint, kind int, keys binary, counts binary")


ANSWERS = ("range int, chunk bigint, everywhere binary, counted binary, n bigint, v bigint, n_counted bigint, "
           "v_counted bigint")


def answers(asked: DataFrame) -> DataFrame:
    """For every request the counts of its keys in all training documents
    and (to tuning chunks) in those that are not held out. One more row a
    range, without chunk, has the range's tokens and distinct words."""
    def run(table: pa.Table) -> pa.Table:
        chunk, kind = table.column("chunk").to_pylist(), table.column("kind").to_pylist()
        keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
        own = [unpack_counts(c) for c in table.column("counts").to_pylist()]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.cumsum([len(k) for k in keys])
        at = np.split(place, ends[:-1])
        total = {k: np.zeros(len(every), np.int64) for k in (TUNED, COUNTED)}
        for k, a, c in zip(kind, at, own):
            if k != HELD:
                total[k][a] += c  # a chunk's keys are distinct
        counted = total[COUNTED]
        everywhere = counted + total[TUNED]
        words = every & _TAG == 0
        r = table.column("range")[0].as_py()
        n = len(chunk) + 1
        sums = [int(x) for c in (everywhere, counted) for x in (c[words].sum(), (c[words] > 0).sum())]
        return pa.table(
            [pa.array([r] * n, pa.int32()), pa.array([*chunk, None], pa.int64()),
             pa.array([*(pack_counts(everywhere[a]) for a in at), None], pa.binary()),
             pa.array([*(pack_counts(counted[a]) if k == TUNED else None for k, a in zip(kind, at)), None], pa.binary()),
             *(pa.array([0] * (n - 1) + [x], pa.int64()) for x in sums)],
            names=["range", "chunk", "everywhere", "counted", "n", "v", "n_counted", "v_counted"])

    return asked.groupBy("range").applyInArrow(run, ANSWERS)


def _estimates(keys, begin, count_of, n_docs: int, n_tokens: int, n_words: int):
    """Estimates of every token, n = 0 (uniform) to the order, and the bucket
    of its longest context that was seen."""
    counts = [count_of(k) for k in keys]
    p = [np.full(len(begin), 1 / (n_words + 1)), counts[0] / max(n_tokens, 1)]
    bucket = np.zeros(len(begin), np.int64)
    for n in range(1, len(keys)):
        context = np.empty(len(begin), np.int64)
        context[1:] = counts[n - 1][:-1]
        context[begin] = n_docs
        p.append(counts[n] / np.maximum(context, 1))
        seen = context > 0
        bucket[seen] = 64 * n + np.frexp(context[seen].astype(np.float64))[1]
    return np.stack(p), bucket, counts[0]


def _joined(chunked: DataFrame, answered: DataFrame) -> DataFrame:
    """Chunks beside the answers to them, which are as many as the ranges."""
    got = (answered.where("chunk is not null").groupBy("chunk")
           .agg(F.array_sort(F.collect_list(F.struct("range", "everywhere", "counted"))).alias("got")))
    return chunked.join(got, "chunk")


def _counts(got, name: str) -> np.ndarray:
    return np.concatenate([unpack_counts(g[name]) for g in got])


def _each(batch: pa.RecordBatch, order: int):
    """(ids, sizes, keys, begin, distinct keys, answers) of every chunk."""
    for ids, sizes, words, tokens, got in zip(*(batch.column(c).to_pylist() for c in ("ids", "sizes", "words", "tokens", "got"))):
        sizes = np.array(sizes)
        keys, begin = _keys(words, tokens, sizes, order)
        yield ids, sizes, keys, begin, np.unique(np.concatenate(keys)), got


def ratio_histogram(joined: DataFrame, order: int, n_docs: int, n_tokens: int, n_words: int) -> DataFrame:
    """(bucket, ratios, n): how many held-out tokens have estimates of these
    ratios to the uniform one, in steps of a logarithm; 0 for none. Bounded
    by the steps, whatever the corpus holds."""
    def run(batches):
        for b in batches:
            for _, _, keys, begin, distinct, got in _each(b, order):
                counts = _counts(got, "counted")
                p, bucket, _ = _estimates(keys, begin, lambda k: counts[np.searchsorted(distinct, k)], n_docs, n_tokens, n_words)
                ratio = p[1:] / p[0]
                step = np.where(ratio > 0, np.round(STEPS * np.log2(np.maximum(ratio, 1e-30))) + 512, 0).astype(np.int64)
                code = bucket
                for s in step:
                    code = code << 11 | np.clip(s, 0, 2047)
                u, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

    return joined.mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def mixture_weights(histogram: list[tuple[int, int]], order: int, rounds: int = 60) -> dict[int, np.ndarray]:
    """Weights of the estimates (uniform first) by bucket, by expectation-
    maximisation; a bucket's counts start from, and are smoothed by, one
    token of every kind."""
    by: dict[int, list] = {}
    for code, n in histogram:
        steps = []
        for _ in range(order):
            steps.append(code & 2047)
            code >>= 11
        by.setdefault(code, []).append((steps[::-1], n))
    out = {}
    for bucket, rows in by.items():
        steps, n = np.array([s for s, _ in rows]), np.array([float(c) for _, c in rows])
        ratio = np.concatenate([np.ones((len(rows), 1)), np.where(steps > 0, 2.0 ** ((steps - 512) / STEPS), 0.0)], axis=1)
        weight = np.full(order + 1, 1 / (order + 1))
        for _ in range(rounds):
            share = weight * ratio
            share *= (n / share.sum(axis=1))[:, None]
            weight = (share.sum(axis=0) + 1) / (n.sum() + order + 1)
        out[bucket] = weight
    return out


def _table(weights: dict[int, np.ndarray], order: int) -> np.ndarray:
    """A row of weights for every bucket; one that no held-out token fell in
    has the weights of the nearest frequency below, or equal ones."""
    table = np.full((64 * order + 64, order + 1), 1 / (order + 1))
    for b in range(len(table)):
        if b in weights:
            table[b] = weights[b]
        elif b % 64 and b // 64:
            table[b] = table[b - 1] if b % 64 > 1 else table[b]
    return table


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def score(docs: DataFrame, order: int = 2, held: int = 1, tuned: int = 2) -> DataFrame:
    """Base and interpolated log10 probability of every whole text, learned
    from documents whose fold is not ``held``; those of fold ``tuned`` are
    the ones that the mixture weights are learned on."""
    f = fold("doc_id")
    kind = F.when(f == held, HELD).when(f == tuned, TUNED).otherwise(COUNTED)
    chunked = scratch_table(chunks(docs, kind), "chunks")
    seen = {r["kind"]: r for r in chunked.groupBy("kind").agg(
        F.sum(F.size("ids")).alias("docs"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("tokens")).collect()}
    docs_of = {k: seen[k]["docs"] if k in seen else 0 for k in (HELD, TUNED, COUNTED)}
    tokens = sum(r["tokens"] for r in seen.values())
    ranges = max(1, -(-tokens * order // RANGE_KEYS))
    answered = scratch_table(answers(requests(chunked, order, ranges)), "answers")
    n, v, n_counted, v_counted = (x or 0 for x in answered.agg(*[F.sum(c) for c in ("n", "v", "n_counted", "v_counted")]).first())
    tuning = _joined(chunked.where(F.col("kind") == TUNED), answered.where("counted is not null"))
    hist = ratio_histogram(tuning, order, docs_of[COUNTED], n_counted, v_counted).collect()  # bounded by its steps
    weights = _table(mixture_weights([(r["code"], r["n"]) for r in hist], order), order)
    n_docs = docs_of[COUNTED] + docs_of[TUNED]

    def run(batches):
        for b in batches:
            for k, (ids, sizes, keys, begin, distinct, got) in enumerate(_each(b, order)):
                counts = _counts(got, "everywhere")
                p, bucket, c = _estimates(keys, begin, lambda x: counts[np.searchsorted(distinct, x)], n_docs, n, v)
                mixed = np.log10((weights[bucket].T * p).sum(axis=0))
                base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
                at = np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([b.column("kind")[k].as_py() == HELD] * len(ids), pa.bool_()),
                     pa.array(sizes, pa.int64()), pa.array(np.add.reduceat((c > 0).astype(np.int64), at), pa.int64()),
                     pa.array([n] * len(ids), pa.int64()), pa.array(np.add.reduceat(base, at), pa.float64()),
                     pa.array(np.add.reduceat(mixed, at), pa.float64())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _joined(chunked, answered).mapInArrow(run, SCORES)
