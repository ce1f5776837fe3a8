"""Quality scores by a factorisation machine.

A document's features are its distinct words, hashed, and bins of structure
statistics and of its metadata (``n_chars``). The score is

    w0 + sum_j w_j x_j + 1/2 sum_f [(sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2]

so all pairwise interactions of rank ``FACTORS`` cost time linear in the
number of features.

Nulls: a null text is an empty one and a null ``n_chars`` has a bin of its
own; both score like any other. Repeated rows get equal scores. An empty
table gives no rows; without labels of both kinds every score is the share of
labels that are 1 (1 without any label: nothing is rejected unseen). The
operator adds one column whose name the caller chooses.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import in_worker, texts, with_columns
from tallyhall.llm.sample import labelled_sample

#: Labelled documents that the model is fitted on, at most.
MAX_DOCS = 6_000
#: Buckets of hashed words; statistics and metadata follow them.
WORDS = 1 << 16
FACTORS = 6
BINS = 16

_UPPER, _LOWER, _DIGIT = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_MARKS = {"upper": _UPPER, "lower": _LOWER, "digit": _DIGIT, "high": bytes(range(128, 256)), "stop": b".,;:",
          "bang": b"!", "ask": b"?", "pipe": b"|", "symbol": b"#*$%&", "angle": b"<>{}[]/\\=_", "quote": b"\"'()-"}
_NOT = {k: bytes(sorted(set(range(256)) - set(v))) for k, v in _MARKS.items()}

STATS = [*_MARKS, "spaces", "words", "chars", "word_length", "distinct", "lines", "line_words", "repeated_lines",
         "top_word", "capital_words", "marked_words", "metadata"]
N_FEATURES = WORDS + len(STATS) * BINS
#: How much a statistic weighs beside a text's words, whose squares sum to 1.
STAT_VALUE = 0.5


def _bin(share: float) -> int:
    """Bins of a share, or of any rate, finer towards 0."""
    return 0 if share <= 0 else int(np.clip(BINS - 1 + np.floor(1.5 * np.log2(share)), 1, BINS - 1))


def _size_bin(n: float) -> int:
    return int(min(BINS - 1, np.log2(n + 1)))


def statistics(raw: bytes, words: list[bytes], distinct: Counter, n_chars: int | None) -> list[int]:
    """The bin of each of ``STATS``."""
    n, size = max(len(words), 1), max(len(raw), 1)
    out = [_bin(len(raw.translate(None, drop)) / size) for drop in _NOT.values()]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    word_bytes = sum(map(len, words))
    title = sum(w[:1].isupper() for w in words)
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    top = max(distinct.values(), default=0)
    return out + [
        _bin((size - word_bytes) / size), _size_bin(len(words)), _size_bin(len(raw)), min(BINS - 1, int(word_bytes / n)),
        min(BINS - 1, int(BINS * len(distinct) / n)), _size_bin(len(lines)), _size_bin(n / max(len(lines), 1)),
        _bin(1 - len(set(lines)) / max(len(lines), 1)), _bin(top / n), _bin(title / n), _bin(marked / n),
        0 if n_chars is None else min(BINS - 1, 1 + int(np.log2(max(n_chars, 0) + 1) * 0.8))]


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices, ascending and distinct, and values of a document's features."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    counted = Counter(words)
    hashed = np.unique(np.fromiter(map(zlib.crc32, counted), np.int64, len(counted)) & (WORDS - 1))
    stats = WORDS + np.arange(len(STATS)) * BINS + statistics(raw, words, counted, n_chars)
    x = np.concatenate([np.full(len(hashed), 1 / np.sqrt(max(len(hashed), 1))), np.full(len(stats), STAT_VALUE)])
    return np.concatenate([hashed, stats]), x


class Machine:
    """w0, w and v of the factorisation machine."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.wv = w0, np.concatenate([w[:, None], v], axis=1).astype(np.float32)

    def margin(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Linear time: one pass over the features, by the sum of squares."""
        if not rows:
            return np.zeros(0)
        starts = np.cumsum([0, *(len(i) for i, _ in rows[:-1])])
        wx = self.wv[np.concatenate([i for i, _ in rows])] * np.concatenate([x for _, x in rows])[:, None].astype(np.float32)
        s = np.add.reduceat(wx, starts, axis=0, dtype=np.float64)
        q = np.add.reduceat(wx[:, 1:] ** 2, starts, axis=0, dtype=np.float64)
        return self.w0 + s[:, 0] + 0.5 * (s[:, 1:] ** 2 - q).sum(axis=1)

    def predict(self, rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -35, 35)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 8, batch: int = 128,
          rate: float = 0.08, l2: float = 2e-5, seed: int = 7, steps: int = 400) -> Machine:
    """Minimises the logistic loss by AdaGrad over small batches; a small
    sample is gone through more often, for ``steps`` batches at least."""
    epochs = max(epochs, -(-steps * batch // max(len(rows), batch)))
    rng = np.random.default_rng(seed)
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w0 = np.log(p / (1 - p))
    wv = np.concatenate([np.zeros((N_FEATURES, 1)), rng.normal(0, 0.05, (N_FEATURES, FACTORS))], axis=1)
    seen = np.full_like(wv, 1e-2)
    seen0 = 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            at = order[k:k + batch]
            part = [rows[i] for i in at]
            size = np.array([len(i) for i, _ in part])
            starts = np.cumsum(size) - size
            idx, x = (np.concatenate(c) for c in zip(*part))
            wx = wv[idx] * x[:, None]
            s = np.add.reduceat(wx, starts, axis=0)
            q = np.add.reduceat(wx[:, 1:] ** 2, starts, axis=0)
            z = w0 + s[:, 0] + 0.5 * (s[:, 1:] ** 2 - q).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[at]) / len(at)
            err = np.repeat(e, size)[:, None] * x[:, None]
            grad = err * np.concatenate([np.ones((len(idx), 1)), np.repeat(s[:, 1:], size, axis=0) - wx[:, 1:]], axis=1)
            u, inv = np.unique(idx, return_inverse=True)
            g = np.stack([np.bincount(inv, c, len(u)) for c in grad.T], axis=1) + l2 * wv[u]
            seen[u] += g ** 2
            wv[u] -= rate * g / np.sqrt(seen[u])
            g0 = e.sum()
            seen0 += g0 ** 2
            w0 -= rate * g0 / np.sqrt(seen0)
    return Machine(float(w0), wv[:, 0], wv[:, 1:])


class Constant:
    def __init__(self, share: float):
        self.share = share

    def predict(self, rows) -> np.ndarray:
        return np.full(len(rows), self.share)


def _rows(batch: pa.RecordBatch, text_col: str, meta_col: str | None):
    meta = batch.column(meta_col).to_pylist() if meta_col else [None] * batch.num_rows
    return [features(t, m) for t, m in zip(texts(batch, text_col), meta)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = MAX_DOCS):
    """A model fitted on at most ``max_docs`` labelled training documents.
    Features are made by Spark; the bounded set of them is fitted on the
    driver."""
    meta = "n_chars" if "n_chars" in docs.columns else None

    def run(batches):
        for b in batches:
            rows = _rows(b, "text", meta)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.astype("<i4").tobytes() for i, _ in rows]), pa.array([len(i) for i, _ in rows], pa.int32()),
                 b.column("__label"), b.column("__id")], names=["i", "n", "y", "id"])

    got = labelled_sample(docs, labels, label, max_docs).mapInArrow(in_worker(run), "i binary, n int, y int, id bigint").collect()
    got.sort(key=lambda r: (r["id"], bytes(r["i"])))
    y = np.array([r["y"] for r in got], np.float64)
    if not len(y) or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 1.0)
    rows = []
    for r in got:
        i = np.frombuffer(r["i"], "<i4").astype(np.int64)
        n = len(i) - len(STATS)
        rows.append((i, np.concatenate([np.full(n, 1 / np.sqrt(max(n, 1))), np.full(len(STATS), STAT_VALUE)])))
    return train(rows, y)


def score(docs: DataFrame, model, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: the chance, 0 to 1, that the label is 1."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    meta = "n_chars" if "n_chars" in docs.columns else None
    out = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches):
        for b in batches:
            p = [model.predict(_rows(b.slice(k, 500), text_col, meta)) for k in range(0, b.num_rows, 500)]
            yield with_columns(b, {name: pa.array(np.concatenate([np.zeros(0), *p]), pa.float64())})

    return docs.mapInArrow(in_worker(run), out)
