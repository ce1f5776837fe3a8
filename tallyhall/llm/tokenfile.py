"""Token-id files in patched frame-of-reference blocks.

A file holds the documents of one range of ids, in ascending order:

    8 bytes       magic
    blocks        token ids, ``BLOCK`` to a block
    blocks        token counts of the documents
    8 n bytes     document ids, int64; n bytes: 1 if the id is null
    8 m bytes     start of every block, uint64: the index
    40 bytes      footer: id blocks, count blocks, ids, documents, footer magic

A block subtracts its minimum and packs the differences at the width that
``PERCENTILE`` of them need. The rest, the exceptions, are stored whole in a
list of places and values:

    uint32 minimum, uint16 values, uint8 width, uint8 0, uint16 exceptions,
    packed bits (low bit first), uint16 places, uint32 values

Files are written by the tasks themselves through a file system that the
path names, under names that no other attempt uses. Only files that finished
tasks report are listed, so a repeated or lost attempt leaves no trace.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhall.llm.common import scratch_path, scratch_table, texts
from tallyhall.llm.tokens import encoder

MAGIC = b"PFORIDS1"
BLOCK = 4096
PERCENTILE = 0.95
#: Ids of one file at most, but for the last document's.
FILE_IDS = 8 << 20

_HEAD = struct.Struct("<IHBBH")
_FOOT = struct.Struct("<QQQQ8s")

FILES = "path string, part int, seq int, n_docs bigint, n_ids bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _bits(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of uint32 ``values``, one after the other."""
    as_bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(as_bits[:, :width], bitorder="little").tobytes()


def _values(data: bytes, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width,
                                    bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def encode_block(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to 65535 uint32 values."""
    v = values.astype(np.uint32)
    low = v.min()
    d = v - low
    need = np.frexp(d.astype(np.float64))[1]  # bits of each difference
    width = int(np.partition(need, k := max(0, int(np.ceil(percentile * len(v))) - 1))[k])
    out = np.flatnonzero(need > width)
    return b"".join([_HEAD.pack(int(low), len(v), width, 0, len(out)), _bits(d, width),
                     out.astype("<u2").tobytes(), v[out].astype("<u4").tobytes()])


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    low, n, width, _, k = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    v = _values(data[at:at + size], n, width) + np.uint32(low)
    at += size
    places = np.frombuffer(data, "<u2", k, at)
    v[places] = np.frombuffer(data, "<u4", k, at + 2 * k)
    return v


class FileWriter:
    """Appends documents to one file."""

    def __init__(self, sink):
        self.sink, self.at, self.starts, self.rest, self.n_rest = sink, 0, [], [], 0
        self.doc_ids, self.counts, self.n_ids = [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes):
        self.sink.write(data)
        self.at += len(data)

    def _block(self, values: np.ndarray):
        self.starts.append(self.at)
        self._put(encode_block(values))

    def add(self, doc_id: int | None, ids: np.ndarray):
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.n_ids += len(ids)
        self.rest.append(ids)
        self.n_rest += len(ids)
        if self.n_rest >= BLOCK:
            v = np.concatenate(self.rest)
            full = len(v) - len(v) % BLOCK
            for k in range(0, full, BLOCK):
                self._block(v[k:k + BLOCK])
            self.rest, self.n_rest = [v[full:]], len(v) - full

    def close(self):
        if self.n_rest:
            self._block(np.concatenate(self.rest))
        id_blocks = len(self.starts)
        counts = np.array(self.counts, np.uint32)
        for k in range(0, len(counts), BLOCK):
            self._block(counts[k:k + BLOCK])
        self._put(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self._put(np.array([d is None for d in self.doc_ids], np.uint8).tobytes())
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(_FOOT.pack(id_blocks, len(self.starts) - id_blocks, self.n_ids, len(counts), MAGIC))
        self.sink.close()


class FileReader:
    """Random access to one file through its block index."""

    def __init__(self, source):
        self.source = source
        foot = source.size() - _FOOT.size
        self.id_blocks, count_blocks, self.n_ids, n, magic = _FOOT.unpack(self._get(foot, _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a token-id file, or cut off")
        blocks = self.id_blocks + count_blocks
        index = foot - 8 * blocks
        docs = index - 9 * n
        self.starts = np.append(np.frombuffer(self._get(index, 8 * blocks), "<u8"), docs).astype(np.int64)
        plain = np.frombuffer(self._get(docs, 8 * n), "<i8")
        null = np.frombuffer(self._get(docs + 8 * n, n), np.uint8)
        self.doc_ids = [None if x else int(d) for d, x in zip(plain, null)]
        self.counts = np.concatenate([np.zeros(0, np.uint32), *map(self.block, range(self.id_blocks, blocks))]).astype(np.int64)

    def _get(self, at: int, n: int) -> bytes:
        self.source.seek(int(at))
        return self.source.read(int(n))

    def block(self, k: int) -> np.ndarray:
        return decode_block(self._get(self.starts[k], self.starts[k + 1] - self.starts[k]))

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file; reads only their blocks."""
        if not n:
            return np.zeros(0, np.uint32)
        k = start // BLOCK
        v = np.concatenate([self.block(j) for j in range(k, (start + n - 1) // BLOCK + 1)])
        return v[start - k * BLOCK:start - k * BLOCK + n]

    def documents(self):
        """(doc_id, ids) in file order, holding one block and one document."""
        k, rest = 0, np.zeros(0, np.uint32)
        for doc_id, n in zip(self.doc_ids, self.counts.tolist()):
            have = [rest]
            size = len(rest)
            while size < n:
                have.append(self.block(k))
                size += len(have[-1])
                k += 1
            rest = np.concatenate(have) if len(have) > 1 else rest
            yield doc_id, rest[:n]
            rest = rest[n:]


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> DataFrame:
    """Encode whole texts (null: empty), add ``end_id`` and write files in
    ascending doc_id order (null first) below ``folder``. Returns one row a
    file: (path, part, seq, n_docs, n_ids). Texts move once, in a range
    exchange; a partition is streamed into files of about ``FILE_IDS``."""
    end = np.array([end_id], "<i4").tobytes()

    def run(batches):
        enc = encoder(tokenizer)
        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        part, done, out, name = TaskContext.get().partitionId(), [], None, ""

        def finish():
            out.close()
            done.append((f"{folder}/{name}", part, len(done), len(out.counts), out.n_ids))

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts(b)):
                if out is None:
                    name = f"{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.pfor"
                    out = FileWriter(filesystem.open_output_stream(f"{base}/{name}"))
                out.add(doc_id, np.frombuffer(enc.encode(text) + end, "<u4"))
                if out.n_ids >= FILE_IDS:
                    finish()
                    out = None
        if out is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*done), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                names=["path", "part", "seq", "n_docs", "n_ids"])

    ordered = (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(run, FILES)


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32) from the files that
    ``files`` lists; ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    listed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("bigint").alias("first"))

    def run(batches):
        for b in batches:
            for path, first in zip(b.column("path").to_pylist(), b.column("first").to_pylist()):
                filesystem, at = _filesystem(path)
                with filesystem.open_input_file(at) as source:
                    f = FileReader(source)
                    crc = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in f.documents()]
                    start = first + np.cumsum(f.counts) - f.counts
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids, pa.int64()), pa.array(start, pa.int64()),
                         pa.array(f.counts, pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # a row stands for a whole file, so the few rows are not gathered by size
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(tasks, "path").mapInArrow(run, ROWS)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to files in the shared folder and read them back.

    Empty table: no files, no rows. Repeated rows are written as often as
    they occur, equal ids in the order of their texts."""
    files = scratch_table(write_token_files(docs, tokenizer, scratch_path(docs.sparkSession, "token-ids"), end_id),
                          "token-files")
    return read_token_files(files)
