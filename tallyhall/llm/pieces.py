"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into units where no piece can reach across: before a word mark
that follows other letters, and around line ends. Every distinct
unit is encoded once. Its substrings of up to ``MAX_PIECE`` letters are
exploded and equi-joined with the piece table, which gives the edges of the
unit's lattice; edges are grouped by unit and folded into the best path.

Two folds read the lattice:

* ``viterbi``: the path with the greatest sum of piece scores, folded with the
  higher-order function ``aggregate``; right for unigram models;
* ``merge``: of all edges that join just two neighbouring segments, the one
  with the best score (leftmost of equals) is taken, until none is left; right
  for BPE models, whose scores rank merges and do not add up.

Documents are held as chunks with their own list of units. Chunks ask for
their units' ids by ranges of unit hashes; a unit is asked for once a chunk,
so none is hot, and the ranges are as many as keep a task's share bounded.

Nulls: a null text is an empty one and gives no ids; a null doc_id is kept.
Repeated rows are encoded as often as they occur. An empty table gives no
rows. Other columns are ignored. Letters without a piece become byte pieces,
or the unknown piece if the model has none.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhall.llm.blobs import pack_counts, unpack_counts
from tallyhall.llm.common import bucketed_table

MARK = "▁"
#: Units that one chunk holds, about.
CHUNK = 2_000_000
#: Units of a chunk that are written as small numbers.
HEAD = 16_384
#: Letters of a unit whose joins are simply looked through.
SHORT = 24
#: Units that one range holds, about.
RANGE_UNITS = 400_000
_UNIT = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_CUT = re.compile("\n")


class Pieces:
    """A model's pieces, their scores, and its byte pieces."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(sp.vocab_size())]
        self.rows = [(sp.id_to_piece(i), i, sp.get_score(i)) for i in range(sp.vocab_size()) if not special[i]]
        self.id = {p: i for p, i, _ in self.rows}
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(sp.vocab_size()) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.score = np.array([sp.get_score(i) for i in range(sp.vocab_size())])
        self.max_piece = max((len(p) for p, _, _ in self.rows), default=1)
        self.text = {i: p.encode() for p, i, _ in self.rows} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.spelt = np.empty(sp.vocab_size(), object)  # by id
        self.spelt[:] = [self.text.get(i, b"") for i in range(sp.vocab_size())]
        if any(MARK in p.lstrip(MARK) or len(p) > 1 and _CUT.search(p) for p, _, _ in self.rows):
            raise ValueError("a piece reaches across the places where texts are cut")

    def table(self, spark: SparkSession) -> DataFrame:
        """(key, piece, id, score): as many rows as the vocabulary has."""
        t = spark.createDataFrame(self.rows, "piece string, id int, score float")
        return t.withColumn("key", F.xxhash64("piece"))

    def spell(self, letter: str) -> list[int]:
        """Ids of one letter."""
        if letter in self.id:
            return [self.id[letter]]
        return [self.bytes.get(b, self.unknown) for b in letter.encode("utf-8", "replace")]

    def decode(self, ids) -> bytes:
        """UTF-8 of the ids' pieces, word marks still in it."""
        return b"".join([self.text.get(i, b"") for i in ids])


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def units(text: str) -> list[str]:
    """A text with its dummy prefix, cut where no piece reaches across."""
    return _UNIT.findall(MARK + text.replace(" ", MARK)) if text else []


class Places(dict):
    """Units by the text they come from, numbered as first seen: ``x`` is the
    unit of a word with its mark, a line end followed by ``x`` that of a word
    at the start of a line, without one. The latter's numbers are held as
    -1 - n, for they stand for a line end too."""

    def __missing__(self, key: str) -> int:
        n = len(self)
        self[key] = got = -1 - n if key[:1] == "\n" and len(key) > 1 else n
        return got

    def units(self) -> list[str]:
        return [MARK + k if k[:1] != "\n" else k[1:] or k for k in self]

    def of(self, text: str) -> np.ndarray:
        """The numbers of a text's ``units``."""
        lines = text.replace("\n", " \n")
        if not text or "  " in lines or lines[0] == " " or lines[-1] == " " or MARK in lines:
            found = [self[u[1:] if u[0] == MARK else u if u == "\n" else "\n" + u] for u in units(text)]
            return np.array([n if n >= 0 else -1 - n for n in found], np.int32)
        words = lines.split(" ")
        n = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        starts = n < 0
        if not starts.any():
            return n
        end = np.cumsum(1 + starts)
        out = np.empty(end[-1], np.int32)
        out[end - 1] = np.where(starts, -1 - n, n)
        out[end[starts] - 2] = self["\n"]
        return out


def lattice(vocabulary: DataFrame, table: DataFrame, max_piece: int, least: int = 2, packed: bool = False) -> DataFrame:
    """(range, unit, edges) of the distinct units with an edge; a vocabulary
    partitioned by range or unit stays so, else the edges are. An edge is a struct (start, size, id, score) for a substring of
    ``least`` letters or more that is a piece. Packed, it is one long: start,
    8 bits of size, 24 bits of id."""
    size = F.length("unit")
    s = (vocabulary.where(size >= least)
         .select("range", "unit", F.explode(F.sequence(F.lit(0), size - least)).alias("start"))
         .select("range", "unit", "start",
                 F.explode(F.sequence(F.lit(least), F.least(F.lit(max_piece), size - F.col("start")))).alias("size"))
         .withColumn("piece", F.substring("unit", F.col("start") + 1, F.col("size")))
         .withColumn("key", F.xxhash64("piece")))
    found = s.join(F.broadcast(table.withColumnRenamed("piece", "known")), "key").where("piece = known")
    edge = F.struct("start", "size", "id", "score")
    if packed:
        edge = F.expr("shiftleft(cast(start as bigint), 32) + shiftleft(cast(size as bigint), 24) + id")
    return found.groupBy("range", "unit").agg(F.collect_list(edge).alias("edges"))


def viterbi(grouped: DataFrame, unknown: float = -1e6) -> DataFrame:
    """(unit, path): starts and ids of the path with the greatest sum of
    scores, by a fold over the places of the unit. A letter without an edge
    is passed at the cost ``unknown``, with id -1. Of equal paths the one
    whose last piece is longest wins."""
    best = ("aggregate(sequence(1, length(unit)), "
            "array(named_struct('score', cast(0 as double), 'start', 0, 'id', -1)), "
            "(state, n) -> concat(state, array(aggregate("
            "filter(array_sort(edges), e -> e.start + e.size = n), "
            f"named_struct('score', state[n - 1].score + cast({unknown} as double), 'start', n - 1, 'id', -1), "
            "(a, e) -> if(state[e.start].score + cast(e.score as double) > a.score, "
            "named_struct('score', state[e.start].score + cast(e.score as double), 'start', e.start, 'id', e.id), a)))))")
    path = ("aggregate(sequence(1, length(unit)), named_struct('at', length(unit), 'path', "
            "cast(array() as array<struct<start: int, id: int>>)), "
            "(s, n) -> if(s.at > 0, named_struct('at', best[s.at].start, 'path', concat(array(named_struct("
            "'start', best[s.at].start, 'id', best[s.at].id)), s.path)), s), s -> s.path)")
    return grouped.withColumn("best", F.expr(best)).select("unit", F.expr(path).alias("path"))


def merge(n: int, edges: dict[tuple[int, int], float]) -> list[int]:
    """Where the segments of a unit of ``n`` letters end. ``edges``: (start,
    end) -> score. Of the joins at hand the best is made, the leftmost of
    equals."""
    if n <= SHORT:
        none = float("-inf")
        at = list(range(n + 1))
        joins = [edges.get((i, i + 2), none) for i in range(n - 1)]
        while joins and (best := max(joins)) > none:
            k = joins.index(best)
            del at[k + 1], joins[k]
            if k:
                joins[k - 1] = edges.get((at[k - 1], at[k + 1]), none)
            if k < len(joins):
                joins[k] = edges.get((at[k], at[k + 2]), none)
        return at[1:]
    # the same by a queue, for long units
    left, right, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    alive, todo = [True] * n, []

    def offer(a: int):
        b = right[a]
        if b < n and (a, end[b]) in edges:
            heapq.heappush(todo, (-edges[a, end[b]], a, end[b]))

    for a in range(n - 1):
        offer(a)
    while todo:
        _, a, e = heapq.heappop(todo)
        b = right[a]
        if not alive[a] or b >= n or end[b] != e:
            continue
        alive[b] = False
        end[a], right[a] = e, right[b]
        if right[a] < n:
            left[right[a]] = a
        offer(a)
        if left[a] >= 0:
            offer(left[a])
    return [end[a] for a in range(n) if alive[a]]


def merged(grouped: DataFrame, path: str) -> DataFrame:
    """(range, unit, ids) by the ``merge`` fold over a packed lattice."""
    def run(batches):
        p = pieces(path)
        for b in batches:
            column = b.column("edges")
            flat = column.flatten().to_numpy()
            start, ids = flat >> 32, flat & 0xFFFFFF
            spans = list(zip(start.tolist(), (start + (flat >> 24 & 0xFF)).tolist()))
            scores = p.score[ids].tolist()
            ends = np.cumsum(column.value_lengths().to_numpy()).tolist()
            out = []
            for unit, a, z in zip(b.column("unit").to_pylist(), [0, *ends], ends):
                got, s = [], 0
                for e in merge(len(unit), dict(zip(spans[a:z], scores[a:z]))):
                    got += [p.id[unit[s:e]]] if e > s + 1 else p.spell(unit[s])
                    s = e
                out.append(array("i", got).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("range"), b.column("unit"), pa.array(out, pa.binary())],
                                             names=["range", "unit", "ids"])

    return grouped.mapInArrow(run, "range int, unit string, ids binary")


def _pack_units(raw: list[bytes]) -> bytes:
    head = pack_counts(np.array([len(r) for r in raw]))
    return len(head).to_bytes(4, "little") + head + zstandard.compress(b"".join(raw), 3)


def _slices(raw: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [raw[a:z] for a, z in zip([0, *ends], ends)]


def _unpack_units(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    return _slices(zstandard.decompress(data[4 + n:]), unpack_counts(data[4:4 + n]))


def _pack_ids(ids: list[bytes]) -> bytes:
    head = pack_counts(np.array([len(x) // 4 for x in ids]))
    return len(head).to_bytes(4, "little") + head + pack_counts(np.frombuffer(b"".join(ids), "<i4"))


def _unpack_ids(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each unit has, and all ids."""
    n = int.from_bytes(data[:4], "little")
    return unpack_counts(data[4:4 + n]), unpack_counts(data[4 + n:])


def _tokens(places: np.ndarray, n: int) -> tuple[bytes, bytes]:
    """Places, the ``HEAD`` most frequent of them written as small numbers,
    and what these stand for."""
    head = np.argsort(-np.bincount(places, minlength=n), kind="stable")[:HEAD]
    code = np.arange(n) + len(head)
    code[head] = np.arange(len(head))
    return pack_counts(code[places]), pack_counts(head)


def _places(tokens: bytes, head: bytes) -> np.ndarray:
    code, first = unpack_counts(tokens), unpack_counts(head)
    small = code < len(first)
    code[small] = first[code[small]]
    code[~small] -= len(first)
    return code


def chunks(docs: DataFrame, ranges: int) -> DataFrame:
    """(chunk, ids, sizes, tokens, head, ranges, units): documents gathered
    with their distinct units, in order of range, packed range by range;
    tokens and head are places among them."""
    def run(batches):
        part, made, held, n = TaskContext.get().partitionId() << 32, 0, [], 0
        place = Places()

        def flush():
            nonlocal made
            made += 1
            raw = [u.encode() for u in place.units()]
            place.clear()
            # by range, units that begin alike together
            of = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) * ranges >> 32
            start = np.array(raw, "S11").view(np.uint8).reshape(-1, 11)[:, 3:]  # less the mark
            order = np.lexsort((np.ascontiguousarray(start).view(">u8").ravel().astype("<u8"), of))
            new = np.empty(len(raw), np.int64)  # first seen -> place in that order
            new[order] = np.arange(len(raw))
            tokens, head = _tokens(new[np.concatenate([w for _, w in held])], len(raw))
            present, first = np.unique(of[order], return_index=True)
            parts = [_pack_units([raw[k] for k in g.tolist()]) for g in np.split(order, first[1:])] if raw else []
            return pa.RecordBatch.from_arrays(
                [pa.array([part + made], pa.int64()), pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                 pa.array([[len(w) for _, w in held]], pa.list_(pa.int32())), pa.array([tokens], pa.binary()),
                 pa.array([head], pa.binary()), pa.array([present.tolist()], pa.list_(pa.int32())),
                 pa.array([parts], pa.list_(pa.binary()))],
                names=["chunk", "ids", "sizes", "tokens", "head", "ranges", "units"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):  # one text at a time
                held.append((doc_id, place.of(text.as_py() or "")))
                n += len(held[-1][1])
                if n >= CHUNK:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "chunk bigint, ids array<bigint>, sizes array<int>, tokens binary, head binary, ranges array<int>, units array<binary>")


def vocabulary(asked: DataFrame) -> DataFrame:
    """(range, unit): the distinct units of all requests."""
    def run(table: pa.Table) -> pa.Table:
        found = sorted(set().union(*map(_unpack_units, table.column("units").to_pylist())))
        return pa.table([pa.array([table.column("range")[0].as_py()] * len(found), pa.int32()), pa.array(found, pa.binary()).cast(pa.string())],
                        names=["range", "unit"])

    return asked.groupBy("range").applyInArrow(run, "range int, unit string")


def answers(asked: DataFrame, dictionary: DataFrame, path: str) -> DataFrame:
    """(range, chunk, ids) for every request, in the order of its units; a
    unit without an edge is spelt letter by letter."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        p = pieces(path)

        def spelt(unit: bytes) -> bytes:
            return np.array([i for c in unit.decode() for i in p.spell(c)], "<i4").tobytes()

        of = dict(zip(right.column("unit").cast(pa.binary()).to_pylist(), right.column("ids").to_pylist()))
        got = [_pack_ids([of.get(u) or spelt(u) for u in _unpack_units(x)]) for x in left.column("units").to_pylist()]
        return pa.table([left.column("range").cast(pa.int32()), left.column("chunk").cast(pa.int64()), pa.array(got, pa.binary())],
                        names=["range", "chunk", "ids"])

    return (asked.groupBy("range").cogroup(dictionary.groupBy("range"))
            .applyInArrow(run, "range int, chunk bigint, ids binary"))


ENCODED = "doc_id bigint, ids binary, text_crc32 bigint"


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text_crc32): the ids of every whole text as little-endian
    int32, and the crc32 of the text that they decode to."""
    spark = docs.sparkSession
    p = pieces(model)
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, -(-size // (40 * RANGE_UNITS)))
    chunked = bucketed_table(chunks(docs, ranges), "unit_chunks", "chunk")
    asked = chunked.select("chunk", F.explode(F.arrays_zip("ranges", "units")).alias("r")).select(
        F.col("r.ranges").alias("range"), "chunk", F.col("r.units").alias("units"))
    known = vocabulary(asked)
    # edges of a unit stand together already: group them by hash, not by sorting
    # and once the dictionary is written, what was exchanged for it can go
    confs = {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": str(1 << 20),
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, v)
    try:
        # a task folds about one range, and writes it where the answers look it up
        grouped = lattice(known.repartition(ranges, "range"), p.table(spark), p.max_piece, packed=True)
        dictionary = bucketed_table(merged(grouped, model), "unit_ids", "range")
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    got = (answers(asked, dictionary, model).groupBy("chunk")
           .agg(F.array_sort(F.collect_list(F.struct("range", "ids"))).alias("got")))  # as many as the ranges

    def run(batches):
        spelt = pieces(model).spelt
        for b in batches:
            for ids, sizes, tokens, head, answer in zip(*(b.column(c) for c in ("ids", "sizes", "tokens", "head", "got"))):
                ids, sizes = ids.as_py(), sizes.as_py()  # one chunk at a time
                parts = [_unpack_ids(g["ids"]) for g in answer.as_py() or ()]
                n_ids = np.concatenate([x for x, _ in parts] or [np.empty(0, np.int64)])
                flat = np.concatenate([x for _, x in parts] or [np.empty(0, np.int64)])
                texts, ends = spelt[flat].tolist(), np.cumsum(n_ids).tolist()
                plain = [b"".join(texts[a:z]) for a, z in zip([0, *ends], ends)]
                del texts, parts
                flat, first = flat.astype("<i4"), np.cumsum(n_ids) - n_ids
                places = _places(tokens.as_py(), head.as_py())
                out, crc, at = [], [], 0
                for n in sizes:
                    mine = places[at:at + n]
                    at += n
                    long = n_ids[mine]
                    out.append(flat[np.repeat(first[mine] - np.cumsum(long) + long, long) + np.arange(long.sum())].tobytes())
                    crc.append(zlib.crc32(b"".join(map(plain.__getitem__, mine.tolist())).replace(MARK.encode(), b" ")[1:]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "ids", "text_crc32"])

    return chunked.select("chunk", "ids", "sizes", "tokens", "head").join(got, "chunk", "left").mapInArrow(run, ENCODED)


def decode(ids: list[int], model: str) -> str:
    """The text of a list of ids."""
    return pieces(model).decode(ids).replace(MARK.encode(), b" ")[1:].decode("utf-8", "replace")
