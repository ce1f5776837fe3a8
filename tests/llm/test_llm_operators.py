"""Every dealt operator against a brute-force version, and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from tallyhall.llm import (components, fingerprint, interpolation, neardup, packing, passages, pieces, quality, rules,
                           tokenfile, tokens, toxicity, trees)
from tallyhall.llm.common import fold, read_table
from tallyhall.llm.queries import QUERIES
from tallyhall.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0d]+")
BPE = tokens.public_path("word_bpe_49k.json")
SP = tokens.public_path("piece_bpe_32k.model")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    checkpoint_dir(spark)
    return read_table(spark, SMALL_SF_DIR, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted(docs.select("doc_id", "text").collect(), key=lambda r: r["doc_id"])


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, long and repeated texts, repeated rows
    and ids, and columns named like those the operators make."""
    checkpoint_dir(spark)
    rnd = random.Random(5)
    long = " ".join(rnd.choice("ab cd efg hijk lmnop").replace(" ", "x") + str(rnd.randint(0, 500)) for _ in range(30000))
    base = " ".join(f"word{k}" for k in range(80))
    text = [None, "", " \n\t ", "a", base, base, base + " tail", long, "ÀÉ ñ 中文 🙂 'tis IT'S", "x " * 300, None, base]
    rows = [(None if k in (3, 10) else min(k, 8), t, None if k % 3 else "en", None if k % 4 else "s", None if k % 2 else len(t or ""),
             float(k), k) for k, t in enumerate(text)]
    rows += [rows[4], rows[3]]
    return spark.createDataFrame(rows, DOCS + ", score double, fp long")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return read_table(spark, SMALL_SF_DIR, "labels")


def test_registered_queries_cover_all_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


# -- tokens, packing, files ------------------------------------------------

def _library_ids(texts):
    """By a tokenizer of its own, as it is loaded."""
    from tokenizers import Tokenizer
    return [x.ids for x in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]


def test_control_characters_added_tokens_and_marks():
    rnd = random.Random(7)
    some = [*map(chr, range(0, 33)), "\x7f", "\x80", "\x85", "\xa0", "\xad", "\u0301", "\u0308", "e", "E", "n", "\u200b", "\u2028", "\u3000", "\ufeff",
            "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "'s", "'LL", "9", "ß", "ẞ", "Ⅷ", "ﬁ", "İ", "中", "🙂", " ", "word", "."]
    texts = ["".join(rnd.choices(some, k=rnd.randint(0, 14))) for _ in range(20_000)] + some
    e = tokens.encoder(BPE)
    wrong = [(t, w) for t, w in zip(texts, _library_ids(texts)) if np.frombuffer(e.encode(t), "<i4").tolist() != w]
    assert not wrong, wrong[:5]


def test_cached_encoder_equals_the_library(rows):
    rnd = random.Random(1)
    alphabet = "aZ09'.,!é́ΣßÅİ 中 \x1f\t-_<|>smtrvel \u0085🙂"
    texts = [r["text"] for r in rows] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    texts += ["x<|endoftext|>y it's IT'S 12a3 'quote don't 're", "\x1cab\x1d c"]
    e = tokens.encoder(BPE)
    assert [np.frombuffer(e.encode(t), "<i4").tolist() for t in texts] == _library_ids(texts)


def test_plain_letters_and_full_caches_equal_the_library(monkeypatch):
    """Every letter below U+0250 and some beyond, alone and beside others; caches that turn over all the time."""
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokens, "CACHE_PARTS", 20)
    some = [*map(chr, range(0x250)), "ɐ", "ⱥ", "ⱦ", "Σ", "ς", "İ", "\u0301", "中"]
    texts = [f"{c} a{c} {c}a a{c}b É{c}{c} 1{c}2 '{c} {c}'s x{c}. {c}.. ab{c}'LL9" for c in some]
    e = tokens.WordIds(BPE)
    wrong = [(t, w) for t, w in zip(texts, _library_ids(texts)) if np.frombuffer(e.encode(t), "<i4").tolist() != w]
    assert not wrong, wrong[:5]
    assert len(e) <= 50 and len(e.parts) <= 20 and len(e.parts.before) <= 20


def test_the_model_is_asked_once_for_a_pre_token():
    """However its words are written: 18 words of one pre-token, 4 marks."""
    e, asked = tokens.WordIds(BPE), []

    class Model:
        def tokenize(self, part, model=e.tokenizer.model):
            asked.append(part)
            return model.tokenize(part)

    e.model = e.parts.model = Model()
    texts = [a + w + b for w in ("éuxrelond", "Éuxrelond", "ÉUXRELOND") for a in ("", "(") for b in ("", ".", ",")]
    assert [np.frombuffer(e.encode(t), "<i4").tolist() for t in texts] == _library_ids(texts)
    assert len(asked) == len(set(asked)) <= 1 + 4


def test_fullest_is_best_by_brute_force():
    rnd = random.Random(2)
    for _ in range(60):
        cap = rnd.randint(5, 30)
        items = [rnd.randint(1, cap) for _ in range(rnd.randint(1, 9))]
        got = packing.fullest(Counter(items), cap)
        first = max(items)
        rest = list(items)
        rest.remove(first)
        sums = {0}
        for x in rest:
            sums |= {s + x for s in sums}
        assert sum(k * n for k, n in got.items()) == first + max(s for s in sums if first + s <= cap)
        assert all(n <= Counter(items)[k] for k, n in got.items())


def _check_pack(p, expected):
    got = {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]): 0 for r in p}
    assert set(got) == set(expected)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in p) == Counter(expected)
    by = {}
    for r in p:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 2048
    return len(by)


def _pieces(pairs):
    out = []
    for (doc_id, _), ids in zip(pairs, _library_ids([t or "" for _, t in pairs])):
        ids = ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            out.append((doc_id, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def test_packing_is_exact_gapless_and_tight(docs, rows, odd, none):
    p = packing.pack(packing.document_pieces(docs, BPE)).collect()
    n = _check_pack(p, _pieces([(r["doc_id"], r["text"]) for r in rows]))
    assert n <= math.ceil(sum(r["length"] for r in p) / 2048) + 1
    pairs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    _check_pack(packing.pack(packing.document_pieces(odd, BPE)).collect(), _pieces(pairs))
    assert packing.pack(packing.document_pieces(none, BPE)).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 7, 4096, 65535):
        for top in (1, 2, 300, 1 << 20, 1 << 32):
            v = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            v[rng.random(n) < 0.03] = 4294967295
            for q in (0.0, 0.5, 0.95, 1.0):
                assert (tokenfile.decode_block(tokenfile.encode_block(v, q)) == v).all()
    v = np.arange(100, dtype=np.uint32) + 1000
    assert len(tokenfile.encode_block(v)) < 110


def test_token_files_round_trip_in_order(spark, docs, rows, odd, none, tmp_path):
    got = sorted(tokenfile.token_files(docs, BPE).collect(), key=lambda r: r["doc_id"])
    start = 0
    for r, g, ids in zip(rows, got, _library_ids([r["text"] for r in rows])):
        ids = ids + [2]
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == \
            (r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    strange = tokenfile.token_files(odd, BPE).collect()
    assert Counter(r["doc_id"] for r in strange) == Counter(r["doc_id"] for r in odd.select("doc_id").collect())
    spans = sorted((r["start"], r["n_tokens"]) for r in strange)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert tokenfile.token_files(none, BPE).count() == 0


def test_token_file_random_access(tmp_path):
    ids = [np.arange(n, dtype=np.uint32) * 7 % 50000 for n in (0, 1, 5000, 12345, 3)]
    with open(tmp_path / "x", "wb") as f:
        w = tokenfile.FileWriter(f)
        for k, v in enumerate(ids):
            w.add(None if k == 1 else k, v)
        w.close()

    class Source:
        def __init__(self, path):
            self.f, self.n = open(path, "rb"), path.stat().st_size  # noqa: SIM115

        def size(self):
            return self.n

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            return self.f.read(n)

    r = tokenfile.FileReader(Source(tmp_path / "x"))
    every = np.concatenate(ids)
    assert r.doc_ids == [0, None, 2, 3, 4] and (r.ids(4000, 9000) == every[4000:13000]).all()
    assert all((a == b).all() for (_, a), b in zip(r.documents(), ids))


# -- near-duplicates -------------------------------------------------------

def _simhash(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(fps, distance=3):
    par = list(range(len(fps)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                par[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def _expected_components(pairs):
    roots = _classes([_simhash(t) for _, t in pairs])
    least = {}
    for (d, _), r in zip(pairs, roots):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, least.get(r)) for (d, _), r in zip(pairs, roots)]


def test_near_duplicates_equal_brute_force(docs, rows, odd, none):
    for df in (docs, odd):
        pairs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = neardup.near_duplicates(df).collect()
        assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(_expected_components(pairs))
        assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in got) == Counter((d, _simhash(t)) for d, t in pairs)
    assert neardup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("bucket", [2, 8, 512])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, bucket, distance):
    checkpoint_dir(spark)
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    rnd = random.Random(bucket)
    fps = set()
    for _ in range(6):
        x = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                x ^= 1 << b
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["fp"]: r["root"] for r in neardup.classes(df, distance).collect()}
    want = _classes(fps, distance)
    assert len({*zip(want, (got[x] for x in signed))}) == len(set(want)) == len(set(got.values()))


def test_keep_first_keeps_one_row_of_each_component(odd, none):
    got = neardup.keep_first(odd)
    pairs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert got.columns == odd.columns and got.count() == len(set(_classes([_simhash(t) for _, t in pairs])))
    kept = [r["doc_id"] for r in got.collect() if (r["text"] or "").startswith("word0")]
    assert kept == [4]
    assert neardup.keep_first(none).count() == 0


def test_connected_components(spark):
    checkpoint_dir(spark)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 101), (200, 200)] + [(50, 60 + k) for k in range(30)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[k] for k in range(41)} == {0} and got[103] == 100 and {got[60 + k] for k in range(30)} == {50} and 200 not in got


# -- passages --------------------------------------------------------------

def _prose(rnd, n):
    return [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]


def test_planted_passages_are_found_and_clean_documents_left(spark):
    checkpoint_dir(spark)
    rnd = random.Random(9)
    passage, fuzzy = _prose(rnd, 60), _prose(rnd, 120)
    short = _prose(rnd, 30)
    texts = []
    for k in range(30):
        t = _prose(rnd, rnd.randint(20, 200))
        at = rnd.randint(0, len(t))
        if k % 3 == 0:
            t[at:at] = passage
        elif k % 3 == 1:
            f = list(fuzzy)
            for i in rnd.sample(range(120), 3):
                f[i] = f"edit{k}{i}"
            if k % 2:
                del f[40]
            t[at:at] = f
        else:
            t[at:at] = short
        texts.append((k, " ".join(t).upper() if k == 6 else " ".join(t)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = passages.passages(df).collect()
    found = {r["doc_id"]: r for r in got}
    assert set(found) == {k for k in range(30) if k % 3 < 2} - {0, 1}
    for k, r in found.items():
        words = dict(texts)[k].lower().split()[r["start"]:r["end"]]
        assert r["first_doc_id"] == (0 if k % 3 == 0 else 1)
        # exact passages are found to the word; an edit near an end of a fuzzy one may cost the words beyond it
        assert abs(len(words) - (60 if k % 3 == 0 else 120)) <= (0 if k % 3 == 0 else 10) and r["similarity"] >= 0.8
    left = {r["doc_id"]: r["text"] for r in passages.remove_passages(df).collect()}
    assert left[2] == texts[2][1] and passage[20] in left[0] and all(passage[20].upper() not in left[k].upper() for k in range(3, 30, 3))


def test_exact_repeats_are_covered(docs, rows):
    first, covered = {}, {}
    for r in rows:
        w = passages.word_hashes(r["text"].encode())
        for k in range(len(w) - 49):
            if first.setdefault(w[k:k + 50].tobytes(), r["doc_id"]) != r["doc_id"]:
                covered.setdefault(r["doc_id"], set()).update(range(k, k + 50))
    for r in passages.passages(docs).collect():
        covered.get(r["doc_id"], set()).difference_update(range(r["start"], r["end"]))
    assert not any(covered.values())


def test_repeated_lines_are_found(spark):
    checkpoint_dir(spark)
    rnd = random.Random(12)
    texts = []
    for p in (1, 2, 3, 4, 5, 8, 10, 13, 16, 24):
        line = _prose(rnd, p)
        for k in range(2):
            texts.append((2 * p + k, " ".join(_prose(rnd, 40) + (line * 200)[:200] + _prose(rnd, 40))))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    covered = {}
    for r in passages.passages(df).collect():
        covered.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    assert {d: 200 - len(c & set(range(40, 240))) for d, c in covered.items()} == {d: 0 for d, _ in texts if d % 2}


def _covered(spark, texts):
    checkpoint_dir(spark)
    out = {}
    for r in passages.passages(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        out.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    return out


def test_passages_whose_parts_lie_scattered_are_found(spark):
    """Twins share 80 words, whose parts stand in earlier documents as
    overlapping pieces too short for a passage, or in the first twin itself."""
    rnd = random.Random(21)
    texts, at = [], {}
    for g in range(40):
        p, base = _prose(rnd, 80), 10 * g
        texts += [(base, " ".join(_prose(rnd, 30) + p[:45] + _prose(rnd, 30))), (base + 1, " ".join(_prose(rnd, 30) + p[35:] + _prose(rnd, 30)))]
        texts += [(base + 5 + k, " ".join(_prose(rnd, 20 + k) + p + _prose(rnd, 20))) for k in range(2)]
        at[base + 6] = set(range(21, 101))
    for g in range(40, 60):
        p, base = _prose(rnd, 80), 10 * g
        first = _prose(rnd, 10) + p[40:] + _prose(rnd, 30) + p[:40] + _prose(rnd, 30) + p
        texts += [(base, " ".join(first)), (base + 1, " ".join(_prose(rnd, 15) + p + _prose(rnd, 15)))]
        at[base + 1] = set(range(15, 95))
    got = _covered(spark, texts)
    assert [d for d, want in at.items() if want - got.get(d, set())] == []


def test_fuzzy_recall_and_long_stretches(spark):
    """Passages of 60 words with up to 12 edits, each in 20 pairs; a long copy
    whose seeds lie in short earlier documents is followed to its end."""
    rnd = random.Random(22)
    texts, pairs = [], []
    for edits in (0, 3, 6, 9, 12):
        for _ in range(20):
            p, base = _prose(rnd, 60), 2 * len(pairs)
            q = list(p)
            for i in rnd.sample(range(60), edits):
                q[i] = f"edit{i}"
            texts += [(base, " ".join(_prose(rnd, 40) + p + _prose(rnd, 40))), (base + 1, " ".join(_prose(rnd, 25) + q + _prose(rnd, 25)))]
            pairs.append(base + 1)
    long = _prose(rnd, 3000)
    texts += [(1000 + k, " ".join(long[k:k + 30] + _prose(rnd, 30))) for k in range(0, 3000, 25)]
    texts += [(8000, " ".join(long)), (8001, " ".join(_prose(rnd, 5) + long))]
    got = _covered(spark, texts)
    found = sum(len(got.get(d, set()) & set(range(25, 85))) >= 45 for d in pairs)
    assert found >= 0.9 * len(pairs)
    assert set(range(5, 3005)) <= got[8001] and 8000 not in got


def test_long_seeds_are_shared_and_a_bucket_stays_small(spark):
    rnd = np.random.default_rng(3)
    words = [rnd.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) for n in (50, 51, 120, 300)]
    same = rnd.integers(0, 1 << 32, 50, dtype=np.uint64).astype(np.uint32)
    for w in words[2:]:
        w[30:80] = same
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    at, h = passages.long_seeds(np.concatenate(words), start, size)
    doc = np.searchsorted(start, at, "right") - 1
    assert (at - start[doc] + passages.LONG <= size[doc]).all() and set(doc) == {0, 1, 2, 3}
    assert set(h[doc == 2]) & set(h[doc == 3])
    for k, w in enumerate(words):  # the same alone as among others
        alone, hashes = passages.long_seeds(w, np.array([0]), np.array([len(w)]))
        assert hashes.tolist() == h[doc == k].tolist() and alone.tolist() == (at - start[doc])[doc == k].tolist()


def test_chains_by_brute_force():
    rnd = random.Random(4)
    for _ in range(40):
        pts = sorted({(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(rnd.randint(1, 9))})
        xs, ys = zip(*pts)
        best = {}
        for i, (x, y) in enumerate(pts):
            before = [best[j] - passages.GAP_COST * (x - pts[j][0] + y - pts[j][1]) for j in range(i)
                      if pts[j][0] < x and pts[j][1] < y]
            best[i] = passages.K + max([0, *before])
        got = passages.chains(list(xs), list(ys), least=1)
        score = passages.K * len(got[0][0]) - passages.GAP_COST * sum(
            b - a for s in got[0] for a, b in zip(s, s[1:]))
        assert score == pytest.approx(max(best.values()))


def test_passages_of_odd_input(odd, none):
    got = passages.passages(odd).collect()
    assert all(r["end"] - r["start"] >= 50 for r in got)
    left = passages.remove_passages(odd)
    assert left.columns == odd.columns and left.where("text like 'word0%'").select("doc_id").distinct().count() == 1
    assert left.where("text is null").count() == 2
    assert passages.passages(none).count() == 0 and passages.remove_passages(none).count() == 0


# -- rules, fingerprints ---------------------------------------------------

def _rule_counts(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    marked = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            marked.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))


def test_rules_equal_brute_force(docs, odd, none):
    for df in (docs, odd):
        want = Counter((r["doc_id"], *_rule_counts(r["text"])) for r in df.select("doc_id", "text").collect())
        got = rules.quality_rules(df).collect()
        assert Counter((r["doc_id"], *(r[c] for c in rules.COUNTS)) for r in got) == want
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
            assert r["kept"] is False if r["base_failed"] else r["kept"] is not None
    assert rules.quality_rules(none).count() == 0


def test_sketch_merges_exactly_and_bounds_the_error(spark):
    rnd = random.Random(8)
    v = [(k % 3, int(rnd.expovariate(1 / 5000))) for k in range(3000)]
    df = spark.createDataFrame(v, "g int, value long")
    parts = rules.sketch(df, ["g"])
    whole = rules.merge(parts, [])
    assert {(r["top"], r["n"]) for r in whole.collect()} == \
        {(r["top"], r["n"]) for r in rules.sketch(df.withColumn("z", F.lit(1)), ["z"]).drop("z").collect()}
    q = rules.quantiles(parts, ["g"], low=0.25, high=0.75).collect()
    for r in q:
        s = sorted(x for g, x in v if g == r["g"])
        for c, share in (("low", 0.25), ("high", 0.75)):
            exact = s[math.ceil(share * len(s)) - 1]
            assert exact <= r[c] <= exact * (1 + 1 / 64) + 1


def _fingerprint(text):
    votes, total = [0] * 64, 0
    for w in WORD.findall(text or ""):
        h, n = xxhash.xxh64_intdigest(w.encode(), 42), min(len(w), 15)
        total += n
        for b in range(64):
            votes[b] += n * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def test_fingerprints_equal_brute_force(spark, docs, rows, odd, none, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 16)
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    t = [r["text"] for r in rows][::-1]
    ids = [r["doc_id"] for r in rows][::-1]
    fps = [_fingerprint(x) for x in t]
    for k, (i, x, n, nf) in enumerate(zip(ids, t, t[1:] + t[:1], fps[1:] + fps[:1])):
        h = len(x) // 2
        e = x[:len(x) - h] + n[:h]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(x), hashlib.sha256(e.encode()).hexdigest())
        assert r["fp"] & (1 << 64) - 1 == fps[k] and r["edited_fp"] & (1 << 64) - 1 == _fingerprint(e)
        assert r["near_edited"] == 1 - (fps[k] ^ _fingerprint(e)).bit_count() / 64
        assert r["near_next"] == 1 - (fps[k] ^ nf).bit_count() / 64
        near = sum((fps[k] ^ y).bit_count() <= 3 for y in fps) - 1
        assert r["n_near"] == (near if i % 20 == 0 else None)
    strange = fingerprint.fingerprints(odd).collect()
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in strange) == \
        Counter((r["doc_id"], _fingerprint(r["text"])) for r in odd.select("doc_id", "text").collect())
    assert all(r["near_next"] is not None for r in strange)
    assert fingerprint.fingerprints(none).count() == 0
    one = fingerprint.fingerprints(docs.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_long_texts_of_one_long_word_overflow_no_lane(spark):
    """All votes for the same bits, at full weight, in the lane that ends in the sign."""
    words = ["abcdefghijklmnopqrstuvwxyz", "Haftungsausschluss", "abcdefgh"]
    assert all(xxhash.xxh64_intdigest(w.encode(), 42) >> 48 for w in words)
    texts = [f"{w} " * n for w in words for n in (2048, 2049, 4096, 9000)] + [" ".join(words * 3000), "short"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in fingerprint.fingerprints(docs).collect()}
    assert got == {k: _fingerprint(t) for k, t in enumerate(texts)}
    # no sum of a piece reaches the sign, whatever the words
    assert fingerprint.PIECE * fingerprint.WEIGHT < 1 << 15


@pytest.mark.parametrize("radius", [1, 3, 5])
def test_radius_search_equals_brute_force(spark, radius):
    rnd = random.Random(radius)
    fps = [rnd.getrandbits(64) for _ in range(150)]
    fps += [x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 7))) for x in fps[:120]]
    s = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in s], "fp long")
    got = fingerprint.within_radius(df.limit(100), df, radius)
    want = {(s[a], s[b]) for a in range(100) for b in range(len(s)) if (fps[a] ^ fps[b]).bit_count() <= radius}
    found = [(r["q"], r["fp"]) for r in got.collect()]
    assert len(found) == len(set(found)) and {p for p in found if p[0] in s[:100]} == want


def test_permuted_tables_are_not_broadcast(spark):
    """A side is small before each fingerprint becomes a row of every table."""
    df = spark.range(3000).select(F.xxhash64("id").alias("fp"))
    got = fingerprint.within_radius(df.where(F.col("fp") % 20 == 0), df, 3)
    assert got.where("q = fp").count() == df.where(F.col("fp") % 20 == 0).count()
    got.collect()  # the plan that ran, not the first one
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan


# -- language model, pieces ------------------------------------------------

def _lm(pairs, order=2):
    """Token-by-token version of the model, with its own counts and weights."""
    fold_of = [zlib.crc32(b"" if d is None else str(d).encode()) % 5 for d, _ in pairs]
    toks = [[w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + [None]
            for _, t in pairs]

    def counts(keep):
        uni, big, n = Counter(), Counter(), 0
        for f, t in zip(fold_of, toks):
            if keep(f):
                n += 1
                uni.update(t)
                big.update(zip(["<"] + t, t))
        return uni, big, n

    def estimates(t, c):
        uni, big, n = c
        total, v = sum(uni.values()), len(uni)
        for h, w in zip(["<"] + t, t):
            ch = n if h == "<" else uni[h]
            bucket = 64 + math.frexp(ch)[1] if ch else 0
            yield bucket, (1 / (v + 1), uni[w] / max(total, 1), big[h, w] / max(ch, 1))

    part = counts(lambda f: f not in (1, 2))
    hist = Counter()
    for f, t in zip(fold_of, toks):
        if f == 2:
            for bucket, p in estimates(t, part):
                code = bucket
                for x in p[1:]:
                    s = 0 if x == 0 else min(2047, int(np.round(4 * np.log2(x / p[0])) + 512))
                    code = code << 11 | s
                hist[code] += 1
    weights = interpolation._table(interpolation.mixture_weights(list(hist.items()), order), order)
    whole = counts(lambda f: f != 1)
    n, v = sum(whole[0].values()), len(whole[0])
    out = []
    for (d, _), f, t in zip(pairs, fold_of, toks):
        score = sum(math.log10(sum(a * b for a, b in zip(weights[k], p))) for k, p in estimates(t, whole))
        base = sum(math.log10((whole[0][w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((d, f == 1, len(t), sum(whole[0][w] > 0 for w in t), n, base, score))
    return out


def test_lm_scores_equal_brute_force(docs, rows, odd, none, monkeypatch):
    monkeypatch.setattr(interpolation, "CHUNK", 5000)
    for df in (docs, odd):
        key = lambda r: tuple((x is None, x) for x in r[:5]) + tuple(round(x, 4) for x in r[5:])
        got = sorted((tuple(r) for r in interpolation.score(df).collect()), key=key)
        want = sorted(_lm([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]), key=key)
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5:] for g in got], [w[5:] for w in want])
    assert interpolation.score(none).count() == 0


def test_lm_beats_the_base_on_held_out_text(docs):
    r = interpolation.score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_lm_of_order_three_runs(docs):
    r = interpolation.score(docs, order=3).agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert r[2] == docs.count() and r[1] < 0


def test_pieces_equal_the_library_and_round_trip(docs, rows, odd, none, monkeypatch):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    monkeypatch.setattr(pieces, "CHUNK", 4000)
    monkeypatch.setattr(pieces, "RANGE_UNITS", 500)
    for df in (docs, odd):
        pairs = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
        got = [(r["doc_id"], np.frombuffer(r["ids"], "<i4").tolist(), r["text_crc32"]) for r in pieces.encode(df, SP).collect()]
        want = [(d, sp.encode(t), zlib.crc32(t.encode())) for d, t in pairs]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert all(pieces.decode(sp.encode(t), SP) == t for _, t in pairs)
    assert pieces.encode(none, SP).count() == 0


def test_long_units_fold_as_short_ones(monkeypatch):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    p = pieces.pieces(SP)
    score = {x: s for x, _, s in p.rows}
    rnd = random.Random(6)
    for short in (0, 24):
        monkeypatch.setattr(pieces, "SHORT", short)
        for _ in range(200):
            w = "▁" + "".join(rnd.choice("thaeinorsd,.A1") for _ in range(rnd.randint(1, 40)))
            edges = {(a, z): score[w[a:z]] for a in range(len(w)) for z in range(a + 2, min(len(w), a + 16) + 1) if w[a:z] in score}
            ends = pieces.merge(len(w), edges)
            assert [w[a:z] for a, z in zip([0, *ends], ends)] == sp.encode(w[1:], out_type=str)


def test_viterbi_fold_finds_the_best_path(spark):
    rnd = random.Random(7)
    table = {"a": -1.0, "b": -1.5, "ab": -2.0, "ba": -2.2, "aba": -2.9, "bb": -2.4, "c": -1.0, "abc": -3.1}
    units = sorted({"".join(rnd.choice("abcx") for _ in range(rnd.randint(1, 7))) for _ in range(60)} | {"ab"})
    t = spark.createDataFrame([(p, k, s) for k, (p, s) in enumerate(table.items())], "piece string, id int, score float")
    t = t.withColumn("key", F.xxhash64("piece"))
    v = spark.createDataFrame([(0, u) for u in units], "range int, unit string")
    names = list(table)
    got = {r["unit"]: r["path"] for r in pieces.viterbi(pieces.lattice(v, t, 3, least=1)).collect()}

    def best(u):
        if not u:
            return 0.0
        return max((table.get(u[:k], -1e6 if k == 1 else -1e18) + best(u[k:]) for k in range(1, len(u) + 1)))

    for u in units:
        if set(u) <= {"x"}:
            assert u not in got  # no edge at all
            continue
        total = sum(table[names[e["id"]]] if e["id"] >= 0 else -1e6 for e in got[u])
        assert total == pytest.approx(best(u), rel=1e-6)


# -- classifiers -----------------------------------------------------------

def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.N_FEATURES), rng.normal(size=(quality.N_FEATURES, quality.FACTORS)))
    rows = [quality.features(t, n) for t, n in (("one two two three!", 5), ("", None), ("A | b\nA | b", 9))]
    for (i, x), got in zip(rows, m.margin(rows)):
        w, v = m.wv[i, 0].astype(float), m.wv[i, 1:].astype(float)
        want = 0.3 + w @ x + sum(v[a] @ v[b] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert got == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_isotonic_is_monotone_and_calibrated():
    rng = np.random.default_rng(2)
    z = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-3 * z))).astype(float)
    c = trees.fit_isotonic(z, y, y.mean())
    p = np.interp(np.linspace(-3, 3, 100), c.at, c.chance)
    assert (np.diff(p) >= 0).all() and abs(np.interp(0.5, c.at, c.chance) - 1 / (1 + np.exp(-1.5))) < 0.12


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = trees.fit_boosted(x[:1500], y[:1500], rounds=60, depth=3)
    assert (((m.margin(x[1500:]) > 0) == y[1500:]).mean()) > 0.9


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.3), (toxicity, "toxic", 0.5)])
def test_classifiers_hold_out_and_score_all(spark, odd, none, labels, module, label, least):
    d = read_table(spark, "/root/testdata/sf0.01", "documents")
    known = read_table(spark, "/root/testdata/sf0.01", "labels")
    model = module.fit(d, known, label)
    got = module.score(d, model, "p").join(known, "doc_id").where(fold("doc_id") == 0)
    acc = got.agg(F.avg(((F.col("p") >= least).cast("int") == F.col(label)).cast("double"))).first()[0]
    assert acc > 0.85
    # labels of the held-out fold are not looked at
    flipped = known.withColumn(label, F.when(fold("doc_id") == 0, 1 - F.col(label)).otherwise(F.col(label)))
    again = module.fit(d, flipped, label)
    a, b = (module.score(d.limit(50), m, "p").select("doc_id", "p").orderBy("doc_id").collect() for m in (model, again))
    assert a == b
    strange = module.score(odd, model, "p")
    assert strange.columns == [*odd.columns, "p"] and strange.where("p between 0 and 1").count() == odd.count()
    assert module.score(none, module.fit(none, labels.limit(0), label), "p").count() == 0
    assert module.fit(odd, labels.select(F.lit(None).cast("long").alias("doc_id"), label), label).predict([]) is not None


def test_insults_in_disguise():
    f = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t)[0]))
    assert f("you are an idiot, really")["near_second"] == 1
    assert f("what an 1d10t you are")["disguised"] >= 1 and f("so st*pid of you")["disguised"] >= 1
    assert f("you l o s e r")["spelled_out"] == 1 and f("stuuupid thing")["stretched"] == 1
    assert f("a calm text about rivers")["bad_any"] == 0


# -- pipeline --------------------------------------------------------------

def test_pipeline_stages(spark, odd, none):
    import corpus_pipeline as c
    assert [n for n, _ in c.STAGES] == ["toxicity", "quality classifier", "SimHash near-dedup", "substring dedup", "best-fit packing"]
    d = read_table(spark, "/root/testdata/sf0.01", "documents")
    sizes = [d.count()]
    for name, stage in c.STAGES[:-1]:
        d = spark.createDataFrame(stage(spark, d, "/root/testdata/sf0.01").toPandas(), d.schema)
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        sizes.append(d.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    left = neardup.near_duplicates(d).groupBy("component_id").count().where("count > 1")
    assert left.count() <= 0.01 * sizes[-1]  # texts that became alike when passages were cut
    packed = c.run(spark, SMALL_SF_DIR)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    for name, stage in c.STAGES:
        for table in (odd, none):
            got = stage(spark, table, SMALL_SF_DIR)
            assert got.count() <= 100 and (name == "best-fit packing" or got.columns == table.columns)
