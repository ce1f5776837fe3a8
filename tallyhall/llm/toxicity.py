"""Toxicity scores: gradient-boosted trees over dense features.

A document's features are lexicon densities, how close insults stand to a
second-person word, rates of capitals and punctuation, and rates of disguised
words (``1d10t``, ``st*pid``, ``l o s e r``, ``stuuupid``). Beside the listed
lexicons one is learned: words, and stems of 4 to 7 bytes, that toxic
documents of the sample use and others hardly do. The trees see, for each
part of the sample, the lexicon that the other parts teach; a document and
its near copies fall in one part and count once, so that a much copied text
does not make its words look toxic. Trees are fitted with the logistic loss;
isotonic regression on rows held back from them calibrates their margin.

Nulls: a null text is an empty one, which scores like any other. Repeated
rows get equal scores. An empty table gives no rows; without labels of both
kinds every score is the share of toxic labels (0 without any label). Columns
named like an output column are replaced by it in the query; the operator
adds one column whose name the caller chooses.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import in_worker, texts, with_columns
from tallyhall.llm.sample import labelled_sample
from tallyhall.llm.trees import fit_boosted, fit_isotonic

#: Labelled documents that the model is fitted on, at most.
MAX_DOCS = 16_000

LEXICON = {
    "insult": """idiot idiots moron morons loser losers clown clowns scum trash garbage imbecile fool fools
        jerk jerks creep creeps coward cowards pig pigs rat rats vermin filth dimwit dunce halfwit bastard
        bastards bitch bitches asshole assholes dumbass jackass retard retards freak freaks weirdo slut whore
        idiota imbécil estúpido estúpida basura escoria payaso perdedor connard connasse crétin salaud ordure
        abruti imbécile trottel vollidiot abschaum versager arschloch dummkopf""",
    "contempt": """stupid dumb pathetic worthless disgusting useless ugly ignorant brainless clueless hopeless
        miserable vile revolting repulsive despicable inferior subhuman filthy crappy lame inútil patético
        asqueroso pathétique dégoûtant nul nulle stupide wertlos widerlich erbärmlich dumm""",
    "threat": """kill die hurt destroy murder shoot stab hang burn beat punch strangle hate matar muerte odio
        tuer crève haine töten hasse stir""",
    "vulgar": """fuck fucking fucked fucker shit shitty crap damn bloody hell piss cunt dick prick suck sucks
        mierda joder puta merde putain scheiße verdammt""",
    "second": "you your you're youre yours yourself u ur thou thy tú tu usted ustedes vosotros vous toi ton du dich dir ihr euch",
}

#: "die" and "dir" and the like are everyday words in one language, insults
#: or threats in another, so each list is a feature of its own and a tree
#: weighs it.
_SETS = {k: frozenset(v.encode().split()) for k, v in LEXICON.items()}
_BAD = _SETS["insult"] | _SETS["contempt"] | _SETS["vulgar"]
_ANY = frozenset().union(*_SETS.values())
_LONG_BAD = frozenset(w for w in _BAD if len(w) >= 4)

_SPACED = bytes(32 if not (chr(i).isalnum() or i >= 128 or i == 39) else i for i in range(256))
_UPPER, _LOWER, _DIGIT = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_NOT = {k: bytes(sorted(set(range(256)) - set(v))) for k, v in
        (("upper", _UPPER), ("lower", _LOWER), ("digit", _DIGIT), ("bang", b"!"), ("ask", b"?"), ("stop", b".,;:"),
         ("symbol", b"#*$%&|<>@^~=+_"), ("newline", b"\n"))}
_LEET = bytes.maketrans(b"01345789@$!+|", b"oieastbgasitl")
_MIXED = re.compile(rb"[a-z]+[0-9@$!*+|]+[a-z]|(?<![^\s])[0-9@$!]+[a-z]+[0-9@$!*]+[a-z]")
_TOKEN = re.compile(rb"[^\s]+")
_SINGLES = re.compile(rb"(?<![^\s])(?:[a-z][ ._-]){3,}[a-z](?![^\s.,!?])")
_RUN = re.compile(rb"([a-z])\1{2,}")

FEATURES = ["words", "insult", "contempt", "threat", "vulgar", "second", "bad_any", "bad_distinct", "bad_count",
            "near_second", "near_share", "capitals", "shouted", "digits", "bangs", "asks", "stops", "symbols",
            "repeated_marks", "mixed", "disguised", "spelled_out", "stretched", "word_length",
            "learned_words", "learned_weight", "learned_density"]

#: Parts of the sample; stems for one are learned from the others.
FOLDS = 5
#: Lengths, in bytes, of the stems that may be learned.
STEMS = (4, 5, 6, 7)


class Stems(dict):
    """Learned lexicon: word or stem -> log odds of its documents' labels."""

    def of(self, distinct) -> list[float]:
        if not self:
            return [0.0, 0.0, 0.0]
        n, weight = 0, 0.0
        for k in STEMS:
            for stem in {w[:k] for w in distinct} & self.keys():
                n += 1
                weight += self[stem]
        return [float(n), weight, 100 * n / max(len(distinct), 1)]


def stem_counts(rows: list[tuple[int, int, bytes]], least: int = 6) -> list[tuple[Counter, Counter, int, int]]:
    """From (fold, label, distinct words with spaces between): for each fold
    the toxic and the other documents that have a stem, and how many of
    either there are. Only stems of ``least`` toxic documents or more are
    kept."""
    folds = [(Counter(), Counter(), [0, 0]) for _ in range(FOLDS)]
    for f, y, words in rows:
        folds[f][2][y > 0] += 1
        if y:
            folds[f][0].update({w[:k] for w in words.split() for k in STEMS})
    kept = Counter()
    for toxic, _, _ in folds:
        kept.update(toxic)
    kept = {s for s, n in kept.items() if n >= least and len(s) >= STEMS[0]}
    for f, y, words in rows:
        if not y:
            folds[f][1].update({w[:k] for w in words.split() for k in STEMS} & kept)
    return [(Counter({s: t[s] for s in kept & t.keys()}), c, n[1], n[0]) for t, c, n in folds]


def learn_stems(counts, least: int = 6, odds: float = 2.0) -> Stems:
    """Stems whose log odds of a toxic document exceed those of all documents
    by ``odds``, with one and a half standard errors to spare."""
    toxic, clean, n1, n0 = Counter(), Counter(), 0, 0
    for t, c, a, b in counts:
        toxic.update(t)
        clean.update(c)
        n1, n0 = n1 + a, n0 + b
    base = np.log((n1 + 0.5) / (n0 + 0.5))
    out = Stems()
    for stem, n in toxic.items():
        a, b = n + 0.5, clean[stem] + 0.5
        weight = float(np.log(a / b) - base)
        if n >= least and weight - 1.5 * np.sqrt(1 / a + 1 / b) >= odds:
            out[stem] = weight
    return out


def _starred(word: bytes) -> bool:
    """``st*pid``: a listed word with letters starred out."""
    return any(len(bad) == len(word) and bad[0] == word[0] and all(a == b or b == 42 for a, b in zip(bad, word))
               for bad in _LONG_BAD)


def features(text: str) -> tuple[list[float], set[bytes]]:
    """The features that need no fitting, and the distinct words."""
    raw = text.encode("utf-8", "replace")
    low = raw.lower()
    words = low.translate(_SPACED).split()
    n, size = max(len(words), 1), max(len(raw), 1)
    count = {k: len(raw.translate(None, drop)) for k, drop in _NOT.items()}
    distinct = set(words)
    hits = dict.fromkeys(_SETS, 0)
    near = bad = n_bad = 0
    if distinct & _ANY:
        at = [i for i, w in enumerate(words) if w in _ANY]
        where: dict[str, list[int]] = {k: [] for k in _SETS}
        for i in at:
            for k, s in _SETS.items():
                if words[i] in s:
                    where[k].append(i)
        hits = {k: len(v) for k, v in where.items()}
        bad_at = sorted(set(where["insult"] + where["contempt"] + where["vulgar"]))
        bad, n_bad = len(bad_at), len(distinct & _BAD)
        if bad_at and where["second"]:
            second = np.array(where["second"])
            k = np.searchsorted(second, bad_at)
            gap = np.minimum(np.abs(second[np.clip(k, 0, len(second) - 1)] - bad_at),
                             np.abs(second[np.clip(k - 1, 0, len(second) - 1)] - bad_at))
            near = int((gap <= 5).sum())
    mixed = disguised = 0
    if count["symbol"] or count["digit"] or count["bang"]:
        for m in _MIXED.finditer(low):
            a = low.rfind(b" ", 0, m.start()) + 1
            word = _TOKEN.match(low, a)[0].strip(b".,;:?\"'()") if a <= m.start() else m[0]
            mixed += 1
            if len(word) <= 24 and (word.translate(_LEET).strip(b"i") in _LONG_BAD or
                                    word.translate(_LEET) in _LONG_BAD or b"*" in word and _starred(word)):
                disguised += 1
    spelled = sum(re.sub(rb"[ ._-]", b"", m[0]) in _BAD for m in _SINGLES.finditer(low))
    stretched = 0
    if _RUN.search(low):
        for w in distinct:
            if _RUN.search(w) and (_RUN.sub(rb"\1", w) in _BAD or _RUN.sub(rb"\1\1", w) in _BAD):
                stretched += 1
    letters = max(count["upper"] + count["lower"], 1)
    shouted = sum(w.isupper() and len(w) > 2 for w in raw.split()) if count["upper"] > 0.1 * letters else 0
    return [np.log1p(len(words)), *(100 * hits[k] / n for k in ("insult", "contempt", "threat", "vulgar", "second")),
            100 * bad / n, n_bad, bad, near, near / max(bad, 1), count["upper"] / letters, shouted / n,
            count["digit"] / size, count["bang"] / n, count["ask"] / n, count["stop"] / n, count["symbol"] / n,
            raw.count(b"!!") / n, mixed / n, disguised, spelled, stretched, (size - len(words)) / n], distinct


def feature_rows(batch_texts: list[str], stems: Stems) -> np.ndarray:
    rows = []
    for t in batch_texts:
        x, distinct = features(t)
        rows.append(x + stems.of(distinct))
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


#: Odd multipliers: each orders the hashes of words in its own way.
MULTIPLIERS = (1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


class Model:
    """Learned stems, trees and calibration."""

    def __init__(self, stems: Stems, calibrated):
        self.stems, self.calibrated = stems, calibrated

    def predict(self, batch_texts: list[str]) -> np.ndarray:
        return self.calibrated.predict(feature_rows(batch_texts, self.stems))


def min_hashes(words: bytes) -> tuple[int, ...]:
    """The least hash of the words under each of ``MULTIPLIERS``: sets that
    share a part J of their words agree in all of them with chance J ** 4."""
    h = np.fromiter(map(zlib.crc32, words.split()), np.uint64)
    return tuple(int((h * np.uint64(m) % np.uint64(1 << 32)).min()) if len(h) else 0 for m in MULTIPLIERS)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = MAX_DOCS):
    """A model fitted on at most ``max_docs`` labelled training documents.
    Of near copies with one label (all ``min_hashes`` equal) one is used, so
    that they don't stand on both sides of a fold or of the calibration.
    Features are made by Spark; the bounded matrix of them is fitted on the
    driver."""
    def run(batches):
        for b in batches:
            x, words = zip(*map(features, texts(b))) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), pa.array([b" ".join(sorted(w)) for w in words], pa.binary()),
                 b.column("__label"), b.column("__id")], names=["x", "words", "y", "id"])

    rows = (labelled_sample(docs, labels, label, max_docs)
            .mapInArrow(in_worker(run), "x array<double>, words binary, y int, id bigint").collect())
    rows.sort(key=lambda r: (r["id"], r["words"]))
    kept, seen = [], set()
    for r in rows:
        words = bytes(r["words"])  # sets of words would take ten times the memory
        sign = min_hashes(words)
        if (sign, r["y"]) not in seen:
            seen.add((sign, r["y"]))
            kept.append((zlib.crc32(b"%d" % sign[0]), r["y"], r["x"], words))
    del rows
    y = np.array([t for _, t, _, _ in kept], np.float64)
    counts = stem_counts([(h % FOLDS, t, w) for h, t, _, w in kept])
    stems = learn_stems(counts)
    if not len(y) or y.min() == y.max():
        return Model(stems, fit_isotonic(np.zeros(0), np.zeros(0), float(y.mean()) if len(y) else 0.0).of(None))
    others = [learn_stems(counts[:f] + counts[f + 1:]) for f in range(FOLDS)]
    x = np.array([v + others[h % FOLDS].of(set(w.split())) for h, _, v, w in kept])
    back = np.array([h // FOLDS % 4 == 0 for h, _, _, _ in kept])
    if back.all() or not back.any() or y[~back].min() == y[~back].max():
        return Model(stems, fit_isotonic(np.zeros(0), np.zeros(0), float(y.mean())).of(None))
    trees = fit_boosted(x[~back], y[~back], rounds=60, depth=3, rate=0.2)
    return Model(stems, fit_isotonic(trees.margin(x[back]), y[back], float(y.mean())).of(trees))


def score(docs: DataFrame, model, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: the chance, 0 to 1, that the label is 1."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    out = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches):
        for b in batches:
            yield with_columns(b, {name: pa.array(model.predict(texts(b, text_col)), pa.float64())})

    return docs.mapInArrow(in_worker(run), out)
