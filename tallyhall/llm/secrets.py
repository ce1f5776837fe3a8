"""Secret scans in SQL functions only: patterns, and Markov models of
characters for what no pattern names.

Patterns find assigned secrets, access keys and long hex numbers, and where
they stand: a text is split at the matches, and the lengths of the pieces and
matches are added up, in blocks of ``BLOCK``, so that a long text with very
many matches takes little more than linear time. Assignments are marked in
the text first; what is left between the marks is searched for other long
tokens.

Two first-order Markov models say how likely a token's characters are: one of
random strings, mixed half and half with the uniform distribution, and one of
ordinary identifiers. Their labelled samples come from the documents: what
the patterns find, and the words and identifiers of about ``TRAIN_DOCS``
different documents that no pattern finds. A token of ``TOKEN`` characters or
more is a secret if its log-likelihood ratio exceeds the logarithm of how
much rarer the random strings are. Ratios are whole thousandths, so sums do
not depend on their order.

Nulls: a null text is an empty one. Repeated rows are documents of their own.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import scratch_table

KINDS = ["assign", "access", "hex", "random"]
#: Fixed patterns; the value of an assignment has 12 characters or more.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

#: Characters that the models know; all others are alike.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
TOKEN, WORD = 20, 8
TRAIN_DOCS = 5000
UNIFORM = 0.5
SMOOTH = 0.5
BLOCK = 64

_N = len(ALPHABET) + 1
_RUN = r"[A-Za-z0-9+/_=-]"
_MARK = "\x01"


def located(df: DataFrame, name: str, text: str, pattern: str, length: str = "length(x)") -> DataFrame:
    """``df`` with an array column ``name`` of (start, end, value) of the
    pattern's matches in column ``text``; null where there are none.
    ``length`` is the length that a match x has in the text."""
    p = F.lit(pattern)
    d = df.withColumn("__any", F.col(text).rlike(pattern))
    d = d.withColumn("__p", F.when(F.col("__any"), F.transform(F.split(text, pattern, -1), F.length)))
    d = d.withColumn("__m", F.when(F.col("__any"), F.regexp_extract_all(text, p, F.lit(0)))).drop("__any")
    d = d.withColumn("__l", F.expr(f"transform(__m, x -> {length})"))
    # how far each match and the piece before it reach; their sums in blocks; the blocks' own
    d = d.withColumn("__a", F.expr("zip_with(slice(__p, 1, size(__l)), __l, (p, l) -> p + l)"))
    d = d.withColumn("__b", F.expr(f"transform(sequence(0, cast((size(__a) - 1) div {BLOCK} as int)), "
                                   f"b -> aggregate(slice(__a, b * {BLOCK} + 1, {BLOCK}), 0, (s, x) -> s + x))"))
    d = d.withColumn("__c", F.expr("transform(__b, (x, i) -> aggregate(slice(__b, 1, i), 0, (s, y) -> s + y))"))
    # (__c is named twice, so that it is computed once and not for every match)
    d = d.withColumn("__s", F.expr(
        f"case when size(__c) > 0 then transform(__a, (x, i) -> get(__c, cast(i div {BLOCK} as int)) + get(__p, i) + "
        f"aggregate(slice(__a, cast(i div {BLOCK} as int) * {BLOCK} + 1, i % {BLOCK}), 0, (s, y) -> s + y)) end"))
    found = F.expr("transform(__m, (x, i) -> named_struct('start', get(__s, i), 'end', get(__s, i) + get(__l, i), 'value', x))")
    return d.withColumn(name, F.when(F.size("__s") > 0, found)).drop("__p", "__m", "__l", "__a", "__b", "__c", "__s")


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, assign, access, hex, token): the matches of each text. Tokens
    are long runs outside assignments that hold no other match."""
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", plain.alias("text"))
    # marks are of no width: they do not count
    d = d.withColumn("marked", F.translate("text", _MARK, " "))
    d = d.withColumn("marked", F.when(F.col("marked").rlike(ASSIGN), F.regexp_replace("marked", ASSIGN, f"{_MARK}$0{_MARK}"))
                     .otherwise(F.col("marked")))
    d = located(d, "found", "marked", f"{_MARK}[^{_MARK}]*{_MARK}|{_RUN}{{{TOKEN},}}", f"length(translate(x, '{_MARK}', ''))")
    d = located(located(d, "access", "text", ACCESS), "hex", "text", HEX)
    assigned = F.transform(F.filter("found", lambda x: x["value"].startswith(_MARK)), lambda x: F.struct(
        x["start"], x["end"], F.regexp_extract(F.translate(x["value"], _MARK, ""), ASSIGN, 2).alias("value")))
    other = F.filter("found", lambda x: ~x["value"].startswith(_MARK) & ~x["value"].rlike(f"{ACCESS}|{HEX}"))
    return d.select("doc_id", F.filter(assigned, lambda x: F.length(x["value"]) >= VALUE).alias("assign"), "access", "hex",
                    other.alias("token"))


def labelled(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, float]:
    """(token, label, n) of the samples: 1 all that the patterns find, 0 the
    other words of about ``TRAIN_DOCS`` different documents; and the share
    of documents that these are taken from."""
    one = F.flatten(F.array(*[F.transform(F.coalesce(k, F.array()), lambda x: x["value"]) for k in KINDS[:3]]))
    ones = found.select(F.explode(one).alias("token"), F.lit(1).alias("label"))
    n = docs.count()
    share = min(1.0, TRAIN_DOCS / max(1, n))
    d = docs.select("doc_id", F.col("text").cast("string")).where(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < round(share * 1_000_000))
    words = F.regexp_extract_all(F.regexp_replace("text", ASSIGN, " "), F.lit(f"{_RUN}{{{WORD},}}"), F.lit(0))
    zeros = (d.select("text").distinct().select(F.explode(words).alias("token")).where(~F.col("token").rlike(f"{ACCESS}|{HEX}"))
             .select("token", F.lit(0).alias("label")))
    return ones.unionByName(zeros).groupBy("token", "label").agg(F.count("*").alias("n")), share


def _codes(token: Column) -> Column:
    return F.transform(F.regexp_extract_all(token, F.lit(r"[\s\S]"), F.lit(0)), lambda c: F.instr(F.lit(ALPHABET), c))


class Model:
    """Log-likelihood ratios of successive characters, in thousandths, and
    the least ratio of a secret."""

    def __init__(self, ratios: list[int], least: int):
        self.ratios, self.least = ratios, least

    def score(self, token: Column) -> Column:
        """The log-likelihood ratio of a token, in thousandths."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")  # one constant
        start = F.struct(F.lit(0).alias("last"), F.lit(0).cast("bigint").alias("sum"))
        return F.aggregate(_codes(token), start, lambda s, x: F.struct(
            x.alias("last"), (s["sum"] + F.get(table, s["last"] * _N + x)).alias("sum")), lambda s: s["sum"])


def train(samples: DataFrame, share: float = 1.0) -> Model:
    """The model of samples (token, label, n); ``share`` is the part of all
    tokens labelled 0 that they hold."""
    pairs = F.expr(f"transform(c, (x, i) -> if(i = 0, 0, get(c, i - 1)) * {_N} + x)")
    counts = (samples.select("label", "n", _codes(F.col("token")).alias("c"))
              .select("label", "n", F.explode(pairs).alias("pair"))
              .groupBy("label", "pair").agg(F.sum("n").alias("n")).collect())  # at most 2 * _N * _N rows
    sizes = dict(samples.groupBy("label").agg(F.sum("n")).collect())
    table = [[0] * (_N * _N) for _ in range(2)]
    for r in counts:
        table[r["label"]][r["pair"]] = r["n"]

    def share_of(label, pair):
        a = pair // _N
        own = table[label][a * _N:(a + 1) * _N]
        return (own[pair % _N] + SMOOTH) / (sum(own) + SMOOTH * _N)

    ratios = [round(1000 * math.log((UNIFORM / _N + (1 - UNIFORM) * share_of(1, p)) / share_of(0, p))) for p in range(_N * _N)]
    odds = (sizes.get(0, 0) / share + 1) / (sizes.get(1, 0) + 1)
    return Model(ratios, max(0, round(1000 * math.log(odds))))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random)."""
    found = scratch_table(matches(docs), "secret-matches")
    model = train(*labelled(docs, found))
    d = found.withColumn("random", F.filter("token", lambda x: model.score(x["value"]) > model.least)).drop("token")

    def spans(kinds):
        def of(at):
            return lambda x: F.struct(x["start"].alias("start"), F.lit(at).alias("kind"), x["end"].alias("end"))

        each = [F.transform(F.coalesce(k, F.array()), of(KINDS.index(k))) for k in kinds]
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(F.array_sort(F.flatten(F.array(*each))),
                                        lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")

    def n(kind):
        return F.coalesce(F.size(F.coalesce(kind, F.array())), F.lit(0)).cast("bigint").alias(f"n_{kind}")

    return d.select("doc_id", *[n(k) for k in KINDS[:3]], F.sha2(spans(KINDS[:3]), 256).alias("base_sha256"),
                    spans(KINDS).alias("spans"), n("random"))
