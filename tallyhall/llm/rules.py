"""Quality rules with thresholds that adapt to language and source.

Per document a few counts are taken in one projection, without a shuffle.
Rates of them go into quantile sketches per (lang, source): log-linear
histograms, which keep the seven leading bits of a value, so a quantile is
off by less than 1/64 of itself. A sketch is a set of counts; sketches merge
by addition, exactly and in any order, and a source that holds a third of all
rows is summed before it moves. A group with fewer than ``LEAST`` documents
takes the merged sketch of its language, then that of all. Documents beyond
the quartiles by more than three times their distance, and by more than a
slack, are not kept.

Nulls: a null text is an empty one (no words, base rules fail); null lang and
null source are groups of their own. Repeated rows count as often as they
occur. An empty table gives no rows. Other columns are ignored. Only SQL
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documents that a sketch must hold to set a threshold.
LEAST = 200
#: Words of a window whose repetition counts.
REPEAT = 8
#: Rates, their slack, and whether low values are outliers too.
RATES = [
    ("symbols", "1000 * n_symbols div n_words", 150, False),
    ("dup_lines", "1000 * n_dup_lines div n_words", 30, False),
    ("repeats", "1000 * n_repeat_words div n_words", 150, False),
    ("word_length", "100 * word_chars div n_words", 150, True),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SPACE = r"[ \t\n\x0B\f\r]+"


def _neighbours(name: str, n: int, f) -> Column:
    """f(a, b) of every two neighbours of an array column."""
    rest = F.size(name) - n
    return F.zip_with(F.slice(F.col(name), F.lit(1), F.greatest(rest, F.lit(0))),
                      F.slice(F.col(name), F.lit(2), F.greatest(rest, F.lit(0))), f)


def word_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and the counts of each text, as longs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(*keep, text.alias("__t"))
    d = d.select(*keep, "__t", F.array_remove(F.split("__t", _SPACE), "").alias("__w"))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    d = d.select(*keep, F.size("__w").cast("long").alias("n_words"),
                 F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
                 (F.size(F.split("__t", r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
                 lines.alias("__l"), F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    last = F.size("__h") - REPEAT
    windows = F.when(last >= 1, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(F.col("__h"), i + k) for k in range(REPEAT)])))
    head = [*keep, "n_words", "word_chars", "n_symbols"]
    d = d.select(*head, (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                 windows.alias("__g"))
    head.append("n_dup_lines")
    # only texts with a repeated window are looked at more closely
    again = F.when(F.size(F.array_distinct("__g")) < F.size("__g"),
                   F.sort_array(F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.select(*head, again.alias("__s"))
    both = _neighbours("__s", 1, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    at = F.when(F.col("__s").isNotNull(),
                F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull())))))
    d = d.select(*head, at.alias("__p"))
    covered = F.aggregate(_neighbours("__p", 1, lambda a, b: F.least(b - a, F.lit(REPEAT))), F.lit(REPEAT),
                          lambda s, x: s + x)
    return d.select(*head, F.coalesce(F.when(F.size("__p") > 0, covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def sketch(values: DataFrame, groups: list[str], value: str = "value") -> DataFrame:
    """(groups, top, n): counts of the values whose bucket ends at ``top``."""
    shift = F.expr(f"greatest(length(bin({value})) - 7, 0)")
    v = values.withColumn("__s", shift)
    return (v.withColumn("top", F.expr(f"shiftleft(shiftright({value}, __s) + 1, __s) - 1"))
            .groupBy(*groups, "top").agg(F.count("*").alias("n")))


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """The sketches of coarser ``groups``."""
    return sketches.groupBy(*groups, "top").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str], **shares: float) -> DataFrame:
    """(groups, size, one column a share): the least bucket end that at least
    the share of the values do not exceed. A group has a few hundred buckets
    at most, whatever it sketches."""
    w = Window.partitionBy(*groups)
    s = (sketches.withColumn("__upto", F.sum("n").over(w.orderBy("top")))
         .withColumn("__all", F.sum("n").over(w)))
    return s.groupBy(*groups).agg(F.max("__all").alias("size"), *[
        F.min(F.when(F.col("__upto") >= F.ceil(F.lit(q) * F.col("__all")), F.col("top"))).alias(name)
        for name, q in shares.items()])


def thresholds(counts: DataFrame) -> DataFrame:
    """One row for every (lang, source) of ``counts``, null as '': the least
    and the greatest value of every rate that are kept."""
    passed = counts.where(~F.col("__failed"))
    rates = F.array(*[F.struct(F.lit(name).alias("rate"), F.expr(how).cast("long").alias("value"))
                      for name, how, _, _ in RATES])
    values = passed.select("__lang", "__source", F.inline(rates))
    fine = sketch(values, ["__lang", "__source", "rate"]).checkpoint()
    of = {"low": 0.25, "high": 0.75}
    fine_q = quantiles(fine, ["__lang", "__source", "rate"], **of)
    lang_q = quantiles(merge(fine, ["__lang", "rate"]), ["__lang", "rate"], **of)
    all_q = quantiles(merge(fine, ["rate"]), ["rate"], **of)
    q = (fine_q.alias("f").join(lang_q.alias("l"), ["__lang", "rate"]).join(all_q.alias("a"), "rate"))

    def pick(c):
        return (F.when(F.col("f.size") >= LEAST, F.col(f"f.{c}")).when(F.col("l.size") >= LEAST, F.col(f"l.{c}"))
                .otherwise(F.col(f"a.{c}")))

    q = q.select("__lang", "__source", "rate", pick("low").alias("low"), pick("high").alias("high"))
    cuts = []
    for name, _, slack, two_sided in RATES:
        at = F.col("rate") == name
        far = 3 * (F.col("high") - F.col("low")) + slack
        cuts.append(F.max(F.when(at, F.col("high") + far)).alias(f"__max_{name}"))
        if two_sided:
            cuts.append(F.max(F.when(at, F.col("low") - far)).alias(f"__min_{name}"))
    return q.groupBy("__lang", "__source").agg(*cuts)


def quality_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every row."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{c}") for c in ("lang", "source")]
    counts = (word_counts(docs.select("doc_id", *named, "text"), ["doc_id", "__lang", "__source"])
              .withColumn("__failed", base_failed()).checkpoint())
    cut = thresholds(counts)
    joined = counts.join(cut, ["__lang", "__source"], "left")
    inside = F.lit(True)
    for name, how, _, two_sided in RATES:
        inside = inside & (F.expr(how) <= F.col(f"__max_{name}"))
        if two_sided:
            inside = inside & (F.expr(how) >= F.col(f"__min_{name}"))
    return joined.select("doc_id", *COUNTS, F.col("__failed").alias("base_failed"),
                         F.when(F.col("__failed"), F.lit(False)).otherwise(inside).alias("kept"))
