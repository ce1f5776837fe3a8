"""Hot, outlying and null ids: bounded samples and even buckets."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyhall.llm import fingerprint, toxicity
from tallyhall.llm.sample import labelled_sample


def _kept(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_a_hot_labelled_id_gives_one_row(spark):
    hot = next(i for i in range(100) if _kept(i))
    ids = [i for i in range(100) if _kept(i)]
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, hot).otherwise(F.col("id") % 100).alias("doc_id"),
                                    F.concat(F.lit("t"), F.col("id")).alias("text"), F.lit(3).alias("n_chars"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", 1000).collect()
    assert sorted(r["__id"] for r in got) == ids and {r["__label"] for r in got} == {0, 1}
    again = labelled_sample(docs.repartition(7), labels, "toxic", 1000).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert len(labelled_sample(docs, labels, "toxic", 10).collect()) == 10


def test_min_hashes_part_unrelated_texts_and_keep_near_copies():
    rng = np.random.default_rng(5)
    common = [b"the", b"and", b"of"]
    words = [b"w%d" % i for i in range(4000)]
    sets = [b" ".join([*common, *rng.choice(words, 60)]) for _ in range(500)]
    assert len({toxicity.min_hashes(s) for s in sets}) == 500
    same = sum(toxicity.min_hashes(s) == toxicity.min_hashes(s + b" one") for s in sets)
    assert same > 425 and toxicity.min_hashes(b"") == (0, 0, 0, 0)


def test_order_buckets_are_even_and_follow_descending_ids(spark):
    n = 12000
    i = F.col("id")
    doc_id = (F.when(i < n // 4, F.lit(77)).when(i < n // 2, F.lit(None).cast("long")).when(i == n - 1, F.lit(10 ** 15))
              .otherwise(i % 500 + 10 ** 6 * (i % 3)))
    docs = spark.range(n).select(doc_id.alias("doc_id"), F.concat(F.lit("text "), i).alias("text"))
    rows = fingerprint.in_order(docs).cache()
    sizes = [r["count"] for r in rows.where("not extra").groupBy("bucket").count().collect()]
    assert sum(sizes) == n and len(sizes) > 3 and max(sizes) <= 2 * n / len(sizes)
    # buckets from the highest to the lowest make one chain of all documents
    got = rows.where("not extra").orderBy(F.desc("bucket"), "at").collect()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted((x for x in ids if x is not None), reverse=True) + [None] * ids.count(None)
    assert [r["next"] for r in got] == [r["text"] for r in got[1:]] + [got[0]["text"]]
    rows.unpersist()


def test_equal_rows_follow_one_another(spark):
    docs = spark.range(5000).select(F.lit(4).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = fingerprint.in_order(docs)
    assert rows.where("not extra").count() == 5000 and rows.where("extra").count() <= 3
    assert rows.where("not extra and next is distinct from 'same'").count() == 0
