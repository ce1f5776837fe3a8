"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhall.llm.common import fold, read_table
from tallyhall.llm.lexical import SEARCH_SQL
from tallyhall.llm.rules_sql import QUALITY_RULES_SQL
from tallyhall.llm.tokens import public_path
from tallyhall.session import checkpoint_dir

WORD_BPE = "word_bpe_49k.json"


def op1_quality_classifier(spark, sf_dir):
    """Every document scored by the factorisation machine; 1 from 0.3 on."""
    from tallyhall.llm import quality
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return _scored(quality.score(docs, model, "score"), 0.3)


def op2_simhash_near_dedup(spark, sf_dir):
    """Every document's fingerprint and component."""
    from tallyhall.llm.neardup import near_duplicates
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", _hex("fp").alias("fingerprint"), "component_id")


def op3_substring_dedup(spark, sf_dir):
    """Every passage of 50 words or more that an earlier document has too."""
    from tallyhall.llm.passages import passages
    return passages(read_table(spark, sf_dir, "documents")).drop("tag")


def op4_quality_rules(spark, sf_dir):
    """Every document's counts and verdict."""
    from tallyhall.llm.rules import quality_rules
    checkpoint_dir(spark)
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark, sf_dir):
    """Every document's ids, as a digest, and the digest of what they decode to."""
    from tallyhall.llm.pieces import encode
    got = encode(read_table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"))
    return got.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), "text_crc32")


def op6_lm_scores(spark, sf_dir):
    """Every document's base and interpolated log probability."""
    from tallyhall.llm.interpolation import score
    return score(read_table(spark, sf_dir, "documents"), order=2, held=1, tuned=2)


def op8_toxicity(spark, sf_dir):
    """Every document scored by the calibrated trees; 1 from 0.5 on."""
    from tallyhall.llm import toxicity
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model, "score"), 0.5)


def _scored(df, least):
    return df.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                     (F.col("score") >= least).cast("int").alias("predicted"))


def op7_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    from tallyhall.llm.packing import document_pieces, pack
    docs = read_table(spark, sf_dir, "documents")
    return pack(document_pieces(docs, public_path(WORD_BPE), 2048, 0), 2048)


def op9_token_id_files(spark, sf_dir):
    """All documents written as token-id files and read back."""
    from tallyhall.llm.tokenfile import token_files
    return token_files(read_table(spark, sf_dir, "documents"), public_path(WORD_BPE), 2)


def op10_document_fingerprints(spark, sf_dir):
    """Every document's fingerprint, that of its edited text, likenesses."""
    from tallyhall.llm.fingerprint import fingerprints
    checkpoint_dir(spark)
    f = fingerprints(read_table(spark, sf_dir, "documents"))
    return f.select("doc_id", "n_chars", "edited_sha256", _hex("fp").alias("fingerprint"),
                    _hex("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", "n_near")


def op11_secret_scan(spark, sf_dir):
    """Every document's secrets, by patterns and by Markov models."""
    from tallyhall.llm.secrets import scan
    return scan(read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    """Every benchmark item's 50 best documents."""
    from tallyhall.llm.lexical import lexical_search
    return lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark, sf_dir):
    """Every conversation's damage, cheapest repair and its digest."""
    from tallyhall.llm.conversations import damage_and_repair
    return damage_and_repair(read_table(spark, sf_dir, "conversations"))


def _hex(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier,
    op2_simhash_near_dedup,
    op3_substring_dedup,
    op4_quality_rules,
    op5_sentencepiece,
    op6_lm_scores,
    op8_toxicity,
    op7_best_fit_packing,
    op9_token_id_files,
    op10_document_fingerprints,
    op11_secret_scan,
    op12_lexical_search,
    op13_conversation_repair,
)}

ORACLE: dict[str, str] = {
    "op4_quality_rules": QUALITY_RULES_SQL,
    "op12_lexical_search": SEARCH_SQL,
}
