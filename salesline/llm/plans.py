"""Registered queries of the corpus operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from salesline.llm import (
    decontaminate, extract, jaccard, langid, negatives, periods, perspectives, sentencepieces, shards, suffixes, topk, toxicity, warc,
)
from salesline.llm.common import table

QUERIES, SQL = {}, {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


@query("op6_perspectives", perspectives.SQL)
def op6(spark, sf):
    """Every dialogue from the side of each participant."""
    return perspectives.rotate_perspectives(table(spark, sf, "conversations"))


@query("op8_decontaminate", decontaminate.SQL)
def op8(spark, sf):
    """Benchmark passages in documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_contamination(docs, table(spark, sf, "benchmark")))


@query("op5_language_filters")
def op5(spark, sf):
    """The language of every document."""
    docs = table(spark, sf, "documents")
    model = langid.fit_languages(langid.learned_rows(docs))
    found = langid.identify(docs.select("doc_id", "text", langid.held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query("op7_sentencepiece")
def op7(spark, sf):
    """Piece ids of every document, and the text they stand for."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return sentencepieces.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


@query("op3_impact_search", topk.SQL)
def op3(spark, sf):
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op9_capture_index", warc.SQL)
def op9(spark, sf):
    """Pages written as archives and read back through the capture index."""
    return warc.archive_and_read(table(spark, sf, "pages"))


@query("op1_restored_toxicity")
def op1(spark, sf):
    """The toxicity of every document after its spelling is restored."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model, terms = toxicity.fit(docs, table(spark, sf, "labels"))
    found = toxicity.score_toxicity(docs.withColumn("held_out", toxicity.held_out()), model, terms)
    score = F.col("toxicity")
    return found.select("doc_id", "held_out", score.alias("score"), (score >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op4_host_extract")
def op4(spark, sf):
    """The main text of every page."""
    return extract.extract_main_text(table(spark, sf, "pages"))


@query("op10_partition_join", jaccard.SQL)
def op10(spark, sf):
    """Groups of similar documents."""
    return jaccard.similar_groups(table(spark, sf, "documents"))


@query("op2_suffix_dedup")
def op2(spark, sf):
    """What is left of every document without strings that stand earlier."""
    return suffixes.digest(suffixes.cut_repeats(table(spark, sf, "documents").select("doc_id", "text")))


@query("op12_hard_negatives", negatives.SQL)
def op12(spark, sf):
    """Rows of other labels just below the positives of every fiftieth vector; every seventh label is moved on."""
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return negatives.hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op11_word_runs")
def op11(spark, sf):
    """Periodic runs of words in every document; those of a tenth of the documents are planted by id."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return periods.digest(periods.collapse_runs(periods.with_planted_runs(docs)))


@query("op13_best_fit_shards")
def op13(spark, sf):
    """All documents in 24 shards of near equal bytes; equal texts stay together."""
    placed = shards.place(table(spark, sf, "documents").select("doc_id", "text")).drop("text")
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shards.with_slots(placed).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)
