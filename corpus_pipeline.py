"""A corpus pipeline: five stages, each applying one operator of ``salesline.llm`` to all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` stores as Parquet and reads again as the
next stage's ``docs``. All but the last return the columns of ``documents``; n_chars follows a changed text.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from salesline.llm import decontaminate, jaccard, langid, sentencepieces, suffixes
from salesline.llm.common import table
from salesline.session import checkpoint_dir, cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_COVER = 0.2
LETTERS = r"[\p{L}\p{N}]"


def with_text(docs, column):
    """``docs`` with another text and its number of code points."""
    return docs.withColumn("text", column).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark, docs, sf_dir):
    """Keep documents in a known language; it is written to ``lang``.

    Rejected are texts without letters and those with fewer than a fifth of their n-grams in any language.
    """
    model = langid.fit_languages(langid.learned_rows(docs))
    found = langid.identify(docs.select(*COLUMNS), model)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_cover") >= LEAST_COVER))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def similarity_join(spark, docs, sf_dir):
    """Keep the document of smallest id of every group of similar ones, once if its row is repeated.

    Rows go by id and text, so that of several texts of one id only the similar ones go. Documents without an id can't
    be told apart and stay.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("text")))
    named = docs.select(*COLUMNS).withColumn("_key", key)
    groups = jaccard.similar_groups(named, doc="_key")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_key")).distinct()
    kept = named.join(gone, "_key", "left_anti").drop("_key")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").take(1)
    if not repeated:
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(kept.where("doc_id is null"))


def suffix_dedup(spark, docs, sf_dir):
    """Cut out strings that stand earlier, and drop documents that lose all letters and digits by it.

    A character of which only some bytes stay is dropped; null texts stay null.
    """
    cut = suffixes.cut_repeats(docs.select(*COLUMNS), replace=True)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(LETTERS)
    return with_text(cut.where(~F.coalesce(emptied, F.lit(False))), F.col("text"))


def decontamination(spark, docs, sf_dir):
    """Cut benchmark passages out, and drop documents that lose all letters and digits by it."""
    found = cut_lineage(decontaminate.find_contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))
    clean = decontaminate.remove_spans(found)
    emptied = (F.size(F.col("hits")["runs"]) > 0) & ~F.col("text").rlike(LETTERS)
    return with_text(clean.where(~F.coalesce(emptied, F.lit(False))), F.col("text"))


def pieces(spark, docs, sf_dir):
    """The piece ids of every document, the text they decode to, and their number."""
    found = sentencepieces.encode_decode(docs.select(*COLUMNS), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [
    ("language_id", language_id),
    ("similarity_join", similarity_join),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("pieces", pieces),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
