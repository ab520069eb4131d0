"""The corpus pipeline: language ID, near-duplicate removal, substring dedup,
benchmark decontamination, packing.

Each stage works on all that the stage before kept, and every stage but the
last returns the columns it was given. Rows that share a doc_id and a text are
treated alike. An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.llm.common import table
from dimwright.llm.decontam import decontaminate
from dimwright.llm.langid import language, learn
from dimwright.llm.minhash import near_duplicates
from dimwright.llm.packing import pack_documents
from dimwright.llm.substring import substring_dedup
from dimwright.operators.keys import materialize

LEAST_SCORE = 0.05      # cosine with the best language below which a text is in none of them


def _uid() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("binary"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters (null and empty ones too), or close to no learned language, go."""
    found = language(F.col("text"), learn(docs))
    return docs.withColumn("_language", found).where(f"_language.lang_pred <> 'und' and _language.score >= {LEAST_SCORE}").drop("_language")


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row of smallest id stays, by the smaller hash among rows that share an id; a null id comes last."""
    gone = near_duplicates(docs, by_row=True).where("not kept").select(F.col("uid").alias("_uid")).distinct()
    return docs.withColumn("_uid", _uid()).join(gone, "_uid", "left_anti").select(*docs.columns)


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows are cut out; a document with nothing left goes."""
    cut = (substring_dedup(docs).where("n_removed > 0").select(F.col("uid").alias("_uid"), F.col("kept_text").alias("_kept"))
           .dropDuplicates(["_uid"]))
    out = docs.withColumn("_uid", _uid()).join(cut, "_uid", "left").where("_kept is null or _kept <> ''")
    text = F.coalesce("_kept", "text")
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("uid").alias("_uid")).distinct()
    return docs.withColumn("_uid", _uid()).join(hit, "_uid", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences, with their ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("near duplicates", near_duplicate_removal), ("substring dedup", substring_removal),
          ("decontamination", benchmark_decontamination), ("packing", packing)]

#: hashes, tokenizers and learned profiles are not for SQL; tests/llm/test_pipeline.py holds it against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
