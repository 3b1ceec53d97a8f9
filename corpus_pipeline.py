"""Corpus pipeline: documents in, token ids out.

Each stage takes all that the stage before it kept, written as Parquet and read again:

1. language ID: documents without a letter, or whose best language scores below
   ``MIN_LANGUAGE_SCORE``, go;
2. toxicity: documents predicted as toxic go;
3. near-duplicates: the row with the smallest doc_id of each class stays (null ids last; rows that
   share a doc_id but not the class are documents of their own), and one of repeated rows;
4. benchmark decontamination: documents that hold a window of a benchmark item go;
5. byte-level BPE: every document left is encoded and decoded.

Stages 1 to 4 return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, decontaminate, langid, neardup, toxicity
from kestrel.plans.materialize import write_and_reload
from kestrel.sources.tables import table

MIN_LANGUAGE_SCORE = 0.3
RANKS = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language."""
    found = langid.predict(docs, langid.fit(docs), "__")
    return found.filter((F.col("__lang_pred") != langid.UNKNOWN)
                        & (F.col("__score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted as toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "__").filter("__predicted = 0").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    found = neardup.surplus(docs.select("doc_id", "text")).withColumnRenamed("key", "__key")
    rows = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    once = rows.join(found.select("__key"), "__key", "left_anti")
    repeated = rows.join(found.filter("kept").select("__key"), "__key", "left_semi").dropDuplicates(["__key"])
    return once.unionByName(repeated).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the bytes decoded from them."""
    both = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(RANKS),
                          public_tokenizers.PATTERN)
    return both.select("doc_id", "lang", "source", F.expr("bigint(octet_length(ids) / 4)").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", language), ("toxicity", clean_speech), ("near-duplicates", one_of_each),
          ("benchmark decontamination", uncontaminated), ("byte-level BPE", encoded)]

#: The stages learn models and draw minwise tokens: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_and_reload(docs, name.lower().replace(" ", "-"))
    return docs
