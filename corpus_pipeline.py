"""A training-data pipeline out of the corpus operators. Each stage works on all that the one before it kept.

Documents without a recognised language go, repeated runs of lines are taken out, one document of each group of near
copies stays, documents that hold benchmark passages go, and what is left is packed into sequences of token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muniscope.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from muniscope.llm.common import settle, ship, workspace

END_ID = 1
ID_BYTES = 2  # the vocabulary has some 49,000 ids


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in which no language is recognised (``und``), whatever their length. A limit on the score would only
    hit short clean texts: on 10,000 documents 57 of 280 below 128 bytes score less than 0.5, none of the longer ones."""
    ship(spark)
    model = language_id.fit(docs.where(~F.coalesce(language_id.held_out(F.col("doc_id")), F.lit(False))))
    return language_id.identify(docs, model).where(F.col("lang_pred") != "und").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes later copies of repeated runs of lines out of the texts; a document that loses all of its lines goes."""
    ship(spark)
    left = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed_lines") > 0) & (F.col("n_removed_lines") == F.col("n_lines"))
    return left.where(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more; the smallest id of each group stays."""
    ship(spark)
    return near_dedup.keep_one(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark).where(~F.col("contaminated")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes sequences of 2048 token ids and returns, from these files, the pieces that they hold."""
    ship(spark)
    pieces = settle(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, width=ID_BYTES), "pieces")
    return packing.placements(packing.write_sequences(packing.pack(spark, pieces), workspace(spark, "sequences"), width=ID_BYTES), ID_BYTES)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack_sequences),
]
# learned weights, rolling hashes and the tokenizer are not SQL: tests/llm compares the result with a plain computation
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
