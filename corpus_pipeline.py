"""A training-corpus pipeline over `documents`: STAGES in order, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import exact_dedup, jaccard, langid, mixing, packing
from tapeline.llm.bloom import without
from tapeline.llm.common import materialise, release_memory, table

#: Least probability of the predicted language that a document needs to stay.
LEAST_SCORE = 0.5

#: A document goes whose code length per byte is so many times what nearly all documents of its predicted language stay below.
MOST_EXCESS = 1.5

#: Tokens of a training sequence.
CAPACITY = 2048

#: Bytes of text that a worker tokenizes at a time, and words whose ids it remembers: less than elsewhere, as it stands beside an executor whose heap the stages before have filled.
SLICE_BYTES, REMEMBERED = 1 << 20, 120_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Those without letters go, those without a language more likely than all
    others together, and those that the predicted language's tree codes far worse than its own documents, as it does
    text in a language or script that wasn't learned and random text."""
    found = langid.predict(docs, langid.train(docs))
    return found.filter((found.lang_pred != "und") & (found.score >= LEAST_SCORE) & (found.excess <= MOST_EXCESS)).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest doc_id."""
    release_memory()
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more), that with the smallest doc_id. Rows without doc_id can't be told apart and stay."""
    release_memory()
    found = materialise(jaccard.jaccard_join(docs).filter("doc_id is not null").select("doc_id", (F.col("component_id") == F.col("doc_id")).alias("stays")))
    away = materialise(found.groupBy("doc_id").agg(F.max("stays").alias("stays")).filter("not stays").select("doc_id"))
    return without(docs, away, [F.col("doc_id")])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0 to 3 times, as equal rows. Null and wordless texts are taken 0 times."""
    release_memory()
    mixed = mixing.mix_sources(docs, with_text=True)
    return mixed.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("copy"), "copies").filter("copies > 0").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, packed into sequences: doc_id, piece, start, length, ids_crc32, sequence_id and offset. Very long texts are many pieces; null and empty ones are the end id alone."""
    release_memory()
    return packing.pack_pieces(materialise(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, slice_bytes=SLICE_BYTES, remembered=REMEMBERED)), CAPACITY)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("jaccard_join", near), ("source_mix", mix), ("best_fit", pack)]

#: The first, third and fifth stage learn, search and pack, which SQL can't express; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
