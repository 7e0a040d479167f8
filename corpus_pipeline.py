"""A corpus pipeline of five stages: language, repeated lines, near duplicates, benchmark passages, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphspark.llm.common import read, store
from graphspark.llm.decontam import decontaminate
from graphspark.llm.langid import identify, sample_labelled, train
from graphspark.llm.lines import WORDS, dedup_lines
from graphspark.llm.minhash import keep_one
from graphspark.llm.packing import pack_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known to the models that their own labels train; a missing label is filled in."""
    found = identify(docs, train(sample_labelled(docs))).where(~F.col("rejected"))
    return found.select(*[F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else c for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of three lines, or of fewer with 50 words, that occur earlier; one of which no line is left goes."""
    return dedup_lines(docs, words=WORDS).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8 or more): that of the least doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and their place in the packed sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]

#: Models, sketches and packing are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each stage's rows are written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
