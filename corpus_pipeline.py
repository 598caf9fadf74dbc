"""A training corpus from raw documents: each stage reads what the one before it kept.

STAGES are applied in order; each result is written as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``. Repeated rows of one document are one document from the near-duplicate stage on.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swelter.llm.common import read_table, shared_folder
from swelter.llm.decontamination import decontaminate
from swelter.llm.near_dedup import NearDuplicates, text_hash
from swelter.llm.packing import pack
from swelter.llm.quality import THRESHOLD, featurize, fit, fold, score
from swelter.llm.queries import tokenizer_files
from swelter.llm.repeated_bytes import remove_repeats

#: Words of a shingle of near-duplicates; bytes of a repeated string, of which passages of 50 words have more (5.9 bytes a word).
SHINGLE, REPEATED = 5, 240

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    # learned from the training folds alone; texts are read twice rather than written or shuffled with their statistics
    known = docs.where(fold(F.col("doc_id").cast("long")) != 0)
    model = fit(featurize(known), read_table(spark, sf_dir, "labels"))
    return score(docs.select(*COLUMNS), model).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near-duplicates, that of the smallest doc_id; rows without an id cannot be told apart and all stay."""
    chosen = NearDuplicates(docs, size=SHINGLE).first_texts()
    rows = docs.select(*COLUMNS).withColumn("k", text_hash())
    once = F.row_number().over(Window.partitionBy("doc_id", "k").orderBy("n_chars", "lang", "source"))
    kept = rows.join(chosen, ["doc_id", "k"], "left_semi").withColumn("once", once).where("once = 1").select(*COLUMNS)
    return kept.unionByName(docs.where("doc_id is null").select(*COLUMNS))


def no_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the strings of ``REPEATED`` bytes that stand more than once."""
    cut = remove_repeats(docs, columns=("lang", "source"), length=REPEATED)
    return cut.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    clean = decontaminate(docs, read_table(spark, sf_dir, "benchmark"), columns=("text", *COLUMNS[2:])).where("not contaminated")
    return clean.select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return pack(docs, *tokenizer_files())


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", no_near_duplicates),
    ("repeated_bytes", no_repeated_bytes),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: SQL expresses neither the classifier nor the packing, so the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them go to the shared checkpoint folder."""
    base = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{base}/{k}_{name}")
        docs = spark.read.parquet(path)
    return docs
