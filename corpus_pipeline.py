"""From raw documents to packed training sequences, stage by stage.

Each stage works on all that the one before kept. Its result is written to the shared folder and read again, so a lost
executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlake.llm import lines, minhash, packing, secrets, toxicity
from roadlake.session import prepare, scratch_path

#: Boilerplate goes however much of a document it is; copies of a whole text count once, so that they do not make its lines boilerplate.
LINE_MAX_LOSS = 1.0
#: Hundredths of their five-word shingles that near duplicates share; the 85 of op7 are that query's contract.
NEAR_PERCENT = 80
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` made to fit the text; null texts keep it."""
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return docs.withColumn("n_chars", length)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by a classifier of the table ``labels``."""
    prepare(spark)
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that over a tenth of their source's different documents repeat."""
    prepare(spark)
    return _counted(lines.drop_boilerplate(docs, F.col("source"), max_loss=LINE_MAX_LOSS, copies_once=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return minhash.drop_near_duplicates(docs, NEAR_PERCENT)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    prepare(spark)
    return _counted(secrets.mask_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    prepare(spark)
    return packing.pack(docs, Path(TOKENIZER).read_text())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]
#: SQL cannot express the first and the last stage; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
