"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again before the next one. All but the last return the columns of the table
``documents``; a stage sees all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import mixing, near_duplicates, packing, quality_rules, site_lines
from wayfare.llm.common import saved
from wayfare.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, or the verdict on their host, reject go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; no document does."""
    clean = site_lines.drop_boilerplate(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_duplicates.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target words; documents are left out or repeated for it."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4096 tokens."""
    packed = packing.pack_documents(docs, tokenizer_path())
    return packed.select(
        F.col("id").alias("doc_id"), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near),
    ("source mix", mix),
    ("packing", pack),
]

#: SQL has neither the tokenizer nor the hashes of the ranking and the sketches; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
