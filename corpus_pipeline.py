"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each result in the shared folder and reads it again for the next stage.

In all stages: an empty table gives an empty one; the order of rows changes nothing but where packing cuts; texts are taken whole, however long; of ties
(documents of one group, strings that stand in several documents) the smallest id decides, or all are treated alike; columns
besides the key and the text are carried along, whatever their names, but for those that begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendora.llm import decontam, neardup, packing, quality, suffix, tokencount
from vendora.operators.ordering import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule; null, empty and wordless texts break one. Repeated rows and null ids are judged row by row."""
    return quality.quality_filter(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id. Of repeated rows one stays; rows without an id all stay."""
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that stand elsewhere too; those of which nothing is left go. Null and short texts stay as they are."""
    cut = suffix.remove_repeats(docs)
    left = cut.filter("__cut.n_removed = 0 OR __cut.kept_text <> ''")
    changed = F.col("__cut.n_removed") > 0
    out = left.withColumn("text", F.when(changed, F.col("__cut.kept_text")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; null and short texts hold none, and an empty benchmark leaves all."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens as pieces of sequences of 4096; a null text is its end id alone."""
    return packing.pack(docs, tokencount.default_file("word_bpe_49k.json"), keep=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", harmonic_packing),
]

#: SQL can express neither the tokenizer nor, at this size, the near-duplicate groups; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
