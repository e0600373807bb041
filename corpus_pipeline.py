"""From raw documents to packed training sequences.

Each stage works on all that the one before it kept. Its result is written as
Parquet and read again, so a lost executor costs at most one stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from yearloom.scratch import scratch_dir

TOKENIZER = "word_bpe_49k.json"
#: SQL cannot express the classifier, the tokenizer or the packing plan.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows."""
    return line_dedup.without_repeated_windows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with digests of their ids."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = scratch_dir(spark, f"stage-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
