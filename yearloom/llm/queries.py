"""The registered queries of this subpackage, with SQL where it can say the same."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import (
    centroids,
    decontamination,
    fertility,
    jaccard_join,
    line_dedup,
    lm_scoring,
    oracle,
    packing,
    phrases,
    substring_dedup,
    topk_search,
    toxicity,
    url_filter,
    warc,
)

Run = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_character_model_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules and, where none fits, by character models."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base figures, token measures and verdict."""
    return fertility.judge(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as written to archives and read back in chunks."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_nb_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from labels outside its held-out fold."""
    return toxicity.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op5_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that overlap."""
    return decontamination.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op6_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's losses under the target and the background model."""
    return lm_scoring.score_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op7_size_aware_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and near-duplicate component."""
    return jaccard_join.with_components(_table(spark, sf_dir, "documents"))


def op8_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes in repeated strings of 400, and a digest of the rest."""
    found = substring_dedup.remove_repeated(_table(spark, sf_dir, "documents"))
    return substring_dedup.summary(found)


def op9_three_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines that repeat a window, and a digest of the rest."""
    rest = line_dedup.remove_repeated(_table(spark, sf_dir, "documents"), "removed")
    return rest.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"),
    )


def op10_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in windows of 2048 tokens, with digests of their ids."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op11_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language that stick together most."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_three_phase_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return topk_search.top_matches(_table(spark, sf_dir, "embeddings"))


def op13_dimension_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster among eight after ten rounds."""
    return centroids.clustered(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Run]:
    """Every query of the subpackage by name."""
    return {
        "pipeline": pipeline,
        "op1_character_model_ratio": op1_character_model_ratio,
        "op2_tokenizer_fertility": op2_tokenizer_fertility,
        "op3_warc_chunks": op3_warc_chunks,
        "op4_nb_ngram_toxicity": op4_nb_ngram_toxicity,
        "op5_spaced_seed_decontamination": op5_spaced_seed_decontamination,
        "op10_minimum_bin_slack": op10_minimum_bin_slack,
        "op11_toivonen_phrases": op11_toivonen_phrases,
        "op12_three_phase_threshold": op12_three_phase_threshold,
        "op13_dimension_sharded_lloyd": op13_dimension_sharded_lloyd,
        "op6_cross_entropy_difference": op6_cross_entropy_difference,
        "op7_size_aware_jaccard": op7_size_aware_jaccard,
        "op8_run_length_index": op8_run_length_index,
        "op9_three_line_windows": op9_three_line_windows,
    }


def oracle_sql() -> dict[str, str]:
    """SQL by query name, where SQL can express the query."""
    return dict(oracle.SQL)
