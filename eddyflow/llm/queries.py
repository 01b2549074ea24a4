"""The registered query of each operator: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontam import contaminated_pairs
from .langid import identify
from .ngramlm import fit_and_score
from .packing import pack_documents
from .prefixtrie import conversation_trie
from .quality import judge_quality
from .resample import resample
from .rpforest import near_vectors
from .sharding import shard_documents
from .simhash import near_duplicates
from .tokens import tokenised
from .urlfilter import judge_urls
from .warc import archive_round_trip

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("host", "text_hash")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_and_score(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, QueryFn] = {
    "op1_warc": op1_warc,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_token_files": op4_token_files,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_url_filters": op6_url_filters,
    "op7_packing": op7_packing,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_embedding_dedup": op13_embedding_dedup,
}
