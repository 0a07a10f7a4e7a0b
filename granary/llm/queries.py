"""The numbered operators and the pipeline, bound to the given tables.

``queries()`` and ``oracle_sql()`` are what the entry file adds to its own.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from granary.llm.bitslices import SEARCH_SQL, search
from granary.llm.brown import score_documents
from granary.llm.collocations import COLLOCATIONS_SQL, collocations
from granary.llm.manifest import MANIFEST_SQL, verified
from granary.llm.outliers import judge
from granary.llm.packing import pack
from granary.llm.pieces import encode_table
from granary.llm.positions import CONTAMINATED_SQL, contaminated
from granary.llm.private import find
from granary.llm.repair import round_trip
from granary.llm.repeats import REPEATS_SQL, remove_repeats
from granary.llm.sharding import shard_documents
from granary.llm.simhash import near_duplicates


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_brown_classes(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"))


def op2_repair_shards(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_mcd_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))


def op4_suffix_tree_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op5_bit_sliced_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"))


def op6_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op7_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_piece_agenda(spark: SparkSession, folder: str) -> DataFrame:
    return encode_table(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_bootstrapped_contexts(spark: SparkSession, folder: str) -> DataFrame:
    return find(table(spark, folder, "documents")).drop("mark")


def op10_kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))


def op11_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_misra_gries_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return verified(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (op1_brown_classes, op2_repair_shards, op3_mcd_outliers, op4_suffix_tree_repeats, op5_bit_sliced_search, op6_simhash_bktree, op7_bin_completion, op8_piece_agenda, op9_bootstrapped_contexts, op10_kd_tree_shards, op11_positional_index, op12_misra_gries_phrases, op13_merkle_manifest)
    return {f.__name__: f for f in numbered} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    known = {"op4_suffix_tree_repeats": REPEATS_SQL, "op5_bit_sliced_search": SEARCH_SQL, "op11_positional_index": CONTAMINATED_SQL, "op12_misra_gries_phrases": COLLOCATIONS_SQL, "op13_merkle_manifest": MANIFEST_SQL}
    return known | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
