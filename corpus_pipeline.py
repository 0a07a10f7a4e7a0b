"""From raw documents to packed sequences: quality, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last
return the columns of documents, extra columns included. ``run`` writes each stage and reads it
again, so a lost executor never reaches further back than its stage. A decision is about a
doc_id and a text together, so different texts under one doc_id (or none) are decided
apart. No SQL expresses the stages (``ORACLE_SQL`` is None); tests hold them against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm import simhash
from granary.llm.outliers import judge
from granary.llm.packing import pack
from granary.llm.private import redact
from granary.llm.repeats import remove_repeats
from granary.llm.text import text_mark
from granary.sources.workspace import settle


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__doc": F.col("doc_id").cast("long"), "__mark": text_mark("text")})


def _keys(decided: DataFrame) -> DataFrame:
    return decided.select(F.col("doc_id").alias("__its_doc"), F.col("mark").alias("__its_mark")).distinct()


def _same() -> Column:
    return F.col("__doc").eqNullSafe(F.col("__its_doc")) & (F.col("__mark") == F.col("__its_mark"))


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text, where documents have it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rejected = _keys(judge(docs).filter(~F.col("kept")))
    return _keyed(docs).join(rejected, _same(), "left_anti").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (texts of similarity 0.8 in words, see ``simhash.near_copies``): the one with the smallest doc_id, of its texts the one with the least hash.

    Without any doc_id in a group, the text with the least hash stays.
    """
    found = simhash.near_copies(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    group = Window.partitionBy("root").orderBy("mark")
    first = found.select("doc_id", "mark", "root").distinct().withColumn("rank", F.row_number().over(group))
    kept = _keyed(docs).join(_keys(first.filter("rank = 1")), _same(), "left_semi")
    return kept.dropDuplicates(["__doc", "__mark"]).select(docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that also start earlier; a text that keeps all its words stays as it is, one that keeps none goes."""
    cut = remove_repeats(docs, keep_text=True)
    cut = cut.select(
        F.col("doc_id").alias("__its_doc"), F.col("mark").alias("__its_mark"), F.col("text").alias("__text"),
        ((F.col("n_removed") == F.col("n_words")) & (F.col("n_removed") > 0)).alias("__empty"),
    ).dropDuplicates(["__its_doc", "__its_mark"])
    others = _keyed(docs).withColumn("__null", F.col("text").isNull()).drop("text")
    text = F.when(~F.col("__null"), F.col("__text")).alias("text")
    joined = others.join(cut, _same()).filter(~F.col("__empty"))
    return _with_length(joined.select(*(text if c == "text" else c for c in docs.columns)))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return _with_length(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages), ("private", private), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
