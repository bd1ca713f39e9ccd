"""Training-data pipeline: quality rules, near duplicates, personal data, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir),
where ``docs`` is what the stage before it kept, and returns a DataFrame.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import landed, table
from pulsekit.llm.ngram_jaccard import ngram_jaccard_components
from pulsekit.llm.packing import best_fit_packing
from pulsekit.llm.pii import mask_personal_data
from pulsekit.llm.quality_rules import quality_rules

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents, with the lines removed that fail; n_chars follows the text.

    A filter on ``kept`` would be pushed below the rules and judge every text a second time; rows that
    are not kept become null arrays instead, which ``inline`` drops.
    """
    judged = quality_rules(docs.select("doc_id", "text", "lang", "source"))
    row = F.struct("doc_id", F.col("clean_text").alias("text"), "lang", "source",
                   F.length("clean_text").cast("long").alias("n_chars"))
    return judged.select(F.inline(F.when(F.col("kept"), F.array(row))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id.

    A document is a doc_id with one text: texts that share a doc_id and are not similar all stay, of rows
    that repeat both one stays.  Rows without doc_id are in no group and stay.
    """
    named = docs.filter("doc_id is not null").withColumn("_node", F.xxhash64("doc_id", "text"))
    components = landed(ngram_jaccard_components(named.select(F.col("_node").alias("doc_id"), "text")), "components")
    first = (components.select(F.col("doc_id").alias("_node"), "component_id").distinct()
             .join(named.select("_node", "doc_id"), "_node").groupBy("component_id")
             .agg(F.min(F.struct("doc_id", "_node")).alias("x")).select("x._node").distinct())
    order = Window.partitionBy("_node", "doc_id", F.hash("text")).orderBy(F.xxhash64("text", "lang", "source", "n_chars"))
    kept = (named.join(first, "_node", "left_semi").withColumn("_row", F.row_number().over(order))
            .filter("_row = 1").select(*docs.columns))
    return kept.unionByName(docs.filter("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with identifiers replaced by their kind."""
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences."""
    return best_fit_packing(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality_rules", quality), ("ngram_jaccard", near_duplicates), ("personal_data", personal_data),
          ("best_fit_packing", packing)]

#: Components, bootstrapping and tokenization have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
