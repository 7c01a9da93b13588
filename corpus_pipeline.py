"""A corpus from raw documents to encoded token ids, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` applies them to ``documents`` in order: what a stage
returns is written to the shared folder and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serplens.llm import op03_jaccard_join, op05_token_blocks, op07_decontamination, op09_line_labels
from serplens.llm import op10_mixing as mixing
from serplens.llm.registry import tokenizer_file
from serplens.llm.tables import documents, table
from serplens.sources.storage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or are mostly boilerplate lines go."""
    field = op09_line_labels.fit_field(docs, table(spark, sf_dir, "labels"))
    return op09_line_labels.keep_good(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return op03_jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    return op07_decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut is shortened."""
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    return mixing.repeat_taken(mixing.mix(sized)).select(*docs.columns)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids start in the encoded files, their number and checksum."""
    return op05_token_blocks.encoded_roundtrip(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_blocks),
]

#: SQL has no counterpart to the line labels; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{i + 1}")
    return docs
