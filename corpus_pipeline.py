"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents
that go on. ``run`` applies them one after the other. Part of the subpackage ``tidemark.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language_id, line_dedup, mixing, ngram_join
from tidemark.llm.common import documents, importable, stored


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; those without a letter go."""
    importable(spark)
    return language_id.known_languages(docs)


def lines_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without blocks of lines that an earlier document has; a text that loses all goes."""
    importable(spark)
    return line_dedup.deduped(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles, the one with the smallest id."""
    importable(spark)
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a rate above zero, and the rate at which each enters the mixture."""
    importable(spark)
    rated = mixing.mixed_rates(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rated.where("rate > 0")


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", lines_deduped),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", decontaminated),
    ("mixing", mixed),
]

# Language scores and document rates come from fitted models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
