"""A corpus pipeline: rules, near copies, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the
last return the columns of ``documents``, whatever further ones there are.

Defined cases of all stages: null text is an empty text; texts of any length are
read whole; an empty table passes as an empty one; ids may repeat or be null, each
row then stands for itself but where a stage says otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common, mixing, ngram_join, packing, pii, rules
from quillspark.llm.queries import SURROGATE_KEY, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go; repeated rows go or stay together, empty texts go."""
    return rules.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id; texts without words are nobody's copies."""
    return ngram_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates, equal data equal ones; a length column follows the new text."""
    out = pii.surrogates(docs, SURROGATE_KEY, kinds=None)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; texts without words count nothing and go with their source's draw."""
    return mixing.mixed(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents in padded batches by token lengths; each copy has a place of its own."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("source_mixture", source_mixture),
    ("length_packing", length_packing),
]

#: SQL has no isolation forest.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
        if i:
            # nothing reads the stage before any more
            common.remove(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
    return docs
