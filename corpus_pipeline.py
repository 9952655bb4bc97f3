"""A corpus pipeline of five stages over ``documents``: toxicity, exact copies, near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns the rows that stay (all columns of its input); the last returns packed pieces. ``run`` writes each stage's
result to the shared folder and hands the reread table on. Stages inherit the edge cases of their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickweave.llm.common import read_table, stored
from tickweave.llm.exact_dedup import drop_copies
from tickweave.llm.mixing import sample_mixture
from tickweave.llm.packing import pack
from tickweave.llm.similarity_join import keep_one_of_each
from tickweave.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")), with_ids=False).drop("ids")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("ngram_jaccard_join", near), ("mixing", mixture), ("packing", packing)]

#: Learned scores, shingle components and calibrated draws are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
