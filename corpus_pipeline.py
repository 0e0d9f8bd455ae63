"""A cleaning pipeline over documents: toxicity, exact and near duplicates, repeated strings, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomwright.llm.common import shared_dir
from loomwright.llm.exact_dedup import drop_duplicates
from loomwright.llm.ngram_join import keep_one_of_each
from loomwright.llm.packing import pack_documents
from loomwright.llm.repeats import clean_texts
from loomwright.llm.toxicity import drop_toxic

VOCABULARY = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (five words, 0.8) one stays."""
    return keep_one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur again are cut out of the texts."""
    return clean_texts(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as token pieces with their ids, each with its sequence and place."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: No SQL can give the learnt scores of the first stage; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage fed with what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
