"""From raw documents to packed training sequences.

Every stage takes the documents that the one before it kept and returns
documents with the same columns; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlift.llm import packing, pii, simhash, suffixes
from offerlift.llm import toxicity as toxic
from offerlift.llm.queries import vocabulary
from offerlift.llm.texts import documents
from offerlift.sources.workspace import materialize, provide_folder

#: No SQL twin: hashes, suffixes and token ids are not to be had in SQL.
ORACLE_SQL = None
#: Bytes of a passage that counts as repeated: 51 words of three letters, with spaces.
PASSAGE = 204
#: Bytes under one hash in the search for them.
PASSAGE_GRAM = 64


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` of its texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; fitted on the labelled ones among them."""
    index = toxic.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic.without_toxic(docs, index)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.without_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur anywhere else, null texts as they are."""
    cut = suffixes.without_repeats(docs, window=PASSAGE, gram=PASSAGE_GRAM)
    return _counted(cut)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal numbers, dates and addresses."""
    return _counted(pii.pseudonymise(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, with their place in a sequence."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each one's rows are written and read again."""
    provide_folder(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
