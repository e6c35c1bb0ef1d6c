"""From raw documents to packed training sequences, in five stages.

Each stage takes all its predecessor kept and returns a DataFrame; all but the last return the columns of
their input, whatever these are. Null texts count as empty. Rows are judged one by one, by their text: ids may be
missing or repeated. An empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import feistel, gam, minhash, packing, rules
from clickloom.llm.common import fresh_name
from clickloom.llm.queries import PSEUDONYM_KEY, QUALITY_THRESHOLD, training_labels
from clickloom.sources.tables import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold. The model learns from the labelled documents among them."""
    model = gam.train(docs, training_labels(spark, sf_dir))
    name = fresh_name(docs.columns, "score")
    scored = gam.score(docs, model, docs.columns, name=name)
    return scored.where(F.col(name) >= QUALITY_THRESHOLD).drop(name)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from the labelled ones among them."""
    return rules.screen(docs, training_labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id."""
    return minhash.one_of_each_group(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal numbers and dates."""
    return feistel.pseudonymise(docs, PSEUDONYM_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near-duplicates", drop_near_duplicates),
    ("pseudonyms", pseudonymise),
    ("packing", pack),
]

#: The learned stages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written down for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
