"""From raw documents to packed sequences: one operator after another.

``STAGES`` names them in order. Each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.folders import Folders
from sluice.functions.shared import fresh_folder
from sluice.llm import mixing, secrets, simhash, toxicity
from sluice.llm.common import passing, stored
from sluice.llm.queries import pack_documents

__all__ = ["ORACLE_SQL", "STAGES", "run", "stored"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The model learns from the documents given and the labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with their secrets masked."""
    return secrets.redact(docs, secrets.forest(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Trained models and tokenizers cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written once; what it stored on the way, and the result before, then go."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        folder = fresh_folder(spark)
        with passing(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(folder)
        if before is not None:
            Folders(spark).delete(before)
        docs, before = spark.read.schema(rows.schema).parquet(folder), folder
    return docs
