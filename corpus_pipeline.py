"""The training-data pipeline: five operators over ``documents``, one after the other.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and
is written as Parquet and read again by ``run``. All stages but the last return the
columns of ``documents``.

- language: documents whose language is rejected go (also those without a letter).
- near_duplicates: documents whose SimHash fingerprints over 3-word shingles differ in at
  most 2 bits are linked (``simhash``, with its own shingle length and distance); one
  document of each component stays, the one with the smallest id; of rows that repeat id
  and text, one stays.
- decontamination: documents that hold a benchmark item go.
- secrets: found spans are replaced, no document goes.
- packing: every piece of every document gets its sequence.

Null texts have no letter and go in the first stage; a null id is larger than any other in
the second; an empty table stays empty through all stages; extra columns are carried to
the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tulha.llm import decontaminate, language, packing, secrets, simhash
from tulha.llm.common import prepare, stored, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.accepted(docs, language.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.one_of_each(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.packed(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_items),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Trained models and tokenisers stand in four of the five stages: no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
