"""From raw documents to packed training sequences: five stages, each written and read again.

1. ``quality_rules``: documents that fail the base rule or a certified cutoff go.
2. ``near_duplicates``: of documents linked by five-word shingles at 0.8 or more, directly or over
   others, one stays.
3. ``personal_data``: spans found are replaced by their kind.
4. ``source_mix``: sources are drawn to their target weights; a document may come up to three times.
5. ``packing``: token ids in sequences of at most 4,096.

All but the last return the columns of ``documents``; ``n_chars`` follows the text where a stage
changes it. Every stage handles nulls in any column, empty and very long texts, repeated rows, empty
tables and further columns as its operator states.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm import mixing, near_dup, packing, pii, quality
from hitledger.llm.shared import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs, threshold=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, width=4096)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", pack_sequences),
]

# SQL can express neither the binomial bounds, the trees, the draws nor the tokenizer; tests hold the
# stages against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
