"""From raw documents to token files: stages that each apply one operator to all rows left."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foreledger.llm import decontaminate, mixing, rules, simhash, tokens
from foreledger.llm.common import run_dir, ship, stored
from foreledger.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return rules.keep(docs, rules.POLICIES[rules.CURRENT])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files whose order is the mix of the sources."""
    return mixing.in_order(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the stage before has written the documents."""
    ship(spark)
    folder = run_dir(spark, "tokens")
    at = docs.metadataColumn("_metadata")
    order = F.struct(at["file_path"].alias("file"), at["row_index"].alias("row"))
    tokens.write_tokens(docs, public_tokenizers.path(VOCABULARY), folder, order)
    return tokens.read_tokens(spark, folder)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("token_files", token_files),
]

# the last stage writes token ids of an external vocabulary, which SQL cannot make
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written before the next stage reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
