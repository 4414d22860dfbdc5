"""The named queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foreledger.llm import (
    collocations,
    decontaminate,
    exact,
    langid,
    mixing,
    pst,
    repeats,
    rules,
    secrets,
    simhash,
    tokens,
    toxicity,
    warc,
)
from foreledger.llm.common import remainder, run_dir, ship, stored
from foreledger.sources.tables import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(rules.ledger(read_table(spark, sf_dir, "documents")), "rule-ledger")
    return rules.apply_policy(rows, rules.POLICIES[rules.CURRENT])


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.train(docs.where(~held_out))
    return langid.predicted(docs, model, F.col("doc_id"), held_out.alias("held_out"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.groups(read_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    return pst.scored(docs, ~held_out, F.col("doc_id"), held_out.alias("held_out"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.passages(docs, items).drop("text_key")


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    folder = run_dir(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    tokens.write_tokens(read_table(spark, sf_dir, "documents"), vocabulary, folder)
    return tokens.read_tokens(spark, folder)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stored(secrets.scan_unseen(docs, None, "doc_id", "text"), "secret-ledger")
    return secrets.findings_by_path(docs, found, "doc_id", "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs.where(~held_out), labels)
    return toxicity.scored(
        docs, model, F.col("doc_id"), held_out.alias("held_out")
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs).select(
        "doc_id",
        "source",
        F.col("_fl_block").alias("block"),
        F.col("_fl_cycle").alias("cycle"),
        F.col("_fl_slot").alias("slot"),
        F.col("_fl_position").alias("position"),
        F.col("_fl_place").alias("place"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    folder = run_dir(spark, "warc")
    stored(warc.write_archives(read_table(spark, sf_dir, "pages"), folder), "warc-manifest")
    return warc.read_archives(spark, folder)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return collocations.ranked(collocations.mined(read_table(spark, sf_dir, "documents")), 2000)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return repeats.digests(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_simhash": op3_simhash,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_decontamination": op5_decontamination,
    "op6_token_ids": op6_token_ids,
    "op7_secret_scan": op7_secret_scan,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}
