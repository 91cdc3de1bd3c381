"""The text operators as queries, with their SQL counterparts where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import (alignment, bpe, chat, classifier, linededup, minhash, packing, parsing, quality, sharding,
                           simhash, suffix, whitening)
from wattframe.llm.common import documents


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(chat.branches(chat.as_trees(given.union(planted))))).drop("branch")


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(documents(spark, folder))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(documents(spark, folder), ["doc_id"])


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    report = linededup.line_report(documents(spark, folder))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    none = F.coalesce("drop", F.array().cast("array<bigint>"))
    return report.select(
        F.col("row.doc_id").alias("doc_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                               for c in ("n_copies", "n_near", "n_links")],
        F.sha2(linededup.kept_lines(text, none), 256).alias("kept_sha256"))


def op6_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.scored(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder)).drop("fp")


def op8_parsing(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.compared(documents(spark, folder))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json")))


def op10_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.deduplicated(documents(spark, folder), suffix.DIGEST, suffix.digest_row)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def _importable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Lets workers import this library from where the driver has it, whatever folder they start in."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return query(spark, folder)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe, "op2_chat": op2_chat, "op3_sharding": op3_sharding, "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup, "op6_classifier": op6_classifier, "op7_simhash": op7_simhash,
    "op8_parsing": op8_parsing, "op9_packing": op9_packing, "op10_suffix": op10_suffix,
    "op11_alignment": op11_alignment, "op12_minhash": op12_minhash,
    "op13_whitening": op13_whitening, "pipeline": pipeline,
}
QUERIES = {name: _importable(query) for name, query in QUERIES.items()}

ESCAPED = "replace(replace(replace(text, '\\', '\\\\'), '#', '\\#'), '</turn>', '<\\/turn>')"

ORACLES: dict[str, str] = {
    "op2_chat": f"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
            union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok')
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
                   as loss_sha256,
               cast(sum(length({ESCAPED}) + length(role) + 15) as bigint) as formatted_chars
        from turns group by conv_id""",
}
