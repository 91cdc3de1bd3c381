"""A corpus made ready for training: rejected, deduplicated by line, document and byte string, and packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import linededup, packing, quality, simhash, suffix
from wattframe.llm.common import documents, row_key, staged


def _with_text(docs: DataFrame, text, source: str = "row") -> DataFrame:
    """The columns of ``docs`` from the struct ``source``, with ``text`` and, if there, its length replaced."""
    made = {"text": text, "n_chars": F.length(F.col("_text")).cast("long")}
    return docs.withColumn("_text", text).select(*[
        F.col("_text").alias("text") if c == "text" else made["n_chars"].alias(c) if c == "n_chars"
        else F.col(f"{source}.`{c}`") for c in docs.select(f"{source}.*").columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the rules, each judged by its own text and language, whatever ids there are."""
    keyed = docs.withColumn("_key", row_key(docs, "lang"))
    failed = quality.judged(keyed, ["_key"]).where("not kept").select("_key").distinct()
    return keyed.join(failed, "_key", "left_anti").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one."""
    return _with_text(linededup.line_report(docs), linededup.kept_lines(F.col("row.text"), F.col("drop")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id; unlike texts stay, also without or with equal ids."""
    kept = staged(simhash.first_rows(docs).withColumnRenamed("key", "_key"), "kept")
    return (docs.withColumn("_key", row_key(docs)).join(kept, "_key", "left_semi")
            .dropDuplicates(["_key"]).select(*docs.columns))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings that stand in an earlier one; a cut character goes whole."""
    changed = suffix.deduplicated(docs, "kept binary, n_removed long, text binary", lambda text, removed: (
        suffix.kept_bytes(text, removed).decode("utf-8", "ignore").encode(),
        sum(b - a for a, b in removed), text if removed else None)).where("n_removed > 0")
    changed = changed.select(row_key(changed).alias("_key"), F.col("kept").cast("string").alias("kept"))
    rows = docs.select(F.struct("*").alias("row")).withColumn("_key", row_key(docs, source="row."))
    joined = rows.join(changed.dropDuplicates(["_key"]), "_key", "left").drop("_key")
    return _with_text(joined, F.coalesce("kept", "row.text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, each with its sequence and place there."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("suffix_dedup", suffix_dedup), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
