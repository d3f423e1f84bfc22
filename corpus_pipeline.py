"""The corpus pipeline: filters and transforms ``documents`` stage by stage.

language ID      drops documents without a language (null texts, texts without a letter)
line dedup       drops lines that three documents or more hold, but in the last one
near dedup       keeps one document of each group of near copies (five-word shingles agree by 0.8 or more;
                 found by operator 7's fingerprints and by MinHash bands, verified on the shingles)
secret scan      replaces secrets by a mark
packing          packs what is left into sequences of 1,024 tokens

Every stage takes and, but for the last, returns the columns of documents; n_chars follows the
text. Each works on all that its predecessor kept.

Defined cases: a null text goes at the first stage, as do texts without a letter; rows with null or
repeated ids go through all stages, told apart by their texts where one of a group stays; of rows
that agree in id and text one stays; ties go to the smaller id, then the smaller digest of the
text; very long texts are taken whole by every stage; further columns pass through up to packing,
but for the names that the stages use (__key, __id, __drop, __text, __runs, __chars and the results'
own); empty inputs give empty results. Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm import language_id, line_dedup, near_copies, packing, secret_scan
from quantloom.llm._common import saved
from quantloom.llm.queries import BYTE_BPE


def _as_documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, n_chars counted anew."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned = language_id.learn(docs)
    if not learned:  # no labels: every text with a letter stays
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language_id.predict(docs, learned)
    kept = judged.where(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.LineIndex.build(docs).apply(docs)
    return _as_documents(cut.withColumnRenamed("kept_text", "text"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_firsts(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(secret_scan.redact(docs, secret_scan.ledger(spark)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("secret scan", hide_secrets),
    ("packing", pack),
]

#: SQL can express neither the trained language identifier nor the fingerprints and token ids; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
