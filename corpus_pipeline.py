"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and its result is written and read again as the next one's docs.

All stages but the last return the columns of docs, whatever else there is beside doc_id, text and source; columns that
share a name with inner ones stay as they are.  Texts of any length are read whole.  Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import decontam, lang_id, ngram_join, packing, secrets
from rasterloom.llm.staging import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go: null, empty and letterless texts, and those of a score below 0.35.

    Repeated rows share their fate; rows with a null doc_id are judged by their text, but never learned from.
    """
    return lang_id.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id.

    Of rows equal in doc_id and text one stays, chosen by a hash of the other columns.  Rows without words or
    with a null doc_id all stay.
    """
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go, with all rows of their doc_id.

    Null and empty texts and rows with a null doc_id stay; null and wordless items match nothing.
    """
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets inside texts are replaced by a mark, and n_chars follows; overlapping ones get one mark.

    No row goes: null and empty texts stay as they are, repeated rows get equal results.
    """
    return secrets.redact(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into sequences; equal lengths go by doc_id, text and source.

    Texts without words have no bin; rows with a null doc_id and repeated rows are packed each.
    """
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit", best_fit),
]

#: Learned models and a sequential packing have no SQL.  Tests hold the operators against brute force where there is one, and
#: the stages against planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
