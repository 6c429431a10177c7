"""Bounded samples of different rows, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def different_texts(docs: DataFrame, size: int, also=None) -> DataFrame:
    """key, place and text of about `size` different (doc_id, text) rows of docs, at most twice as many, for which `also` holds.

    Chosen by a hash of id and text, so the choice does not depend on partitions, and neither null or repeated ids
    nor repeated rows make it larger.  Empty and null texts are left out.  Copies meet before they are shuffled.
    """
    rows = docs.where("text is not null and text <> ''")
    rows = (rows if also is None else rows.where(also)).select("text", F.xxhash64("doc_id", "text").alias("key"))
    share = min(1.0, size / max(1, rows.agg(F.approx_count_distinct("key", 0.02)).first()[0]))
    chosen = rows.withColumn("place", F.pmod("key", F.lit(1 << 30))).where(F.col("place") < int((1 << 30) * share))
    chosen = chosen.groupBy("key").agg(F.min("place").alias("place"), F.min("text").alias("text"))
    return chosen.orderBy("place", "key").limit(2 * size)
