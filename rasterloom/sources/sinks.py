"""Reports, lists and patches written through Spark's writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators import stats


def write_stats_json(figures: DataFrame, months: DataFrame, path: str) -> None:
    """One JSON document: channel -> spacing -> figures, and the months' counts."""
    report = stats.document(figures, months)
    held, rest = F.to_json("channels"), F.to_json(F.struct("acquisition_month_histogram"))
    inner = F.expr("substring(held, 2, length(held) - 2)")
    line = F.concat(F.lit("{"), inner, F.when(inner == "", "").otherwise(","), F.expr("substring(rest, 2)"))
    report.select(held.alias("held"), rest.alias("rest")).select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_failures(status: DataFrame, path: str) -> bool:
    """Writes {product, error} of failed products, if there are any."""
    failed = status.where(~F.col("ok")).select(F.col("name").alias("product"), "error")
    if failed.isEmpty():
        return False
    failed.write.mode("overwrite").json(path)
    return True


def write_split_summary(report: DataFrame, path: str) -> None:
    """The split's report as one JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_split(parts: DataFrame, folder: str, percentage: int) -> None:
    """train_XX and val_YY name lists, a name a line in id order."""
    for kind, share in (("train", percentage), ("val", 100 - percentage)):
        names = parts.where(F.col("split") == kind).orderBy("id").select(F.col("id").cast("string").alias("value"))
        names.coalesce(1).write.mode("overwrite").text(f"{folder}/{kind}_{share:02d}")  # one name a scene


def write_patches(patches: DataFrame, path: str) -> None:
    """Patches by spacing and product; only the partitions that are written anew are replaced."""
    patches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pixel_spacing", "product_name").parquet(path)


def read_patches(spark, path: str, spacing: str | None = None) -> DataFrame:
    """Patches, of one spacing if given (a partition filter)."""
    patches = spark.read.parquet(path)
    return patches.where(F.col("pixel_spacing") == spacing) if spacing else patches


def write_pixels(pixels: DataFrame, path: str) -> None:
    pixels.write.mode("overwrite").option("header", "true").csv(path)
