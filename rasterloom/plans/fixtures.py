"""Rasters and scenes derived from the driver's tables, for Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 64
HALF = WIDTH // 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, v: one band, 64 columns."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "v")).withColumn("v", F.col("v").cast("double"))


def two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, hh, hv: two bands, 32 columns."""
    e = table(spark, sf_dir, "embeddings")
    bands = F.arrays_zip(F.slice("embedding", 1, HALF).alias("hh"), F.slice("embedding", HALF + 1, HALF).alias("hv"))
    out = e.select(F.col("vec_id").alias("row"), F.posexplode(bands).alias("col", "p"))
    return out.select("row", "col", F.col("p.hh").cast("double").alias("hh"), F.col("p.hv").cast("double").alias("hv"))


def signed_round(v, places: int) -> F.Column:
    """v rounded; a negative number that rounds to zero gives -0.0, as in the SQL."""
    v = F.col(v) if isinstance(v, str) else v
    return F.round(F.abs(v), places) * F.signum(v)


def height(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the raster."""
    return table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] + 1


def quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, g: ras in 256 grey levels."""
    level = F.floor((F.col("v") + 0.6) / 1.2 * 256).cast("int")
    return ras(spark, sf_dir).select("row", "col", F.least(F.lit(255), F.greatest(F.lit(0), level)).alias("g"))


def class_of(v) -> F.Column:
    return F.when(v < -0.05, 0).when(v < 0.05, 1).otherwise(2)


def scene_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scene, label: each event is a pixel."""
    kinds = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2)
    label = kinds.when(F.col("event_type") == "signup", 3).otherwise(255)
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("scene"), label.alias("label"))


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two with region: blocks of 8x8 whose last row and column are boundary (-2)."""
    edge = (F.col("row") % 8 == 7) | (F.col("col") % 8 == 7)
    block = (F.floor(F.col("row") / 8) * 4 + F.floor(F.col("col") / 8)).cast("int")
    return two(spark, sf_dir).withColumn("region", F.when(edge, -2).otherwise(block))


RAS = "ras AS (SELECT vec_id AS row, unnest(range(64))::INTEGER AS col, unnest(embedding)::DOUBLE AS v FROM embeddings)"
TWO = "two AS (SELECT vec_id AS row, i::INTEGER AS col, embedding[i + 1]::DOUBLE AS hh, embedding[i + 33]::DOUBLE AS hv FROM embeddings, range(32) t(i))"
QUANTISED = f"{RAS}, q AS (SELECT row, col, least(255, greatest(0, floor((v + 0.6::DOUBLE) / 1.2::DOUBLE * 256)::INTEGER)) AS g FROM ras)"
CLASSES = f"{RAS}, cls AS (SELECT row, col, v, CASE WHEN v < -0.05::DOUBLE THEN 0 WHEN v < 0.05::DOUBLE THEN 1 ELSE 2 END AS k FROM ras)"
SCENES = """sc AS (SELECT event_id, user_id AS scene,
    CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 255 END AS label FROM events)"""
REGIONS = f"""{TWO}, reg AS (SELECT *, CASE WHEN row % 8 = 7 OR col % 8 = 7 THEN -2 ELSE ((row // 8) * 4 + col // 8)::INTEGER END AS region FROM two)"""
NEIGHBOURS = "off(k, dr, dc) AS (VALUES (0, 0, -1), (1, -1, -1), (2, -1, 0), (3, -1, 1), (4, 0, 1), (5, 1, 1), (6, 1, 0), (7, 1, -1))"
