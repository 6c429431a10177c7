"""The dataset preparation as three plans: statistics, split, and patches with segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import radiometry
from rasterloom.functions.names import day_index, spacing_tag
from rasterloom.operators import labels, raster, stats, tiles


def dataset_statistics(pixels: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Figures by channel and spacing, and products by month; pixels have hh, hv, spacing, products acquired and ok."""
    rows = stats.channels(pixels, {"HH": "hh", "HV": "hv"}, ["spacing"])
    return stats.finalize(stats.partial_stats(rows, ["channel", "spacing"])), stats.month_histogram(products.where("ok"), F.col("acquired"))


def resampled(pixels: DataFrame, height: int, width: int, spacing: tuple[float, float], target: float) -> DataFrame:
    """One scene's pixels in dB on the target grid: to linear, area-weighted mean, back to dB."""
    linear = pixels.withColumns({b: radiometry.db_to_linear(radiometry.finite(F.col(b))) for b in ("hh", "hv")})
    out = raster.area_average(linear, ["hh", "hv"], height, width, target / spacing[0], target / spacing[1])
    return out.withColumns({b: radiometry.linear_to_db(F.col(b)) for b in ("hh", "hv")})


def class_split(pixels: DataFrame, scenes: DataFrame, percentage: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Class percentages, the scenes' split and its report; pixels have scene and label, scenes scene."""
    dense = labels.dense_counts(scenes, labels.class_counts(pixels))
    water = F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("water")
    ice = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("ice")
    parts = labels.split(dense.groupBy(F.col("scene").alias("id")).agg(water, ice), percentage)
    return labels.percentages(dense), parts, labels.split_document(parts, dense, percentage)


def patches(pixels: DataFrame, product: dict, height: int, width: int, size: int = 384, overlap: float = 0.0) -> DataFrame:
    """Patch rows of one scene: pixels (row, col, hh, hv, label, land) become windows that have a valid pixel.

    A pixel is invalid without HH, on land or without a label; its label becomes 255.
    """
    hh = radiometry.finite(F.col("hh"))
    invalid = hh.isNull() | F.col("land") | (F.coalesce("label", F.lit(labels.INVALID)) == labels.INVALID)
    marked = pixels.withColumns({"hh": hh, "hv": radiometry.finite(F.col("hv")), "invalid": invalid}).withColumn("label", F.when(invalid, labels.INVALID).otherwise(F.col("label")))
    rows, cols = raster.windows(height, size, overlap), raster.windows(width, size, overlap)
    members = raster.window_members(marked, rows, cols)
    valid = members.groupBy("wr", "wc").agg(F.bool_and("invalid").alias("gone")).where("not gone").drop("gone")
    top, left = (F.get(F.array(*[F.lit(a) for a, _ in bounds]), F.col(w)) for bounds, w in ((rows, "wr"), (cols, "wc")))
    packed = tiles.to_tiles(members.join(valid, ["wr", "wc"]), ["wr", "wc"], ["hh", "hv", "label"], top, left, min(size, height), min(size, width))
    order = F.col("wr") * len(cols) + F.col("wc")
    return packed.select(
        spacing_tag(F.lit(float(product["spacing"]))).alias("pixel_spacing"), F.lit(product["name"]).alias("product_name"), order.cast("int").alias("window"), "height", "width",
        top.alias("y1"), left.alias("x1"), "hh", "hv", F.transform("label", lambda x: x.cast("smallint")).alias("label"),
        F.month(F.lit(product["acquired"]).cast("timestamp")).alias("month"), day_index(F.lit(product["acquired"]).cast("timestamp")).alias("day"),
    )


def segmented(patch_rows: DataFrame, classes: int = 70, iterations: int = 200) -> DataFrame:
    """Patch rows with segments, n_segments and boundaries."""
    keys = ["pixel_spacing", "product_name", "window"]
    found = tiles.irgs_tiles(patch_rows.select(*keys, "height", "width", "hh", "hv"), keys, ["hh", "hv"], classes, iterations)
    return patch_rows.join(found.select(*keys, "segments", "n_segments", "boundaries", "ok", "error"), keys)


def standardized(pixels: DataFrame) -> DataFrame:
    """Model input: both bands standardised by the fixed constants."""
    return pixels.withColumns({b: radiometry.standardize(F.col(b), radiometry.BAND_MEAN[b], radiometry.BAND_STD[b]) for b in ("hh", "hv")})
