"""From product folders to statistics, split and patches, for many scenes at once.

Pixels of all scenes are one table keyed by product; sizes and spacings are columns, so no step loops over scenes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions import radiometry
from rasterloom.functions.names import day_index, spacing_tag
from rasterloom.operators import labels, raster, spatial, stats, tiles
from rasterloom.sources import products, rasters

BANDS = ("hh", "hv")


def load(spark: SparkSession, root: str, names: DataFrame | None = None, nodata: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(pixels, scenes): pixels product, row, col, hh, hv; scenes one row a product with its metadata, size, scale, ok and error.

    A product fails, and keeps its row, if its XML or raster can't be read or its bands' scales differ or are unknown.
    """
    meta = products.read_products(spark, root).withColumnRenamed("name", "product")
    if names is not None:
        meta = meta.join(names.withColumnRenamed("name", "product"), "product", "left_semi")
    rows = rasters.read_pixels(spark, root, nodata=nodata).join(meta.select("product"), "product", "left_semi")
    sizes = rows.groupBy("product").agg((F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"), F.max("error").alias("raster_error"))
    pixels = rows.where("error is null").drop("error")
    bands = stats.channels(pixels, {b: b for b in BANDS}, ["product"])
    scales = stats.exact_percentiles(bands, ["product", "channel"], "x", radiometry.SCALE_PLACES).withColumn("scale", radiometry.scale_of(F.col("p")))
    scales = scales.groupBy("product").agg(F.min("scale").alias("scale"), F.max("scale").alias("other"), F.count("*").alias("bands"))
    found = meta.join(sizes, "product", "left").join(scales, "product", "left")
    bad_scale = (F.col("scale") != F.col("other")) | F.col("scale").isin("dn", "unknown") | (F.coalesce("bands", F.lit(0)) < len(BANDS))
    error = F.coalesce(
        "error", "raster_error", F.when(F.col("n_rows").isNull(), "no raster"), F.when(~((F.col("range_m") > 0) & (F.col("azimuth_m") > 0)) | F.col("range_m").isNull(), "spacings are not positive"),
        F.when(bad_scale, "bands are not both dB or both linear"),
    )
    found = found.withColumn("error", error).withColumn("ok", F.col("error").isNull())
    return pixels, found.drop("raster_error", "other", "bands")


def is_identity(a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> Column:
    """Whether an affine transform is the identity, up to the sign of its row step."""
    near = lambda x, v: F.abs(x - v) < 1e-9
    return near(a, 1) & near(b, 0) & near(c, 0) & near(d, 0) & near(F.abs(e), 1) & near(f, 0)


def geometry(crs: Column) -> Column:
    return F.when(crs.isNull(), "sensor").otherwise("earth")


def resample(pixels: DataFrame, scenes: DataFrame, target: float) -> DataFrame:
    """product, row, col, hh, hv (dB), rows, cols on the target grid: area-weighted means of linear values; cells without a valid pixel are null."""
    sizes = scenes.where("ok").select("product", "scale", (target / F.col("azimuth_m")).alias("ry"), (target / F.col("range_m")).alias("rx"), "n_rows", "n_cols")
    count = lambda n, r: F.greatest(F.lit(1), F.bround(F.col(n) / F.col(r), 0).cast("int"))
    sizes = sizes.withColumns({"rows": count("n_rows", "ry"), "cols": count("n_cols", "rx")}).drop("n_rows", "n_cols")
    held = pixels.join(sizes, "product")
    value = lambda b: F.when(F.col("scale") == "db", radiometry.db_to_linear(radiometry.finite(F.col(b)))).otherwise(radiometry.finite(F.col(b)))
    spread = held.withColumns({b: value(b) for b in BANDS}).withColumn("r", F.explode(raster.overlaps("row", F.col("ry"), F.col("rows")))).withColumn("c", F.explode(raster.overlaps("col", F.col("rx"), F.col("cols"))))
    weight = F.col("r.w") * F.col("c.w")
    mean = lambda b: radiometry.linear_to_db(F.try_divide(F.sum(weight * F.col(b)), F.sum(F.when(F.col(b).isNotNull(), weight)))).alias(b)
    return spread.where(weight > 1e-12).groupBy("product", F.col("r.i").alias("row"), F.col("c.i").alias("col")).agg(*[mean(b) for b in BANDS], F.first("rows").alias("rows"), F.first("cols").alias("cols"))


def statistics(pixels: DataFrame, scenes: DataFrame, spacings: list[float]) -> tuple[DataFrame, DataFrame]:
    """Figures by channel and spacing over all scenes, and scenes by month."""
    parts = None
    for spacing in spacings:
        rows = resample(pixels, scenes, spacing).withColumn("spacing", F.lit(float(spacing)))
        parts = rows if parts is None else parts.unionByName(rows)
    rows = stats.channels(parts, {"HH": "hh", "HV": "hv"}, ["product", "spacing"])
    partials = stats.partial_stats(rows, ["product", "channel", "spacing"])
    figures = stats.finalize(stats.merge_stats(partials, ["channel", "spacing"]))
    return figures.withColumn("spacing", F.regexp_replace(F.col("spacing").cast("string"), r"\.0$", "")), stats.month_histogram(scenes.where("ok"), F.col("acquired"))


def geolocated(pixels: DataFrame, scenes: DataFrame) -> DataFrame:
    """pixels (on a grid of rows x cols) with lat and lon, bilinear between the product's tie points and held at their edge."""
    ties = scenes.where("ok").select(
        "product", "n_rows", "n_cols", F.array_sort(F.array_distinct(F.transform("tie_points", lambda p: p["line"]))).alias("lines"),
        F.array_sort(F.array_distinct(F.transform("tie_points", lambda p: p["pixel"]))).alias("places"),
        F.array_sort(F.transform("tie_points", lambda p: F.struct(p["line"].alias("line"), p["pixel"].alias("pixel"), p["lat"].alias("lat"), p["lon"].alias("lon")))).alias("ties"),
    )
    held = pixels.join(ties, "product").withColumns({"y": (F.col("row") + 0.5) * F.col("n_rows") / F.col("rows") - 0.5, "x": (F.col("col") + 0.5) * F.col("n_cols") / F.col("cols") - 0.5})

    def cell(axis: str, at: str) -> tuple[Column, Column]:
        low = F.greatest(F.lit(0), F.least(F.size(axis) - 2, F.size(F.filter(axis, lambda v: v <= F.col(at))) - 1))
        a, b = F.get(axis, low), F.get(axis, F.least(low + 1, F.size(axis) - 1))
        return low, F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.col(at) - a, b - a))), F.lit(0.0))

    i, u = cell("lines", "y")
    j, v = cell("places", "x")
    held = held.withColumns({"i": i, "u": u, "j": j, "v": v})

    def value(name: str) -> Column:
        wide = F.size("places")
        corner = lambda di, dj: F.get("ties", F.least(F.col("i") + di, F.size("lines") - 1) * wide + F.least(F.col("j") + dj, wide - 1))[name]
        top = (1 - F.col("v")) * corner(0, 0) + F.col("v") * corner(0, 1)
        low = (1 - F.col("v")) * corner(1, 0) + F.col("v") * corner(1, 1)
        return (1 - F.col("u")) * top + F.col("u") * low

    return held.select(*pixels.columns, value("lat").alias("lat"), value("lon").alias("lon"))


def land_mask(pixels: DataFrame, scenes: DataFrame, ocean: DataFrame | None, cell: float = 20_000.0) -> DataFrame:
    """pixels with land: outside every ocean polygon (edges lon, lat as x1, y1, x2, y2), tested at the pixel's projected place; no polygons, no land."""
    if ocean is None:
        return pixels.withColumn("land", F.lit(False))
    x, y = spatial.polar_forward(F.col("lat"), F.col("lon"))
    placed = geolocated(pixels, scenes).select("product", "row", "col", x.alias("x"), y.alias("y"))
    ends = {}
    for k in ("1", "2"):
        ends[f"px{k}"], ends[f"py{k}"] = spatial.polar_forward(F.col(f"y{k}"), F.col(f"x{k}"))
    edges = ocean.withColumns(ends).select("poly", *[F.col(f"p{c}").alias(c) for c in ("x1", "y1", "x2", "y2")])
    points = placed.select(F.struct("product", "row", "col").alias("id"), "x", "y")
    found = spatial.inside_table(points, edges, cell).select("id.product", "id.row", "id.col", (~F.col("inside")).alias("land"))
    return pixels.join(found, ["product", "row", "col"])


def labelled(pixels: DataFrame, annotations: DataFrame) -> DataFrame:
    """pixels with label: the nearest of the scene's annotation image, null without one."""
    sizes = annotations.groupBy(F.col("scene").alias("product")).agg((F.max("row") + 1).alias("lh"), (F.max("col") + 1).alias("lw"))
    near = lambda axis, n, m: F.least(F.col(n) - 1, F.floor((F.col(axis) + 0.5) * F.col(n) / F.col(m)).cast("int"))
    held = pixels.join(sizes, "product", "left").withColumns({"sr": near("row", "lh", "rows"), "sc": near("col", "lw", "cols")})
    source = annotations.select(F.col("scene").alias("product"), F.col("row").alias("sr"), F.col("col").alias("sc"), "label")
    return held.join(source, ["product", "sr", "sc"], "left").select(*pixels.columns, "label")


def patches(pixels: DataFrame, scenes: DataFrame, spacing: float, size: int = 384, overlap: float = 0.0) -> DataFrame:
    """Patch rows of all scenes: pixels product, row, col, hh, hv, label, land, rows, cols.

    A pixel is invalid without HH, on land or without a label.  Windows without a valid pixel are left out; the rest are numbered in
    raster order within their scene.  Scenes smaller than a patch are padded: bands by mirroring, labels with 255.
    """
    invalid = F.col("hh").isNull() | F.col("land") | (F.coalesce("label", F.lit(labels.INVALID)) == labels.INVALID)
    marked = pixels.withColumns({"invalid": invalid, "label": F.when(invalid, labels.INVALID).otherwise(F.col("label"))})

    def own(axis: str, n: str) -> Column:
        held = F.transform(raster.window_columns(F.col(n), size, overlap), lambda w, i: F.struct(i.alias("i"), w["lo"].alias("lo"), w["hi"].alias("hi")))
        return F.explode(F.filter(held, lambda w: (F.col(axis) >= w["lo"]) & (F.col(axis) < w["hi"])))

    members = marked.withColumn("wr", own("row", "rows")).withColumn("wc", own("col", "cols"))
    members = members.withColumns({"top": F.col("wr.lo"), "left": F.col("wc.lo"), "crop_h": F.col("wr.hi") - F.col("wr.lo"), "crop_w": F.col("wc.hi") - F.col("wc.lo"), "wr": F.col("wr.i"), "wc": F.col("wc.i")})
    keys = ["product", "wr", "wc"]
    valid = members.groupBy(*keys).agg(F.bool_and("invalid").alias("gone"), F.first("top").alias("y1"), F.first("left").alias("x1"), F.first("crop_h").alias("h"), F.first("crop_w").alias("w")).where("not gone")
    valid = valid.withColumn("patch_id", (F.row_number().over(W.partitionBy("product").orderBy("wr", "wc")) - 1).cast("int"))
    packed = tiles.to_padded_tiles(members.join(valid.select(*keys), keys, "left_semi"), keys, ["hh", "hv", "label"], size, {"label": labels.INVALID})
    meta = scenes.select("product", "product_id", F.month("acquired").alias("month"), day_index(F.col("acquired")).alias("day"))
    return packed.join(valid, keys).join(meta, "product", "left").select(
        spacing_tag(F.lit(float(spacing))).alias("pixel_spacing"), F.col("product").alias("product_name"), "product_id", "patch_id", "x1", "y1", (F.col("x1") + F.col("w")).alias("x2"),
        (F.col("y1") + F.col("h")).alias("y2"), "height", "width", "hh", "hv", F.transform("label", lambda x: x.cast("smallint")).alias("label"), "month", "day",
    )


def segment(patch_rows: DataFrame, classes: int = 70, iterations: int = 200) -> DataFrame:
    """Patch rows with segments (null where invalid), n_segments and boundaries (-1 where invalid)."""
    keys = ["pixel_spacing", "product_name", "patch_id"]
    found = tiles.irgs_tiles(patch_rows.select(*keys, "height", "width", "hh", "hv", "label"), keys, ["hh", "hv"], classes, iterations, labels="label")
    return patch_rows.join(found.select(*keys, "segments", "n_segments", "boundaries", "ok", "error"), keys)
