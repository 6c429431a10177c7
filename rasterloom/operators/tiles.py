"""Tile tables: one row a patch with its bands as arrays, and the kernels that run on each tile."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.kernels import filters, segmentation

TILE = "height int, width int"


def to_tiles(pixels: DataFrame, keys: list[str], bands: list[str], top: Column, left: Column, height: int, width: int) -> DataFrame:
    """keys, height, width and one array a band in raster order; places without a pixel are NaN (bounded by the tile's size).

    Tiles are few bytes and much work, so they keep the number of shuffle partitions instead of being coalesced by size.
    """
    tasks = int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ((F.col("row") - top) * width + (F.col("col") - left)).cast("int")
    held = pixels.withColumn("place", place).repartition(tasks, *keys).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct(*bands).alias("v")))).alias("held"))
    index = F.sequence(F.lit(0), F.lit(height * width - 1))

    def array(band: str) -> Column:
        return F.transform(index, lambda i: F.coalesce(F.try_element_at("held", i)[band].cast("double"), F.lit(float("nan")))).alias(band)

    return held.select(*keys, F.lit(height).alias("height"), F.lit(width).alias("width"), *map(array, bands))


def to_padded_tiles(pixels: DataFrame, keys: list[str], bands: list[str], size: int, outside: dict[str, float]) -> DataFrame:
    """keys and square arrays of a fixed size; pixels have top, left, crop_h and crop_w of their window.

    Beyond a window smaller than the size, bands are mirrored (edge pixels repeated, as often as needed), and
    those named in `outside` get its value.
    """
    tasks = int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ((F.col("row") - F.col("top")) * size + (F.col("col") - F.col("left"))).cast("int")
    held = pixels.withColumn("place", place).repartition(tasks, *keys).groupBy(*keys)
    held = held.agg(F.first("crop_h").alias("crop_h"), F.first("crop_w").alias("crop_w"), F.map_from_entries(F.collect_list(F.struct("place", F.struct(*bands).alias("v")))).alias("held"))
    index = F.sequence(F.lit(0), F.lit(size * size - 1))

    def back(at: Column, n: Column) -> Column:
        turn = at % (2 * n)
        return F.when(turn < n, turn).otherwise(2 * n - 1 - turn)

    def array(band: str) -> Column:
        def value(i: Column) -> Column:
            r, c = F.floor(i / size).cast("int"), i % size
            found = F.try_element_at("held", (back(r, F.col("crop_h")) * size + back(c, F.col("crop_w"))).cast("int"))[band].cast("double")
            if band in outside:
                found = F.when((r < F.col("crop_h")) & (c < F.col("crop_w")), found).otherwise(F.lit(float(outside[band])))
            return F.coalesce(found, F.lit(float("nan")))

        return F.transform(index, value).alias(band)

    return held.select(*keys, F.lit(size).alias("height"), F.lit(size).alias("width"), *map(array, bands))


def run_kernel(tiles: DataFrame, keys: list[str], kernel: Callable[[pd.Series], dict], schema: str) -> DataFrame:
    """Applies the kernel to each tile; a tile that fails keeps its keys, with ok false and the error's text."""
    names = [f.split()[0] for f in schema.split(",")]
    types = {f.name: f.dataType.simpleString() for f in tiles.schema.fields}
    out = ", ".join([*(f"{k} {types[k]}" for k in keys), schema, "ok boolean", "error string"])

    def run(batches):
        for frame in batches:
            rows = []
            for _, tile in frame.iterrows():
                row = {k: tile[k] for k in keys}
                try:
                    row |= kernel(tile) | {"ok": True, "error": None}
                except Exception as e:  # one tile's failure must not stop the job; it is reported in its row
                    row |= dict.fromkeys(names) | {"ok": False, "error": f"{type(e).__name__}: {e}"}
                rows.append(row)
            yield pd.DataFrame(rows, columns=[*keys, *names, "ok", "error"])

    return tiles.mapInPandas(run, out)


def _image(tile: pd.Series, band: str) -> np.ndarray:
    return np.asarray(tile[band], dtype=float).reshape(int(tile["height"]), int(tile["width"]))


def _unit(image: np.ndarray) -> np.ndarray:
    low, high = np.nanmin(image), np.nanmax(image)
    return (image - low) / (high - low + 1e-8)


def watershed_tiles(tiles: DataFrame, keys: list[str], bands: list[str], sigma: float = 1.2) -> DataFrame:
    """keys, labels (array), n_regions."""

    def kernel(tile: pd.Series) -> dict:
        images = [_image(tile, b) for b in bands]
        mask = ~np.isnan(images[0])
        filled = [np.where(np.isnan(i), np.nanmean(i), i) for i in images]
        labels = segmentation.watershed(filters.smooth(filters.gradient(filled, mask), sigma), mask)
        return {"labels": labels.ravel().tolist(), "n_regions": int(labels.max(initial=-1)) + 1}

    return run_kernel(tiles, keys, kernel, "labels array<int>, n_regions int")


def irgs_tiles(tiles: DataFrame, keys: list[str], bands: list[str], classes: int, iterations: int, temperature: float | None = None, seed: int = 0, labels: str | None = None) -> DataFrame:
    """keys, segments (array, null where masked), n_segments, boundaries (1 or -1), classes (array), energies.

    Pixels whose label is 255 take part in the segmentation, but are left out of its result.
    """

    def kernel(tile: pd.Series) -> dict:
        images = [_unit(_image(tile, b)) for b in bands]
        mask = ~np.isnan(images[0])
        filled = [np.where(np.isnan(i), 0.0, i) for i in images]
        found = segmentation.irgs(filled, mask, classes, iterations, seed, temperature=temperature)
        if labels:
            invalid = _image(tile, labels) == 255
            found.classes[invalid], found.boundaries[invalid] = -1, -1
        parts, n = segmentation.segments(found)
        return {
            "segments": [None if s < 0 else int(s) for s in parts.ravel()], "n_segments": n, "boundaries": found.boundaries.ravel().tolist(),
            "classes": found.classes.ravel().tolist(), "energies": found.energies,
        }

    return run_kernel(tiles, keys, kernel, "segments array<int>, n_segments int, boundaries array<smallint>, classes array<int>, energies array<double>")


def gabor_tiles(tiles: DataFrame, keys: list[str], band: str, frequencies=(0.1, 0.2, 0.3), orientations: int = 4) -> DataFrame:
    """keys and the mean magnitude of each filter's response."""

    def kernel(tile: pd.Series) -> dict:
        return {"response": filters.gabor_bank(np.nan_to_num(_image(tile, band)), frequencies, orientations).mean(axis=(1, 2)).tolist()}

    return run_kernel(tiles, keys, kernel, "response array<double>")


def epx_tiles(tiles: DataFrame, keys: list[str], band: str) -> DataFrame:
    """keys and the doubled image as an array."""
    return run_kernel(tiles, keys, lambda tile: {"doubled": filters.epx(_image(tile, band)).ravel().tolist()}, "doubled array<double>")
