"""Class maps from a segmentation model, tile by tile."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from rasterloom.functions.radiometry import BAND_MEAN, BAND_STD, FLOOR


def input_divisor(strides: list[int] | None, downsamples: list[bool] | None = None) -> int:
    """What a model's input sides must be divisible by: with stages that may downsample, 2 for each that does; else the product of the strides; 32 if unknown."""
    if strides is None:
        return 32
    if downsamples is not None:
        return 2 ** sum(s == 2 or d for s, d in zip(strides[1:], downsamples, strict=False))
    return math.prod(strides)


def predict_tiles(tiles: DataFrame, keys: list[str], load: Callable[[], Callable[[np.ndarray], np.ndarray]], divisor: int = 32) -> DataFrame:
    """keys and the class of each pixel of tiles (height, width, hh, hv).

    load makes the model once a task: it maps [2, rows, cols] to logits [classes, rows, cols].
    Bands are standardised, missing pixels become 0, and tiles are padded by reflection to the divisor.
    """
    types = {f.name: f.dataType.simpleString() for f in tiles.schema.fields}

    def run(batches):
        model = load()
        for frame in batches:
            rows = []
            for _, tile in frame.iterrows():
                h, w = int(tile["height"]), int(tile["width"])
                bands = [np.asarray(tile[b], dtype=float).reshape(h, w) for b in ("hh", "hv")]
                image = np.stack([np.nan_to_num((x - BAND_MEAN[b]) / (BAND_STD[b] + FLOOR)) for x, b in zip(bands, ("hh", "hv"), strict=True)])
                wide = np.pad(image, ((0, 0), (0, -h % divisor), (0, -w % divisor)), mode="reflect")
                rows.append({k: tile[k] for k in keys} | {"classes": model(wide)[:, :h, :w].argmax(0).ravel().tolist()})
            yield pd.DataFrame(rows, columns=[*keys, "classes"])

    return tiles.mapInPandas(run, ", ".join([*(f"{k} {types[k]}" for k in keys), "classes array<int>"]))
