"""Operators on tables of several images give what they give on each image alone; and arithmetic that replaced searches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import cluster, raster, regions, stats


@pytest.fixture(scope="module")
def scenes(spark):
    rng = random.Random(3)
    rows = [(s, r, c, rng.gauss(0, 1), rng.gauss(0, 1), rng.choice([0, 0, 1, 2, -2])) for s in ("a", "b") for r in range(9) for c in range(11)]
    return spark.createDataFrame(rows, "scene string, row int, col int, hh double, hv double, k int").cache()


def rows_of(frame):
    return sorted((tuple(map(str, r)) for r in frame.select(*sorted(frame.columns)).collect()))


def gmm(scenes):
    return cluster.gmm_of_pixels(scenes)


CASES = {
    "components": lambda p, image: regions.components(p, "k", image=image),
    "components4": lambda p, image: regions.components(p, "k", True, image),
    "fill_boundaries": lambda p, image: regions.fill_boundaries(p, p.sparkSession.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 1.0)], "k int, m1 double, m2 double"), image=image),
    "boundary_flags": lambda p, image: regions.boundary_flags(p, image=image),
    "border_regions": lambda p, image: regions.border_regions(p.withColumnRenamed("k", "region"), 9, 11, F.col("hh") > 1.5, image),
    "boundary_sites": lambda p, image: regions.boundary_sites(p.withColumnRenamed("k", "region"), image),
}


@pytest.mark.parametrize("name", CASES)
def test_images_stay_apart(scenes, name):
    together = CASES[name](scenes, ["scene"])
    apart = None
    for s in ("a", "b"):
        own = CASES[name](scenes.where(F.col("scene") == s).drop("scene"), None).withColumn("scene", F.lit(s))
        apart = own if apart is None else apart.unionByName(own)
    assert rows_of(together) == rows_of(apart) and together.count() > 0


def test_pixel_classes_of_two_images_stay_apart(scenes):
    model = gmm(scenes.where("k >= 0"))
    valid = scenes.where("k >= 0")
    classes = rows_of(cluster.assign_pixels(valid.drop("k"), model, image=["scene"]))
    swept = rows_of(cluster.mrf_sweep(valid, model, 0.5, 1, image=["scene"]))
    for s in ("a", "b"):
        own = valid.where(F.col("scene") == s)
        assert rows_of(cluster.assign_pixels(own.drop("k", "scene"), model).withColumn("scene", F.lit(s))) == [r for r in classes if s in r]
        assert rows_of(cluster.mrf_sweep(own.drop("scene"), model, 0.5, 1).withColumn("scene", F.lit(s))) == [r for r in swept if s in r]


@pytest.mark.parametrize(("size", "patch", "overlap"), [(40, 16, 0.25), (16, 16, 0.5), (17, 16, 0.25), (28, 16, 0.25), (29, 16, 0.0), (5, 16, 0.25), (100, 7, 0.9)])
def test_window_members_are_those_of_the_bounds(spark, size, patch, overlap):
    bounds = raster.windows(size, patch, overlap)
    pixels = spark.range(size).select(F.col("id").cast("int").alias("row"), F.lit(0).alias("col"))
    got = sorted((r["row"], r["wr"]) for r in raster.window_members(pixels, bounds, [(0, 1)]).collect())
    assert got == sorted((x, i) for x in range(size) for i, (a, b) in enumerate(bounds) if a <= x < b)


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    values = {"smooth": rng.normal(size=150_000), "hot": np.where(rng.random(120_000) < 0.4, 3.0, rng.normal(size=120_000)), "few": np.array([1.0, 2.0, 4.0]), "one": np.array([7.0])}
    values["steps"] = rng.integers(0, 11, 110_000) / 100
    places = (0.0, 0.01, 0.5, 0.99, 1.0)
    frame = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v] + [("few", float("nan")), ("none", None)], "k string, x double")
    got = {r["k"]: list(r["p"]) for r in stats.exact_percentiles(frame, ["k"], "x", places).collect()}
    assert set(got) == set(values)
    for k, v in values.items():
        assert np.allclose(got[k], np.quantile(v, places), rtol=0, atol=1e-12)
    assert stats.exact_percentiles(frame.where("k = 'few'"), [], "x", places).first()["p"][2] == 2.0
    assert stats.exact_percentiles(frame.limit(0), ["k"], "x", places).count() == 0
