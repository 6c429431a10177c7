"""Kernels on tiles of the driver's rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.operators import tiles
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import Registry

catalog = Registry()
query = catalog.query

_SIDE = 32
_EPX = 20  # divides the rasters' heights


def _tiles(spark, sf_dir):
    """The two-band raster in 32 x 32 tiles; row 49 of each fifty is missing."""
    pixels = fx.two(spark, sf_dir).withColumn("tile", F.floor(F.col("row") / _SIDE).cast("int"))
    missing = F.col("row") % 50 == 49
    pixels = pixels.withColumns({b: F.when(~missing, F.col(b)) for b in ("hh", "hv")})
    return tiles.to_tiles(pixels, ["tile"], ["hh", "hv"], F.col("tile") * _SIDE, F.lit(0), _SIDE, fx.HALF)


@query(f"""WITH {fx.TWO} SELECT (row // {_SIDE})::INTEGER AS tile, count(*) FILTER (row % 50 <> 49) AS n, round(sum(hh) FILTER (row % 50 <> 49), 6) AS total FROM two GROUP BY 1""")
def tile_pack(spark, sf_dir):
    """Valid pixels and their sum in each packed tile."""
    valid = F.filter("hh", lambda x: ~F.isnan(x))
    total = F.aggregate(valid, F.lit(0.0), lambda a, x: a + x)
    return _tiles(spark, sf_dir).select("tile", F.size(valid).cast("long").alias("n"), F.round(total, 6).alias("total"))


@query()
def watershed_tile(spark, sf_dir):
    out = tiles.watershed_tiles(_tiles(spark, sf_dir), ["tile"], ["hh", "hv"])
    return out.select("tile", "n_regions", F.size(F.filter("labels", lambda x: x == -2)).alias("boundary"), "ok", "error")


@query()
def irgs_tile(spark, sf_dir):
    out = tiles.irgs_tiles(_tiles(spark, sf_dir), ["tile"], ["hh", "hv"], 4, 5)
    return out.select("tile", "n_segments", F.size(F.filter("boundaries", lambda x: x == 1)).alias("inner"), F.round(F.element_at("energies", -1), 4).alias("energy"), "ok", "error")


@query()
def gibbs_tile(spark, sf_dir):
    out = tiles.irgs_tiles(_tiles(spark, sf_dir), ["tile"], ["hh", "hv"], 4, 3, temperature=0.01, seed=3)
    return out.select("tile", "n_segments", F.array_distinct("classes").alias("classes"), "ok", "error")


@query()
def gabor_tile(spark, sf_dir):
    out = tiles.gabor_tiles(_tiles(spark, sf_dir), ["tile"], "hh")
    return out.select("tile", F.transform("response", lambda x: F.round(x, 6)).alias("response"), "ok")


@query(f"""WITH {fx.TWO}, q AS (SELECT row, col, floor(hh * 4) AS v FROM two),
    s AS (SELECT c.row, c.col, c.v, coalesce(u.v, c.v) AS u, coalesce(d.v, c.v) AS d, coalesce(l.v, c.v) AS l, coalesce(r.v, c.v) AS r FROM q c LEFT JOIN q u ON u.row = c.row - 1 AND u.col = c.col AND u.row // {_EPX} = c.row // {_EPX}
        LEFT JOIN q d ON d.row = c.row + 1 AND d.col = c.col AND d.row // {_EPX} = c.row // {_EPX} LEFT JOIN q l ON l.row = c.row AND l.col = c.col - 1 LEFT JOIN q r ON r.row = c.row AND r.col = c.col + 1)
    SELECT row // {_EPX} AS tile, round(sum(CASE WHEN l = u AND l <> d AND u <> r THEN l ELSE v END), 3) AS q00, round(sum(CASE WHEN u = r AND u <> l AND r <> d THEN u ELSE v END), 3) AS q01,
        round(sum(CASE WHEN d = l AND d <> r AND l <> u THEN d ELSE v END), 3) AS q10, round(sum(CASE WHEN r = d AND r <> u AND d <> l THEN r ELSE v END), 3) AS q11 FROM s GROUP BY 1""")
def epx_upsample(spark, sf_dir):
    """Sums of the four quarters of an edge-preserving doubling, tile by tile."""
    pixels = fx.two(spark, sf_dir).withColumns({"tile": F.floor(F.col("row") / _EPX), "hh": F.floor(F.col("hh") * 4).cast("double")})
    out = tiles.epx_tiles(tiles.to_tiles(pixels, ["tile"], ["hh"], F.col("tile") * _EPX, F.lit(0), _EPX, fx.HALF), ["tile"], "hh")
    cells = out.select("tile", F.posexplode("doubled").alias("i", "v")).withColumns({"r": F.floor(F.col("i") / (2 * fx.HALF)) % 2, "c": F.col("i") % 2})
    part = lambda r, c: F.round(F.sum(F.when((F.col("r") == r) & (F.col("c") == c), F.col("v"))), 3).alias(f"q{r}{c}")
    return cells.groupBy("tile").agg(part(0, 0), part(0, 1), part(1, 0), part(1, 1))


