"""Stencils, resampling, tiling, masks and projections over the driver's tables."""

from __future__ import annotations

import math

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions.radiometry import db_to_linear, linear_to_db
from rasterloom.operators import raster, spatial, stats
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import Registry

catalog = Registry()
query = catalog.query


def _rounded(frame, *bands, places=6):
    return frame.select("row", "col", *[F.round(b, places).alias(b) for b in bands])


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"{x!r}::DOUBLE" if isinstance(x, float) else repr(x) for x in r) + ")" for r in rows)


def _taps_sql(name: str, taps: list[float]) -> str:
    half = len(taps) // 2
    return f"{name}(i, w) AS (VALUES {_values([(i - half, t) for i, t in enumerate(taps)])})"


def _conv_sql(source: str, taps: str, axis: str, size: str, value: str = "v", out: str = "v") -> str:
    other = "row" if axis == "col" else "col"
    at = f"(a.{axis} - t.i)"
    place = f"CASE WHEN {at} < 0 THEN -{at} - 1 WHEN {at} >= {size} THEN 2 * {size} - 1 - {at} ELSE {at} END"
    return f"(SELECT a.row, a.col, sum(t.w * b.{value}) AS {out} FROM {source} a CROSS JOIN {taps} t JOIN {source} b ON b.{other} = a.{other} AND b.{axis} = {place} GROUP BY a.row, a.col)"


@query(f"""WITH {fx.RAS}, h AS (SELECT (max(row) + 1) // 6 * 6 AS n FROM ras)
    SELECT (row // 6)::INTEGER AS row, (col // 6)::INTEGER AS col, round(avg(v), 6) AS v FROM ras, h WHERE row < n AND col < 60 GROUP BY 1, 2""")
def block_average(spark, sf_dir):
    out = raster.block_average(fx.ras(spark, sf_dir), ["v"], 6, fx.height(spark, sf_dir), fx.WIDTH)
    return _rounded(out, "v")


@query(f"""WITH {fx.RAS}, h AS (SELECT greatest(1, round_even((max(row) + 1) / 1.5::DOUBLE, 0))::INTEGER AS n FROM ras),
    lin AS (SELECT row, col, CASE WHEN row % 50 = 49 THEN NULL ELSE pow(10::DOUBLE, v) END AS x FROM ras),
    o AS (SELECT r.i::INTEGER AS row, c.i::INTEGER AS col, x,
        (least((lin.row + 1) / 1.5::DOUBLE, r.i + 1) - greatest(lin.row / 1.5::DOUBLE, r.i)) * (least((lin.col + 1) / 4.0::DOUBLE, c.i + 1) - greatest(lin.col / 4.0::DOUBLE, c.i)) AS w
        FROM lin, h, range(100000) r(i), range(16) c(i) WHERE r.i < n AND r.i BETWEEN floor(lin.row / 1.5::DOUBLE) AND floor(lin.row / 1.5::DOUBLE) + 1 AND c.i = lin.col // 4)
    SELECT row, col, round(10 * log10(greatest(sum(w * x) / sum(w) FILTER (x IS NOT NULL), 1e-12::DOUBLE)), 6) AS v FROM o WHERE w > 1e-12::DOUBLE GROUP BY row, col""")
def resample_area_weighted(spark, sf_dir):
    """dB to linear, area-weighted mean over 1.5 rows x 4 columns, back to dB; missing pixels weigh nothing."""
    linear = F.when(F.col("row") % 50 != 49, db_to_linear(F.col("v") * 10))
    pixels = fx.ras(spark, sf_dir).withColumn("v", linear)
    out = raster.area_average(pixels, ["v"], fx.height(spark, sf_dir), fx.WIDTH, 1.5, 4.0)
    return _rounded(out.withColumn("v", linear_to_db(F.col("v"))), "v")


@query(f"""WITH {fx.RAS} SELECT r.i::INTEGER AS row, c.i::INTEGER AS col, v FROM range(40) r(i), range(48) c(i), (SELECT max(row) + 1 AS n FROM ras) h, ras
    WHERE ras.row = least(n - 1, floor((r.i + 0.5::DOUBLE) * n / 40)::BIGINT) AND ras.col = least(63, floor((c.i + 0.5::DOUBLE) * 64 / 48)::BIGINT)""")
def resize_nearest(spark, sf_dir):
    return raster.resize_nearest(fx.ras(spark, sf_dir), ["v"], (fx.height(spark, sf_dir), fx.WIDTH), (40, 48))


@query(f"WITH {fx.RAS} SELECT (2 * row + i)::INTEGER AS row, (2 * col + j)::INTEGER AS col, v FROM ras, range(2) r(i), range(2) c(j)")
def upsample_nearest(spark, sf_dir):
    """Corner-aligned nearest upsampling to twice the size."""
    n = fx.height(spark, sf_dir)
    return raster.resize_nearest(fx.ras(spark, sf_dir), ["v"], (n, fx.WIDTH), (2 * n, 2 * fx.WIDTH), centred=False)


@query(f"""WITH {fx.RAS}, g AS (SELECT r.i::INTEGER AS row, c.i::INTEGER AS col, r.i * (n - 1)::DOUBLE / 40 AS y, c.i * 63::DOUBLE / 40 AS x
        FROM range(40) r(i), range(40) c(i), (SELECT max(row) + 1 AS n FROM ras)),
    t AS (SELECT g.row, g.col, v, abs(1 - di - (y - floor(y))) * abs(1 - dj - (x - floor(x))) AS w
        FROM g, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(di, dj), ras WHERE ras.row = floor(y)::BIGINT + di AND ras.col = floor(x)::BIGINT + dj)
    SELECT row, col, round(sum(w * v), 6) AS v FROM t WHERE w > 0 GROUP BY row, col""")
def resize_bilinear(spark, sf_dir):
    return _rounded(raster.resize_bilinear(fx.ras(spark, sf_dir), "v", (fx.height(spark, sf_dir), fx.WIDTH), (40, 40)), "v")


@query(f"""WITH {fx.RAS}, p AS (SELECT row, unnest([col, -col - 1, 127 - col]) AS col, v FROM ras) SELECT row, col::INTEGER AS col, v FROM p WHERE col >= -5 AND col < 69""")
def mirror_pad(spark, sf_dir):
    return raster.mirror_padded(fx.ras(spark, sf_dir), "col", fx.WIDTH, 5).select("row", "col", "v")


@query(f"""WITH {fx.RAS}, e AS (SELECT row, unnest(range(-3, 67)) AS col FROM (SELECT DISTINCT row FROM ras))
    SELECT e.row, e.col::INTEGER AS col, a.v AS last, CASE WHEN e.col BETWEEN 0 AND 63 THEN a.v ELSE 0 END AS zero, b.v AS cycle
    FROM e JOIN ras a ON a.row = e.row AND a.col = least(63, greatest(0, e.col)) JOIN ras b ON b.row = e.row AND b.col = (e.col + 64) % 64""")
def pad_modes(spark, sf_dir):
    pad = lambda mode: raster.padded(fx.ras(spark, sf_dir), "col", fx.WIDTH, 3, mode, ["v"], ["row"]).select("row", "col", F.col("v").alias(mode))
    return pad("last").join(pad("zero"), ["row", "col"]).join(pad("cycle"), ["row", "col"])


@query(f"WITH {fx.RAS} SELECT row - 10 AS row, (col - 4)::INTEGER AS col, v FROM ras WHERE row BETWEEN 10 AND 29 AND col BETWEEN 4 AND 43")
def crop_area(spark, sf_dir):
    return raster.cropped(fx.ras(spark, sf_dir), 10, 4, 20, 40)


_H = "(SELECT max(row) + 1 FROM ras)"
_G, _D = raster.gaussian_taps(1.0), raster.derivative_taps(1.0)


@query(f"WITH {fx.RAS}, {_taps_sql('g', _G)}, h AS {_conv_sql('ras', 'g', 'col', '64')} SELECT row, col, round(v, 6) AS v FROM {_conv_sql('h', 'g', 'row', _H)}")
def gaussian_smooth(spark, sf_dir):
    return _rounded(raster.smooth(fx.ras(spark, sf_dir), ["v"], 1.0, fx.height(spark, sf_dir), fx.WIDTH), "v")


def _gradient_sql(source: str, band: str, width: int, height: str) -> str:
    return f"""{band}_a AS {_conv_sql(source, 'd', 'col', str(width), band)}, {band}_dx AS {_conv_sql(f'{band}_a', 'g', 'row', height)},
        {band}_b AS {_conv_sql(source, 'g', 'col', str(width), band)}, {band}_dy AS {_conv_sql(f'{band}_b', 'd', 'row', height)}"""


_H2 = "(SELECT max(row) + 1 FROM two)"


@query(f"""WITH {fx.TWO}, {_taps_sql('g', _G)}, {_taps_sql('d', _D)}, {_gradient_sql('two', 'hh', 32, _H2)}, {_gradient_sql('two', 'hv', 32, _H2)},
    s AS (SELECT row, col, a.v * a.v + c.v * c.v AS p, b.v * b.v + d.v * d.v AS q, a.v * b.v + c.v * d.v AS t
        FROM hh_dx a JOIN hh_dy b USING (row, col) JOIN hv_dx c USING (row, col) JOIN hv_dy d USING (row, col)),
    m AS (SELECT row, col, sqrt(0.5::DOUBLE * (p + q + sqrt((p - q) * (p - q) + 4 * t * t))) AS g FROM s)
    SELECT row, col, round(g / max(g) OVER (), 6) AS g FROM m""")
def gradient_bdvf(spark, sf_dir):
    """Normalised two-band gradient."""
    out = raster.gradients(fx.two(spark, sf_dir), ["hh", "hv"], 1.0, fx.height(spark, sf_dir), fx.HALF)
    out = out.withColumn("g", raster.bdvf([F.col("hh_dx"), F.col("hv_dx")], [F.col("hh_dy"), F.col("hv_dy")]))
    top = out.agg(F.max("g").alias("top"))
    return out.crossJoin(F.broadcast(top)).select("row", "col", F.round(F.col("g") / F.nullif("top", F.lit(0.0)), 6).alias("g"))  # top is one row


@query(f"""WITH {fx.RAS}, {_taps_sql('g', _G)}, {_taps_sql('d', _D)}, {_gradient_sql('ras', 'v', 64, _H)}
    SELECT row, col, round(sqrt(a.v * a.v + b.v * b.v), 6) AS g FROM v_dx a JOIN v_dy b USING (row, col)""")
def gradient_l2(spark, sf_dir):
    out = raster.gradients(fx.ras(spark, sf_dir), ["v"], 1.0, fx.height(spark, sf_dir), fx.WIDTH)
    return out.select("row", "col", F.round(raster.l2norm([F.col("v_dx")], [F.col("v_dy")]), 6).alias("g"))


def _separable_sql(taps) -> str:
    d, g = _taps_sql("d", taps[0]), _taps_sql("g", taps[1])
    return f"WITH {fx.RAS}, {g}, {d}, {_gradient_sql('ras', 'v', 64, _H)} SELECT row, col, round(a.v, 6) AS v_dx, round(b.v, 6) AS v_dy FROM v_dx a JOIN v_dy b USING (row, col)"


@query(_separable_sql(raster.SOBEL))
def gradient_sobel(spark, sf_dir):
    return _rounded(raster.separable_gradients(fx.ras(spark, sf_dir), ["v"], raster.SOBEL, fx.height(spark, sf_dir), fx.WIDTH), "v_dx", "v_dy")


@query(_separable_sql(raster.PREWITT))
def gradient_prewitt(spark, sf_dir):
    return _rounded(raster.separable_gradients(fx.ras(spark, sf_dir), ["v"], raster.PREWITT, fx.height(spark, sf_dir), fx.WIDTH), "v_dx", "v_dy")


@query(f"""WITH {fx.RAS}, s AS (SELECT b.row - i AS row, b.col - j AS col, avg(v * v) - avg(v) * avg(v) AS v FROM ras b, range(7) r(i), range(7) c(j)
        WHERE b.row >= i AND b.col >= j GROUP BY 1, 2 HAVING count(*) = 49),
    e AS (SELECT min(v) AS low, (max(v) - min(v)) / 256 AS step FROM s), h AS (SELECT least(255, floor((v - low) / step)::INTEGER) AS bin, count(*) AS n, max(low) AS low, max(step) AS step FROM s, e GROUP BY 1)
    SELECT round(low + (bin + 0.5::DOUBLE) * step, 6) AS noise FROM h ORDER BY n DESC, bin LIMIT 1""")
def noise_variance(spark, sf_dir):
    return raster.noise_variance(fx.ras(spark, sf_dir), ["v"], fx.height(spark, sf_dir), fx.WIDTH).select(F.round("noise", 6).alias("noise"))


@query(f"WITH {fx.RAS} SELECT least(63, greatest(0, floor((v + 0.6::DOUBLE) / 1.2::DOUBLE * 64)::INTEGER)) AS bin, count(*) AS n FROM ras GROUP BY 1")
def intensity_histogram(spark, sf_dir):
    return stats.histogram(fx.ras(spark, sf_dir), [], F.col("v"), 64, -0.6, 0.6)


@query(f"WITH {fx.QUANTISED}, h AS (SELECT g, count(*) AS n FROM q GROUP BY g) SELECT g AS mode, n FROM h ORDER BY n DESC, g LIMIT 1")
def histogram_mode(spark, sf_dir):
    """The fullest of 256 bins, the lowest on ties."""
    return fx.quantised(spark, sf_dir).groupBy("g").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "g").limit(1).select(F.col("g").alias("mode"), "n")


@query(f"""WITH {fx.RAS}, lv AS (SELECT (b.row - i)::INTEGER AS row, (b.col - j)::INTEGER AS col, avg(v) AS m, avg(v * v) - avg(v) * avg(v) AS s FROM ras b, range(-3, 4) r(i), range(-3, 4) c(j) GROUP BY 1, 2)
    SELECT ras.row, ras.col, round(m, 6) AS mean, round(greatest(s, 0), 6) AS variance FROM ras JOIN lv ON lv.row = ras.row AND lv.col = ras.col""")
def local_variance(spark, sf_dir):
    """Mean and variance over 7x7 squares."""
    return _rounded(raster.local_moments(fx.ras(spark, sf_dir), "v", 3), "mean", "variance")


@query(f"""WITH {fx.QUANTISED}, h AS (SELECT g, count(*) AS n FROM q GROUP BY g),
    c AS (SELECT g, sum(n) OVER (ORDER BY g) AS w, sum(n * g) OVER (ORDER BY g) AS s, sum(n) OVER () AS t, sum(n * g) OVER () AS a FROM h),
    v AS (SELECT g, w / t::DOUBLE * (1 - w / t::DOUBLE) * pow(s::DOUBLE / w - (a - s)::DOUBLE / nullif(t - w, 0), 2) AS between_class FROM c)
    SELECT g AS threshold, round(between_class, 4) AS variance FROM v WHERE between_class IS NOT NULL ORDER BY round(between_class, 6) DESC, g LIMIT 1""")
def otsu_threshold(spark, sf_dir):
    """The grey level with the largest between-class variance, the first on ties."""
    out = stats.otsu(fx.quantised(spark, sf_dir).groupBy("g").agg(F.count("*").alias("n")))
    return out.select("threshold", F.round("variance", 4).alias("variance"))


@query(f"""WITH {fx.QUANTISED}, h AS (SELECT g, count(*) AS n FROM q WHERE row % 50 <> 49 GROUP BY g),
    c AS (SELECT g, sum(n) OVER (ORDER BY g) AS w, sum(n * g) OVER (ORDER BY g) AS s, sum(n) OVER () AS t, sum(n * g) OVER () AS a FROM h),
    v AS (SELECT g, w / t::DOUBLE * (1 - w / t::DOUBLE) * pow(s::DOUBLE / w - (a - s)::DOUBLE / nullif(t - w, 0), 2) AS between_class FROM c),
    o AS (SELECT g AS threshold FROM v WHERE between_class IS NOT NULL ORDER BY round(between_class, 6) DESC, g LIMIT 1)
    SELECT row, col, CASE WHEN row % 50 = 49 THEN -2 WHEN g > threshold THEN 2 ELSE 1 END AS class FROM q, o""")
def otsu_classes(spark, sf_dir):
    return stats.otsu_classes(fx.quantised(spark, sf_dir), F.col("row") % 50 == 49)


@query("""WITH d AS (SELECT c_custkey AS id, (100 + c_custkey % 700)::INTEGER AS h FROM customer),
    s AS (SELECT id, h, least(96, h) AS crop, CASE WHEN 96 < h THEN 96 - 24 ELSE h END AS stride FROM d),
    w AS (SELECT id, unnest(range(0, greatest(h - crop + stride - 1, 0) // stride + 1)) AS i, h, crop, stride FROM s)
    SELECT id, i::INTEGER AS i, greatest(least(i * stride + crop, h) - crop, 0)::INTEGER AS lo, least(i * stride + crop, h)::INTEGER AS hi FROM w""")
def sliding_windows(spark, sf_dir):
    sizes = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (100 + F.col("c_custkey") % 700).cast("int").alias("h"))
    return sizes.select("id", F.posexplode(raster.window_columns(F.col("h"), 96, 0.25)).alias("i", "w")).select("id", "i", "w.lo", "w.hi")


def _windowed(spark, sf_dir):
    pixels = fx.two(spark, sf_dir).withColumn("invalid", (F.col("row") % 50 == 49) | (F.col("row") < 40) & (F.col("col") < 20))
    rows, cols = raster.windows(fx.height(spark, sf_dir), 16, 0.25), raster.windows(fx.HALF, 16, 0.25)
    return raster.window_members(pixels, rows, cols), rows, cols


_WIN = f"""{fx.TWO}, px AS (SELECT *, (row % 50 = 49 OR (row < 40 AND col < 20)) AS invalid FROM two), size AS (SELECT max(row) + 1 AS h FROM two),
    wr AS (SELECT i::INTEGER AS i, least(i * 12, h - 16) AS a, least(i * 12, h - 16) + 16 AS b FROM size, range(100000) t(i) WHERE i <= (h - 16 + 11) // 12),
    wc(j, c, d) AS (VALUES {_values([(i, a, b) for i, (a, b) in enumerate(raster.windows(32, 16, 0.25))])}),
    held AS (SELECT i, j, count(*) AS n, count(*) FILTER (invalid) AS bad FROM px, wr, wc WHERE row >= a AND row < b AND col >= c AND col < d GROUP BY i, j HAVING NOT bool_and(invalid)),
    named AS (SELECT *, row_number() OVER (ORDER BY i, j) - 1 AS patch FROM held)"""


@query(f"WITH {_WIN} SELECT patch::INTEGER AS patch, i AS wr, j AS wc, n, bad FROM named")
def valid_windows(spark, sf_dir):
    """Windows with a valid pixel, numbered in raster order; one scene's windows are few."""
    members, _, _ = _windowed(spark, sf_dir)
    held = members.groupBy("wr", "wc").agg(F.count("*").alias("n"), F.count_if("invalid").alias("bad"), F.bool_and("invalid").alias("all_bad")).where("not all_bad")
    return held.select((F.row_number().over(W.orderBy("wr", "wc")) - 1).alias("patch"), "wr", "wc", "n", "bad")


@query(f"""WITH {_WIN}, e AS (SELECT i, j, list(round(hh, 6) ORDER BY row, col) AS hh FROM px, wr, wc WHERE row >= a AND row < b AND col >= c AND col < d GROUP BY i, j)
    SELECT i AS wr, j AS wc, hh FROM e JOIN held USING (i, j)""")
def patch_extract(spark, sf_dir):
    """Patches as arrays in raster order; a patch is bounded by its size."""
    members, _, _ = _windowed(spark, sf_dir)
    cells = F.transform(F.array_sort(F.collect_list(F.struct("row", "col", fx.signed_round("hh", 6).alias("hh")))), lambda p: p["hh"])
    out = members.groupBy("wr", "wc").agg(cells.alias("hh"), F.bool_and("invalid").alias("all_bad"))
    return out.where("not all_bad").select("wr", "wc", "hh")


@query(f"""WITH {fx.TWO} SELECT two.row, two.col, (two.row % 50 = 49 OR coalesce(e.label, 9) = 9 OR two.col < 2) AS invalid,
    (CASE WHEN two.row % 50 = 49 OR coalesce(e.label, 9) = 9 OR two.col < 2 THEN 255 ELSE e.label END)::INTEGER AS label FROM two LEFT JOIN embeddings e ON e.vec_id = two.row""")
def invalid_mask(spark, sf_dir):
    """Missing HH, land or invalid label make a pixel invalid, and its label 255."""
    pixels = fx.two(spark, sf_dir).withColumn("hh", F.when(F.col("row") % 50 != 49, F.col("hh")))
    marks = fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), "label")
    bad = F.col("hh").isNull() | (F.coalesce("label", F.lit(9)) == 9) | (F.col("col") < 2)
    return pixels.join(marks, "row", "left").select("row", "col", bad.alias("invalid"), F.when(bad, 255).otherwise(F.col("label")).alias("label"))


RINGS = [[(10.5, 10.5), (40.5, 10.5), (40.5, 20.5), (10.5, 20.5)], [(5.2, 30.1), (50.7, 60.3), (20.4, 90.9)]]
_EDGES = [(p, x1, y1, x2, y2) for p, _, x1, y1, x2, y2 in spatial.rings_to_edges(RINGS)]
_PIP = f"""{fx.RAS}, ed(poly, x1, y1, x2, y2) AS (VALUES {_values(_EDGES)}),
    hit AS (SELECT row, col, poly, count(*) AS n FROM ras, ed WHERE y1 <> y2 AND (y1 > row + 0.5::DOUBLE) <> (y2 > row + 0.5::DOUBLE)
        AND col + 0.5::DOUBLE < (x2 - x1) * (row + 0.5::DOUBLE - y1) / (y2 - y1) + x1 GROUP BY row, col, poly)"""


@query(f"WITH {_PIP} SELECT row, col, coalesce((SELECT bool_or(n % 2 = 1) FROM hit WHERE hit.row = ras.row AND hit.col = ras.col), FALSE) AS ocean FROM ras")
def land_mask_pip(spark, sf_dir):
    pixels = fx.ras(spark, sf_dir)
    return pixels.select("row", "col", spatial.inside(F.col("col") + 0.5, F.col("row") + 0.5, RINGS).alias("ocean"))


@query(f"""WITH {_PIP}, ax AS (SELECT row, col, CASE WHEN x2 = x1 THEN CASE WHEN x1 < col OR x1 > col + 1 THEN 2 ELSE 0 END ELSE least((col - x1) / nullif(x2 - x1, 0), (col + 1 - x1) / nullif(x2 - x1, 0)) END AS a1,
        CASE WHEN x2 = x1 THEN 1 ELSE greatest((col - x1) / nullif(x2 - x1, 0), (col + 1 - x1) / nullif(x2 - x1, 0)) END AS b1,
        CASE WHEN y2 = y1 THEN CASE WHEN y1 < row OR y1 > row + 1 THEN 2 ELSE 0 END ELSE least((row - y1) / nullif(y2 - y1, 0), (row + 1 - y1) / nullif(y2 - y1, 0)) END AS a2,
        CASE WHEN y2 = y1 THEN 1 ELSE greatest((row - y1) / nullif(y2 - y1, 0), (row + 1 - y1) / nullif(y2 - y1, 0)) END AS b2 FROM ras, ed),
    tc AS (SELECT row, col, bool_or(greatest(0, a1, a2) <= least(1, b1, b2)) AS t FROM ax GROUP BY row, col)
    SELECT tc.row, tc.col, (t OR coalesce((SELECT bool_or(n % 2 = 1) FROM hit WHERE hit.row = tc.row AND hit.col = tc.col), FALSE)) AS ocean FROM tc""")
def land_mask_touched(spark, sf_dir):
    """Cells that a polygon covers at their centre or whose area one of its edges meets."""
    pixels = fx.ras(spark, sf_dir)
    sea = spatial.inside(F.col("col") + 0.5, F.col("row") + 0.5, RINGS) | spatial.touched(F.col("row").cast("double"), F.col("col").cast("double"), RINGS)
    return pixels.select("row", "col", sea.alias("ocean"))


@query(f"WITH {_PIP} SELECT row * 64 + col AS id, coalesce((SELECT bool_or(n % 2 = 1) FROM hit WHERE hit.row = ras.row AND hit.col = ras.col), FALSE) AS inside FROM ras")
def land_mask_table(spark, sf_dir):
    """The same with polygons as an edge table, joined by horizontal bands."""
    edges = spark.createDataFrame(_EDGES, "poly int, x1 double, y1 double, x2 double, y2 double")
    points = fx.ras(spark, sf_dir).select((F.col("row") * 64 + F.col("col")).alias("id"), (F.col("col") + 0.5).alias("x"), (F.col("row") + 0.5).alias("y"))
    return spatial.inside_table(points, edges, 16.0).select("id", "inside")


_TC = [0.0, 32.0, 63.0]


@query(f"""WITH {fx.RAS}, size AS (SELECT max(row) + 1 AS h FROM ras),
    tie AS (SELECT i, j, r, c, 70 + r / 1000 + pow(c / 63::DOUBLE, 2) / 10 AS lat
        FROM (SELECT unnest([0, 1, 2]) AS i, unnest([0, h // 2, h - 1])::DOUBLE AS r FROM size) a, (VALUES (0, 0::DOUBLE), (1, 32::DOUBLE), (2, 63::DOUBLE)) b(j, c)),
    cell AS (SELECT row, col, CASE WHEN row >= h // 2 THEN 1 ELSE 0 END AS i, CASE WHEN col >= 32 THEN 1 ELSE 0 END AS j FROM ras, size),
    u AS (SELECT cell.row, cell.col, least(1, greatest(0, (cell.row - a.r) / (d.r - a.r))) AS u, least(1, greatest(0, (cell.col - a.c) / (d.c - a.c))) AS v, a.lat AS a, b.lat AS b, c.lat AS c, d.lat AS d
        FROM cell JOIN tie a ON a.i = cell.i AND a.j = cell.j JOIN tie b ON b.i = cell.i AND b.j = cell.j + 1 JOIN tie c ON c.i = cell.i + 1 AND c.j = cell.j JOIN tie d ON d.i = cell.i + 1 AND d.j = cell.j + 1)
    SELECT row, col, round((1 - u) * ((1 - v) * a + v * b) + u * ((1 - v) * c + v * d), 6) AS lat FROM u""")
def tie_point_interp(spark, sf_dir):
    n = fx.height(spark, sf_dir)
    rows = [0.0, float(n // 2), float(n - 1)]
    lat = [[70 + r / 1000 + (c / 63) ** 2 / 10 for c in _TC] for r in rows]
    at = spatial.grid_interpolate(F.col("row").cast("double"), F.col("col").cast("double"), rows, _TC, lat)
    return fx.ras(spark, sf_dir).select("row", "col", F.round(at, 6).alias("lat"))


@query(f"""WITH {fx.RAS}, p AS (SELECT row, col, row * 0.83::DOUBLE + 0.4::DOUBLE AS y, col * 1.07::DOUBLE - 1.3::DOUBLE AS x FROM ras),
    t AS (SELECT p.row, p.col, sum(CASE WHEN m.v > 0 THEN 1 ELSE 0 END * abs(1 - di - (y - floor(y))) * abs(1 - dj - (x - floor(x)))) AS s
        FROM p CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(di, dj) LEFT JOIN ras m ON m.row = floor(y)::BIGINT + di AND m.col = floor(x)::BIGINT + dj GROUP BY p.row, p.col)
    SELECT row, col, (s > 0.5::DOUBLE) AS ocean FROM t""")
def mask_bilinear_sample(spark, sf_dir):
    """A mask sampled at fractional places; outside counts as 0."""
    mask = fx.ras(spark, sf_dir).select(F.col("row").alias("r"), F.col("col").alias("c"), (F.col("v") > 0).cast("int").alias("m"))
    places = fx.ras(spark, sf_dir).select("row", "col", (F.col("row") * 0.83 + 0.4).alias("y"), (F.col("col") * 1.07 - 1.3).alias("x"))
    taps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    spread = places.withColumn("t", taps).select(
        "row", "col", (F.floor("y") + F.col("t.i")).alias("r"), (F.floor("x") + F.col("t.j")).cast("int").alias("c"),
        (F.abs(1 - F.col("t.i") - (F.col("y") - F.floor("y"))) * F.abs(1 - F.col("t.j") - (F.col("x") - F.floor("x")))).alias("w"),
    )
    total = spread.join(mask, ["r", "c"], "left").groupBy("row", "col").agg(F.sum(F.coalesce("m", F.lit(0)) * F.col("w")).alias("s"))
    return total.select("row", "col", (F.col("s") > 0.5).alias("ocean"))


def _lcc_sql() -> str:
    n, f, rho0 = spatial._conic(spatial.LCC)
    e, a = spatial.LCC["e"], spatial.LCC["a"]
    return f"""p AS (SELECT c_custkey AS id, 45::DOUBLE + c_nationkey AS lat, -120::DOUBLE + c_custkey % 50 AS lon FROM customer),
        s AS (SELECT *, {e!r}::DOUBLE * sin(radians(lat)) AS s FROM p),
        t AS (SELECT *, tan({math.pi / 4!r}::DOUBLE - radians(lat) / 2) / pow((1 - s) / (1 + s), {e / 2!r}::DOUBLE) AS t FROM s),
        r AS (SELECT id, {a * f!r}::DOUBLE * pow(t, {n!r}::DOUBLE) AS rho, {n!r}::DOUBLE * (radians(lon) - radians(-100::DOUBLE)) AS theta FROM t)
        SELECT id, round(rho * sin(theta), 2) AS x, round({rho0!r}::DOUBLE - rho * cos(theta), 2) AS y FROM r"""


@query(f"WITH {_lcc_sql()}")
def lcc_project(spark, sf_dir):
    points = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (45.0 + F.col("c_nationkey")).alias("lat"), (-120.0 + F.col("c_custkey") % 50).alias("lon"))
    x, y = spatial.lcc_forward(F.col("lat"), F.col("lon"))
    return points.select("id", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


@query("SELECT c_custkey AS id, round(45::DOUBLE + c_nationkey, 6) AS lat, round(-120::DOUBLE + c_custkey % 50, 6) AS lon FROM customer")
def lcc_round_trip(spark, sf_dir):
    points = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (45.0 + F.col("c_nationkey")).alias("lat"), (-120.0 + F.col("c_custkey") % 50).alias("lon"))
    x, y = spatial.lcc_forward(F.col("lat"), F.col("lon"))
    lat, lon = spatial.lcc_inverse(F.col("x"), F.col("y"))
    return points.select("id", x.alias("x"), y.alias("y")).select("id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


_T = {"1": "1::DOUBLE", "x": "x", "y": "y", "xy": "x * y", "xx": "x * x", "yy": "y * y"}
_MOMENTS = [f"round(sum(({_T[a]}) * ({_T[b]})), 3) AS m_{a}_{b}" for i, a in enumerate(_T) for b in list(_T)[i:]] + [f"round(sum(({_T[a]}) * z), 3) AS r_{a}_z" for a in _T]


@query(f"SELECT {', '.join(_MOMENTS)} FROM (SELECT l_quantity / 50 AS x, l_discount * 10 AS y, l_tax AS z FROM lineitem)")
def poly2_moments(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 50).alias("x"), (F.col("l_discount") * 10).alias("y"), F.col("l_tax").alias("z"))
    out = spatial.polynomial_moments(rows, "x", "y", ["z"])
    return out.select(*[F.round(c, 3).alias(c) for c in out.columns])


@query("SELECT d::INTEGER AS divisor, n::INTEGER AS size, ((d - n % d) % d)::INTEGER AS pad FROM (VALUES (16), (32), (64)) a(d), range(100, 165) b(n)")
def divisor_pad(spark, sf_dir):
    grid = spark.range(100, 165).select(F.col("id").cast("int").alias("size")).withColumn("divisor", F.explode(F.array(F.lit(16), F.lit(32), F.lit(64))))
    return grid.select("divisor", "size", raster.divisor_pad(F.col("size"), F.col("divisor")).alias("pad"))


@query(f"""WITH {fx.RAS} SELECT a.row, a.col, round(a.v + b.v, 6) AS plus, round(a.v * b.v, 6) AS times, round(abs(a.v - b.v), 6) AS gap, round(least(0.2::DOUBLE, greatest(-0.2::DOUBLE, a.v)), 6) AS clipped
    FROM ras a JOIN ras b ON b.row = a.row AND b.col = 63 - a.col""")
def image_arithmetic(spark, sf_dir):
    """An image and its mirror image: sum, product, distance and a clip."""
    flip = fx.ras(spark, sf_dir).select("row", (63 - F.col("col")).alias("col"), F.col("v").alias("w"))
    out = fx.ras(spark, sf_dir).join(flip, ["row", "col"])
    v, w = F.col("v"), F.col("w")
    return _rounded(out.select("row", "col", (v + w).alias("plus"), (v * w).alias("times"), F.abs(v - w).alias("gap"), F.least(F.lit(0.2), F.greatest(F.lit(-0.2), v)).alias("clipped")), "plus", "times", "gap", "clipped")


@query("""WITH e AS (SELECT vec_id, unnest(range(64)) AS k, unnest(embedding) AS x FROM embeddings)
    SELECT vec_id, k::INTEGER AS class FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, k) AS r FROM e) WHERE r = 1""")
def argmax_logits(spark, sf_dir):
    logits = F.col("embedding")
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", (F.array_position(logits, F.array_max(logits)) - 1).cast("int").alias("class"))
