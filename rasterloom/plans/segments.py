"""Region graphs, Gaussian classes, energies and texture over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions import energy
from rasterloom.operators import cluster, graphs, regions, texture
from rasterloom.plans import fixtures as fx
from rasterloom.plans.registry import Registry

catalog = Registry()
query = catalog.query

_REG = fx.REGIONS
_STATS = f"""{_REG}, st AS (SELECT region, count(*) AS n, avg(hh) AS m1, avg(hv) AS m2, avg(hh * hh) AS c11, avg(hh * hv) AS c12, avg(hv * hv) AS c22,
    avg(col) AS cx, avg(row) AS cy, min(row) AS top, max(row) AS bottom, min(col) AS "left", max(col) AS "right" FROM reg WHERE region >= 0 GROUP BY region)"""
_SITES = f"""{fx.NEIGHBOURS}, near AS (SELECT p.row, p.col, k, q.region AS other FROM reg p CROSS JOIN off JOIN reg q ON q.row = p.row + dr AND q.col = p.col + dc WHERE p.region < 0 AND q.region >= 0),
    firsts AS (SELECT row, col, other, min(k) AS k FROM near GROUP BY row, col, other),
    sites AS (SELECT row, col, least(x, y) AS a, greatest(x, y) AS b FROM
        (SELECT row, col, list(other ORDER BY k)[1] AS x, list(other ORDER BY k)[2] AS y FROM firsts GROUP BY row, col HAVING count(*) >= 2)),
    strength AS (SELECT row, col, abs(hh) + abs(hv) AS g FROM reg),
    adj AS (SELECT a, b, count(*) AS length FROM sites GROUP BY a, b)"""
_CLASSES = "rc AS (SELECT region, (CASE WHEN m1 < -0.01::DOUBLE THEN 0 WHEN m1 < 0.01::DOUBLE THEN 1 ELSE 2 END) AS class FROM st)"


def _pixels(spark, sf_dir):
    return fx.region_map(spark, sf_dir)


def _stats(spark, sf_dir):
    return regions.region_stats(_pixels(spark, sf_dir))


def _sites(spark, sf_dir):
    return regions.boundary_sites(_pixels(spark, sf_dir))


def _strength(spark, sf_dir):
    return _pixels(spark, sf_dir).select("row", "col", (F.abs("hh") + F.abs("hv")).alias("g"))


def _class(m):
    return F.when(m < -0.01, 0).when(m < 0.01, 1).otherwise(2)


def _classes(spark, sf_dir):
    return _stats(spark, sf_dir).withColumn("class", _class(F.col("m1")))


def _round(frame, keys, *columns, places=6):
    return frame.select(*keys, *[F.round(c, places).alias(c) for c in columns])


@query(f"""WITH {_STATS} SELECT region, n, top, bottom, "left", "right", round(m1, 6) AS m1, round(m2, 6) AS m2, round(c11, 6) AS c11, round(c12, 6) AS c12, round(c22, 6) AS c22,
    round(cx, 6) AS cx, round(cy, 6) AS cy FROM st""")
def region_stats(spark, sf_dir):
    return _round(_stats(spark, sf_dir), ["region", "n", "top", "bottom", "left", "right"], "m1", "m2", "c11", "c12", "c22", "cx", "cy")


@query(f"""WITH {_REG}, {fx.NEIGHBOURS}, m AS (SELECT *, row % 50 = 49 AS masked FROM reg)
    SELECT DISTINCT region FROM (SELECT region FROM m WHERE region >= 0 AND (row = 0 OR col = 0 OR row = (SELECT max(row) FROM reg) OR col = 31)
    UNION ALL SELECT p.region FROM m p CROSS JOIN off JOIN m q ON q.row = p.row + dr AND q.col = p.col + dc WHERE p.region >= 0 AND q.masked)""")
def region_border(spark, sf_dir):
    return regions.border_regions(_pixels(spark, sf_dir), fx.height(spark, sf_dir), fx.HALF, F.col("row") % 50 == 49)


@query(f"WITH {_REG}, {_SITES} SELECT a, b, length FROM adj")
def region_adjacency(spark, sf_dir):
    return regions.adjacency(_sites(spark, sf_dir))


@query(f"""WITH {_STATS}, {_SITES}, {_CLASSES} SELECT round(sum(CASE WHEN x.class <> y.class THEN length ELSE 0 END) / (SELECT count(*) FROM reg)::DOUBLE, 6) AS ratio
    FROM adj JOIN rc x ON x.region = a JOIN rc y ON y.region = b""")
def boundary_ratio(spark, sf_dir):
    edges = regions.adjacency(_sites(spark, sf_dir))
    return regions.boundary_ratio(edges, _classes(spark, sf_dir), _pixels(spark, sf_dir)).select(F.round("ratio", 6).alias("ratio"))


@query(f"""WITH {fx.CLASSES}, {fx.NEIGHBOURS} SELECT count(*) FILTER (p.k <> q.k) AS unlike, count(*) AS pairs FROM cls p CROSS JOIN off JOIN cls q ON q.row = p.row + dr AND q.col = p.col + dc""")
def unlike_pairs(spark, sf_dir):
    return cluster.unlike_pairs(fx.ras(spark, sf_dir).withColumn("k", fx.class_of(F.col("v"))))


_HIST = f"""{_REG}, {_SITES}, sg AS (SELECT sites.*, g FROM sites JOIN strength USING (row, col)), tp AS (SELECT max(g) AS top, count(*) AS total FROM sg),
    hist AS (SELECT least(255, floor(g / (top / 256))::INTEGER) AS bin, count(*) / max(total)::DOUBLE AS share, max(top) AS top FROM sg, tp GROUP BY 1)"""


@query(f"WITH {_HIST} SELECT bin, round(share, 6) AS share FROM hist")
def edge_strength_hist(spark, sf_dir):
    return _round(regions.edge_strengths(_sites(spark, sf_dir), _strength(spark, sf_dir)), ["bin"], "share")


@query(f"""WITH {_HIST}, c AS (SELECT bin, top, sum(share) OVER (ORDER BY bin) AS cum FROM hist)
    SELECT it::INTEGER AS iteration, round(coalesce((min(bin) FILTER (round(cum, 9) > round(it * 0.02::DOUBLE, 9)) + 0.5::DOUBLE) * max(top) / 256, max(top)), 6) AS k FROM c, (VALUES (1), (10), (25), (49)) i(it) GROUP BY it""")
def k_schedule(spark, sf_dir):
    hist = regions.edge_strengths(_sites(spark, sf_dir), _strength(spark, sf_dir))
    out = None
    for it in (1, 10, 25, 49):
        row = regions.schedule(hist, it).select(F.lit(it).alias("iteration"), F.round("k", 6).alias("k"))
        out = row if out is None else out.unionByName(row)
    return out


_LUT = ", ".join(f"({i}, {r!r}::DOUBLE, {b!r}::DOUBLE)" for i, (r, b) in enumerate(zip(energy.BETA_RATIO, energy.BETA_VALUE, strict=True)))


@query(f"""WITH lut(i, r, b) AS (VALUES {_LUT}), s AS (SELECT x.r AS r1, x.b AS b1, y.r AS r0, y.b AS b0 FROM lut x JOIN lut y ON y.i = x.i + 1),
    q AS (SELECT l_orderkey, l_linenumber, l_discount * 7 + 0.001::DOUBLE AS ratio FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(CASE WHEN ratio >= (SELECT max(r) FROM lut) THEN 0.05::DOUBLE WHEN ratio <= (SELECT min(r) FROM lut) THEN 3.0::DOUBLE
        ELSE b1 + (b0 - b1) / (r0 - r1) * (ratio - r1) END, 6) AS beta FROM q LEFT JOIN s ON ratio > r0 AND ratio <= r1 AND ratio < (SELECT max(r) FROM lut)""")
def beta_lookup(spark, sf_dir):
    ratio = F.col("l_discount") * 7 + 0.001
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(energy.beta(ratio), 6).alias("beta"))


_PEN = "pen AS (SELECT a, b, count(*) AS length, sum(exp(-pow(g / 0.2::DOUBLE, 2))) * 0.8::DOUBLE AS penalty FROM sites JOIN strength USING (row, col) GROUP BY a, b)"


def _penalties(spark, sf_dir):
    return regions.edge_penalties(_sites(spark, sf_dir), _strength(spark, sf_dir), F.lit(0.2), F.lit(0.8))


@query(f"WITH {_REG}, {_SITES}, {_PEN} SELECT a, b, length, round(penalty, 6) AS penalty FROM pen")
def edge_penalty(spark, sf_dir):
    return _round(_penalties(spark, sf_dir), ["a", "b", "length"], "penalty")


_SPREAD = "ln(greatest(CASE WHEN {n} <= 3 THEN 1::DOUBLE ELSE sqrt(greatest(({c11} - {m1} * {m1}) * ({c22} - {m2} * {m2}) - pow({c12} - {m1} * {m2}, 2), 0)) END, sqrt(1e-6::DOUBLE))) * {n} / 2"


def _spread_sql(alias: str) -> str:
    return _SPREAD.format(**{c: f"{alias}.{c}" for c in regions.MOMENTS})


_DIFF = f"""mg AS (SELECT a, b, length, penalty, x.n + y.n AS n, {', '.join(f'(x.{c} * x.n + y.{c} * y.n) / (x.n + y.n) AS {c}' for c in regions.MOMENTS[1:])},
        {_spread_sql('x')} AS ea, {_spread_sql('y')} AS eb FROM pen JOIN st x ON x.region = a JOIN st y ON y.region = b),
    ed AS (SELECT a, b, length, penalty, {_spread_sql('mg')} - ea - eb AS diff FROM mg),
    wt AS (SELECT ed.*, CASE WHEN x.class = y.class THEN diff - penalty ELSE 1e8::DOUBLE END AS weight FROM ed JOIN rc x ON x.region = a JOIN rc y ON y.region = b)"""
_WEIGHTS = f"{_STATS}, {_SITES}, {_PEN}, {_CLASSES}, {_DIFF}"


def _weights(spark, sf_dir):
    edges = regions.region_difference(_penalties(spark, sf_dir), _stats(spark, sf_dir))
    named = regions.with_ends(edges, _classes(spark, sf_dir), ["class"])
    return regions.edge_weights(named, F.col("class_a") == F.col("class_b"))


@query(f"WITH {_WEIGHTS} SELECT a, b, round(diff, 5) AS region_diff FROM ed")
def region_diff_energy(spark, sf_dir):
    return _round(regions.region_difference(_penalties(spark, sf_dir), _stats(spark, sf_dir)), ["a", "b"], "region_diff", places=5)


@query(f"WITH {_WEIGHTS} SELECT a, b, round(weight, 5) AS weight FROM wt")
def edge_weight(spark, sf_dir):
    return _round(_weights(spark, sf_dir), ["a", "b"], "weight", places=5)


_MERGES = """ends AS (SELECT a AS node, a, b, weight FROM wt WHERE weight < 0 UNION ALL SELECT b, a, b, weight FROM wt WHERE weight < 0),
    least_edge AS (SELECT node, a, b, weight FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight, a, b) AS r FROM ends) WHERE r = 1),
    mer AS (SELECT a, b, weight FROM least_edge GROUP BY a, b, weight HAVING count(*) = 2)"""


@query(f"WITH {_WEIGHTS}, {_MERGES} SELECT a, b, round(weight, 5) AS weight FROM mer")
def best_merge(spark, sf_dir):
    return _round(regions.best_merges(_weights(spark, sf_dir)), ["a", "b"], "weight", places=5)


@query(f"""WITH {_WEIGHTS}, {_MERGES}, ren AS (SELECT coalesce(x.a, pen.a) AS p, coalesce(y.a, pen.b) AS q, length, penalty FROM pen LEFT JOIN mer x ON x.b = pen.a LEFT JOIN mer y ON y.b = pen.b)
    SELECT least(p, q) AS a, greatest(p, q) AS b, sum(length)::BIGINT AS length, round(sum(penalty), 6) AS penalty FROM ren WHERE p <> q GROUP BY 1, 2""")
def contract_edges(spark, sf_dir):
    return _round(regions.contract(_penalties(spark, sf_dir), regions.best_merges(_weights(spark, sf_dir))), ["a", "b", "length"], "penalty")


@query(f"""WITH {_WEIGHTS}, {_MERGES} SELECT coalesce(mer.a, region) AS region, sum(n)::BIGINT AS n, {', '.join(f'round(sum(st.{c} * n) / sum(n), 6) AS {c}' for c in regions.MOMENTS[1:])}
    FROM st LEFT JOIN mer ON mer.b = region GROUP BY 1""")
def merge_moments(spark, sf_dir):
    out = regions.merge_regions(_stats(spark, sf_dir), regions.best_merges(_weights(spark, sf_dir)))
    return out.select("region", "n", *[fx.signed_round(c, 6).alias(c) for c in regions.MOMENTS[1:]])


@query(f"""WITH {_REG}, nw AS (SELECT row, col, CASE WHEN region < 0 THEN -2 ELSE (region // 3) * 5 + CASE WHEN row > 60 THEN 1 ELSE 0 END END AS region FROM reg)
    SELECT reg.region AS old, arg_max(nw.region, reg.row * 1000 + reg.col) AS new FROM reg JOIN nw USING (row, col) WHERE reg.region >= 0 AND nw.region >= 0 GROUP BY reg.region""")
def merge_lut(spark, sf_dir):
    old = _pixels(spark, sf_dir)
    new = old.withColumn("region", F.when(F.col("region") < 0, -2).otherwise(F.floor(F.col("region") / 3) * 5 + F.when(F.col("row") > 60, 1).otherwise(0)).cast("int"))
    return regions.merge_lut(old, new)


@query(f"""WITH {_REG}, o AS (SELECT row, col, CASE WHEN region < 0 THEN region ELSE 1000 - region * 7 END AS region FROM reg),
    nm AS (SELECT region, row_number() OVER (ORDER BY region) - 1 AS new FROM (SELECT DISTINCT region FROM o WHERE region >= 0))
    SELECT row, col, coalesce(new, o.region)::INTEGER AS new FROM o LEFT JOIN nm USING (region)""")
def relabel_map(spark, sf_dir):
    odd = _pixels(spark, sf_dir).withColumn("region", F.when(F.col("region") < 0, F.col("region")).otherwise(1000 - F.col("region") * 7))
    return regions.relabel(odd).select("row", "col", "new")


@query(f"WITH {_STATS} SELECT region, (row_number() OVER (ORDER BY m1, region) - 1)::INTEGER AS place FROM st")
def sort_map(spark, sf_dir):
    return regions.sort_by_mean(_stats(spark, sf_dir))


@query()
def connected_components(spark, sf_dir):
    """Eight-connected components of the class map; the tests flood the whole map."""
    pixels = fx.ras(spark, sf_dir).withColumn("k", fx.class_of(F.col("v")))
    return regions.components(pixels, "k")


_GMM = """gm AS (SELECT class, sum(n) AS n, sum(m1 * n) / sum(n) AS mu1, sum(m2 * n) / sum(n) AS mu2, sum(c11 * n) / sum(n) AS s11, sum(c12 * n) / sum(n) AS s12, sum(c22 * n) / sum(n) AS s22
        FROM st JOIN rc USING (region) GROUP BY class),
    gv AS (SELECT class, n / sum(n) OVER ()::DOUBLE AS prior, mu1, mu2, s11 - mu1 * mu1 AS v11, s12 - mu1 * mu2 AS v12, s22 - mu2 * mu2 AS v22 FROM gm),
    g AS (SELECT *, v22 / (v11 * v22 - v12 * v12) AS i11, -v12 / (v11 * v22 - v12 * v12) AS i12, v11 / (v11 * v22 - v12 * v12) AS i22, sqrt(v11 * v22 - v12 * v12) AS cov_det FROM gv)"""
_MODEL = f"{_STATS}, {_CLASSES}, {_GMM}"


def _gmm(spark, sf_dir):
    return cluster.gmm_of_regions(_classes(spark, sf_dir))


@query(f"WITH {_MODEL} SELECT class, round(prior, 6) AS prior, round(mu1, 6) AS mu1, round(mu2, 6) AS mu2, round(i11, 3) AS i11, round(i12, 3) AS i12, round(i22, 3) AS i22, round(cov_det, 8) AS cov_det FROM g")
def gmm_mstep(spark, sf_dir):
    g = _gmm(spark, sf_dir)
    r = lambda c, p: F.round(c, p).alias(c)
    return g.select("class", r("prior", 6), r("mu1", 6), r("mu2", 6), r("i11", 3), r("i12", 3), r("i22", 3), r("cov_det", 8))


_UNARY = """un AS (SELECT region, g.class AS candidate, n, (0.5::DOUBLE * (i11 * (c11 - 2 * m1 * mu1 + mu1 * mu1) + 2 * i12 * (c12 - m1 * mu2 - m2 * mu1 + mu1 * mu2)
        + i22 * (c22 - 2 * m2 * mu2 + mu2 * mu2)) + ln(cov_det)) * n / 2 AS u FROM st, g),
    best AS (SELECT region, candidate AS class, u FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY u, candidate) AS r FROM un) WHERE r = 1)"""


def _best(spark, sf_dir):
    return cluster.classify(cluster.unary(_stats(spark, sf_dir), _gmm(spark, sf_dir)))


@query(f"WITH {_MODEL}, {_UNARY} SELECT region, class, round(u, 4) AS u FROM best")
def unary_argmin(spark, sf_dir):
    return _round(_best(spark, sf_dir), ["region", "class"], "u", places=4)


_FISHER = """fp AS (SELECT x.prior / (x.prior + y.prior) AS w, x.mu1 - y.mu1 AS d1, x.mu2 - y.mu2 AS d2, x.v11 AS a11, x.v12 AS a12, x.v22 AS a22, y.v11 AS b11, y.v12 AS b12, y.v22 AS b22
        FROM g x JOIN g y ON x.class < y.class),
    fw AS (SELECT d1, d2, w * a11 + (1 - w) * b11 AS v11, w * a12 + (1 - w) * b12 AS v12, w * a22 + (1 - w) * b22 AS v22 FROM fp),
    fs AS (SELECT least(1e8::DOUBLE, min((d1 * d1 * v22 - 2 * d1 * d2 * v12 + d2 * d2 * v11) / (v11 * v22 - v12 * v12))) AS fisher FROM fw)"""


@query(f"WITH {_MODEL}, {_FISHER} SELECT round(fisher, 5) AS fisher FROM fs")
def min_fisher(spark, sf_dir):
    return cluster.fisher(_gmm(spark, sf_dir)).select(F.round("fisher", 5).alias("fisher"))


@query(f"""WITH {_MODEL}, {_FISHER}, pairs AS (SELECT x.mu1 - y.mu1 AS d1, x.mu2 - y.mu2 AS d2, x.prior * x.v11 + y.prior * y.v11 AS v11,
        x.prior * x.v12 + y.prior * y.v12 AS v12, x.prior * x.v22 + y.prior * y.v22 AS v22 FROM g x JOIN g y ON x.class < y.class)
    SELECT round(least(1e8::DOUBLE, min((d1 * d1 * v22 - 2 * d1 * d2 * v12 + d2 * d2 * v11) / (v11 * v22 - v12 * v12))), 5) AS fisher FROM pairs""")
def pixel_fisher(spark, sf_dir):
    return cluster.fisher(_gmm(spark, sf_dir), normalised=False).select(F.round("fisher", 5).alias("fisher"))


@query(f"WITH {_MODEL}, {_FISHER} SELECT round(0.7::DOUBLE * 3 * (fisher / 0.4::DOUBLE) / (1 + fisher / 0.4::DOUBLE), 6) AS beta FROM fs")
def beta_fisher(spark, sf_dir):
    return cluster.fisher(_gmm(spark, sf_dir)).select(F.round(energy.fisher_beta(F.lit(0.7), F.col("fisher")), 6).alias("beta"))


@query(f"""WITH {_STATS}, {_SITES}, {_PEN}, {_CLASSES}, {_GMM}, {_UNARY},
    bin AS (SELECT sum(CASE WHEN x.class <> y.class THEN penalty ELSE 0 END) AS b FROM pen JOIN best x ON x.region = a JOIN best y ON y.region = pen.b)
    SELECT round((SELECT sum(u) FROM best), 4) AS "unary", round(b, 4) AS "binary", round((SELECT sum(u) FROM best) + b, 4) AS energy FROM bin""")
def overall_energy(spark, sf_dir):
    best = _best(spark, sf_dir)
    edges = regions.with_ends(_penalties(spark, sf_dir), best, ["class"])
    return _round(cluster.overall_energy(best, edges), [], "unary", "binary", "energy", places=4)


@query(f"WITH {fx.CLASSES}, {fx.NEIGHBOURS} SELECT round(0.6::DOUBLE * count(*), 4) AS energy FROM cls p CROSS JOIN off JOIN cls q ON q.row = p.row + dr AND q.col = p.col + dc AND p.k <> q.k")
def mll_energy(spark, sf_dir):
    found = cluster.unlike_pairs(fx.ras(spark, sf_dir).withColumn("k", fx.class_of(F.col("v"))))
    return found.select(F.round(0.6 * F.col("unlike"), 4).alias("energy"))


_CENTRES = [(0, -0.05, 0.0), (1, 0.0, 0.02), (2, 0.06, -0.01)]
_KM = f"""{_STATS}, ce(k, c1, c2) AS (VALUES {', '.join(f'({k}, {a!r}::DOUBLE, {b!r}::DOUBLE)' for k, a, b in _CENTRES)}),
    near_c AS (SELECT region, n, m1, m2, k, row_number() OVER (PARTITION BY region ORDER BY pow(m1 - c1, 2) + pow(m2 - c2, 2), k) AS r FROM st, ce)"""


@query(f"WITH {_KM} SELECT k, round(sum(m1 * n) / sum(n), 6) AS c1, round(sum(m2 * n) / sum(n), 6) AS c2 FROM near_c WHERE r = 1 GROUP BY k")
def kmeans_step(spark, sf_dir):
    centres = spark.createDataFrame(_CENTRES, "k int, c1 double, c2 double")
    return _round(cluster.kmeans_update(cluster.kmeans_assign(_stats(spark, sf_dir), centres)), ["k"], "c1", "c2")


_PGMM = f"""{fx.TWO}, px AS (SELECT *, CASE WHEN hh < -0.05::DOUBLE THEN 0 WHEN hh < 0.05::DOUBLE THEN 1 ELSE 2 END AS k FROM two),
    pm AS (SELECT k, count(*) / sum(count(*)) OVER ()::DOUBLE AS prior, avg(hh) AS mu1, avg(hv) AS mu2, avg(hh * hh) - avg(hh) * avg(hh) AS v11, avg(hh * hv) - avg(hh) * avg(hv) AS v12,
        avg(hv * hv) - avg(hv) * avg(hv) AS v22 FROM px GROUP BY k),
    pg AS (SELECT *, v22 / (v11 * v22 - v12 * v12) AS i11, -v12 / (v11 * v22 - v12 * v12) AS i12, v11 / (v11 * v22 - v12 * v12) AS i22, sqrt(v11 * v22 - v12 * v12) AS cov_det FROM pm)"""


def _pixel_gmm(spark, sf_dir):
    pixels = fx.two(spark, sf_dir).withColumn("k", fx.class_of(F.col("hh")))
    return pixels, cluster.gmm_of_pixels(pixels)


@query(f"""WITH {_PGMM}, sc1 AS (SELECT row, col, hh, hv, pg.k, ln(prior) - ln(cov_det) - 0.5::DOUBLE * (i11 * pow(hh - mu1, 2) + 2 * i12 * (hh - mu1) * (hv - mu2) + i22 * pow(hv - mu2, 2)) AS l FROM px, pg),
    sc2 AS (SELECT *, exp(l - max(l) OVER (PARTITION BY row, col)) AS e FROM sc1), sc3 AS (SELECT *, e / sum(e) OVER (PARTITION BY row, col) AS p FROM sc2)
    SELECT k, round(sum(p) / sum(sum(p)) OVER (), 6) AS prior, round(sum(p * hh) / sum(p), 6) AS mu1, round(sum(p * hv) / sum(p), 6) AS mu2 FROM sc3 GROUP BY k""")
def em_step(spark, sf_dir):
    pixels, gmm = _pixel_gmm(spark, sf_dir)
    return _round(cluster.em_step(pixels.drop("k"), gmm), ["k"], "prior", "mu1", "mu2")


@query(f"""WITH {_PGMM}, sc1 AS (SELECT row, col, pg.k AS c, ln(cov_det) - ln(prior) + 0.5::DOUBLE * (i11 * pow(hh - mu1, 2) + 2 * i12 * (hh - mu1) * (hv - mu2) + i22 * pow(hv - mu2, 2)) AS u FROM px, pg)
    SELECT row, col, c AS class FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY u, c) AS r FROM sc1) WHERE r = 1""")
def pixel_classes(spark, sf_dir):
    pixels, gmm = _pixel_gmm(spark, sf_dir)
    return cluster.assign_pixels(pixels.drop("k"), gmm)


@query(f"""WITH {_PGMM}, {fx.NEIGHBOURS}, nb AS (SELECT p.row, p.col, q.k AS c, count(*) AS same FROM px p CROSS JOIN off JOIN px q ON q.row = p.row + dr AND q.col = p.col + dc GROUP BY p.row, p.col, q.k),
    sc1 AS (SELECT px.row, px.col, pg.k AS c, round(ln(cov_det) + 0.5::DOUBLE * (i11 * pow(hh - mu1, 2) + 2 * i12 * (hh - mu1) * (hv - mu2) + i22 * pow(hv - mu2, 2)) - 0.4::DOUBLE * coalesce(same, 0), 9) AS u
        FROM px CROSS JOIN pg LEFT JOIN nb ON nb.row = px.row AND nb.col = px.col AND nb.c = pg.k WHERE px.row % 2 * 2 + px.col % 2 = 1),
    bs AS (SELECT row, col, c FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY u, c) AS r FROM sc1) WHERE r = 1)
    SELECT px.row, px.col, coalesce(c, k) AS k FROM px LEFT JOIN bs ON bs.row = px.row AND bs.col = px.col""")
def mrf_sweep(spark, sf_dir):
    pixels, gmm = _pixel_gmm(spark, sf_dir)
    return cluster.mrf_sweep(pixels, gmm, 0.4, 1).select("row", "col", "k")


@query()
def pixel_em(spark, sf_dir):
    """Class parameters after up to five steps over the whole raster."""
    pixels, gmm = _pixel_gmm(spark, sf_dir)
    return _round(cluster.em(pixels.drop("k"), gmm, 5), ["k"], "prior", "mu1", "mu2", places=4)


@query()
def region_kmeans(spark, sf_dir):
    """Centres over all regions of the raster."""
    return _round(cluster.kmeans(_stats(spark, sf_dir).select("m1", "m2", "n"), 3), ["k"], "c1", "c2")


@query(f"WITH {_REG}, {_SITES}, both_ways AS (SELECT a, b FROM adj UNION ALL SELECT b, a FROM adj) SELECT a AS node, count(*) AS degree FROM both_ways GROUP BY a")
def region_degrees(spark, sf_dir):
    return graphs.degrees(regions.adjacency(_sites(spark, sf_dir)))


@query(f"WITH {_REG}, {_SITES}, both_ways AS (SELECT a, b FROM adj UNION ALL SELECT b, a FROM adj), d AS (SELECT a, count(*) AS degree FROM both_ways GROUP BY a) SELECT coalesce(max(degree), 0) AS degree FROM d")
def max_degree(spark, sf_dir):
    return graphs.max_degree(regions.adjacency(_sites(spark, sf_dir)))


@query(f"WITH {_PGMM} SELECT k, (SELECT count(*) FROM px WHERE px.k = pm.k) AS n, round(mu1, 6) AS mu1, round(mu2, 6) AS mu2, round(v11, 6) AS v11, round(v12, 6) AS v12, round(v22, 6) AS v22 FROM pm")
def segment_stats(spark, sf_dir):
    pixels, _ = _pixel_gmm(spark, sf_dir)
    return _round(cluster.segment_statistics(pixels), ["k", "n"], "mu1", "mu2", "v11", "v12", "v22")


@query(f"""WITH {_STATS}, {_CLASSES}, {fx.NEIGHBOURS}, lab AS (SELECT reg.row, reg.col, hh, hv, coalesce(rc.class, -2) AS k FROM reg LEFT JOIN rc USING (region)),
    cm AS (SELECT k, avg(hh) AS m1, avg(hv) AS m2 FROM lab WHERE k >= 0 GROUP BY k),
    nb AS (SELECT DISTINCT p.row, p.col, p.hh, p.hv, q.k AS c FROM lab p CROSS JOIN off JOIN lab q ON q.row = p.row + dr AND q.col = p.col + dc WHERE p.k < 0 AND q.k >= 0),
    rk AS (SELECT nb.row, nb.col, c, row_number() OVER (PARTITION BY nb.row, nb.col ORDER BY pow(hh - m1, 2) + pow(hv - m2, 2), c) AS r FROM nb JOIN cm ON cm.k = c)
    SELECT lab.row, lab.col, CASE WHEN k >= 0 THEN k ELSE coalesce(c, k) END AS filled FROM lab LEFT JOIN rk ON rk.row = lab.row AND rk.col = lab.col AND r = 1""")
def boundary_fill_same_class(spark, sf_dir):
    named = _pixels(spark, sf_dir).join(_classes(spark, sf_dir).select("region", F.col("class").alias("k")), "region", "left")
    named = named.withColumn("k", F.coalesce("k", F.lit(-2))).select("row", "col", "hh", "hv", "k")
    means = named.where("k >= 0").groupBy("k").agg(F.avg("hh").alias("m1"), F.avg("hv").alias("m2"))
    return regions.fill_boundaries(named, means).select("row", "col", "filled")


_GL = f"""{fx.QUANTISED}, w AS (SELECT row // 16 * 4 + col // 16 AS tile, row, col, floor(g * 16 / 256)::INTEGER AS g FROM q), dir(dr, dc) AS (VALUES (0, 1), (-1, 1), (-1, 0), (-1, -1)),
    pr AS (SELECT a.tile, a.g::DOUBLE AS i, b.g::DOUBLE AS j FROM w a CROSS JOIN dir JOIN w b ON b.tile = a.tile AND b.row = a.row + dr AND b.col = a.col + dc),
    sm AS (SELECT tile, count(*) AS n, sum(pow(i - j, 2)) AS con, sum(abs(i - j)) AS dis, sum(1 / (1 + pow(i - j, 2))) AS hom, sum(1 / (1 + abs(i - j))) AS inv, sum(i + j) AS s, sum(i * i + j * j) AS q2, sum(i * j) AS x FROM pr GROUP BY tile),
    sy AS (SELECT tile, i, j, count(*) AS c FROM (SELECT tile, i, j FROM pr UNION ALL SELECT tile, j, i FROM pr) GROUP BY tile, i, j),
    sh AS (SELECT sy.tile, sum(pow(c / (2 * n)::DOUBLE, 2)) AS asm, -sum(c / (2 * n)::DOUBLE * ln(c / (2 * n)::DOUBLE)) AS ent FROM sy JOIN sm USING (tile) GROUP BY sy.tile),
    mv AS (SELECT *, s / (2 * n) AS mu, greatest(q2 / (2 * n) - pow(s / (2 * n), 2), 0) AS var FROM sm JOIN sh USING (tile))"""


def _texture_tiles(spark, sf_dir):
    """Tiles of 16 x 16 pixels in 16 grey levels."""
    pixels = fx.quantised(spark, sf_dir).withColumn("tile", F.floor(F.col("row") / 16) * 4 + F.floor(F.col("col") / 16))
    return texture.quantise(pixels, 16)


@query(f"""WITH {_GL} SELECT tile, round(asm, 6) AS asm, round(ent, 6) AS ent, round(con / n, 6) AS con, round(dis / n, 6) AS dis, round(hom / n, 6) AS hom, round(inv / n, 6) AS inv, round(mu, 6) AS mu,
    round(sqrt(var), 6) AS std, round(CASE WHEN sqrt(var) <= 1e-12::DOUBLE THEN 1 ELSE (x / n - mu * mu) / var END, 6) AS cor FROM mv""")
def glcm_measures(spark, sf_dir):
    found = texture.measures(texture.pairs(_texture_tiles(spark, sf_dir), ["tile"]), ["tile"])
    return _round(found, ["tile"], "asm", "ent", "con", "dis", "hom", "inv", "mu", "std", "cor")


@query("""WITH p AS (SELECT vec_id AS id, embedding[1]::DOUBLE * 5 AS x, embedding[2]::DOUBLE * 5 AS y, embedding[3]::DOUBLE AS w FROM embeddings)
    SELECT a.id, round(sum(b.w * exp(-0.5::DOUBLE * (pow(a.x - b.x, 2) + pow(a.y - b.y, 2)))), 6) AS g FROM p a, p b GROUP BY a.id""")
def gauss_transform_exact(spark, sf_dir):
    e = lambda i: F.element_at("embedding", i).cast("double")
    points = fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (e(1) * 5).alias("x"), (e(2) * 5).alias("y"), e(3).alias("w"))
    return _round(cluster.gauss_transform(points.withColumnRenamed("w", "value"), ["x", "y"], "value"), ["id"], "g")


_MAP = f"{fx.CLASSES}, km AS (SELECT row, col, CASE WHEN row % 8 = 7 THEN -2 ELSE k END AS k FROM cls), {fx.NEIGHBOURS}"
_FLAGS = f"""{_MAP}, fl AS (SELECT p.row, p.col, p.k, bool_or(p.k <> q.k) AS unlike, list(DISTINCT q.k ORDER BY q.k) FILTER (q.k >= 0) AS candidates,
    count(DISTINCT q.k) FILTER (q.k >= 0) >= 2 AS two_regions, count(DISTINCT q.k) FILTER (q.k >= 0 AND off.k % 2 = 0) >= 2 AS inner_two
    FROM km p CROSS JOIN off JOIN km q ON q.row = p.row + dr AND q.col = p.col + dc GROUP BY p.row, p.col, p.k)"""


def _class_map(spark, sf_dir):
    return fx.ras(spark, sf_dir).withColumn("k", F.when(F.col("row") % 8 == 7, -2).otherwise(fx.class_of(F.col("v")))).select("row", "col", "k")


@query(f"WITH {_FLAGS} SELECT row, col, unlike, array_to_string(candidates, ',') AS candidates, two_regions, inner_two AS inner FROM fl")
def boundary_flags(spark, sf_dir):
    out = regions.boundary_flags(_class_map(spark, sf_dir))
    return out.withColumn("candidates", F.array_join(F.transform("candidates", lambda x: x.cast("string")), ","))


@query(f"WITH {_FLAGS} SELECT round(count(*) FILTER (k < 0 AND two_regions) / count(*)::DOUBLE, 6) AS ratio FROM fl")
def class_map_ratio(spark, sf_dir):
    return regions.class_map_ratio(_class_map(spark, sf_dir)).select(F.round("ratio", 6).alias("ratio"))


@query(f"WITH {_REG} SELECT greatest(coalesce(max(region), -1), -1) AS max_label, count(DISTINCT region) FILTER (region > 0) AS n_positive FROM reg")
def label_counts(spark, sf_dir):
    return regions.label_counts(_pixels(spark, sf_dir), "region")


@query(f"WITH {fx.RAS} SELECT count(*) AS n FROM ras a FULL JOIN (SELECT row, col + 4 AS col, CASE WHEN row % 9 = 0 THEN v + 1 ELSE v END AS v FROM ras) b ON a.row = b.row AND a.col = b.col WHERE a.v IS DISTINCT FROM b.v")
def image_difference(spark, sf_dir):
    """Against the raster moved by four columns, with every ninth row brighter."""
    other = fx.ras(spark, sf_dir).withColumns({"col": F.col("col") + 4, "v": F.when(F.col("row") % 9 == 0, F.col("v") + 1).otherwise(F.col("v"))})
    return regions.difference(fx.ras(spark, sf_dir), other, "v")


@query(f"WITH {_STATS}, {_SITES} SELECT a, b, length, y.n / x.n::DOUBLE > 0.9::DOUBLE AS refresh FROM adj JOIN st x ON x.region = a JOIN st y ON y.region = b")
def size_ratio_skip(spark, sf_dir):
    return regions.skip_small(regions.adjacency(_sites(spark, sf_dir)), _stats(spark, sf_dir), 0.9)


@query(f"""WITH RECURSIVE {_STATS}, {_SITES}, {_CLASSES}, act AS (SELECT a, b FROM adj JOIN rc x ON x.region = a JOIN rc y ON y.region = b WHERE x.class = y.class),
    two_way AS (SELECT a, b FROM act UNION ALL SELECT b, a FROM act), reach AS (SELECT region, region AS o FROM rc UNION SELECT two_way.b, r.o FROM reach r JOIN two_way ON two_way.a = r.region)
    SELECT region, min(o)::BIGINT AS component FROM reach GROUP BY region""")
def same_class_regions(spark, sf_dir):
    return regions.same_class_regions(regions.adjacency(_sites(spark, sf_dir)), _classes(spark, sf_dir))


_BLOCKS = """ln AS (SELECT l_orderkey, l_linenumber, l_partkey * 8 + l_linenumber AS node FROM lineitem),
    be AS (SELECT DISTINCT least(x.node, y.node) AS a, greatest(x.node, y.node) AS b FROM ln x JOIN ln y ON x.l_orderkey = y.l_orderkey AND x.l_linenumber < y.l_linenumber AND y.l_linenumber <= x.l_linenumber + 2)"""
_TRIPLES = f"{_BLOCKS}, tr AS (SELECT x.a, x.b, y.b AS c FROM be x JOIN be y ON y.a = x.b JOIN be z ON z.a = x.a AND z.b = y.b)"


def _triples(spark, sf_dir):
    """Triples of an order graph: lines of a part are adjacent if an order has them next to each other or one apart."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("x"), (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("a"))
    after = lines.select("l_orderkey", F.explode(F.array(F.col("x") - 1, F.col("x") - 2)).alias("x"), F.col("a").alias("b"))
    return regions.cliques3(lines.join(after, ["l_orderkey", "x"]).select("a", "b"))


@query(f"WITH {_TRIPLES} SELECT a, b, c FROM tr")
def region_cliques(spark, sf_dir):
    return _triples(spark, sf_dir)


@query(f"""WITH {_TRIPLES}, nm AS (SELECT a || '-' || b || '-' || c AS id, unnest([a, b, c]) AS region FROM tr)
    SELECT x.id AS x, y.id AS y, count(*) AS shared FROM nm x JOIN nm y ON x.region = y.region AND x.id < y.id GROUP BY 1, 2""")
def clique_graph(spark, sf_dir):
    return regions.clique_graph(_triples(spark, sf_dir).withColumn("id", F.concat_ws("-", "a", "b", "c")))


@query(f"""WITH {_GL}, ms AS (SELECT tile, con / n AS con, hom / n AS hom, mu, asm, ent FROM mv)
    SELECT tile, round(con / 225, 6) AS con, round((hom - 1 / 226::DOUBLE) / (1 - 1 / 226::DOUBLE), 6) AS hom, round(mu / 15, 6) AS mu, round((asm - 1 / 256::DOUBLE) / (1 - 1 / 256::DOUBLE), 6) AS asm,
        round(ent / ln(256::DOUBLE), 6) AS ent FROM ms""")
def glcm_normalised(spark, sf_dir):
    found = texture.measures(texture.pairs(_texture_tiles(spark, sf_dir), ["tile"]), ["tile"])
    return _round(texture.normalised(found, ["tile"], 16, 930), ["tile"], "con", "hom", "mu", "asm", "ent")


@query("""SELECT i::INTEGER AS iteration, round(8 * pow(0.9::DOUBLE, i) + 1, 9) AS alpha, round(8 * pow(0.9::DOUBLE, i) + 0.5::DOUBLE, 9) AS pixel_alpha, round(2 * pow(0.98::DOUBLE, i), 9) AS temperature FROM range(100) t(i)""")
def schedules(spark, sf_dir):
    i = F.col("iteration")
    r = lambda c, n: F.round(c, 9).alias(n)
    rows = spark.range(100).select(F.col("id").cast("int").alias("iteration"))
    return rows.select("iteration", r(energy.alpha(i, 8.0, 0.9), "alpha"), r(energy.pixel_alpha(i, 8.0, 0.9, 2), "pixel_alpha"), r(energy.temperature(i, 2.0), "temperature"))


@query("""WITH e AS (SELECT label, vec_id AS row, unnest(range(64))::INTEGER AS col, (unnest(embedding) > 0)::INTEGER * CASE WHEN label = 3 THEN 0 ELSE 255 END AS v FROM embeddings),
    r AS (SELECT label, min(v) AS lo, max(v) AS hi FROM e GROUP BY label) SELECT label, row, col, (lo = hi OR v >= (lo + hi) / 2) AS valid FROM e JOIN r USING (label)""")
def mask_threshold(spark, sf_dir):
    """Masks by label; that of label 3 is constant, hence valid everywhere."""
    rows = fx.table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "x"))
    rows = rows.withColumn("v", F.when((F.col("x") > 0) & (F.col("label") != 3), 255).otherwise(0))
    w = W.partitionBy("label")
    return rows.select("label", "row", "col", energy.mask_of(F.col("v"), F.min("v").over(w), F.max("v").over(w)).alias("valid"))
