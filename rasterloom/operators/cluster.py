"""Gaussian classes of regions and pixels: estimation, unary energies, separability, and single steps of the iterative fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions import energy
from rasterloom.operators.raster import neighbours

RIDGE, LEAST_EIGEN = 0.001, 1e-12
REACH = 7.0  # beyond it a Gaussian weight is under 2.3e-11


def _gaussian(sums: DataFrame, key: str) -> DataFrame:
    """key, prior, mu1, mu2, inverse covariance i11, i12, i22, root determinant, from n and count-weighted moments."""
    var = {"v11": F.col("c11") - F.col("mu1") * F.col("mu1"), "v12": F.col("c12") - F.col("mu1") * F.col("mu2"), "v22": F.col("c22") - F.col("mu2") * F.col("mu2")}
    out = sums.withColumns(var)
    ridge = F.when(energy.least_eigen2(F.col("v11"), F.col("v12"), F.col("v22")) <= LEAST_EIGEN, RIDGE).otherwise(0.0)
    out = out.withColumn("ridge", ridge).withColumns({"v11": F.col("v11") + F.col("ridge"), "v22": F.col("v22") + F.col("ridge")})
    out = out.withColumn("det", energy.det2(F.col("v11"), F.col("v12"), F.col("v22")))
    return out.select(
        key, (F.col("n") / F.sum("n").over(W.partitionBy())).alias("prior"), "mu1", "mu2", (F.col("v22") / F.col("det")).alias("i11"),
        (-F.col("v12") / F.col("det")).alias("i12"), (F.col("v11") / F.col("det")).alias("i22"), F.sqrt(F.greatest(F.col("det"), F.lit(0.0))).alias("cov_det"),
        "v11", "v12", "v22",
    )


def gmm_of_regions(regions: DataFrame, key: str = "class") -> DataFrame:
    """Class parameters from region moments; a row a class."""
    n = F.sum("n")
    mean = lambda c: F.sum(F.col(c) * F.col("n")) / n
    sums = regions.groupBy(key).agg(n.alias("n"), mean("m1").alias("mu1"), mean("m2").alias("mu2"), *[mean(c).alias(c) for c in ("c11", "c12", "c22")])
    return _gaussian(sums, key)


def gmm_of_pixels(pixels: DataFrame, key: str = "k") -> DataFrame:
    """Class parameters from labelled pixels (hh, hv)."""
    hh, hv = F.col("hh"), F.col("hv")
    sums = pixels.where(F.col(key) >= 0).groupBy(key)
    return _gaussian(sums.agg(F.count("*").alias("n"), F.avg(hh).alias("mu1"), F.avg(hv).alias("mu2"), F.avg(hh * hh).alias("c11"), F.avg(hh * hv).alias("c12"), F.avg(hv * hv).alias("c22")), key)


def unary(regions: DataFrame, gmm: DataFrame, key: str = "class") -> DataFrame:
    """region, candidate, u: energy of each region in each class; classes are few, so they are broadcast."""
    classes = F.broadcast(gmm.select(F.col(key).alias("candidate"), "mu1", "mu2", "i11", "i12", "i22", "cov_det"))
    m1, m2, mu1, mu2 = (F.col(c) for c in ("m1", "m2", "mu1", "mu2"))
    spread = (F.col("c11") - 2 * m1 * mu1 + mu1 * mu1, F.col("c12") - m1 * mu2 - m2 * mu1 + mu1 * mu2, F.col("c22") - 2 * m2 * mu2 + mu2 * mu2)
    trace = energy.scatter_trace((F.col("i11"), F.col("i12"), F.col("i22")), spread)
    return regions.crossJoin(classes).select("region", "candidate", ((0.5 * trace + F.log("cov_det")) * F.col("n") / 2).alias("u"))


def classify(energies: DataFrame) -> DataFrame:
    """region, class of least energy, the smallest on ties."""
    return energies.groupBy("region").agg(F.min(F.struct("u", "candidate")).alias("best")).select("region", F.col("best.candidate").alias("class"), F.col("best.u").alias("u"))


def fisher(gmm: DataFrame, key: str = "class", normalised: bool = True) -> DataFrame:
    """Least separability over all pairs of classes, one row: distance against the prior-weighted within-class scatter.

    The priors of a pair sum to one if normalised, as for regions; for pixels they are taken as they are.
    """
    side = lambda s: gmm.select(F.col(key).alias(f"k{s}"), *[F.col(c).alias(f"{c}{s}") for c in ("prior", "mu1", "mu2", "v11", "v12", "v22")])
    pairs = side("_i").join(F.broadcast(side("_j")), F.col("k_i") < F.col("k_j"))
    both = F.col("prior_i") + F.col("prior_j") if normalised else F.lit(1.0)
    v = {c: (F.col(f"{c}_i") * F.col("prior_i") + F.col(f"{c}_j") * F.col("prior_j")) / both for c in ("v11", "v12", "v22")}
    d1, d2 = F.col("mu1_i") - F.col("mu1_j"), F.col("mu2_i") - F.col("mu2_j")
    value = (d1 * d1 * v["v22"] - 2 * d1 * d2 * v["v12"] + d2 * d2 * v["v11"]) / energy.det2(v["v11"], v["v12"], v["v22"])
    return pairs.agg(F.least(F.lit(1e8), F.min(value)).alias("fisher"))


def overall_energy(assigned: DataFrame, edges: DataFrame) -> DataFrame:
    """Sum of the regions' unary energies and of the penalties between different classes, one row; edges have class_a, class_b, penalty."""
    first = assigned.agg(F.sum("u").alias("unary"))
    second = edges.agg(F.sum(F.when(F.col("class_a") != F.col("class_b"), F.col("penalty")).otherwise(0.0)).alias("binary"))
    return first.crossJoin(second).select("unary", "binary", (F.col("unary") + F.col("binary")).alias("energy"))


def unlike_pairs(pixels: DataFrame, key: str = "k") -> DataFrame:
    """Ordered neighbour pairs of unequal labels, one row."""
    return neighbours(pixels.where(F.col(key) >= 0), key).agg(F.count_if(F.col(key) != F.col("other")).alias("unlike"), F.count("*").alias("pairs"))


def kmeans_assign(points: DataFrame, centres: DataFrame) -> DataFrame:
    """points with class and squared distance of the nearest centre (k, c1, c2); centres are few, so they are broadcast as one array."""
    rows = centres.agg(F.array_sort(F.collect_list(F.struct("k", "c1", "c2"))).alias("centres"))
    away = lambda c: F.struct((F.pow(F.col("m1") - c["c1"], 2) + F.pow(F.col("m2") - c["c2"], 2)).alias("d"), c["k"].alias("k"))
    found = points.crossJoin(F.broadcast(rows)).withColumn("best", F.array_min(F.transform("centres", away)))
    return found.drop("centres").withColumns({"class": F.col("best.k"), "distance": F.col("best.d")}).drop("best")


def kmeans_update(assigned: DataFrame) -> DataFrame:
    """k, c1, c2: count-weighted means of the classes."""
    n = F.sum("n")
    return assigned.groupBy(F.col("class").alias("k")).agg((F.sum(F.col("m1") * F.col("n")) / n).alias("c1"), (F.sum(F.col("m2") * F.col("n")) / n).alias("c2"))


def kmeans(points: DataFrame, k: int, rounds: int = 50, tolerance: float = 1e-6) -> DataFrame:
    """Centres by Lloyd's rounds from k spread-out quantiles of the first feature; each round is one pass over points (m1, m2, n)."""
    spark = points.sparkSession
    marks = points.agg(F.percentile_approx("m1", [(2 * i + 1) / (2 * k) for i in range(k)]).alias("q"), F.avg("m2").alias("m")).first()
    centres = [(i, float(q), float(marks["m"])) for i, q in enumerate(marks["q"])]
    before = float("inf")
    for _ in range(rounds):
        assigned = kmeans_assign(points, spark.createDataFrame(centres, "k int, c1 double, c2 double"))
        n = F.sum("n")
        rows = assigned.groupBy("class").agg((F.sum(F.col("m1") * F.col("n")) / n).alias("c1"), (F.sum(F.col("m2") * F.col("n")) / n).alias("c2"), F.sum(F.col("distance") * F.col("n")).alias("e")).collect()
        held = {r["class"]: (r["class"], r["c1"], r["c2"]) for r in rows}  # k rows
        centres = [held.get(c[0], c) for c in centres]
        now = sum(r["e"] for r in rows)
        if before - now <= tolerance * max(now, 1e-12):
            break
        before = now
    return spark.createDataFrame(centres, "k int, c1 double, c2 double")


def _with_classes(pixels: DataFrame, gmm: DataFrame, key: str) -> DataFrame:
    """pixels with classes, one array of the class parameters: a row a class, so they travel as one broadcast row and no pixel is shuffled."""
    held = gmm.agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), "prior", "mu1", "mu2", "i11", "i12", "i22", "cov_det"))).alias("classes"))
    return pixels.crossJoin(F.broadcast(held))


def _distance(c: Column) -> Column:
    """Squared Mahalanobis distance of a pixel from a class."""
    d1, d2 = F.col("hh") - c["mu1"], F.col("hv") - c["mu2"]
    return c["i11"] * d1 * d1 + 2 * c["i12"] * d1 * d2 + c["i22"] * d2 * d2


def em_step(pixels: DataFrame, gmm: DataFrame, key: str = "k") -> DataFrame:
    """Class parameters after one expectation-maximisation step over pixels (hh, hv) of one model."""
    held = _with_classes(pixels.select("hh", "hv"), gmm, key)
    held = held.withColumn("l", F.transform("classes", lambda c: F.log(c["prior"]) - F.log(c["cov_det"]) - 0.5 * _distance(c)))
    held = held.withColumn("top", F.array_max("l")).withColumn("e", F.transform("l", lambda x: F.exp(x - F.col("top"))))
    held = held.withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    parts = F.arrays_zip(F.transform("classes", lambda c: c["k"]).alias("k"), F.transform("e", lambda x: x / F.col("total")).alias("p"))
    scored = held.select("hh", "hv", F.explode(parts).alias("part")).select("hh", "hv", F.col("part.k").alias(key), F.col("part.p").alias("p"))
    n = F.sum("p")
    mean = lambda x: F.sum(F.col("p") * x) / n
    hh, hv = F.col("hh"), F.col("hv")
    return _gaussian(scored.groupBy(key).agg(n.alias("n"), mean(hh).alias("mu1"), mean(hv).alias("mu2"), mean(hh * hh).alias("c11"), mean(hh * hv).alias("c12"), mean(hv * hv).alias("c22")), key)


def em(pixels: DataFrame, start: DataFrame, rounds: int = 20, tolerance: float = 1e-4, key: str = "k") -> DataFrame:
    """Class parameters by repeated steps, until the means hardly move; parameters are a row a class and are carried as literals."""
    spark, gmm, before = pixels.sparkSession, start, None
    for _ in range(rounds):
        rows = em_step(pixels, gmm, key).collect()  # a row a class
        gmm = spark.createDataFrame(rows)
        means = {r[key]: (r["mu1"], r["mu2"]) for r in rows}
        if before and all(abs(means[c][i] - before.get(c, (1e9, 1e9))[i]) <= tolerance for c in means for i in (0, 1)):
            break
        before = means
    return gmm


def _least(energy_of) -> Column:
    """The class of least energy, the smallest on ties."""
    return F.array_min(F.transform("classes", lambda c: F.struct(energy_of(c).alias("u"), c["k"].alias("k"))))["k"]


def assign_pixels(pixels: DataFrame, gmm: DataFrame, key: str = "k", image: list[str] | None = None) -> DataFrame:
    """row, col, class of largest likelihood of each pixel, after the image's columns; each row is judged on its own."""
    best = _least(lambda c: F.log(c["cov_det"]) - F.log(c["prior"]) + 0.5 * _distance(c))
    return _with_classes(pixels, gmm, key).select(*(image or []), "row", "col", best.alias("class"))


def mrf_sweep(pixels: DataFrame, gmm: DataFrame, beta: float, parity: int, key: str = "k", image: list[str] | None = None) -> DataFrame:
    """One conditional-mode sweep over the pixels of one colour of a 2 x 2 colouring; others keep their class.

    No two pixels of a colour are neighbours, so all of them may change at once without the energy rising.
    """
    place = [*(image or []), "row", "col"]
    near = neighbours(pixels, key, image=image).groupBy(*place).agg(F.collect_list("other").alias("around"))  # eight at most
    same = lambda c: F.size(F.filter(F.coalesce("around", F.array().cast("array<int>")), lambda o: o == c["k"]))
    best = _least(lambda c: F.round(F.log(c["cov_det"]) + 0.5 * _distance(c) - beta * same(c), 9))
    turn = (F.col("row") % 2 * 2 + F.col("col") % 2) == parity
    held = _with_classes(pixels.join(near, place, "left"), gmm, key)
    return held.withColumn(key, F.when(turn, best).otherwise(F.col(key))).drop("around", "classes")


def segment_statistics(pixels: DataFrame, key: str = "k") -> DataFrame:
    """Mean, population covariance and pixel count of each class."""
    return pixels.where(F.col(key) >= 0).groupBy(key).agg(
        F.count("*").alias("n"), F.avg("hh").alias("mu1"), F.avg("hv").alias("mu2"), F.var_pop("hh").alias("v11"), F.covar_pop("hh", "hv").alias("v12"), F.var_pop("hv").alias("v22")
    )


def gauss_transform(points: DataFrame, features: list[str], value: str, reach: float = REACH) -> DataFrame:
    """Gauss transform: each point's sum of values weighted by exp(-distance squared / 2).

    Points meet those of their own and the adjoining cells of side `reach` by an equality join; what lies
    farther would add less than exp(-reach**2 / 2) of its value.
    """
    cell = [F.floor(F.col(f) / reach).alias(f"{f}_cell") for f in features]
    other = points.select(*[F.col(f).alias(f"{f}_j") for f in features], F.col(value).alias("w"), *cell)
    for f in features:
        other = other.withColumn(f"{f}_cell", F.explode(F.array(*[F.col(f"{f}_cell") + d for d in (-1, 0, 1)])))
    distance = sum(F.pow(F.col(f) - F.col(f"{f}_j"), 2) for f in features)
    near = points.select("id", *features, *cell).join(other, [f"{f}_cell" for f in features])
    return near.groupBy("id").agg(F.sum(F.col("w") * F.exp(-0.5 * distance)).alias("g"))
