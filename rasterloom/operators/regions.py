"""Region adjacency: statistics of labelled regions, their boundaries, and merging, on plain tables.

Pixels carry a region id, -2 on boundaries.  Regions are one row each, edges one row for
each pair a < b.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions import energy
from rasterloom.operators.graphs import connected_components, cut
from rasterloom.operators.raster import NEIGHBOURS8, neighbours

BOUNDARY = -2


def region_stats(pixels: DataFrame, image: list[str] | None = None) -> DataFrame:
    """region, n, means and co-means of hh and hv, centroid and bounding box; boundary pixels are left out."""
    hh, hv = F.col("hh"), F.col("hv")
    return pixels.where("region >= 0").groupBy(*(image or []), "region").agg(
        F.count("*").alias("n"), F.avg(hh).alias("m1"), F.avg(hv).alias("m2"), F.avg(hh * hh).alias("c11"), F.avg(hh * hv).alias("c12"), F.avg(hv * hv).alias("c22"),
        F.avg("col").alias("cx"), F.avg("row").alias("cy"), F.min("row").alias("top"), F.max("row").alias("bottom"), F.min("col").alias("left"), F.max("col").alias("right"),
    )


def border_regions(pixels: DataFrame, height: int, width: int, masked: Column, image: list[str] | None = None) -> DataFrame:
    """Regions with a pixel at the image edge or next to a masked pixel."""
    image = image or []
    own = pixels.where("region >= 0")
    edge = own.where((F.col("row") == 0) | (F.col("col") == 0) | (F.col("row") == height - 1) | (F.col("col") == width - 1)).select(*image, "region")
    near = neighbours(pixels.withColumn("masked", masked).withColumn("pair", F.struct("region", "masked")), "pair", image=image)
    return edge.unionByName(near.where("other.masked and pair.region >= 0").select(*image, "pair.region")).distinct()


def boundary_sites(pixels: DataFrame, image: list[str] | None = None) -> DataFrame:
    """row, col, a, b of each boundary pixel with two regions: the first two distinct labels clockwise from west, a < b."""
    image = image or []
    near = neighbours(pixels, "region", NEIGHBOURS8, image).where((F.col("region") < 0) & (F.col("other") >= 0))
    labels = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("nbr", "other"))), lambda p: p["other"]))  # eight at most
    sites = near.groupBy(*image, "row", "col").agg(labels.alias("labels")).where(F.size("labels") >= 2)
    x, y = F.get("labels", F.lit(0)), F.get("labels", F.lit(1))
    return sites.select(*image, "row", "col", F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def adjacency(sites: DataFrame, image: list[str] | None = None) -> DataFrame:
    """a, b, length of each boundary."""
    return sites.groupBy(*(image or []), "a", "b").agg(F.count("*").alias("length"))


def boundary_ratio(edges: DataFrame, classes: DataFrame, pixels: DataFrame) -> DataFrame:
    """Length of the boundaries between different classes over the number of pixels, one row."""
    named = with_ends(edges, classes.select("region", "class"), ["class"])
    unlike = named.agg(F.sum(F.when(F.col("class_a") != F.col("class_b"), F.col("length")).otherwise(0)).alias("unlike"))
    return unlike.crossJoin(pixels.agg(F.count("*").alias("n"))).select((F.col("unlike") / F.col("n")).alias("ratio"))  # one row each


def with_ends(edges: DataFrame, regions: DataFrame, columns: list[str]) -> DataFrame:
    """edges with the columns of both ends, suffixed _a and _b."""
    one = lambda s: regions.select(F.col("region").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    return edges.join(one("a"), "a").join(one("b"), "b")


def edge_strengths(sites: DataFrame, strength: DataFrame, bins: int = 256, image: list[str] | None = None) -> DataFrame:
    """bin, share of the boundary pixels by strength, in bins up to the largest."""
    rows = sites.join(strength, [*(image or []), "row", "col"])
    top = rows.agg(F.max("g").alias("top"), F.count("*").alias("total"))
    place = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("g"), F.col("top") / bins)).cast("int"))
    return rows.crossJoin(F.broadcast(top)).groupBy(place.alias("bin")).agg((F.count("*") / F.first("total")).alias("share"), F.first("top").alias("top"))


def schedule(histogram: DataFrame, iteration: int, bins: int = 256) -> DataFrame:
    """k: the centre of the bin in which the cumulative share exceeds the iteration's part, one row."""
    run = W.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    cum = histogram.withColumn("cum", F.sum("share").over(run))
    first = F.min(F.when(F.col("cum") > iteration * energy.SCHEDULE_STEP, F.col("bin")))
    return cum.agg(first.alias("bin"), F.max("top").alias("top")).select(F.coalesce((F.col("bin") + 0.5) * F.col("top") / bins, F.col("top")).alias("k"))


def edge_penalties(sites: DataFrame, strength: DataFrame, k: Column, beta: Column, image: list[str] | None = None) -> DataFrame:
    """a, b, length, penalty: beta times the sum of the sites' penalties, the same in whatever order the sites come."""
    rows = sites.join(strength, [*(image or []), "row", "col"])
    return rows.groupBy(*(image or []), "a", "b").agg(F.count("*").alias("length"), (_sum(energy.site_penalty(F.col("g"), k)) * beta).alias("penalty"))


def _sum(v: Column) -> Column:
    """Sum of numbers up to 1, as multiples of 2**-32 and rests as multiples of 2**-64: both sums are exact for up to two million
    rows, so equal boundaries get equal sums and their order decides, as it does in the SQL, not the order of a shuffle."""
    high = F.rint(v * 2.0**32) / 2.0**32
    return F.sum(high) + F.sum(F.rint((v - high) * 2.0**64) / 2.0**64)


MOMENTS = ["n", "m1", "m2", "c11", "c12", "c22"]


def _spread(n, m1, m2, c11, c12, c22):
    return energy.log_spread(n, energy.det2(c11 - m1 * m1, c12 - m1 * m2, c22 - m2 * m2))


def region_difference(edges: DataFrame, regions: DataFrame) -> DataFrame:
    """edges with region_diff: energy of the two regions merged less their own."""
    ends = with_ends(edges, regions, MOMENTS)
    n = F.col("n_a") + F.col("n_b")
    mean = lambda c: (F.col(f"{c}_a") * F.col("n_a") + F.col(f"{c}_b") * F.col("n_b")) / n
    own = lambda s: _spread(*[F.col(f"{c}_{s}") for c in MOMENTS])
    return ends.select(*edges.columns, (_spread(n, *[mean(c) for c in MOMENTS[1:]]) - own("a") - own("b")).alias("region_diff"))


def edge_weights(edges: DataFrame, active: Column) -> DataFrame:
    """edges (with region_diff and penalty) with weight; inactive edges never merge."""
    return edges.withColumn("weight", F.when(active, F.col("region_diff") - F.col("penalty")).otherwise(F.lit(energy.INACTIVE)))


def best_merges(edges: DataFrame) -> DataFrame:
    """A set of independent merges: edges of negative weight that are the smallest at both ends.

    Both ends come from one row: sums of floats differ in their last bits where a plan computes them twice,
    and an edge would not meet itself.
    """
    both = edges.where("weight < 0").select("a", "b", "weight")
    ends = both.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "weight")
    least = ends.groupBy("node").agg(F.min(F.struct("weight", "a", "b")).alias("e"))
    return least.groupBy("e.a", "e.b").agg(F.count("*").alias("count"), F.min("e.weight").alias("weight")).where("count = 2").select("a", "b", "weight")


def merge_regions(regions: DataFrame, merges: DataFrame) -> DataFrame:
    """Count-weighted moments after b joins a."""
    named = regions.join(merges.select(F.col("b").alias("region"), F.col("a").alias("into")), "region", "left")
    n = F.sum("n")
    means = [(F.sum(F.col(c) * F.col("n")) / n).alias(c) for c in MOMENTS[1:]]
    return named.groupBy(F.coalesce("into", "region").alias("region")).agg(n.alias("n"), *means)


def contract(edges: DataFrame, merges: DataFrame) -> DataFrame:
    """Edges after the merges: ends renamed, inner edges gone, parallel ones added up.

    Both ends are looked up in one join: merges that are computed twice may choose otherwise between equal weights.
    """
    ends = edges.select("a", "b", "length", "penalty", F.posexplode(F.array("a", "b")).alias("end", "node"))
    named = ends.join(merges.select(F.col("b").alias("node"), F.col("a").alias("into")), "node", "left").withColumn("into", F.coalesce("into", "node"))
    of = lambda end, c: F.when(F.col("end") == end, F.col(c))
    whole = named.groupBy("a", "b").agg(F.max(of(0, "into")).alias("x"), F.max(of(1, "into")).alias("y"), F.sum(of(0, "length")).alias("length"), F.sum(of(0, "penalty")).alias("penalty"))
    moved = whole.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "length", "penalty").where("a <> b")
    return moved.groupBy("a", "b").agg(F.sum("length").alias("length"), F.sum("penalty").alias("penalty"))


def merge_lut(old: DataFrame, new: DataFrame, image: list[str] | None = None) -> DataFrame:
    """old, new: the new label of each old region, by its last pixel in raster order."""
    place = [*(image or []), "row", "col"]
    pixels = old.select(*place, F.col("region").alias("old")).join(new.select(*place, F.col("region").alias("new")), place)
    return pixels.where("old >= 0 and new >= 0").groupBy(*(image or []), "old").agg(F.max_by("new", F.struct("row", "col")).alias("new"))


def relabel(pixels: DataFrame, label: str = "region", image: list[str] | None = None) -> DataFrame:
    """Consecutive labels 0, 1, ... in label order within an image; negative ones stay.  Ranks are taken over distinct labels only."""
    image = image or []
    names = pixels.where(F.col(label) >= 0).select(*image, label).distinct()
    names = names.withColumn("new", F.row_number().over(W.partitionBy(*image).orderBy(label)) - 1)
    return pixels.join(names, [*image, label], "left").withColumn("new", F.coalesce("new", F.col(label)))


def sort_by_mean(regions: DataFrame, image: list[str] | None = None) -> DataFrame:
    """region, place: an image's regions in order of their first mean."""
    image = image or []
    return regions.select(*image, "region", (F.row_number().over(W.partitionBy(*image).orderBy("m1", "region")) - 1).alias("place"))


def components(pixels: DataFrame, label: str, connect4: bool = False, image: list[str] | None = None) -> DataFrame:
    """row, col, component: connected pixels of equal label, named by their first pixel in raster order.

    Runs along rows are found first by a window, so only runs take part in the
    contraction of the pairs that touch from row to row.  In several images the runs are numbered
    by image, row and column, and a component's first run gives it its name within the image.
    """
    image = image or []
    line = W.partitionBy(*image, "row").orderBy("col")
    fresh = (F.lag(label).over(line).isNull()) | (F.lag(label).over(line) != F.col(label)) | (F.lag("col").over(line) != F.col("col") - 1)
    place = F.col("row").cast("long") * (1 << 31) + F.col("col")
    runs = pixels.where(F.col(label) >= 0).withColumn("start", F.when(fresh, place)).withColumn("run", F.max("start").over(line.rowsBetween(W.unboundedPreceding, 0)))
    runs = runs.select(*image, "row", "col", label, "run")
    if image:  # numbers that are unique over all images and rise with the run within each
        heads = runs.where(F.col("run") == F.col("row").cast("long") * (1 << 31) + F.col("col")).select(*image, "run").repartitionByRange(*image, "run").sortWithinPartitions(*image, "run")
        heads = cut(heads.withColumn("number", F.monotonically_increasing_id()))
        runs = runs.withColumnRenamed("run", "start").join(heads.withColumnRenamed("run", "start"), [*image, "start"]).withColumnRenamed("number", "run")
    near = neighbours(runs.withColumn("v", F.struct(label, "run")), "v", ((-1, 0),) if connect4 else ((-1, -1), (-1, 0), (-1, 1)), image)
    edges = near.where(F.col(f"v.{label}") == F.col(f"other.{label}")).select(F.col("v.run").alias("a"), F.col("other.run").alias("b"))
    found = connected_components(edges)
    named = runs.join(found.withColumnRenamed("node", "run"), "run", "left").withColumn("component", F.coalesce("component", "run"))
    if not image:
        return named.select("row", "col", "component")
    first = heads.select(F.col("number").alias("component"), F.col("run").alias("name"))
    return named.join(first, "component").select(*image, "row", "col", F.col("name").alias("component"))


def fill_boundaries(pixels: DataFrame, means: DataFrame, label: str = "k", image: list[str] | None = None) -> DataFrame:
    """Boundary pixels get a neighbour's class: the only one, or of several the one of nearest mean; all at once, from the old map."""
    place = [*(image or []), "row", "col"]
    held = pixels.withColumn("v", F.struct(label, "hh", "hv"))
    near = neighbours(held, "v", image=image).where(f"v.{label} < 0 and other.{label} >= 0").select(*place, "v.hh", "v.hv", F.col(f"other.{label}").alias("c")).distinct()
    scored = near.join(F.broadcast(means.select(F.col(label).alias("c"), "m1", "m2")), "c")  # a row a class
    distance = F.pow(F.col("hh") - F.col("m1"), 2) + F.pow(F.col("hv") - F.col("m2"), 2)
    best = scored.groupBy(*place).agg(F.min_by("c", F.struct(distance, "c")).alias("filled"))
    return pixels.join(best, place, "left").withColumn("filled", F.when(F.col(label) >= 0, F.col(label)).otherwise(F.coalesce("filled", F.col(label))))


def boundary_flags(pixels: DataFrame, label: str = "k", image: list[str] | None = None) -> DataFrame:
    """For each pixel: unlike (a neighbour of another label), candidates (the classes of its neighbours, smallest first),
    two_regions (two or more labels around it) and inner (the same over the four nearest)."""
    place = [*(image or []), "row", "col"]
    near = neighbours(pixels, label, image=image)
    straight = F.col("nbr").isin(0, 2, 4, 6)
    valid = F.col("other") >= 0
    found = near.groupBy(*place).agg(
        F.max(F.col(label) != F.col("other")).alias("unlike"),
        F.array_sort(F.collect_set(F.when(valid, F.col("other")))).alias("candidates"),
        (F.count_distinct(F.when(valid, F.col("other"))) >= 2).alias("two_regions"),
        (F.count_distinct(F.when(valid & straight, F.col("other"))) >= 2).alias("inner"),
    )
    return pixels.select(*place).join(found, place, "left")


def class_map_ratio(pixels: DataFrame, label: str = "k", image: list[str] | None = None) -> DataFrame:
    """Boundary pixels (label < 0) that touch two or more classes, over all pixels, one row."""
    place = [*(image or []), "row", "col"]
    flags = boundary_flags(pixels, label, image).join(pixels.select(*place, label), place)
    return flags.agg((F.count_if((F.col(label) < 0) & F.col("two_regions")) / F.count("*")).alias("ratio"))


def label_counts(pixels: DataFrame, label: str) -> DataFrame:
    """max_label (-1 without any) and n_positive (distinct labels above 0), one row."""
    return pixels.agg(F.greatest(F.coalesce(F.max(label), F.lit(-1)), F.lit(-1)).alias("max_label"), F.count_distinct(F.when(F.col(label) > 0, F.col(label))).alias("n_positive"))


def shape_matches(labels: DataFrame, scenes: DataFrame) -> DataFrame:
    """scene, matches: whether the label image has the scene's n_rows and n_cols."""
    found = labels.groupBy("scene").agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w"))
    return scenes.join(found, "scene", "left").select("scene", F.coalesce((F.col("h") == F.col("n_rows")) & (F.col("w") == F.col("n_cols")), F.lit(False)).alias("matches"))


def difference(a: DataFrame, b: DataFrame, value: str, image: list[str] | None = None) -> DataFrame:
    """n pixels that differ or exist in one image only, one row; 0 for equal images."""
    place = [*(image or []), "row", "col"]
    both = a.select(*place, F.col(value).alias("x"), F.lit(1).alias("in_a")).join(b.select(*place, F.col(value).alias("y"), F.lit(1).alias("in_b")), place, "full")
    return both.agg(F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull() | ~F.col("x").eqNullSafe(F.col("y"))).alias("n"))


def skip_small(edges: DataFrame, regions: DataFrame, least: float = 0.005) -> DataFrame:
    """edges with refresh: false where the neighbour b is so small against a that a merge leaves the weight as it is."""
    ends = with_ends(edges, regions, ["n"])
    return ends.withColumn("refresh", F.col("n_b") / F.col("n_a") > least).drop("n_a", "n_b")


def same_class_regions(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """region, component: regions connected through boundaries between equal classes; edges a, b, classes region, class."""
    active = with_ends(edges, classes, ["class"]).where("class_a = class_b").select("a", "b")
    found = connected_components(active)
    named = classes.select("region").join(found.withColumnRenamed("node", "region"), "region", "left")
    return named.select("region", F.coalesce("component", F.col("region").cast("long")).alias("component"))


def cliques3(edges: DataFrame) -> DataFrame:
    """a, b, c: triples of mutually adjacent regions, a < b < c, by two equality joins."""
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = e.select(F.col("a").alias("b"), F.col("b").alias("c"))
    third = e.select("a", F.col("b").alias("c"))
    return e.join(second, "b").join(third, ["a", "c"], "left_semi").select("a", "b", "c")


def clique_graph(cliques: DataFrame) -> DataFrame:
    """x, y, shared: pairs of cliques that share regions, and how many; cliques a, b, c with id."""
    members = cliques.select("id", F.explode(F.array("a", "b", "c")).alias("region"))
    other = members.select(F.col("id").alias("y"), "region")
    return members.withColumnRenamed("id", "x").join(other, "region").where("x < y").groupBy("x", "y").agg(F.count("*").alias("shared"))
