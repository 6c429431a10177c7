"""Class histograms of scenes and the balanced split into training and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.operators.stats import beside

# Annotation colours and class names.
CLASSES = ("WATER", "ICE", "SHOALS", "SHIP", "ICEBERG", "UNKNOWN")
COLOURS = ((0, 0, 128), (128, 0, 0), (0, 255, 0), (255, 255, 0), (255, 0, 255), (150, 150, 150))
INVALID = 255


def colour_class(red, green, blue, classes: int = len(COLOURS)):
    """Class of an exact colour; 255 for any other."""
    out = F.lit(INVALID)
    for i in reversed(range(classes)):
        r, g, b = COLOURS[i]
        out = F.when((red == r) & (green == g) & (blue == b), i).otherwise(out)
    return out.cast("smallint")


def class_counts(pixels: DataFrame, scene: str = "scene", label: str = "label") -> DataFrame:
    """scene, label, n of the valid pixels."""
    return pixels.where(F.col(label).between(0, len(CLASSES) - 1)).groupBy(scene, label).agg(F.count("*").alias("n"))


def dense_counts(scenes: DataFrame, counts: DataFrame) -> DataFrame:
    """One row for each scene and class, 0 where a scene has none of a class."""
    grid = scenes.select("scene").distinct().withColumn("label", F.explode(F.array(*[F.lit(i) for i in range(len(CLASSES))])))
    return grid.join(counts, ["scene", "label"], "left").select("scene", "label", F.coalesce("n", F.lit(0)).alias("n"))


def percentages(counts: DataFrame) -> DataFrame:
    """label, pixels, pixel_percentage, scenes (that have the class)."""
    per = counts.groupBy("label").agg(F.sum("n").alias("pixels"), F.count_if(F.col("n") > 0).alias("scenes"))
    total = F.sum("pixels").over(W.partitionBy())
    return per.withColumn("pixel_percentage", F.when(total > 0, 100.0 * F.col("pixels") / total).otherwise(0.0))


def balance(water, ice):
    """Distance from an even mix; 1 without either class."""
    return F.when(water + ice > 0, F.abs(water / (water + ice) - 0.5)).otherwise(1.0)


def split(scenes: DataFrame, percentage: int) -> DataFrame:
    """scenes (id, water, ice) with split, `train` or `val`.

    Training gets max(1, n * percentage // 100) scenes, at most n - 1.  Validation starts from the
    best balanced scene that has both classes, or else the first water and the first ice scene,
    and is filled by descending imbalance.  The scene table is a row a scene, so its order may be global.
    """
    both = (F.col("water") > 0) & (F.col("ice") > 0)
    scored = scenes.withColumn("score", balance(F.col("water"), F.col("ice")))
    seeds = scored.agg(
        F.count("*").alias("n"),
        F.min(F.when(both, F.struct("score", "id"))).alias("best"),
        F.min(F.when(F.col("water") > 0, F.col("id"))).alias("first_water"),
        F.min(F.when(F.col("ice") > 0, F.col("id"))).alias("first_ice"),
    )
    rank = (
        F.when(F.col("best").isNotNull(), F.when(F.col("id") == F.col("best.id"), 0).otherwise(2))
        .when(F.col("id") == F.col("first_water"), 0)
        .when(F.col("id") == F.col("first_ice"), 1)
        .otherwise(2)
    )
    place = F.row_number().over(W.orderBy("rank", F.desc("score"), "id"))
    train = F.greatest(F.lit(1), F.floor(F.col("n") * percentage / 100))
    train = F.when(F.col("n") > 1, F.least(train, F.col("n") - 1)).otherwise(train)
    ranked = scored.crossJoin(F.broadcast(seeds)).withColumn("rank", rank).withColumn("place", place)  # seeds is one row
    return ranked.select("id", "water", "ice", F.when(F.col("place") <= F.col("n") - train, "val").otherwise("train").alias("split"))


def split_document(parts: DataFrame, counts: DataFrame, percentage: int) -> DataFrame:
    """The split's report, one row: numbers of scenes, shares of all classes, scenes that have each class,
    shares of the two balanced classes in all parts, and the scenes of each part in id order (a name a scene).

    parts: id, water, ice, split; counts: scene, label, n (a row for each class of each scene).
    """
    names = F.create_map(*[x for i, c in enumerate(CLASSES) for x in (F.lit(i), F.lit(c))])
    shares = percentages(counts).withColumn("name", names[F.col("label")])
    by_name = lambda c: F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("label", "name", F.col(c).alias("x")))), lambda s: F.struct(s["name"], s["x"])))
    classes = shares.agg(by_name("pixel_percentage").alias("total_pixel_percentages_all_classes"), by_name("scenes").alias("scene_counts_all_classes"))
    own = lambda k: F.lit(True) if k == "total" else F.col("split") == k
    sums = {k: (F.sum(F.when(own(k), F.col("water"))), F.sum(F.when(own(k), F.col("ice")))) for k in ("total", "train", "val")}
    part = lambda a, b: F.when(a + b > 0, 100.0 * a / (a + b)).otherwise(0.0)
    balanced = [F.struct(part(w, i).alias("WATER"), part(i, w).alias("ICE")).alias(f"{k}_pixel_percentages_balance_classes") for k, (w, i) in sums.items()]
    scenes = [F.array_sort(F.collect_list(F.when(F.col("split") == k, F.col("id").cast("string")))).alias(f"{k}_scenes") for k in ("train", "val")]
    split = parts.agg(
        F.count("*").alias("n_scenes"), F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_val"),
        F.lit(percentage).alias("train_percentage"), F.lit(100 - percentage).alias("val_percentage"), F.array(F.lit("WATER"), F.lit("ICE")).alias("balance_classes"),
        *balanced, *scenes,
    )
    return beside(split, classes)


def split_summary(parts: DataFrame) -> DataFrame:
    """Scenes and water and ice percentages of train, val and total."""
    sums = parts.rollup("split").agg(F.count("*").alias("scenes"), F.sum("water").alias("water"), F.sum("ice").alias("ice"))
    total = F.col("water") + F.col("ice")
    share = lambda c: F.when(total > 0, 100.0 * F.col(c) / total).otherwise(0.0)
    return sums.select(F.coalesce("split", F.lit("total")).alias("split"), "scenes", share("water").alias("water_percentage"), share("ice").alias("ice_percentage"))
