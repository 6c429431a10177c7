"""Grey-level co-occurrence measures per window, from pairs found by an equality join on shifted keys."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECTIONS = ((0, 1), (-1, 1), (-1, 0), (-1, -1))  # 0, 45, 90 and 135 degrees


def quantise(pixels: DataFrame, levels: int, top: int = 256) -> DataFrame:
    return pixels.withColumn("g", F.floor(F.col("g") * levels / top).cast("int"))


def pairs(pixels: DataFrame, window: list[str], distance: int = 1, directions=DIRECTIONS) -> DataFrame:
    """window, i, j of the pairs of grey levels at the distance, both pixels inside the window."""
    moves = F.array(*[F.struct(F.lit(r * distance).alias("r"), F.lit(c * distance).alias("c")) for r, c in directions])
    sent = pixels.select(*window, "row", "col", F.col("g").alias("j"), F.explode(moves).alias("m"))
    sent = sent.select(*window, (F.col("row") - F.col("m.r")).alias("row"), (F.col("col") - F.col("m.c")).alias("col"), "j")
    return pixels.select(*window, "row", "col", F.col("g").alias("i")).join(sent, [*window, "row", "col"]).select(*window, "i", "j")


def measures(found: DataFrame, window: list[str]) -> DataFrame:
    """ASM, ENT, CON, DIS, HOM, INV, MU, STD and COR of each window; the matrix is the symmetric one."""
    i, j = F.col("i").cast("double"), F.col("j").cast("double")
    d = i - j
    sums = found.groupBy(*window).agg(
        F.count("*").alias("n"), F.sum(d * d).alias("con"), F.sum(F.abs(d)).alias("dis"), F.sum(1 / (1 + d * d)).alias("hom"), F.sum(1 / (1 + F.abs(d))).alias("inv"),
        F.sum(i + j).alias("s"), F.sum(i * i + j * j).alias("q"), F.sum(i * j).alias("x"),
    )
    both = found.select(*window, "i", "j").unionByName(found.select(*window, F.col("j").alias("i"), F.col("i").alias("j")))
    cells = both.groupBy(*window, "i", "j").agg(F.count("*").alias("c"))
    cells = cells.join(sums.select(*window, "n"), window).withColumn("p", F.col("c") / (2 * F.col("n")))
    shape = cells.groupBy(*window).agg(F.sum(F.col("p") * F.col("p")).alias("asm"), (-F.sum(F.col("p") * F.log("p"))).alias("ent"))
    n, mu = F.col("n"), F.col("s") / (2 * F.col("n"))
    var = F.greatest(F.lit(0.0), F.col("q") / (2 * n) - mu * mu)
    cor = F.when(F.sqrt(var) <= 1e-12, 1.0).otherwise(F.try_divide(F.col("x") / n - mu * mu, var))
    return sums.join(shape, window).select(
        *window, "asm", "ent", (F.col("con") / n).alias("con"), (F.col("dis") / n).alias("dis"), (F.col("hom") / n).alias("hom"), (F.col("inv") / n).alias("inv"),
        mu.alias("mu"), F.sqrt(var).alias("std"), cor.alias("cor"),
    )


def bounds(levels: int, pairs: int) -> dict[str, tuple[float, float]]:
    """Theoretical range of each measure for a window of `pairs` pairs: used to bring it to 0..1.

    The range of std is that of the variance.
    """
    top = levels - 1
    cells = min(2 * pairs, levels * levels)
    return {
        "asm": (1 / cells, 1.0), "ent": (0.0, math.log(cells)), "con": (0.0, top * top), "dis": (0.0, top), "hom": (1 / (1 + top * top), 1.0), "inv": (1 / (1 + top), 1.0),
        "mu": (0.0, top), "std": (0.0, top * top / 4), "cor": (-1.0, 1.0),
    }


def normalised(found: DataFrame, window: list[str], levels: int, pairs: int) -> DataFrame:
    """Measures brought to 0..1 by their theoretical bounds."""
    return found.select(*window, *[((F.col(c) - lo) / (hi - lo)).alias(c) for c, (lo, hi) in bounds(levels, pairs).items()])
