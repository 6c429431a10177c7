"""Masked statistics that merge: partial sums, their union, and the figures made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.functions.radiometry import finite
from rasterloom.operators.graphs import cut

SKETCH = 10_000
BROADCAST_KEYS = 10_000


def channels(frame: DataFrame, bands: dict[str, str], keys: list[str]) -> DataFrame:
    """One row for each band of each row: keys, channel, x (double)."""
    pairs = ", ".join(f"'{name}', cast({column} as double)" for name, column in bands.items())
    return frame.selectExpr(*keys, f"stack({len(bands)}, {pairs}) as (channel, x)")


def partial_stats(frame: DataFrame, keys: list[str], x: str = "x") -> DataFrame:
    """n, sum, sum_sq, min, max of the finite values."""
    v = finite(F.col(x))
    return frame.groupBy(*keys).agg(F.count(v).alias("n"), F.sum(v).alias("sum"), F.sum(v * v).alias("sum_sq"), F.min(v).alias("min"), F.max(v).alias("max"))


def merge_stats(partials: DataFrame, keys: list[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("sum_sq").alias("sum_sq"), F.min("min").alias("min"), F.max("max").alias("max")
    )


def finalize(partials: DataFrame) -> DataFrame:
    """Adds mean and population std; both null where there is no value."""
    mean = F.try_divide(F.col("sum"), F.col("n"))
    std = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("sum_sq"), F.col("n")) - mean * mean))
    return partials.withColumns({"mean": mean, "std": F.when(F.col("n") > 0, std)})


def exact_percentiles(frame: DataFrame, keys: list[str], x: str, places: tuple[float, ...]) -> DataFrame:
    """keys and p, an array of the percentiles at the places with linear interpolation.

    A sketch first brackets each percentile: its bounds are `SKETCH` exact, and taken three times as
    far apart.  A second pass counts the values below each bracket and the distinct values in it, so that
    exact ranks need a sort of less than a thousandth of the rows, without repeats, and no task holds a key.
    """
    rows = frame.where(finite(F.col(x)).isNotNull()).select(*keys, F.col(x).alias("_x"))
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
    own = keys or ["_all"]
    ends = [min(1.0, max(0.0, p + d * 3 / SKETCH)) for p in places for d in (-1, 1)]
    sketch = rows.groupBy(*own).agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.percentile_approx("_x", ends, SKETCH).alias("_q"))
    few = F.col("_n") <= 10 * SKETCH  # a bracket is then a few ranks wide: the whole range is small enough
    bracket = lambda i, p: F.struct(
        F.lit(i).alias("i"), (F.lit(p) * (F.col("_n") - 1) + 1).alias("rank"),
        F.when(few | F.lit(ends[2 * i] == 0.0), F.col("_lo")).otherwise(F.col("_q")[2 * i]).alias("lo"),
        F.when(few | F.lit(ends[2 * i + 1] == 1.0), F.col("_hi")).otherwise(F.col("_q")[2 * i + 1]).alias("hi"),
    )
    brackets = cut(sketch.select(*own, F.array(*[bracket(i, p) for i, p in enumerate(places)]).alias("_b")))
    brackets = F.broadcast(brackets) if brackets.count() <= BROADCAST_KEYS else brackets
    # One row a key and value or, below a bracket, one count: repeats meet before the shuffle.
    met = rows.join(brackets, own).select(*own, "_x", F.explode(F.filter("_b", lambda b: F.col("_x") <= b["hi"])).alias("b"))
    place = F.when(F.col("_x") >= F.col("b.lo"), F.col("_x"))  # null: below
    counts = met.groupBy(*own, "b.i", "b.rank", place.alias("_v")).agg(F.count("*").alias("c"))
    run = W.partitionBy(*own, "i").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.withColumn("_r", F.sum("c").over(run)).where("_v is not null")
    low = F.min(F.when(F.col("_r") >= F.floor("rank"), F.col("_v")))
    high = F.min(F.when(F.col("_r") >= F.ceil("rank"), F.col("_v")))
    found = ranked.groupBy(*own, "i").agg((low + (high - low) * (F.max("rank") - F.floor(F.max("rank")))).alias("v"))
    out = found.groupBy(*own).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("p"))  # one row a place
    return out.select(*keys, "p")


def beside(a: DataFrame, b: DataFrame) -> DataFrame:
    """The columns of two frames of one row, as one row."""
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])


# Names of the months in reports.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def document(figures: DataFrame, months: DataFrame) -> DataFrame:
    """The report, one row with one struct: a map of spacings to figures for each channel, and the months' counts by name.

    figures: channel, spacing, mean, std, min, max; months: month, n.  Both are a few rows.
    """
    entry = F.struct(F.col("spacing").cast("string").alias("key"), F.struct("mean", "std", "min", "max").alias("value"))
    channels = figures.groupBy("channel").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stats"))
    by_name = lambda a, b: F.when(a["channel"] < b["channel"], -1).when(a["channel"] > b["channel"], 1).otherwise(0)
    channels = channels.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "stats")), by_name)).alias("channels"))
    counts = [F.coalesce(F.sum(F.when(F.col("month") == i + 1, F.col("n"))), F.lit(0)).alias(name) for i, name in enumerate(MONTHS)]
    return beside(channels, months.agg(F.struct(*counts).alias("acquisition_month_histogram")))


def month_histogram(frame: DataFrame, ts: Column) -> DataFrame:
    """month 1..12, n; months without rows count 0, null times are skipped."""
    months = frame.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    found = frame.where(ts.isNotNull()).groupBy(F.month(ts).alias("month")).count()
    return months.join(found, "month", "left").select("month", F.coalesce("count", F.lit(0)).alias("n"))


def histogram(frame: DataFrame, keys: list[str], value: Column, bins: int, low: float, high: float) -> DataFrame:
    """bin, n over [low, high); values beyond go to the end bins, null and NaN are skipped."""
    place = F.floor((value - low) / (high - low) * bins).cast("int")
    clamped = F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))
    return frame.where(finite(value).isNotNull()).groupBy(*keys, clamped.alias("bin")).agg(F.count("*").alias("n"))


def otsu(counts: DataFrame) -> DataFrame:
    """threshold, variance: the level with the largest variance between classes, the first on ties; counts (g, n) has a row a level."""
    run, whole = W.orderBy("g").rowsBetween(W.unboundedPreceding, 0), W.partitionBy()
    mass = F.col("n") * F.col("g")
    sums = counts.select("g", F.sum("n").over(run).alias("w"), F.sum(mass).over(run).alias("s"), F.sum("n").over(whole).alias("t"), F.sum(mass).over(whole).alias("a"))
    part = F.col("w") / F.col("t")
    gap = F.col("s") / F.col("w") - F.try_divide(F.col("a") - F.col("s"), F.col("t") - F.col("w"))
    out = sums.select(F.col("g").alias("threshold"), (part * (1 - part) * gap * gap).alias("variance")).where("variance is not null")
    return out.orderBy(F.desc(F.round("variance", 6)), "threshold").limit(1)


def otsu_classes(pixels: DataFrame, masked: Column) -> DataFrame:
    """row, col, class of pixels (g): 2 above the threshold of the unmasked ones, 1 up to it, -2 where masked; 1 if all have one level."""
    counts = pixels.where(~masked).groupBy("g").agg(F.count("*").alias("n"))
    held = pixels.crossJoin(F.broadcast(otsu(counts).agg(F.max("threshold").alias("threshold"))))  # one row
    return held.select("row", "col", F.when(masked, -2).when(F.col("g") > F.col("threshold"), 2).otherwise(1).alias("class"))
