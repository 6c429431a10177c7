"""Stencils, resampling, tiling and padding of pixel tables (row, col, bands).

One-dimensional filters pad by mirrored copies of border pixels, then slide a window along each
row (or column): one shuffle for each direction, however long the filter.  Neighbour pairs come
from shifted keys and an equality join, never from a range join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Neighbours (row, column offset) clockwise from west.
NEIGHBOURS8 = ((0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1))
NEIGHBOURS4 = ((0, -1), (-1, 0), (0, 1), (1, 0))
DIE_OFF = 1e-4


def gaussian_width(sigma: float) -> int:
    width = next((i for i in range(31) if math.exp(-i * i / (2 * sigma * sigma)) < DIE_OFF), 31)
    return max(1, width - 1)


def gaussian_taps(sigma: float) -> list[float]:
    """Each tap is the mean of the Gaussian at t - 1/2, t and t + 1/2."""
    ss, width = 2 * sigma * sigma, gaussian_width(sigma)
    at = lambda t: sum(math.exp(-((t + d) ** 2) / ss) for d in (-0.5, 0, 0.5)) / (3 * math.sqrt(math.pi * ss))
    return [at(abs(t)) for t in range(-width, width + 1)]


def derivative_taps(sigma: float) -> list[float]:
    ss, width = sigma * sigma, gaussian_width(sigma)
    return [-t / ss * math.exp(-t * t / (2 * ss)) / (math.sqrt(2 * math.pi) * sigma) for t in range(-width, width + 1)]


def second_derivative_taps(sigma: float) -> list[float]:
    ss, width = sigma * sigma, gaussian_width(sigma)
    return [(t * t / ss - 1) * math.exp(-t * t / (2 * ss)) / (math.sqrt(2 * math.pi) * sigma * ss) for t in range(-width, width + 1)]


def mirror(index: Column, size: Column) -> Column:
    """Source index of an index up to one size beyond either end: the edge pixel is repeated."""
    return F.when(index < 0, -index - 1).when(index >= size, 2 * size - 1 - index).otherwise(index)


def padded(pixels: DataFrame, axis: str, size: int, margin: int, mode: str, bands: list[str], keys: list[str]) -> DataFrame:
    """pixels with `margin` more lines at both ends of the axis: zero, last (the edge line), cycle or mirror."""
    if mode == "mirror":
        return mirror_padded(pixels, axis, size, margin)
    x = F.col(axis)
    if mode == "cycle":
        return pixels.withColumn(axis, F.explode(F.filter(F.array(x, x - size, x + size), lambda p: (p >= -margin) & (p < size + margin))))
    low, high = F.sequence(F.lit(-margin), F.lit(-1)), F.sequence(F.lit(size), F.lit(size + margin - 1))
    edge = pixels.where((x == 0) | (x == size - 1))
    beyond = edge.withColumn(axis, F.explode(F.when((x == 0) & F.lit(size == 1), F.concat(low, high)).when(x == 0, low).otherwise(high)))
    if mode == "zero":
        beyond = beyond.withColumns({b: F.lit(0.0) for b in bands})
    elif mode != "last":
        raise ValueError(f"unknown padding {mode}")
    return pixels.select(*keys, axis, *bands).unionByName(beyond.select(*keys, axis, *bands))


def shifted(pixels: DataFrame, rows: int, cols: int, height: int, width: int) -> DataFrame:
    """pixels moved by (rows, cols); what leaves the image is dropped."""
    moved = pixels.withColumns({"row": F.col("row") + rows, "col": F.col("col") + cols})
    return moved.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))


def cropped(pixels: DataFrame, top: int, left: int, height: int, width: int) -> DataFrame:
    """The sub-area from (top, left), with its own coordinates."""
    return shifted(pixels, -top, -left, height, width)


SOBEL, PREWITT = ([0.5, 0.0, -0.5], [0.25, 0.5, 0.25]), ([3**-0.5, 0.0, -(3**-0.5)], [3**-0.5, 3**-0.5, 3**-0.5])


def separable_gradients(pixels: DataFrame, bands: list[str], taps: tuple[list[float], list[float]], height: int, width: int) -> DataFrame:
    """<band>_dx and <band>_dy by a derivative and a smoothing filter, such as SOBEL or PREWITT."""
    d, g = taps
    wide = pixels.select("*", *[F.col(b).alias(f"{b}_dx") for b in bands], *[F.col(b).alias(f"{b}_dy") for b in bands])
    along = {f"{b}_dx": d for b in bands} | {f"{b}_dy": g for b in bands}
    across = {f"{b}_dx": g for b in bands} | {f"{b}_dy": d for b in bands}
    return convolve(convolve(wide, along, "col", width, ["row"]), across, "row", height, ["col"])


def noise_window(features: int) -> int:
    """Side of the window for noise estimates: odd, at least 7."""
    side = int(math.sqrt(10 * features))
    return max(7, side + (side % 2 == 0))


def noise_variance(pixels: DataFrame, bands: list[str], height: int, width: int, bins: int = 256) -> DataFrame:
    """The mode of the local variances (one band) or of the determinants of the local covariances (two bands) over all whole windows, one row."""
    side = min(noise_window(len(bands)), height, width)
    reach = side - 1
    line = W.partitionBy("row").orderBy("col").rangeBetween(0, reach)
    column = W.partitionBy("col").orderBy("row").rangeBetween(0, reach)
    products = {f"s_{a}": F.col(a) for a in bands} | {f"s_{a}_{b}": F.col(a) * F.col(b) for i, a in enumerate(bands) for b in bands[i:]}
    sums = pixels.withColumns({k: F.sum(v).over(line) for k, v in products.items()}).withColumns({k: F.sum(k).over(column) for k in products})
    whole = sums.where((F.col("row") < height - reach) & (F.col("col") < width - reach))
    n = side * side
    cov = lambda a, b: F.col(f"s_{a}_{b}") / n - F.col(f"s_{a}") / n * F.col(f"s_{b}") / n
    value = cov(bands[0], bands[0]) if len(bands) == 1 else cov(bands[0], bands[0]) * cov(bands[1], bands[1]) - F.pow(cov(bands[0], bands[1]), 2)
    spread = whole.select(value.alias("v"))
    ends = spread.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    step = (F.col("high") - F.col("low")) / bins
    place = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("v") - F.col("low"), step)).cast("int"))
    counts = spread.crossJoin(F.broadcast(ends)).groupBy(F.coalesce(place, F.lit(0)).alias("bin")).agg(F.count("*").alias("n"), F.first("low").alias("low"), F.first(step).alias("step"))  # ends is one row
    return counts.orderBy(F.desc("n"), "bin").limit(1).select((F.col("low") + (F.col("bin") + 0.5) * F.col("step")).alias("noise"))


def mirror_padded(pixels: DataFrame, axis: str, size: Column | int, margin: int) -> DataFrame:
    """pixels with mirrored copies up to `margin` beyond both ends of the axis."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.filter(F.array(F.col(axis), -F.col(axis) - 1, 2 * size - 1 - F.col(axis)), lambda x: (x >= -margin) & (x < size + margin))
    return pixels.withColumn(axis, F.explode(places))


def convolve(pixels: DataFrame, bands: dict[str, list[float]], axis: str, size: Column | int, keys: list[str]) -> DataFrame:
    """Convolution of each band with its taps along `axis`; keys name the image and the other axis."""
    margin = max(len(t) for t in bands.values()) // 2
    limit = F.lit(size) if isinstance(size, int) else size
    line = W.partitionBy(*keys).orderBy(axis)

    def filtered(band: str, taps: list[float]) -> Column:
        half, out = len(taps) // 2, F.lit(0.0)
        for i, tap in enumerate(taps):
            out = out + tap * F.lag(band, i - half).over(line)  # out(x) = sum of tap(i) * in(x - i)
        return out

    padded = mirror_padded(pixels, axis, size, margin)
    done = padded.withColumns({b: filtered(b, t) for b, t in bands.items()})
    return done.where((F.col(axis) >= 0) & (F.col(axis) < limit))


def smooth(pixels: DataFrame, bands: list[str], sigma: float, height: Column | int, width: Column | int, image: list[str] | None = None) -> DataFrame:
    image, taps = image or [], dict.fromkeys(bands, gaussian_taps(sigma))
    return convolve(convolve(pixels, taps, "col", width, [*image, "row"]), taps, "row", height, [*image, "col"])


def gradients(pixels: DataFrame, bands: list[str], sigma: float, height: Column | int, width: Column | int, image: list[str] | None = None) -> DataFrame:
    """Adds <band>_dx and <band>_dy by Gaussian derivatives."""
    image, g, d = image or [], gaussian_taps(sigma), derivative_taps(sigma)
    wide = pixels.select("*", *[F.col(b).alias(f"{b}_dx") for b in bands], *[F.col(b).alias(f"{b}_dy") for b in bands])
    along = {f"{b}_dx": d for b in bands} | {f"{b}_dy": g for b in bands}
    across = {f"{b}_dx": g for b in bands} | {f"{b}_dy": d for b in bands}
    return convolve(convolve(wide, along, "col", width, [*image, "row"]), across, "row", height, [*image, "col"])


def bdvf(dx: list[Column], dy: list[Column]) -> Column:
    """Largest rate of change of a vector field, in a form whose root is never of a negative number."""
    p, q, t = sum(x * x for x in dx), sum(y * y for y in dy), sum(x * y for x, y in zip(dx, dy, strict=True))
    return F.sqrt(0.5 * (p + q + F.sqrt((p - q) * (p - q) + 4 * t * t)))


def l2norm(dx: list[Column], dy: list[Column]) -> Column:
    return F.sqrt(sum(x * x for x in dx) + sum(y * y for y in dy))


def neighbours(pixels: DataFrame, value: str, offsets=NEIGHBOURS8, image: list[str] | None = None) -> DataFrame:
    """row, col, value, nbr, other for each neighbour (numbered nbr) that exists: shifted copies meet by an equality join."""
    image = image or []
    moves = F.array(*[F.struct(F.lit(k).alias("nbr"), F.lit(r).alias("r"), F.lit(c).alias("c")) for k, (r, c) in enumerate(offsets)])
    sent = pixels.select(*image, "row", "col", F.col(value).alias("other"), F.explode(moves).alias("m"))
    sent = sent.select(*image, (F.col("row") - F.col("m.r")).alias("row"), (F.col("col") - F.col("m.c")).alias("col"), F.col("m.nbr").alias("nbr"), "other")
    return pixels.select(*image, "row", "col", value).join(sent, [*image, "row", "col"])


def block_average(pixels: DataFrame, bands: list[str], block: int, height: int, width: int) -> DataFrame:
    """Means of whole blocks; rows and columns that fill no block are dropped."""
    whole = pixels.where((F.col("row") < height // block * block) & (F.col("col") < width // block * block))
    keys = [F.floor(F.col(a) / block).cast("int").alias(a) for a in ("row", "col")]
    return whole.groupBy(*keys).agg(*[F.avg(b).alias(b) for b in bands])


def overlaps(axis: str, ratio: float | Column, cells: int | Column) -> Column:
    """Target cells of a source pixel along an axis, with the part of the pixel in each."""
    low, high = F.col(axis) / ratio, (F.col(axis) + 1) / ratio
    limit = F.lit(cells) if isinstance(cells, int) else cells
    first, last = F.floor(low).cast("int"), F.least(F.ceil(high).cast("int"), limit) - 1
    part = lambda i: F.struct(i.alias("i"), ((F.least(high, i + 1.0) - F.greatest(low, i.cast("double"))) * ratio).alias("w"))
    return F.when(first <= last, F.transform(F.sequence(first, last), part)).otherwise(F.array().cast("array<struct<i:int,w:double>>"))


def area_average(pixels: DataFrame, bands: list[str], height: int, width: int, ratio_rows: float, ratio_cols: float) -> DataFrame:
    """Overlap-weighted means on a grid of max(1, round(size / ratio)) cells; missing pixels weigh nothing."""
    rows, cols = max(1, round(height / ratio_rows)), max(1, round(width / ratio_cols))
    spread = pixels.withColumn("r", F.explode(overlaps("row", ratio_rows, rows))).withColumn("c", F.explode(overlaps("col", ratio_cols, cols)))
    weight = F.col("r.w") * F.col("c.w")
    mean = lambda b: F.try_divide(F.sum(weight * F.col(b)), F.sum(F.when(F.col(b).isNotNull(), weight))).alias(b)
    return spread.where(weight > 1e-12).groupBy(F.col("r.i").alias("row"), F.col("c.i").alias("col")).agg(*[mean(b) for b in bands])


def _grid(pixels: DataFrame, rows: int, cols: int) -> DataFrame:
    line = pixels.sparkSession.range(rows).select(F.col("id").cast("int").alias("row"))
    return line.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))


def resize_nearest(pixels: DataFrame, bands: list[str], size: tuple[int, int], target: tuple[int, int], centred: bool = True) -> DataFrame:
    """Nearest source pixel of each target pixel's centre (or corner).

    Each source pixel is sent to the target cells that take it, found among those around its own
    place, so there is no target grid to join with, however large it is.
    """
    shift = 0.5 if centred else 0.0

    def cells(axis: str, n: int, m: int) -> Column:
        x = F.col(axis)
        low, high = F.floor(x * F.lit(m / n) - shift) - 1, F.ceil((x + 1) * F.lit(m / n) - shift) + 1
        near = F.sequence(F.greatest(F.lit(0), low.cast("int")), F.least(F.lit(m - 1), high.cast("int")))
        return F.explode(F.filter(near, lambda i: F.least(F.lit(n - 1), F.floor((i + shift) * n / m).cast("int")) == x))

    inside = pixels.where(F.col("row").between(0, size[0] - 1) & F.col("col").between(0, size[1] - 1))
    sent = inside.select(cells("row", size[0], target[0]).alias("to_row"), "col", *bands)
    return sent.select(F.col("to_row").alias("row"), cells("col", size[1], target[1]).alias("col"), *bands)


def resize_bilinear(pixels: DataFrame, band: str, size: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """Bilinear values at i * (size - 1) / target."""
    at = lambda axis, n, m: F.col(axis) * (n - 1) / m
    grid = _grid(pixels, *target).withColumns({"y": at("row", size[0], target[0]), "x": at("col", size[1], target[1])})
    base = {"r0": F.floor("y").cast("int"), "c0": F.floor("x").cast("int")}
    taps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    grid = grid.withColumns(base).withColumn("tap", taps)
    weight = F.abs(1 - F.col("tap.i") - (F.col("y") - F.col("r0"))) * F.abs(1 - F.col("tap.j") - (F.col("x") - F.col("c0")))
    grid = grid.select("row", "col", weight.alias("w"), (F.col("r0") + F.col("tap.i")).alias("sr"), (F.col("c0") + F.col("tap.j")).alias("sc")).where("w > 0")
    source = pixels.select(F.col("row").alias("sr"), F.col("col").alias("sc"), F.col(band).alias("v"))
    return grid.join(source, ["sr", "sc"]).groupBy("row", "col").agg(F.sum(F.col("w") * F.col("v")).alias(band))


def windows(size: int, patch: int, overlap: float) -> list[tuple[int, int]]:
    """Bounds of the sliding windows along one axis; the last ones are moved back inside."""
    crop = min(patch, size)
    stride = crop - round(crop * overlap) if crop < size else size
    if stride < 1:
        raise ValueError("the overlap leaves no stride")
    count = max(size - crop + stride - 1, 0) // stride + 1
    ends = [min(i * stride + crop, size) for i in range(count)]
    return [(max(e - crop, 0), e) for e in ends]


def window_columns(size: Column, patch: int, overlap: float) -> Column:
    """The same for a column of sizes: an array of (lo, hi)."""
    crop = F.least(F.lit(patch), size)
    stride = F.when(crop < size, crop - F.bround(crop * F.lit(overlap), 0)).otherwise(size).cast("int")
    count = F.floor(F.greatest(size - crop + stride - 1, F.lit(0)) / stride).cast("int")
    hi = lambda i: F.least(i * stride + crop, size)
    return F.transform(F.sequence(F.lit(0), count), lambda i: F.struct(F.greatest(hi(i) - crop, F.lit(0)).alias("lo"), hi(i).alias("hi")))


def window_members(pixels: DataFrame, rows: list[tuple[int, int]], cols: list[tuple[int, int]]) -> DataFrame:
    """pixels with wr and wc, the windows that hold them (several where windows overlap).

    The bounds are those of `windows`: all but the last are a stride apart, so a pixel's windows come
    from its place by arithmetic, however many windows there are.
    """

    def own(axis: str, bounds: list[tuple[int, int]]) -> Column:
        last, crop = len(bounds) - 1, bounds[0][1] - bounds[0][0]
        stride, x = bounds[1][0] if last > 1 else 1, F.col(axis)
        first = F.greatest(F.lit(0), F.floor((x - crop) / stride) + 1).cast("int")
        final = F.least(F.lit(last - 1), F.floor(x / stride)).cast("int")
        regular = F.when(first <= final, F.sequence(first, final)).otherwise(F.array().cast("array<int>"))
        return F.explode(F.concat(regular, F.when((x >= bounds[last][0]) & (x < bounds[last][1]), F.array(F.lit(last))).otherwise(F.array().cast("array<int>"))))

    return pixels.withColumn("wr", own("row", rows)).withColumn("wc", own("col", cols))


def local_moments(pixels: DataFrame, band: str, half: int, image: list[str] | None = None) -> DataFrame:
    """Adds mean and variance over the square of half-width `half` around each pixel, cut at the borders."""
    image = image or []
    line = W.partitionBy(*image, "row").orderBy("col").rangeBetween(-half, half)
    column = W.partitionBy(*image, "col").orderBy("row").rangeBetween(-half, half)
    sums = {"s0": F.count(band).over(line), "s1": F.sum(band).over(line), "s2": F.sum(F.col(band) * F.col(band)).over(line)}
    out = pixels.withColumns(sums).withColumns({k: F.sum(k).over(column) for k in sums})
    mean = F.col("s1") / F.col("s0")
    return out.withColumns({"mean": mean, "variance": F.greatest(F.lit(0.0), F.col("s2") / F.col("s0") - mean * mean)}).drop(*sums)


def divisor_pad(size: Column, divisor: Column) -> Column:
    return (divisor - size % divisor) % divisor
