"""Backscatter scales and normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The model's band constants in dB.
BAND_MEAN = {"hh": -16.849971303873264, "hv": -27.80859960890284}
BAND_STD = {"hh": 6.601613867039019, "hv": 6.390188051517371}
FLOOR = 1e-12
SCALE_PLACES = (0.0, 0.01, 0.5, 0.99, 1.0)


def finite(x: Column) -> Column:
    """NULL for NaN and infinities, so that aggregates skip them."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def db_to_linear(x: Column) -> Column:
    return F.pow(F.lit(10.0), x / 10)


def linear_to_db(x: Column) -> Column:
    return F.when(x.isNotNull(), 10 * F.log10(F.greatest(x, F.lit(FLOOR))))


def scale_of(p: Column) -> Column:
    """db, linear, dn or unknown from the percentiles [0, 1, 50, 99, 100] of the values."""
    low, p1, mid, p99, high = (F.get(p, i) for i in range(5))
    return (
        F.when((mid < 0) & (p1 < -5) & (p99 < 50) & (low < 0), "db")
        .when((low >= 0) & (mid < 1) & (p99 < 5), "linear")
        .when((low >= 0) & ((mid > 10) | (p99 > 100) | (high > 255)), "dn")
        .otherwise("unknown")
    )


def scale_percentiles(x: Column, accuracy: int | None = None) -> Column:
    """The percentiles that tell scales apart as an aggregate: exact (its state grows with the distinct values of a group), or a sketch of the given accuracy."""
    if accuracy:
        return F.percentile_approx(x, list(SCALE_PLACES), accuracy)
    return F.percentile(x, F.array(*[F.lit(p) for p in SCALE_PLACES]))


def standardize(x: Column, mean: float, std: float) -> Column:
    """Missing pixels become 0."""
    return (F.coalesce(finite(x), F.lit(mean)) - mean) / (std + FLOOR)


def minmax(x: Column, low: Column, high: Column) -> Column:
    return (x - low) / (high - low + 1e-8)
