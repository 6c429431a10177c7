"""Calendar parts and names of products, patches and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_index(ts: Column) -> Column:
    """Zero-based day of the year."""
    return F.dayofyear(ts) - 1


def acquisition_time(text: Column) -> Column:
    """ISO time with Z or an offset."""
    return F.to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))


def basename(path: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(path, r"[/\\]+$", ""), r"[^/\\]*$", 0)


def spacing_tag(metres: Column) -> Column:
    """200m, 12.5m."""
    return F.concat(F.regexp_replace(metres.cast("string"), r"\.0$", ""), F.lit("m"))


def patch_name(index: Column) -> Column:
    return F.lpad(index.cast("string"), 5, "0")


def failures_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\.json$", "_failures.json")
