"""Session settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def builder(app: str = "rasterloom", master: str | None = None) -> SparkSession.Builder:
    """UTC timestamps, adaptive execution with skew handling, and Arrow for grouped kernels."""
    out = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    return out.master(master) if master else out
