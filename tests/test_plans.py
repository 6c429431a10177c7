"""Plans: column pruning, pushed filters, and no joins that grow with the square of the rows."""

import io
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rasterloom.operators import raster, regions, spatial
from rasterloom.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")

#: Queries whose sides are one row or a row a class, or that are quadratic by what they compute.
SMALL_SIDES = {
    "split_train_val", "split_train_val_sparse", "split_summary", "split_document", "gradient_bdvf", "edge_strength_hist", "k_schedule", "boundary_ratio", "unary_argmin", "overall_energy", "em_step",
    "pixel_classes", "mrf_sweep", "kmeans_step", "noise_variance", "min_fisher", "beta_fisher", "pixel_em", "region_kmeans",
}


def plan(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SMALL_SIDES))
def test_no_quadratic_join(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_columns_are_pruned(spark):
    text = plan(catalog.queries()["channel_stats"](spark, SF))
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_extendedprice:double>" in text


def test_filters_are_pushed(spark):
    assert "GreaterThan(l_discount,0.0)" in plan(catalog.queries()["sar_scale_classify"](spark, SF))


def test_filters_need_one_shuffle_a_direction(spark):
    pixels = spark.range(64).select((F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"), F.rand(1).alias("v"))
    text = plan(raster.smooth(pixels, ["v"], 1.0, 8, 8))
    assert text.count("Exchange (") <= 2 * 2 and "Join" not in text  # each is listed in the tree and in the details


def test_spatial_and_neighbour_joins_are_equality_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points = spark.createDataFrame([(1, 0.5, 0.5)], "id int, x double, y double")
        edges = spark.createDataFrame([(0, 0.0, 0.0, 1.0, 2.0)], "poly int, x1 double, y1 double, x2 double, y2 double")
        pixels = spark.createDataFrame([(0, 0, 1)], "row int, col int, region int")
        for frame in (spatial.inside_table(points, edges), regions.boundary_sites(pixels)):
            text = plan(frame)
            assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
