"""Golden cases, invariants and readers."""

import json
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import energy, inference, names, radiometry
from rasterloom.kernels import filters, segmentation
from rasterloom.operators import cluster, graphs, labels, raster, regions, spatial, stats, texture
from rasterloom.plans import pipeline
from rasterloom.sources import products, rasters, sinks
from rasterloom.streaming import statistics as streaming


def test_partial_stats_golden(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", x) for x in (1.0, 2.0, nan, 3.0, 6.0, inf)] + [("b", nan)]
    out = {r["k"]: r for r in stats.finalize(stats.partial_stats(spark.createDataFrame(rows, "k string, x double"), ["k"])).collect()}
    assert (out["a"]["n"], out["a"]["sum"], out["a"]["sum_sq"], out["a"]["min"], out["a"]["max"], out["a"]["mean"]) == (4, 12, 50, 1, 6, 3)
    assert out["a"]["std"] == pytest.approx(1.8708286934)
    assert out["b"]["n"] == 0 and out["b"]["mean"] is None and out["b"]["std"] is None


@pytest.mark.parametrize(
    ("size", "patch", "overlap", "want"),
    [(10, 4, 0, [(0, 4), (4, 8), (6, 10)]), (10, 4, 0.25, [(0, 4), (3, 7), (6, 10)]), (10, 5, 0.5, [(0, 5), (3, 8), (5, 10)]), (3, 4, 0, [(0, 3)])],
)
def test_windows(spark, size, patch, overlap, want):
    assert raster.windows(size, patch, overlap) == want
    got = spark.range(1).select(raster.window_columns(F.lit(size), patch, overlap).alias("w")).first()["w"]
    assert [(w["lo"], w["hi"]) for w in got] == want


def test_windows_without_stride():
    with pytest.raises(ValueError, match="stride"):
        raster.windows(10, 4, 1.0)


@pytest.mark.parametrize(("percentage", "val"), [(80, {2}), (60, {0, 2})])
def test_split_golden(spark, percentage, val):
    scenes = spark.createDataFrame([(0, 0, 0), (1, 100, 0), (2, 50, 50), (3, 30, 70), (4, 0, 80)], "id int, water long, ice long")
    parts = {r["id"]: r["split"] for r in labels.split(scenes, percentage).collect()}
    assert {i for i, s in parts.items() if s == "val"} == val and len(parts) == 5


def test_split_of_one_scene(spark):
    assert labels.split(spark.createDataFrame([(7, 0, 0)], "id int, water long, ice long"), 80).first()["split"] == "train"


def test_scales(spark):
    one = spark.range(1)
    assert one.select(radiometry.db_to_linear(F.lit(-20.0))).first()[0] == pytest.approx(0.01)
    assert one.select(radiometry.linear_to_db(F.lit(0.0))).first()[0] == pytest.approx(-120)
    for ratio, want in ((0.3, 0.3745750823), (0.7, 0.05), (0.6, 0.1374504624), (0.001, 3.0)):
        assert one.select(energy.beta(F.lit(ratio))).first()[0] == pytest.approx(want)
        assert segmentation.beta_of(ratio) == pytest.approx(want)


def test_gaussian_taps():
    taps = raster.gaussian_taps(1.0)
    assert len(taps) == 9 and taps[4:] == pytest.approx([0.367691, 0.241185, 0.067012, 0.007611, 0.000341], abs=1e-6)


def test_area_average(spark):
    line = spark.createDataFrame([(0, i, float(i + 1)) for i in range(6)], "row int, col int, v double")
    out = {r["col"]: r["v"] for r in raster.area_average(line, ["v"], 1, 6, 1.0, 2.0).collect()}
    assert out == pytest.approx({0: 1.5, 1: 3.5, 2: 5.5})
    out = {r["col"]: r["v"] for r in raster.area_average(line, ["v"], 1, 6, 1.0, 1.5).collect()}
    assert out == pytest.approx({0: 4 / 3, 1: 8 / 3, 2: 13 / 3, 3: 17 / 3})


def test_bdvf(spark):
    dx, dy = [F.lit(3.0), F.lit(1.0)], [F.lit(4.0), F.lit(2.0)]
    assert spark.range(1).select(raster.bdvf(dx, dy)).first()[0] == pytest.approx(5.4649857042)


def test_neighbour_count_and_plan(spark):
    pixels = spark.range(500 * 64).select((F.col("id") / 64).cast("int").alias("row"), (F.col("id") % 64).cast("int").alias("col"), F.lit(0).alias("k"))
    assert raster.neighbours(pixels, "k").count() == 252_620


def test_filters_agree(spark):
    rng = np.random.default_rng(1)
    image = rng.normal(size=(20, 16))
    pixels = spark.createDataFrame([(r, c, float(image[r, c])) for r in range(20) for c in range(16)], "row int, col int, v double")
    got = np.zeros((20, 16))
    for r in raster.smooth(pixels, ["v"], 1.0, 20, 16).collect():
        got[r["row"], r["col"]] = r["v"]
    taps = np.array(raster.gaussian_taps(1.0))
    want = filters.convolve1d(filters.convolve1d(image, taps, 1), taps, 0)
    assert np.allclose(got, want)


def test_merge_moments(spark):
    frame = spark.createDataFrame([(0, 2, 2.0, 3.0, 5.0, 7.0, 10.0), (1, 1, 5.0, 0.0, 25.0, 0.0, 0.0)], "region int, n long, m1 double, m2 double, c11 double, c12 double, c22 double")
    merges = spark.createDataFrame([(0, 1)], "a int, b int")
    row = regions.merge_regions(frame, merges).first()
    assert (row["n"], row["m1"], row["m2"]) == (3, 3, 2)
    assert (row["c11"], row["c12"], row["c22"]) == pytest.approx((35 / 3, 14 / 3, 20 / 3))


def test_glcm_golden(spark):
    pixels = spark.createDataFrame([(0, 0, 0, 0), (0, 0, 1, 1), (0, 1, 0, 1), (0, 1, 1, 1)], "tile int, row int, col int, g int")
    row = texture.measures(texture.pairs(pixels, ["tile"], 1, ((0, 1),)), ["tile"]).first()
    want = {"con": 0.5, "hom": 0.75, "mu": 0.75, "std": 0.4330127, "cor": -1 / 3, "asm": 0.375, "ent": 1.0397208}
    assert {k: row[k] for k in want} == pytest.approx(want, abs=1e-6)


def test_relabel_and_mirror(spark):
    pixels = spark.createDataFrame([(i, 0, v) for i, v in enumerate([7, 3, -2, 7, 9])], "row int, col int, region int")
    assert [r["new"] for r in regions.relabel(pixels).orderBy("row").collect()] == [1, 0, -2, 1, 2]
    got = spark.createDataFrame([(-1,), (-2,), (5,), (6,)], "x int").select(raster.mirror(F.col("x"), F.lit(5))).collect()
    assert [r[0] for r in got] == [0, 1, 4, 3]


def test_components_of_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    out = {r["node"]: r["component"] for r in graphs.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}
    assert graphs.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pixel_components_equal_flood_fill(spark):
    image = np.random.default_rng(5).integers(0, 3, (18, 15))
    image[4, :] = -1
    pixels = spark.createDataFrame([(r, c, int(image[r, c])) for r in range(18) for c in range(15)], "row int, col int, k int")
    got = {(r["row"], r["col"]): r["component"] for r in regions.components(pixels, "k").collect()}
    want = segmentation.components(image)
    assert len(got) == int((want >= 0).sum())
    pairs = {(got[r, c], int(want[r, c])) for r, c in got}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_watershed_separates_two_basins():
    valley = np.tile(np.array([0.0, 0.1, 0.3, 0.9, 0.3, 0.1, 0.0]), (6, 1))
    mask = np.ones(valley.shape, bool)
    out = segmentation.watershed(valley, mask)
    assert set(out[:, :3].ravel()) == {0} and set(out[:, 4:].ravel()) == {1} and set(out[:, 3]) == {-2}
    mask[0] = False
    assert (segmentation.watershed(valley, mask)[0] == -2).all()


def test_graph_merge_conserves_sums():
    rng = np.random.default_rng(2)
    bands, mask = [rng.normal(size=(24, 24)), rng.normal(size=(24, 24))], np.ones((24, 24), bool)
    marks = segmentation.watershed(filters.smooth(filters.gradient(bands, mask), 1.2), mask)
    graph = segmentation.region_graph(marks, bands, mask)
    before = sum(graph.count.values()), sum(graph.total.values())
    done = segmentation.merge_all(graph, dict.fromkeys(graph.count, 0), dict.fromkeys(graph.sites, 1e6))
    assert done and sum(graph.count.values()) == before[0] and np.allclose(sum(graph.total.values()), before[1])


def test_irgs_finds_two_halves():
    rng = np.random.default_rng(3)
    image = np.where(np.arange(40)[None, :] < 20, 0.2, 0.8) + rng.normal(scale=0.03, size=(40, 40))
    mask = np.ones((40, 40), bool)
    mask[:3] = False
    out = segmentation.irgs([image, image[::-1]], mask, 2, 6, seed=1)
    assert (out.classes[:3] == -1).all() and (out.boundaries[:3] == -1).all()
    left, right = out.classes[5:, 2:17], out.classes[5:, 23:38]
    assert np.unique(left).size == np.unique(right).size == 1 and left[0, 0] != right[0, 0]
    parts, n = segmentation.segments(out)
    assert n == 2 and (parts[:3] == -1).all()


def test_irgs_of_nothing():
    out = segmentation.irgs([np.zeros((5, 5))], np.zeros((5, 5), bool), 3, 2)
    assert (out.classes == -1).all() and segmentation.segments(out)[1] == 0


def test_cut_points():
    points, bridges = segmentation.cut_points([(0, 1), (1, 2), (2, 0), (2, 3), (3, 4)])
    assert points == {2, 3} and bridges == {(2, 3), (3, 4)}


def test_polygon_clip_and_projection(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    assert sorted(spatial.clip_polygon(square, (2, 3, 20, 5))) == [(2, 3), (2, 5), (10, 3), (10, 5)]
    assert spatial.clip_polygon(square, (20, 20, 30, 30)) == []
    x, y = spatial.polar_forward(F.lit(70.0), F.lit(-45.0))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert row["x"] == pytest.approx(0, abs=1e-6) and row["y"] == pytest.approx(-2187927.65, abs=0.1)  # the radius of the true parallel


def test_png_round_trip_and_annotations(spark, tmp_path):
    colours = [*labels.COLOURS, (1, 2, 3)]
    pixels = b"".join(bytes(c) for c in colours)
    data = products.encode_png(1, len(colours), pixels)
    assert products.decode_png(data) == (1, len(colours), pixels, 3)
    for name, body in (("one", data), ("bad", b"nonsense")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "custom_annotation.png").write_bytes(body)
    rows = products.read_annotations(spark, str(tmp_path)).orderBy("col").collect()
    assert [r["label"] for r in rows] == [0, 1, 2, 3, 4, 5, 255] and {r["scene"] for r in rows} == {"one"}
    two = products.read_annotations(spark, str(tmp_path), classes=2).orderBy("col").collect()
    assert [r["label"] for r in two] == [0, 1, 255, 255, 255, 255, 255]


PRODUCT = """<?xml version="1.0"?><product xmlns="urn:x"><productId>P1</productId><sampledPixelSpacing>50.0</sampledPixelSpacing><sampledLineSpacing>40</sampledLineSpacing>
<acquisitionStartTime>2021-07-16T12:09:35.5Z</acquisitionStartTime><geolocationGrid>
<imageTiePoint><imageCoordinate><line>0</line><pixel>0</pixel></imageCoordinate><geodeticCoordinate><latitude>70.5</latitude><longitude>-60</longitude></geodeticCoordinate></imageTiePoint>
</geolocationGrid></product>"""


def test_products_lists_and_status(spark, tmp_path):
    for name, text in (("a", PRODUCT), ("b", "<broken")):
        (tmp_path / "root" / name).mkdir(parents=True)
        (tmp_path / "root" / name / "product.xml").write_text(text)
    rows = {r["name"]: r for r in products.read_products(spark, str(tmp_path / "root")).collect()}
    assert rows["a"]["ok"] and (rows["a"]["product_id"], rows["a"]["range_m"], rows["a"]["azimuth_m"]) == ("P1", 50.0, 40.0)
    assert rows["a"]["acquired"].isoformat() == "2021-07-16T12:09:35.500000" and rows["a"]["tie_points"][0]["lat"] == 70.5
    assert not rows["b"]["ok"] and rows["b"]["error"]
    (tmp_path / "list.txt").write_text(" a \n\nzz\n")
    listed, folders = products.product_list(spark, str(tmp_path / "list.txt")), products.scan_folders(spark, str(tmp_path / "root"))
    assert [r["name"] for r in products.existing(listed, folders).collect()] == ["a"]
    assert [r["name"] for r in products.missing(listed, folders).collect()] == ["zz"]
    status = products.scene_status(products.read_products(spark, str(tmp_path / "root")), spark.createDataFrame([("a",)], "scene string"))
    assert {r["name"]: r["ok"] for r in status.collect()} == {"a": True, "b": False}
    assert sinks.write_failures(status, str(tmp_path / "failures")) and not sinks.write_failures(status.where("ok"), str(tmp_path / "none"))


def test_names(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(names.basename(F.lit(r"x/y\z/"))) == "z" and value(names.spacing_tag(F.lit(200.0))) == "200m" and value(names.spacing_tag(F.lit(12.5))) == "12.5m"
    assert value(names.patch_name(F.lit(7))) == "00007" and value(names.failures_path(F.lit("a/b.json"))) == "a/b_failures.json"
    assert value(names.day_index(F.lit("2021-01-01").cast("timestamp"))) == 0 and value(names.day_index(F.lit("2020-12-31").cast("timestamp"))) == 365


def test_patch_pipeline(spark, tmp_path):
    pixels = spark.range(40 * 40).select((F.col("id") / 40).cast("int").alias("row"), (F.col("id") % 40).cast("int").alias("col"))
    pixels = pixels.withColumns({"hh": F.when(F.col("row") == 0, F.lit(float("nan"))).otherwise(F.rand(1)), "hv": F.rand(2), "label": (F.col("col") > 19).cast("int"), "land": (F.col("row") >= 20) & (F.col("col") < 20)})
    out = pipeline.patches(pixels, {"name": "p", "spacing": 200, "acquired": "2021-07-16 12:00:00"}, 40, 40, 20)
    rows = out.collect()
    assert len(rows) == 3 and {(r["y1"], r["x1"]) for r in rows} == {(0, 0), (0, 20), (20, 20)}  # the window that is all land is left out
    first = next(r for r in rows if r["y1"] == 0 and r["x1"] == 0)
    assert len(first["hh"]) == 400 and math.isnan(first["hh"][0]) and first["label"][0] == 255 and first["label"][25] == 0 and (first["month"], first["day"]) == (7, 196)
    done = pipeline.segmented(out, 3, 3)
    sinks.write_patches(done, str(tmp_path / "patches"))
    back = sinks.read_patches(spark, str(tmp_path / "patches"), "200m").collect()
    assert len(back) == 3 and all(r["ok"] and r["n_segments"] > 0 for r in back)


def test_statistics_and_split_pipelines(spark, tmp_path):
    pixels = spark.createDataFrame([(50, -10.0, -20.0), (50, float("nan"), -22.0), (100, -12.0, -24.0)], "spacing int, hh double, hv double")
    when = spark.createDataFrame([("2021-07-16", True), ("2021-01-02", False)], "t string, ok boolean").select(F.col("t").cast("timestamp").alias("acquired"), "ok")
    figures, months = pipeline.dataset_statistics(pixels, when)
    assert figures.count() == 4 and [r["n"] for r in months.orderBy("month").collect()] == [0] * 6 + [1] + [0] * 5
    sinks.write_stats_json(figures, months, str(tmp_path / "stats"))
    (line,) = [r["value"] for r in spark.read.text(str(tmp_path / "stats")).collect()]
    document = json.loads(line)
    assert set(document) == {"HH", "HV", "acquisition_month_histogram"} and document["HH"]["50"]["mean"] == -10 and document["acquisition_month_histogram"]["Jul"] == 1
    marks = spark.createDataFrame([(s, k) for s, ks in {1: [0, 0, 1], 2: [0], 3: [1, 255]}.items() for k in ks], "scene long, label int")
    shares, parts, report = pipeline.class_split(marks, marks, 60)
    assert shares.count() == 6 and {r["split"] for r in parts.collect()} == {"train", "val"}
    sinks.write_split_summary(report, str(tmp_path / "summary"))
    (document,) = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "summary")).collect()]
    assert (document["n_scenes"], document["n_train"], document["n_val"]) == (3, 1, 2) and document["scene_counts_all_classes"]["WATER"] == 2
    assert sorted(document["train_scenes"] + document["val_scenes"]) == ["1", "2", "3"] and document["total_pixel_percentages_all_classes"]["ICE"] == 40
    sinks.write_split(parts, str(tmp_path / "lists"), 60)
    assert spark.read.text(str(tmp_path / "lists" / "train_60")).count() == 1


def test_streaming_statistics(spark, tmp_path):
    spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", float("nan"))], "k string, x double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, x double").parquet(str(tmp_path / "in"))
    run = streaming.running_stats(stream, ["k"]).writeStream.format("memory").queryName("running").outputMode("complete").start()
    run.processAllAvailable()
    run.stop()
    rows = {r["k"]: r for r in spark.table("running").collect()}
    assert rows["a"]["mean"] == 2 and rows["a"]["n"] == 2 and rows["b"]["n"] == 0


def test_tiff_and_pixels(spark, tmp_path):
    image = np.arange(24, dtype=np.float32).reshape(2, 3, 4)
    image[0, 0, 0] = -999
    assert np.array_equal(rasters.decode_tiff(rasters.encode_tiff(image)), image)
    for name, body in (("a", rasters.encode_tiff(image)), ("b", b"nonsense"), ("c", rasters.encode_tiff(image[:1]))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.tif").write_bytes(body)
    (tmp_path / "a" / "x.img").write_bytes(rasters.encode_tiff(image + 1))
    rows = rasters.read_pixels(spark, str(tmp_path), nodata=-998).collect()
    assert {r["product"] for r in rows if r["error"]} == {"b", "c"}
    good = {(r["row"], r["col"]): (r["hh"], r["hv"]) for r in rows if not r["error"]}
    assert len(good) == 12 and good[0, 0] == (None, 13) and good[2, 3] == (12, 24)


def test_shapefile(spark, tmp_path):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 0.0)]
    body = struct.pack("<i4dii", 5, 0, 0, 4, 3, 1, len(ring)) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    data = struct.pack(">i", 9994) + b"\0" * 96 + struct.pack(">ii", 1, len(body) // 2) + body
    (tmp_path / "o.shp").write_bytes(data)
    rows = rasters.read_polygons(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["x1"], r["y1"], r["x2"], r["y2"]) for r in rows] == [(0, 0, 4, 0), (4, 0, 4, 3), (4, 3, 0, 0)]


SECOND = """<product xmlns="u"><productId>R2</productId><imageAttributes><fullResolutionImageData pole="HH">a.tif</fullResolutionImageData><fullResolutionImageData pole="HV">b.tif</fullResolutionImageData>
<rasterAttributes><numberOfSamplesPerLine>8</numberOfSamplesPerLine><numberOfLines>6</numberOfLines></rasterAttributes><geographicInformation><geolocationGrid>
<imageTiePoint><imageCoordinate><line>0</line><pixel>0</pixel></imageCoordinate><geodeticCoordinate><latitude>70</latitude><longitude>-60</longitude></geodeticCoordinate></imageTiePoint>
<imageTiePoint><imageCoordinate><line>4</line><pixel>6</pixel></imageCoordinate><geodeticCoordinate><latitude>71</latitude><longitude>-61</longitude></geodeticCoordinate></imageTiePoint>
</geolocationGrid></geographicInformation></imageAttributes><sourceAttributes><rawDataStartTime>2010-01-02T03:04:05Z</rawDataStartTime><passDirection>Descending</passDirection></sourceAttributes></product>"""


def test_second_products_and_lut(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "product.xml").write_text(SECOND)
    (tmp_path / "lut.xml").write_text("<lut><offset>1.5</offset><gains>2.0 3.0\n4.5</gains></lut>")
    row = products.read_second_products(spark, str(tmp_path / "p"), 2).first()
    assert (row["product_id"], row["n_rows"], row["n_cols"], row["pass_direction"]) == ("R2", 6, 8, "Descending")
    assert [(f["pole"], f["file"]) for f in row["files"]] == [("HH", "a.tif"), ("HV", "b.tif")]
    assert row["points"][1]["line"] == 2 and row["points"][1]["pixel"] == 3 and (row["lat_min"], row["lon_max"]) == (70, -60)
    assert [(r["index"], r["gain"], r["offset"]) for r in products.read_lut(spark, str(tmp_path / "lut.xml")).collect()] == [(0, 2.0, 1.5), (1, 3.0, 1.5), (2, 4.5, 1.5)]


def test_sensor_land_mask(spark):
    grid = spark.createDataFrame([(r, c, 70.0 + r * 0.05, -45.0 + c * 0.05) for r in range(6) for c in range(6)], "row int, col int, lat double, lon double")
    x, y = spatial.polar_forward(F.col("lat"), F.col("lon"))
    places = {(r["row"], r["col"]): (r["x"], r["y"]) for r in grid.select("row", "col", x.alias("x"), y.alias("y")).collect()}
    left, top = min(p[0] for p in places.values()) - 2000, max(p[1] for p in places.values()) + 2000
    mid = places[3, 3][0] - 950
    ring = [(left, top), (mid, top), (mid, top - 100_000), (left, top - 100_000)]
    size = (300, 100)
    out = {(r["row"], r["col"]): r["land"] for r in spatial.sensor_land_mask(grid, F.col("lat"), F.col("lon"), [ring], 200.0, (left, top), size).collect()}
    assert all(out[k] == (p[0] > mid) for k, p in places.items() if abs(p[0] - mid) > 300)
    assert all(r["land"] for r in spatial.sensor_land_mask(grid, F.col("lat"), F.col("lon"), [], 200.0, (left, top), size).collect())


def test_polynomial_fit(spark):
    rows = [(float(x), float(y), 1 + 2 * x - y + 0.5 * x * y + 0.25 * x * x - 0.125 * y * y, 3.0 - x + 4 * y) for x in range(5) for y in range(5)]
    frame = spark.createDataFrame(rows, "x double, y double, z double, w double")
    assert spatial.solve_moments(spatial.polynomial_moments(frame, "x", "y", ["z"]), "z") == pytest.approx([1, 2, -1, 0.5, 0.25, -0.125])
    assert spatial.solve_moments(spatial.linear_moments(frame, "x", "y", ["w"]), "w") == pytest.approx([3, -1, 4])


def test_inference(spark):
    assert inference.input_divisor(None) == 32 and inference.input_divisor([1, 2, 2]) == 4 and inference.input_divisor([1, 1, 1, 1], [True, True, False]) == 4
    tiles = spark.createDataFrame([(1, 3, 5, [float("nan")] + [-10.0] * 14, [-30.0] * 15)], "id int, height int, width int, hh array<double>, hv array<double>")
    out = inference.predict_tiles(tiles, ["id"], lambda: lambda image: np.stack([np.zeros(image.shape[1:]), image[0]]), 4).first()
    assert out["classes"] == [0] + [1] * 14


def test_mrf_sweeps_lower_the_energy(spark):
    rng = np.random.default_rng(4)
    truth = (np.arange(16)[None, :] > 7).astype(int) * np.ones((16, 1), int)
    hh, hv = truth + rng.normal(scale=0.6, size=(16, 16)), truth + rng.normal(scale=0.6, size=(16, 16))
    pixels = spark.createDataFrame([(r, c, float(hh[r, c]), float(hv[r, c]), int(hh[r, c] > 0.5)) for r in range(16) for c in range(16)], "row int, col int, hh double, hv double, k int")
    gmm = cluster.gmm_of_pixels(pixels)
    out = pixels
    for parity in range(4):
        out = cluster.mrf_sweep(out, gmm, 1.0, parity).select("row", "col", "hh", "hv", "k")
    errors = lambda frame: sum(r["k"] != truth[r["row"], r["col"]] for r in frame.collect())
    assert errors(out) < errors(pixels) / 2


def test_watermark_plan(spark, tmp_path):
    spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'a' as k").write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "ev"))
    run = streaming.windowed_counts(stream, "ts", "k").writeStream.format("memory").queryName("windows").outputMode("update").start()
    run.processAllAvailable()
    run.stop()
    assert [r["n"] for r in spark.table("windows").collect()] == [1]


@pytest.mark.parametrize(("size", "target"), [((5, 4), (10, 8)), ((7, 6), (3, 4)), ((3, 5), (10, 7)), ((6, 1), (1, 9)), ((4, 4), (4, 4))])
@pytest.mark.parametrize("centred", [True, False])
def test_nearest_resizing_without_a_target_grid(spark, size, target, centred):
    """The grid of targets was broadcast, twice the raster's size, through the driver."""
    source = [(r, c, r * 100.0 + c) for r in range(size[0]) for c in range(size[1]) if (r, c) != (1, 0)]  # one is missing
    outside = [(-1, 0, -7.0), (size[0], 0, -7.0), (0, size[1], -7.0), (None, 0, -7.0)]
    frame = raster.resize_nearest(spark.createDataFrame(source + outside, "row long, col int, v double"), ["v"], size, target, centred)
    assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()
    held, shift = {(r, c): v for r, c, v in source}, 0.5 if centred else 0.0
    place = lambda i, n, m: min(n - 1, math.floor((i + shift) * n / m))
    want = {(r, c): held.get((place(r, size[0], target[0]), place(c, size[1], target[1]))) for r in range(target[0]) for c in range(target[1])}
    got = [tuple(r) for r in frame.collect()]
    assert sorted(got) == sorted((*k, v) for k, v in want.items() if v is not None)


def _restless(spark, edges):
    """edges whose weights come out with other last bits each time that they are computed, as sums of floats over a shuffle do."""
    noise = F.udf(lambda w: w * (1 + 1e-12 * random.random()), "double").asNondeterministic()
    return spark.createDataFrame(edges, "a int, b int, weight double").withColumn("weight", noise("weight"))


def test_best_merges_of_weights_that_are_computed_again(spark):
    edges = [(i, i + 1, -1.0 - i % 2) for i in range(40)] + [(100, 101, -3.0), (101, 102, 1.0), (200, 201, 0.0)]
    got = sorted((r["a"], r["b"], round(r["weight"], 6)) for r in regions.best_merges(_restless(spark, edges)).collect())
    assert got == [(i, i + 1, -2.0) for i in range(1, 40, 2)] + [(100, 101, -3.0)]


def test_contracted_edges_after_merges_that_are_computed_again(spark):
    edges = _restless(spark, [(0, 1, -2.0), (0, 2, 1.0), (1, 2, 1.0), (2, 3, -5.0), (4, 5, 1.0)]).withColumns({"length": F.lit(3), "penalty": F.lit(0.5)})
    got = sorted(tuple(r) for r in regions.contract(edges.drop("weight"), regions.best_merges(edges)).collect())
    assert got == [(0, 2, 6, 1.0), (4, 5, 3, 0.5)]


def test_contracted_edges_choose_once_between_equal_weights(spark):
    pairs = [(4 * i + j, 4 * i + j + 1) for i in range(40) for j in (0, 1)]  # 40 chains 0 - 1 - 2, whose two edges weigh the same
    merges = regions.best_merges(_restless(spark, [(a, b, -2.0) for a, b in pairs]))
    edges = spark.createDataFrame([(a, b, 3, 0.5) for a, b in pairs], "a int, b int, length int, penalty double")
    spark.conf.set("spark.sql.exchange.reuse", "false")  # else a plan may happen to compute the merges once
    try:
        got = sorted((r["a"] // 4, r["a"] % 4, r["b"] % 4, r["length"]) for r in regions.contract(edges, merges).collect())
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert [g[0] for g in got] == list(range(40)) and {g[1:] for g in got} <= {(0, 1, 3), (0, 2, 3)}


def test_contracted_edges_that_are_parallel_before(spark):
    edges = spark.createDataFrame([(0, 1, 1, 0.5), (0, 2, 2, 0.25), (0, 2, 2, 0.25), (1, 2, 4, None), (2, 3, 8, 1.0), (5, 5, 1, 1.0)], "a int, b int, length int, penalty double")
    merges = spark.createDataFrame([(0, 1, -1.0)], "a int, b int, weight double")
    assert sorted(tuple(r) for r in regions.contract(edges, merges).collect()) == [(0, 2, 8, 0.5), (2, 3, 8, 1.0)]


def test_penalties_do_not_depend_on_the_order_of_the_sites(spark):
    draw = random.Random(5)
    values = [draw.random() * 0.6 for _ in range(24)]
    orders = [random.Random(i).sample(values, len(values)) for i in range(60)]  # 60 boundaries with the same strengths
    rows = [(e, i, v) for e, order in enumerate(orders) for i, v in enumerate(order)]
    sites = spark.createDataFrame([(r, c, 2 * r, 2 * r + 1) for r, c, _ in rows], "row int, col int, a int, b int").coalesce(1)
    got = regions.edge_penalties(sites, spark.createDataFrame(rows, "row int, col int, g double"), F.lit(0.2), F.lit(0.8)).collect()
    assert len(got) == 60 and len({r["penalty"] for r in got}) == 1
    assert abs(got[0]["penalty"] - 0.8 * math.fsum(math.exp(-((v / 0.2) ** 2)) for v in values)) < 1e-13
    odd = spark.createDataFrame([(0, 0, float("nan")), (0, 1, 0.1)], "row int, col int, g double")
    assert math.isnan(regions.edge_penalties(sites.where("row = 0 and col < 2"), odd, F.lit(0.2), F.lit(0.8)).first()["penalty"])


def test_merged_moments_after_merges_that_are_computed_again(spark):
    stats_of = spark.createDataFrame([(i, 2, float(i), 0.0, 1.0, 0.0, 1.0) for i in range(4)], "region int, n long, m1 double, m2 double, c11 double, c12 double, c22 double")
    merges = regions.best_merges(_restless(spark, [(0, 1, -2.0), (1, 2, 1.0), (2, 3, -5.0)]))
    got = sorted((r["region"], r["n"], r["m1"]) for r in regions.merge_regions(stats_of, merges).collect())
    assert got == [(0, 4, 0.5), (2, 4, 2.5)]


def test_merged_moments_keep_the_sign_of_zero(spark, monkeypatch):
    from rasterloom.plans import segments

    held = spark.createDataFrame([(7, 3, 0.25, -4e-7, 0.1, 4e-7, None)], "region int, n long, m1 double, m2 double, c11 double, c12 double, c22 double")
    monkeypatch.setattr(segments, "_weights", lambda *_: spark.createDataFrame([], "a int, b int, weight double"))
    monkeypatch.setattr(segments, "_stats", lambda *_: held)
    row = segments.merge_moments(spark, "").first()
    assert [str(row[c]) for c in ("m1", "m2", "c11", "c12", "c22")] == ["0.25", "-0.0", "0.1", "0.0", "None"]


def test_patches_keep_the_sign_of_zero(spark, tmp_path):
    from rasterloom.plans import rasters as plans

    small = {0: -4e-7, 1: 4e-7, 2: -0.0, 3: -6e-7, 4: -0.25}  # columns of row 40, the first after the invalid ones
    rows = [(r, [small.get(c, 0.5) if r == 40 else 0.5 for c in range(64)], 0) for r in range(56)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    patch = plans.patch_extract(spark, str(tmp_path)).where("wr = 4 and wc = 0").first()  # rows 40 to 55
    assert [str(v) for v in patch["hh"][:6]] == ["-0.0", "0.0", "-0.0", "-1e-06", "-0.25", "0.5"]
