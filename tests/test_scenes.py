"""Product folders to statistics, split and patches, through the command line."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom import __main__ as cli
from rasterloom.operators import labels
from rasterloom.plans import scenes
from rasterloom.sources import products, rasters

XML = """<product xmlns="urn:x"><productId>{name}</productId><sampledPixelSpacing>100</sampledPixelSpacing><sampledLineSpacing>{line}</sampledLineSpacing>
<rawDataStartTime>2021-0{month}-16T12:09:35Z</rawDataStartTime><geolocationGrid>{ties}</geolocationGrid></product>"""
TIE = """<imageTiePoint><imageCoordinate><line>{y}</line><pixel>{x}</pixel></imageCoordinate><geodeticCoordinate><latitude>{lat}</latitude><longitude>{lon}</longitude></geodeticCoordinate></imageTiePoint>"""


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    rng = np.random.default_rng(1)
    ties = "".join(TIE.format(y=y, x=x, lat=70 + y * 0.001, lon=-45 + x * 0.003) for y in (0, 39) for x in (0, 29))
    for k, (name, line) in enumerate((("one", 100), ("two", 50))):
        shape = (40, 30) if name == "one" else (24, 10)
        image = np.stack([rng.normal(-17, 2, shape), rng.normal(-27, 2, shape)])
        image[:, 0] = -999
        (folder / "p" / name).mkdir(parents=True)
        (folder / "p" / name / "x.tif").write_bytes(rasters.encode_tiff(image))
        (folder / "p" / name / "product.xml").write_text(XML.format(name=name.upper(), line=line, month=k + 3, ties=ties))
        half = (shape[0] // 2, shape[1] // 2)
        marks = b"".join(bytes(labels.COLOURS[0] if c < half[1] // 2 else labels.COLOURS[1]) for _ in range(half[0]) for c in range(half[1]))
        (folder / "l" / name).mkdir(parents=True)
        (folder / "l" / name / "custom_annotation.png").write_bytes(products.encode_png(*half, marks))
    (folder / "p" / "bad").mkdir()
    (folder / "p" / "bad" / "product.xml").write_text("<product>")
    (folder / "list.txt").write_text("one\ntwo\nbad\n")
    return folder


def test_load_and_resample(spark, root):
    pixels, found = scenes.load(spark, str(root / "p"), nodata=-999)
    rows = {r["product"]: r for r in found.collect()}
    assert {p: r["ok"] for p, r in rows.items()} == {"one": True, "two": True, "bad": False} and rows["one"]["scale"] == "db"
    grid = scenes.resample(pixels, found, 200.0).collect()
    assert {(r["product"], r["rows"], r["cols"]) for r in grid} == {("one", 20, 15), ("two", 6, 5)}
    source = {(r["row"], r["col"]): r["hh"] for r in pixels.where("product = 'one'").collect()}
    cell = next(r for r in grid if r["product"] == "one" and (r["row"], r["col"]) == (0, 3))
    assert cell["hh"] == pytest.approx(10 * np.log10(np.mean([10 ** (source[1, c] / 10) for c in (6, 7)])))  # row 0 is missing


def test_geolocation(spark, root):
    pixels, found = scenes.load(spark, str(root / "p"), nodata=-999)
    native = pixels.where("product = 'one'").withColumns({"rows": F.lit(40), "cols": F.lit(30)})
    rows = {(r["row"], r["col"]): (r["lat"], r["lon"]) for r in scenes.geolocated(native, found).collect()}
    assert rows[10, 20] == pytest.approx((70.01, -44.94)) and rows[39, 0] == pytest.approx((70.039, -45))


def test_command_line(spark, root, tmp_path):
    cli.main(["stats", "--data_root", str(root / "p"), "--out_json", str(tmp_path / "s.json"), "--spacings", "200", "400", "--nodata", "-999"])
    (document,) = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "s.json")).collect()]
    assert set(document) == {"HH", "HV", "acquisition_month_histogram"} and set(document["HH"]) == {"200", "400"}
    assert spark.read.json(str(tmp_path / "s_failures.json")).first()["product"] == "bad"
    common = ["--data_root", str(root / "p"), "--labels_root", str(root / "l"), "--annotated_products_txt", str(root / "list.txt")]
    cli.main(["split", *common, "--output", str(tmp_path / "split"), "--percentage", "60"])
    names = [r["value"] for k in ("train_60", "val_40") for r in spark.read.text(str(tmp_path / "split" / k)).collect()]
    assert sorted(names) == ["bad", "one", "two"]
    (summary,) = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "split" / "summary")).collect()]
    assert summary["n_scenes"] == 3 and sorted(summary["train_scenes"] + summary["val_scenes"]) == ["bad", "one", "two"]
    ring = [(-46.0, 69.0), (-44.96, 69.0), (-44.96, 71.0), (-46.0, 71.0), (-46.0, 69.0)]
    body = struct.pack("<i4dii", 5, 0, 0, 0, 0, 1, len(ring)) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    (tmp_path / "o.shp").write_bytes(struct.pack(">i", 9994) + b"\0" * 96 + struct.pack(">ii", 1, len(body) // 2) + body)
    cli.main(["patches", *common, "--output", str(tmp_path / "patches"), "--shp_path", str(tmp_path / "o.shp"), "--patch_size", "8", "--irgs_classes", "2", "--irgs_iterations", "2", "--nodata", "-999"])
    rows = spark.read.parquet(str(tmp_path / "patches")).collect()
    assert {r["product_name"] for r in rows} == {"one", "two"} and all(r["ok"] and len(r["hh"]) == 64 and len(r["segments"]) == 64 for r in rows)
    two = next(r for r in rows if r["product_name"] == "two")
    image = np.array(two["hh"]).reshape(8, 8)
    assert np.allclose(image[6:8, :5], image[[5, 4], :5]) and np.allclose(image[:, 5:8], image[:, [4, 3, 2]])
    assert set(np.array(two["label"]).reshape(8, 8)[6:].ravel()) == {255} and (two["month"], two["x2"], two["y2"]) == (4, 5, 6)
    east = [r for r in rows if r["product_name"] == "one" and r["x1"] > 0]
    assert all(x == 255 for r in east for i, x in enumerate(r["label"]) if (r["x1"] + i % 8 + 0.5) * 2 * 0.003 > 0.045)  # land east of the polygon
    assert {r["patch_id"] for r in rows if r["product_name"] == "one"} == set(range(sum(r["product_name"] == "one" for r in rows)))
