"""Scene products: folders with a product XML, annotation images and product lists.

Files are read through Spark's readers, so any store that Spark reads will do.
"""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.names import acquisition_time, basename
from rasterloom.operators.labels import colour_class


def product_list(spark: SparkSession, path: str) -> DataFrame:
    """name: the trimmed lines of a text file, blank ones left out."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def existing(names: DataFrame, folders: DataFrame) -> DataFrame:
    return names.join(folders, "name", "left_semi").orderBy("name")


def missing(names: DataFrame, folders: DataFrame) -> DataFrame:
    return names.join(folders, "name", "left_anti").orderBy("name")


def scan_folders(spark: SparkSession, root: str, pattern: str = "product.xml") -> DataFrame:
    """name of each folder under root that holds a file of the pattern."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(basename(F.regexp_replace("path", r"/[^/]*$", "")).alias("name")).distinct()


def _text(xml: Column, *tags: str) -> Column:
    """Text of the first of the tags that is there, whatever its namespace."""
    found = [F.xpath_string(xml, F.lit(f"//*[local-name()='{t}'][1]")) for t in tags]
    return F.coalesce(*[F.when(x != "", x) for x in found])


def read_products(spark: SparkSession, root: str) -> DataFrame:
    """One row a product XML: name, product_id, times, spacings, tie points, ok and error.

    Files that can't be parsed keep their row, with ok false.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "product.xml").load(root)
    raw = files.select(basename(F.regexp_replace("path", r"/[^/]*$", "")).alias("name"), F.regexp_replace(F.decode("content", "UTF-8"), r'\sxmlns="[^"]*"', "").alias("xml"))
    sound = F.col("xml").rlike(r"(?s)<product[\s>].*</product>\s*$")
    held = raw.withColumn("ok", sound).withColumn("doc", F.when(sound, F.col("xml")).otherwise(F.lit("<product/>")))
    doc = F.col("doc")
    number = lambda *t: _text(doc, *t).try_cast("double") if hasattr(Column, "try_cast") else _text(doc, *t).cast("double")
    points = lambda tag: F.transform(F.xpath(doc, F.lit(f"//*[local-name()='imageTiePoint']//*[local-name()='{tag}']/text()")), lambda x: x.cast("double"))
    ties = F.arrays_zip(points("line").alias("line"), points("pixel").alias("pixel"), points("latitude").alias("lat"), points("longitude").alias("lon"))
    full = F.filter(ties, lambda p: p["line"].isNotNull() & p["pixel"].isNotNull() & p["lat"].isNotNull() & p["lon"].isNotNull())
    return held.select(
        "name", _text(doc, "productId").alias("product_id"), acquisition_time(_text(doc, "rawDataStartTime", "acquisitionStartTime", "sceneStartTime")).alias("acquired"),
        number("sampledPixelSpacing").alias("range_m"), number("sampledLineSpacing").alias("azimuth_m"), full.alias("tie_points"), "ok",
        F.when(~F.col("ok"), F.lit("product.xml can't be read")).alias("error"),
    )


def read_second_products(spark: SparkSession, root: str, block: int = 1) -> DataFrame:
    """One row a product XML of the second kind: files by pole, raster size, ids, pass direction, control points divided by the block size, and their extent."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "product.xml").load(root)
    doc = F.col("doc")
    raw = files.select(basename(F.regexp_replace("path", r"/[^/]*$", "")).alias("name"), F.regexp_replace(F.decode("content", "UTF-8"), r'\sxmlns="[^"]*"', "").alias("doc"))
    numbers = lambda tag: F.transform(F.xpath(doc, F.lit(f"//imageTiePoint//{tag}/text()")), lambda x: x.cast("double"))
    points = F.arrays_zip(F.transform(numbers("line"), lambda x: x / block).alias("line"), F.transform(numbers("pixel"), lambda x: x / block).alias("pixel"), numbers("latitude").alias("lat"), numbers("longitude").alias("lon"))
    names = F.arrays_zip(F.xpath(doc, F.lit("//fullResolutionImageData/@pole")).alias("pole"), F.xpath(doc, F.lit("//fullResolutionImageData/text()")).alias("file"))
    out = raw.select(
        "name", _text(doc, "productId").alias("product_id"), _text(doc, "productType").alias("product_type"), _text(doc, "passDirection").alias("pass_direction"),
        acquisition_time(_text(doc, "rawDataStartTime")).alias("started"), _text(doc, "numberOfLines").cast("int").alias("n_rows"), _text(doc, "numberOfSamplesPerLine").cast("int").alias("n_cols"),
        names.alias("files"), points.alias("points"),
    )
    side = lambda f, c: f(F.transform("points", lambda p: p[c]))
    return out.select("*", side(F.array_min, "lat").alias("lat_min"), side(F.array_max, "lat").alias("lat_max"), side(F.array_min, "lon").alias("lon_min"), side(F.array_max, "lon").alias("lon_max"))


def read_lut(spark: SparkSession, path: str) -> DataFrame:
    """index, gain, offset of a calibration table (lut/offset, lut/gains)."""
    xml = spark.read.format("binaryFile").load(path).select(F.decode("content", "UTF-8").alias("xml"))
    gains = F.split(F.trim(_text(F.col("xml"), "gains")), r"\s+")
    return xml.select(F.posexplode(gains).alias("index", "gain"), _text(F.col("xml"), "offset").cast("double").alias("offset")).withColumn("gain", F.col("gain").cast("double"))


def decode_png(data: bytes) -> tuple[int, int, bytes, int]:
    """Height, width, pixel bytes and channels of an 8-bit, non-interlaced PNG."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, palette, head = 8, b"", b"", None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = body
        elif kind == b"IDAT":
            packed += body
        at += size + 12
    width, height, depth, colour, _, _, laced = head
    if depth != 8 or laced:
        raise ValueError("only 8-bit PNGs without interlace are read")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw, step, above, rows = zlib.decompress(packed), width * channels, bytearray(width * channels), []
    for r in range(height):
        kind, line = raw[r * (step + 1)], bytearray(raw[r * (step + 1) + 1 : (r + 1) * (step + 1)])
        for i in range(step if kind else 0):
            a = line[i - channels] if i >= channels else 0
            b, c = above[i], above[i - channels] if i >= channels else 0
            if kind == 4:
                near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            else:
                near = (0, a, b, (a + b) // 2)[kind]
            line[i] = (line[i] + near) & 255
        rows.append(bytes(line))
        above = line
    pixels = b"".join(rows)
    if colour == 3:
        return height, width, b"".join(palette[3 * p : 3 * p + 3] for p in pixels), 3
    return height, width, pixels, channels


def encode_png(height: int, width: int, pixels: bytes, channels: int = 3) -> bytes:
    """An 8-bit PNG without filters."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    step = width * channels
    lines = b"".join(b"\x00" + pixels[r * step : (r + 1) * step] for r in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def read_annotations(spark: SparkSession, root: str, pattern: str = "custom_annotation.png", classes: int = 6) -> DataFrame:
    """scene, row, col, label of each annotation image: one row a pixel, 255 for other colours.

    Two classes (water and ice) give the binary labels.  Files that can't be decoded give no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    named = files.select(basename(F.regexp_replace("path", r"/[^/]*$", "")).alias("scene"), "content")

    def decode(batches):
        for frame in batches:
            for scene, content in zip(frame["scene"], frame["content"], strict=True):
                try:
                    height, width, pixels, channels = decode_png(bytes(content))
                except (ValueError, KeyError, TypeError, struct.error, zlib.error):
                    continue
                for r in range(height):
                    line = pixels[r * width * channels : (r + 1) * width * channels]
                    red = list(line[0::channels])
                    green, blue = (list(line[1::channels]), list(line[2::channels])) if channels >= 3 else (red, red)
                    yield pd.DataFrame({"scene": scene, "row": r, "col": range(width), "red": red, "green": green, "blue": blue})

    rows = named.mapInPandas(decode, "scene string, row int, col int, red int, green int, blue int")
    return rows.select("scene", "row", "col", colour_class(F.col("red"), F.col("green"), F.col("blue"), classes).alias("label"))


def scene_status(products: DataFrame, annotated: DataFrame) -> DataFrame:
    """name, ok, error: products that can't be read or have no annotation are told apart, none is dropped."""
    held = annotated.select(F.col("scene").alias("name")).distinct().withColumn("annotated", F.lit(True))
    found = products.join(held, "name", "left")
    error = F.coalesce("error", F.when(F.col("annotated").isNull(), F.lit("no annotation")))
    return found.select("name", error.isNull().alias("ok"), error.alias("error"))


