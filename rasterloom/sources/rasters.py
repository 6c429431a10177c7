"""TIFF rasters and polygon shapefiles, read through Spark's binary reader."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.names import basename

# TIFF tags and field sizes.
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _OFFSETS, _SAMPLES, _ROWS, _COUNTS, _PLANAR, _FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 339
_PREDICTOR, _TILE_WIDTH, _TILE_HEIGHT, _TILES, _TILE_COUNTS, _NODATA = 317, 322, 323, 324, 325, 42113
_FIELD = {1: ("B", 1), 2: ("c", 1), 3: ("H", 2), 4: ("I", 4), 12: ("d", 8), 16: ("Q", 8)}


def read_tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and tags of the first image of a TIFF."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF")
    at = struct.unpack(order + "I", data[4:8])[0]
    tags: dict[int, tuple] = {}
    for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        entry = data[at + 2 + 12 * i : at + 14 + 12 * i]
        tag, kind, n = struct.unpack(order + "HHI", entry[:8])
        if kind in _FIELD:
            code, size = _FIELD[kind]
            place = 8 if n * size <= 4 else None
            raw = entry[8 : 8 + n * size] if place else data[(p := struct.unpack(order + "I", entry[8:])[0]) : p + n * size]
            tags[tag] = struct.unpack(f"{order}{n}{code}", raw)
    return order, tags


def tiff_nodata(data: bytes) -> float | None:
    """The no-data value that a TIFF names, or None."""
    text = b"".join(read_tags(data)[1].get(_NODATA, ())).split(b"\0")[0].strip()
    return float(text) if text else None


def _unlzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; 256 empties the table, 257 ends."""
    start = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, last, out, held, bits = [*start], 9, b"", bytearray(), 0, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = [*start], 9, b""
            continue
        if code > len(table) or code == len(table) and not last:
            raise ValueError("broken LZW data")
        word = table[code] if code < len(table) else last + last[:1]
        if last:
            table.append(last + word[:1])
            width = min(12, (len(table) + 1).bit_length())
        out += word
        last = word
    return bytes(out)


_UNPACK = {1: bytes, 5: _unlzw, 8: zlib.decompress, 32946: zlib.decompress}


def decode_tiff(data: bytes) -> np.ndarray:
    """[bands, rows, cols] of a TIFF in strips or tiles of 8-, 16-, 32- or 64-bit samples: plain, LZW or deflated, with or without differences along rows.

    Strips and tiles without bytes are zero.
    """
    order, tags = read_tags(data)
    rows, cols, bands = tags[_HEIGHT][0], tags[_WIDTH][0], tags.get(_SAMPLES, (1,))[0]
    unpack = _UNPACK.get(tags.get(_COMPRESSION, (1,))[0])
    if unpack is None:
        raise ValueError("only plain, LZW and deflated TIFFs are read")
    kind = np.dtype({1: "u", 2: "i", 3: "f"}[tags.get(_FORMAT, (1,))[0]] + str(tags.get(_BITS, (8,))[0] // 8))
    predictor = tags.get(_PREDICTOR, (1,))[0]
    if predictor not in (1, 2) or predictor == 2 and kind.kind == "f":
        raise ValueError(f"predictor {predictor} is not read")
    tiled = _TILES in tags
    height, width = (tags[_TILE_HEIGHT][0], tags[_TILE_WIDTH][0]) if tiled else (min(tags.get(_ROWS, (rows,))[0], rows), cols)
    across, down = -(-cols // width), -(-rows // height)
    apart = tags.get(_PLANAR, (1,))[0] == 2
    depth = 1 if apart else bands
    out = np.zeros((bands, rows, cols), kind)
    places = zip(tags[_TILES if tiled else _OFFSETS], tags[_TILE_COUNTS if tiled else _COUNTS], strict=True)
    for i, (start, size) in enumerate(places):
        if not size:
            continue
        band, place = divmod(i, across * down)
        top, left = place // across * height, place % across * width
        held = height if tiled else min(height, rows - top)
        flat = np.frombuffer(unpack(data[start : start + size]), kind.newbyteorder(order), held * width * depth)
        block = flat.astype(kind).reshape(held, width, depth)[:, : cols - left][: rows - top]
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind)
        target = out[band : band + 1] if apart else out
        target[:, top : top + block.shape[0], left : left + block.shape[1]] = block.transpose(2, 0, 1)
    return out


def encode_tiff(image: np.ndarray) -> bytes:
    """A plain one-strip float32 TIFF with bands one after the other."""
    image = np.asarray(image, dtype="<f4")
    bands, rows, cols = image.shape
    body = image.tobytes()
    size = rows * cols * 4
    lists = struct.pack(f"<{bands}I", *[8 + i * size for i in range(bands)]) + struct.pack(f"<{bands}I", *[size] * bands)
    lists_at = 8 + len(body)
    one = lambda tag, v: struct.pack("<HHII", tag, 4, 1, v)
    many = lambda tag, i: struct.pack("<HHII", tag, 4, bands, lists_at + 4 * bands * i if bands > 1 else (8, size)[i])
    entries = [one(_WIDTH, cols), one(_HEIGHT, rows), one(_BITS, 32), one(_COMPRESSION, 1), many(_OFFSETS, 0), one(_SAMPLES, bands), one(_ROWS, rows), many(_COUNTS, 1), one(_PLANAR, 2), one(_FORMAT, 3)]
    return b"II*\x00" + struct.pack("<I", lists_at + len(lists)) + body + lists + struct.pack("<H", len(entries)) + b"".join(entries) + b"\x00" * 4


def read_pixels(spark: SparkSession, root: str, patterns: tuple[str, str] = ("*.img", "*.tif"), nodata: float | None = None) -> DataFrame:
    """product, row, col, hh, hv, error of two-band rasters; a product's .img is taken before its .tif.

    Missing pixels - those of value nodata, or of the one that the file names - are null.  A product whose raster is unreadable, doubled or not two-band has one row with an error.
    """
    held = None
    for rank, pattern in enumerate(patterns):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path").withColumn("rank", F.lit(rank))
        held = files if held is None else held.unionByName(files)
    named = held.withColumn("product", basename(F.regexp_replace("path", r"/[^/]*$", "")))
    chosen = named.groupBy("product", "rank").agg(F.count("*").alias("n"), F.min("path").alias("path")).groupBy("product").agg(F.min(F.struct("rank", "n", "path")).alias("f"))
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{img,tif}").load(root).select("path", "content")
    files = chosen.select("product", "f.path", "f.n").join(content, "path")

    def decode(batches):
        for frame in batches:
            for product, n, body in zip(frame["product"], frame["n"], frame["content"], strict=True):
                try:
                    if n > 1:
                        raise ValueError(f"{n} rasters of one kind")
                    image = decode_tiff(bytes(body)).astype(float)
                    missing = tiff_nodata(bytes(body)) if nodata is None else nodata
                    if image.shape[0] != 2:
                        raise ValueError(f"{image.shape[0]} bands")
                except (ValueError, KeyError, IndexError, ZeroDivisionError, struct.error, zlib.error) as e:
                    yield pd.DataFrame({"product": [product], "row": [None], "col": [None], "hh": [None], "hv": [None], "error": [f"{type(e).__name__}: {e}"]})
                    continue
                if missing is not None:
                    image[image == missing] = np.nan
                for r in range(image.shape[1]):  # a row of the raster at a time
                    yield pd.DataFrame({"product": product, "row": r, "col": range(image.shape[2]), "hh": image[0, r], "hv": image[1, r], "error": None})

    rows = files.select("product", "n", "content").mapInPandas(decode, "product string, row int, col int, hh double, hv double, error string")
    return rows.withColumns({b: F.when(~F.isnan(b), F.col(b)) for b in ("hh", "hv")})


def decode_shapes(data: bytes) -> list[tuple[int, int, int, float, float, float, float]]:
    """(polygon, ring, seq, x1, y1, x2, y2) of the edges of a polygon shapefile."""
    if struct.unpack(">i", data[:4])[0] != 9994:
        raise ValueError("not a shapefile")
    at, out, number = 100, [], 0
    while at + 8 <= len(data):
        size = struct.unpack(">i", data[at + 4 : at + 8])[0] * 2
        body, at = data[at + 8 : at + 8 + size], at + 8 + size
        if len(body) >= 44 and struct.unpack("<i", body[:4])[0] in (5, 15, 25):
            parts, points = struct.unpack("<ii", body[36:44])
            first = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
            xy = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
            for ring in range(parts):
                for seq, i in enumerate(range(first[ring], first[ring + 1] - 1)):
                    out.append((number, ring, seq, *xy[2 * i : 2 * i + 4]))
        number += 1
    return out


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """file, poly, ring, seq, x1, y1, x2, y2 of the edges of polygon shapefiles."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path)

    def decode(batches):
        for frame in batches:
            for name, body in zip(frame["path"], frame["content"], strict=True):
                edges = pd.DataFrame(decode_shapes(bytes(body)), columns=["poly", "ring", "seq", "x1", "y1", "x2", "y2"])
                yield edges.assign(file=name)[["file", "poly", "ring", "seq", "x1", "y1", "x2", "y2"]]

    return files.select("path", "content").mapInPandas(decode, "file string, poly int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
