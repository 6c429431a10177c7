"""TIFF layouts: strips and tiles, packings, differences along rows, the file's own no-data value."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from rasterloom.sources import rasters


def lzw(data: bytes) -> bytes:
    table = {bytes([i]): i for i in range(256)}
    bits, n, width, free, word = 256, 9, 9, 258, b""

    def put(code):
        nonlocal bits, n
        bits, n = bits << width | code, n + width

    for byte in data:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = free
        free += 1
        width = min(12, free.bit_length())
        word = bytes([byte])
        if free == 4094:
            put(table[word])
            put(256)
            table, width, free, word = {bytes([i]): i for i in range(256)}, 9, 258, b""
    if word:
        put(table[word])
        free += 1
        width = min(12, free.bit_length())
    put(257)
    pad = -n % 8
    return (bits << pad).to_bytes((n + pad) // 8, "big")


PACK = {1: bytes, 5: lzw, 8: zlib.compress}


def tiff(image, order="<", packing=1, tile=None, strip=3, apart=False, predictor=1, nodata=None) -> bytes:
    bands, rows, cols = image.shape
    height, width = tile or (strip, cols)
    blocks = []
    for part in [image[b : b + 1] for b in range(bands)] if apart else [image]:
        for top in range(0, rows, height):
            for left in range(0, cols, width):
                block = part[:, top : top + height, left : left + width]
                if tile:
                    block = np.pad(block, ((0, 0), (0, height - block.shape[1]), (0, width - block.shape[2])))
                block = block.transpose(1, 2, 0)
                if predictor == 2:
                    block = np.diff(block, axis=1, prepend=np.zeros_like(block[:, :1]))
                blocks.append(PACK[packing](np.ascontiguousarray(block).astype(image.dtype.newbyteorder(order)).tobytes()))
    body, starts = b"", []
    for block in blocks:
        starts.append(8 + len(body))
        body += block
    kind = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    tags = [(256, 4, [cols]), (257, 4, [rows]), (258, 3, [image.dtype.itemsize * 8] * bands), (259, 3, [packing]), (277, 3, [bands]), (284, 3, [1 + apart]), (317, 3, [predictor]), (339, 3, [kind] * bands)]
    tags += [(322, 4, [width]), (323, 4, [height]), (324, 4, starts), (325, 4, [len(b) for b in blocks])] if tile else [(273, 4, starts), (278, 4, [height]), (279, 4, [len(b) for b in blocks])]
    if nodata is not None:
        tags.append((42113, 2, [bytes([c]) for c in nodata.encode() + b"\0"]))
    entries = b""
    for tag, field, values in sorted(tags, key=lambda t: t[0]):
        raw = struct.pack(f"{order}{len(values)}{ {2: 'c', 3: 'H', 4: 'I'}[field] }".replace(" ", ""), *values)
        if len(raw) > 4:
            place, body = 8 + len(body), body + raw
            raw = struct.pack(order + "I", place)
        entries += struct.pack(order + "HHI", tag, field, len(values)) + raw.ljust(4, b"\0")
    head = {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 8 + len(body))
    return head + body + struct.pack(order + "H", len(entries) // 12) + entries + b"\0" * 4


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("packing", [1, 5, 8])
@pytest.mark.parametrize("tile", [None, (16, 16), (64, 32)])
@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("kind, predictor", [("u1", 1), ("u2", 2), ("i2", 1), ("f4", 1)])
def test_layouts(order, packing, tile, apart, kind, predictor):
    image = np.random.default_rng(7).integers(0, 100, (2, 37, 41)).astype(kind)
    assert np.array_equal(rasters.decode_tiff(tiff(image, order, packing, tile, apart=apart, predictor=predictor)), image)


def test_lzw_of_every_code_width():
    data = np.random.default_rng(3).integers(0, 7, 60_000).astype("u1").tobytes()
    assert rasters._unlzw(lzw(data)) == data
    assert rasters._unlzw(lzw(b"a" * 5000)) == b"a" * 5000
    with pytest.raises(ValueError):
        rasters._unlzw(bytes([0x80, 0x7F, 0xFF, 0xFF]))


def test_unread_kinds_say_so():
    image = np.ones((1, 4, 4), "f4")
    with pytest.raises(ValueError, match="predictor"):
        rasters.decode_tiff(tiff(image, predictor=2))


def test_nodata_of_the_file(spark, tmp_path):
    image = np.array([[[1.0, -9999.0], [3.0, 4.0]], [[5.0, 6.0], [-9999.0, 8.0]]], "f4")
    for product, value in (("named", "-9999"), ("silent", None)):
        (tmp_path / product).mkdir()
        (tmp_path / product / "a.tif").write_bytes(tiff(image, tile=(16, 16), packing=5, nodata=value))
    got = {(r["product"], r["row"], r["col"]): (r["hh"], r["hv"], r["error"]) for r in rasters.read_pixels(spark, str(tmp_path)).collect()}
    assert got["named", 0, 1] == (None, 6.0, None) and got["named", 1, 0] == (3.0, None, None)
    assert got["silent", 0, 1] == (-9999.0, 6.0, None)
    own = {(r["product"], r["row"], r["col"]): r["hh"] for r in rasters.read_pixels(spark, str(tmp_path), nodata=4.0).collect()}
    assert own["named", 1, 1] is None and own["named", 0, 1] == -9999.0
