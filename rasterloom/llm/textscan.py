"""Vectorised word scanning and hashing over Arrow string columns.

A text is UTF-8 bytes; a word is a maximal run of bytes other than 0x20 and 0x09-0x0D
(none of which occurs inside a multi-byte UTF-8 sequence).  Work is done on slices of a
few hundred kilobytes of text, so the memory of a Python worker does not depend on the
number of rows in an Arrow batch; one text longer than a slice is handled alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 18
BATCH_BYTES = 4 << 20
U64 = np.uint64
_MUL_A, _MUL_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
# Two families of hashes; bases are odd, hence invertible modulo 2**64.
_BYTE_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD_BASE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * _MUL_A
    x = x ^ (x >> U64(27))
    x = x * _MUL_B
    return x ^ (x >> U64(31))


CODES = tuple(mix(np.arange(1, 257, dtype=U64) * U64(base)) for base in _BYTE_BASE)
BYTE_CODE = CODES[0]


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to size."""

    def run(b: int) -> np.ndarray:
        steps = np.full(size + 1, b, dtype=U64)
        steps[0] = 1
        return np.cumprod(steps, dtype=U64)

    return run(base), run(pow(base, -1, 1 << 64))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(1 << 16, 1 << int(n).bit_length()))


def prefix_hash(codes: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows, see :func:`stretch_hash`."""
    out = np.zeros(len(codes) + 1, dtype=U64)
    np.cumsum(codes * powers(base, len(codes))[0][: len(codes)], out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """A hash of codes[start:stop] that does not depend on where the stretch lies."""
    return mix((prefix[stop] - prefix[start]) * powers(base, len(prefix))[1][start])


@dataclass
class Scan:
    """Words of consecutive texts: word i is raw[start[i]:stop[i]]; text r has words first[r]..first[r+1]."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def word_hashes(self, family: int = 0) -> np.ndarray:
        base = _BYTE_BASE[family]
        return stretch_hash(prefix_hash(CODES[family][self.raw], base), self.start, self.stop, base)

    def text_bytes(self, row: int) -> bytes:
        return self.raw[self.offsets[row] : self.offsets[row + 1]].tobytes()


def bounded(frame: DataFrame) -> DataFrame:
    """The frame, in a session whose Arrow batches are small: a Python worker keeps what its largest batch took.

    Spark reads the setting when a frame runs, so it can't be put back here; one that the session
    has been given as small or smaller stays as it is.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = frame.sparkSession.conf.get(setting, "64MB").strip().lower()
    if not own.isdigit() or not 0 < int(own) <= BATCH_BYTES:
        frame.sparkSession.conf.set(setting, str(BATCH_BYTES))
    return frame


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls become empty texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def scan(raw: np.ndarray, offsets: np.ndarray) -> Scan:
    n = len(raw)
    solid = ~IS_SPACE[raw]
    inside = np.zeros(n + 1, dtype=bool)  # inside[i]: byte i continues the word of byte i - 1
    np.logical_and(solid[1:], solid[:-1], out=inside[1:n]) if n else None
    inside[offsets] = False
    start = np.flatnonzero(solid & ~inside[:n])
    stop = np.flatnonzero(solid & ~inside[1:]) + 1
    return Scan(raw, offsets, start, stop, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Scan]]:
    """The batch in consecutive parts of about `size` bytes of text, with their words."""
    raw, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    at, rows = 0, batch.num_rows
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        lo, hi = offsets[at], offsets[end]
        yield batch.slice(at, end - at), scan(raw[lo:hi], offsets[at : end + 1] - lo)
        at = end


def word_windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of `size` consecutive words of one text: (index of first word, text, hash)."""
    counts = np.diff(first)
    n = np.maximum(counts - size + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    begin = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[:-1][row]
    return begin, row, words_hash(hashes, begin, begin + size)


def words_hash(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of the word sequence hashes[start:stop] for each pair of bounds; hashes of the same family."""
    base = _WORD_BASE[family]
    return stretch_hash(prefix_hash(hashes, base), start, stop, base)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def list_column(flat: pa.Array | np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat if isinstance(flat, pa.Array) else pa.array(flat))
