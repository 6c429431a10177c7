"""A filter of bounded size over 64-bit keys: it may pass a key that is absent, never stops one that is present.

It only spares rows a shuffle.  The exact joins that follow do not rely on it: beyond
`MAX_WORDS` it passes more keys than needed and the result stays the same.  Keys are dealt by
the part of the filter that they mark, so each part is made by one task and comes to the driver once:
32 MB at most in all, however many keys there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.textscan import U64, mix

MAX_WORDS = 1 << 22  # 32 MB
PART_WORDS = 1 << 16


def _place(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Which 64-bit word, and four bits in it, stand for each key."""
    h = mix(keys.view(U64) ^ U64(0x5851F42D4C957F2D))
    mask = np.zeros(len(h), dtype=U64)
    for shift in (0, 6, 12, 18):
        mask |= U64(1) << ((h >> U64(shift)) & U64(63))
    return ((h >> U64(32)) & U64(words - 1)).astype(np.int64), mask


class KeyFilter:
    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def passes(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, dtype=bool)
        word, mask = _place(keys, len(self.bits))
        return (self.bits[word] & mask) == mask


def build(keys: DataFrame, column: str) -> KeyFilter:
    """The filter over a long column; 16 bits a key up to 32 MB."""
    n = keys.count()
    words = min(MAX_WORDS, max(64, 1 << int(n // 4).bit_length()))
    part = min(words, PART_WORDS)

    def deal(batches):
        for batch in batches:
            word, _ = _place(batch.column(0).to_numpy(zero_copy_only=False), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((word // part).astype(np.int32))], ["key", "part"])

    def mark(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            word, mask = _place(batch.column(0).to_numpy(zero_copy_only=False), words)
            for p in np.unique(word // part):
                own = word // part == p
                np.bitwise_or.at(held.setdefault(int(p), np.zeros(part, dtype=U64)), word[own] % part, mask[own])
        for p, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["part", "bits"])

    dealt = keys.where(F.col(column).isNotNull()).select(F.col(column).cast("long").alias("key"))
    parts = words // part
    dealt = dealt.mapInArrow(deal, "key long, part int").repartition(parts, "part") if parts > 1 else dealt.withColumn("part", F.lit(0)).coalesce(1)
    out = np.zeros(words, dtype=U64)
    for row in dealt.mapInArrow(mark, "part int, bits binary").toLocalIterator():
        out[row["part"] * part : (row["part"] + 1) * part] = np.frombuffer(bytes(row["bits"]), dtype=U64)
    return KeyFilter(out)
