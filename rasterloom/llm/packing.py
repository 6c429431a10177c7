"""Conflict-constrained best-fit packing of texts into sequences of a fixed number of words.

Documents over the capacity give full pieces and a rest; full pieces fill a bin each.  The rest
go, largest first, to the bin with the least residual that still holds them and has neither
their source nor their duplicate cluster: bins are ordered by residual, and the search goes from
the first one large enough to its successors until a compatible bin is found; if none is, a
bin is opened.  A bin carries its sources and clusters as bitmaps.

The corpus is dealt by a hash of the id into shards of about `SHARD` documents, so a hot
source or cluster is spread over all shards and each shard is packed by one task in bounded
memory.  Texts do not move: only (id, words, source, cluster) rows are shuffled; a table of
near-duplicate classes meets them there.

A source has one bit in a shard, a cluster one if it has several documents there.  Null
sources conflict with nothing.  The default cluster is the exact text.

Defined results.  Null, empty and blank texts have no words: bin, piece start and length are
null and 0, nothing is dropped.  Repeated rows are packed each; as copies they share no bin.
Equal lengths are placed by id, cluster and source.  A text of any length is cut into pieces.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import textscan

CAPACITY = 2048
SHARD = 8192
RESULT = "doc_id long, piece int, start long, n_words long, bin string, offset int"


def _words(batches):
    for batch in batches:
        for part, scan in textscan.slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(np.diff(scan.first).astype(np.int64))], ["doc_id", "source", "cluster", "n_words"])


def _bits(values: list, several: bool) -> list[int]:
    """A bit for each value (for those met several times, if asked); 0 for null."""
    counts: dict = {}
    for v in values:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    names = {v: 1 << i for i, v in enumerate(v for v, n in counts.items() if n > 1 or not several)}
    return [names.get(v, 0) for v in values]


def best_fit(sizes: list[int], conflicts: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, placed in the order given; conflicts are bitmaps."""
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[int] = []
    out = []
    for size, mask in zip(sizes, conflicts, strict=True):
        at = bisect_left(order, (size, -1))
        while at < len(order) and held[order[at][1]] & mask:
            at += 1
        if at < len(order):
            residual, own = order.pop(at)
        else:
            residual, own = capacity, len(held)
            held.append(0)
        held[own] |= mask
        out.append((own, capacity - residual))
        if residual > size:
            insort(order, (residual - size, own))
    return out


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        table = table.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
        ids, words = table["doc_id"].to_pylist(), table["n_words"].to_pylist()
        sources = _bits(table["source"].to_pylist(), False)
        clusters = _bits(table["cluster"].to_pylist(), True)
        width = max((s.bit_length() for s in sources), default=0)
        rest = sorted((i for i, n in enumerate(words) if n % capacity), key=lambda i: -(words[i] % capacity))
        placed = best_fit([words[i] % capacity for i in rest], [sources[i] | clusters[i] << width for i in rest], capacity)
        bins = max((b for b, _ in placed), default=-1) + 1
        spot = dict(zip(rest, placed, strict=True))
        rows = []
        for i, n in enumerate(words):
            for piece in range(n // capacity):
                rows.append((ids[i], piece, piece * capacity, capacity, f"{shard}-{bins}", 0))
                bins += 1
            if n % capacity:
                own, offset = spot[i]
                rows.append((ids[i], n // capacity, n - n % capacity, n % capacity, f"{shard}-{own}", offset))
            if not n:
                rows.append((ids[i], 0, 0, 0, None, None))
        names = ("doc_id", "piece", "start", "n_words", "bin", "offset")
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32())
        columns = zip(*rows, strict=True)
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=list(names))

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, cluster: str | None = None, classes: DataFrame | None = None) -> DataFrame:
    """One row for each piece of each row of docs: doc_id, piece, start and n_words (in words), bin, offset in the bin.

    classes (doc_id, text_key, class_id) names the clusters of the default ones' texts, as ngram_join.classes gives them.
    """
    shards = max(1, -(-docs.count() // shard))
    key = F.col(cluster).cast("string") if cluster else F.xxhash64("text").cast("string")
    rows = textscan.bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce("text", F.lit("")).alias("text"), key.alias("cluster"))
    rows = rows.mapInArrow(_words, "doc_id long, source string, cluster string, n_words long")
    if classes is not None:
        own = classes.select(F.col("doc_id").alias("_id"), F.col("text_key").cast("string").alias("cluster"), F.col("class_id").cast("string").alias("_class"))
        rows = rows.withColumn("_id", F.coalesce("doc_id", F.col("cluster").cast("long"))).join(own, ["_id", "cluster"], "left")
        rows = rows.select("doc_id", "source", F.coalesce("_class", "cluster").alias("cluster"), "n_words")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", F.lit(17)), F.lit(shards)).cast("int"))
    return rows.groupBy("shard").applyInArrow(_pack(capacity), RESULT)
