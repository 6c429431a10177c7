"""Removal of word spans that an earlier document already has (de Bruijn compaction).

Every window of `k` consecutive words is an edge of the de Bruijn graph whose nodes are the
(k-1)-word overlaps.  Each edge belongs to the smallest `m`-gram hash inside it; consecutive
edges of a document with the same smallest m-gram form a path, held as one row
(anchor, content, check, doc_id, start, n).  Equal edges have equal anchors, so

1. anchors met in one document only are dropped (one shuffle of path rows; a filter of bounded
   size keeps the others' paths out of later shuffles),
2. a path whose content is also in a smaller doc_id is settled whole: one join on the content
   settles all of its edges at once,
3. where an anchor has several contents, paths branch: those of each content's first document are
   taken apart into edges, which meet by edge.  The first document of an edge is also the first of
   the path around it, so no other copies are needed, however many there are,
4. a settled span carries the coordinates of its source (the first document that has it, and the word
   where it starts there) and the digest of the words found there; the words at its own place must
   have the same digest before they are cut.

Words decide through two independent hashes, content of 64 and check of 32 bits, taken together: keys
of joins and digests have 96 bits (among 1e13 different windows two collide with probability 0.0006),
and anchors, which have 64, only say where to look.

Hot passages: minima and maxima of paths are pre-aggregated before each shuffle; the rows of hot edges
are not shuffled, and the join on contents is a plain sort-merge join, whose skewed
partitions adaptive execution splits.

Defined results.  Null or empty text: no words, hash of the empty string.  Documents under k
words lose nothing.  Rows that repeat a doc_id are judged one by one: a span is cut only where
its content is found.  A null doc_id is neither source nor target.  A text of any length is read
whole, by itself if it is longer than a slice.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.llm import keyfilter, textscan
from rasterloom.llm.staging import staged
from rasterloom.llm.textscan import U64

WINDOW = 13
ANCHOR = 5
HOT_SHARE = 2_000
HOT_BUCKETS = 1 << 14
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width] for each i, by doubling."""
    size, out = 1, x
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Paths:
    """Edges of one slice of texts, and the runs of them that share an anchor; contents are cut to `bits` for tests of collisions."""

    def __init__(self, scan: textscan.Scan, k: int, m: int, bits: int = 64):
        self.scan, self.k, self.mask = scan, k, U64((1 << bits) - 1)
        self.hashes = scan.word_hashes()
        self.edge, self.row, _ = textscan.word_windows(self.hashes, scan.first, k)
        if not len(self.edge):
            self.start = self.stop = np.zeros(0, np.int64)
            return
        at = np.arange(max(len(self.hashes) - m + 1, 0))
        grams = textscan.words_hash(self.hashes, at, at + m)
        anchor = _sliding_min(grams, k - m + 1)[self.edge]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.row[1:] != self.row[:-1])
        self.start = np.flatnonzero(new)  # first edge of each path
        self.stop = np.append(self.start[1:], len(anchor))
        self.anchor = textscan.signed(anchor[self.start] & self.mask)
        self.first = scan.first

    def contents(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return textscan.signed(textscan.words_hash(self.hashes, first, stop) & self.mask)

    def digests(self, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """content and check of the words first..stop."""
        check = textscan.words_hash(self.scan.word_hashes(1), first, stop, 1) >> U64(32)
        return self.contents(first, stop), check.astype(np.uint32).view(np.int32)

    def words_of(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the words of the paths."""
        return self.edge[self.start[own]], self.edge[self.stop[own] - 1] + self.k

    def edges_of(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the edges of the paths, and the bounds of each path among them."""
        n = (self.stop - self.start)[own]
        bounds = np.append(0, np.cumsum(n))
        return np.arange(bounds[-1]) + np.repeat(self.start[own] - bounds[:-1], n), bounds


def _anchors(k: int, m: int, bits: int):
    def run(batches):
        for batch in batches:
            for part, scan in textscan.slices(batch, "text"):
                p = Paths(scan, k, m, bits)
                if len(p.start):
                    ids = part.column(0).take(pa.array(p.row[p.start]))
                    yield pa.RecordBatch.from_arrays([pa.array(p.anchor), ids], ["anchor", "doc_id"])

    return run


def _paths(k: int, m: int, bits: int, wanted):
    def run(batches):
        keep = wanted.value
        for batch in batches:
            for part, scan in textscan.slices(batch, "text"):
                p = Paths(scan, k, m, bits)
                own = np.flatnonzero(keep.passes(p.anchor)) if len(p.start) else p.start
                if not len(own):
                    continue
                start, row = p.start[own], p.row[p.start[own]]
                content, check = p.digests(*p.words_of(own))
                place = (p.edge[start] - p.first[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.anchor[own]), pa.array(content), pa.array(check), part.column(0).take(pa.array(row)), pa.array(place), pa.array((p.stop - p.start)[own].astype(np.int32))],
                    ["anchor", "content", "check", "doc_id", "start", "n"],
                )

    return run


def _edges(k: int, m: int, bits: int, branching, firsts):
    def run(batches):
        keep, first = branching.value, firsts.value
        for batch in batches:
            for part, scan in textscan.slices(batch, "text"):
                p = Paths(scan, k, m, bits)
                own = np.flatnonzero(keep.passes(p.anchor)) if len(p.start) else p.start
                if len(own):
                    ids = part.column(0).to_numpy(zero_copy_only=False)[p.row[p.start[own]]]
                    own = own[first.passes(p.contents(*p.words_of(own)) ^ ids)]
                if not len(own):
                    continue
                row = p.row[p.start[own]]
                edges, bounds = p.edges_of(own)
                content, check = p.digests(p.edge[edges], p.edge[edges] + k)
                place = (p.edge[p.start[own]] - p.first[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(place), textscan.list_column(content, bounds), textscan.list_column(check, bounds)], ["doc_id", "start", "contents", "checks"]
                )

    return run


def _heads(branching):
    """Content and first document of the paths that branch, in one number."""

    def run(batches):
        keep = branching.value
        for batch in batches:
            anchor, content, source = (batch.column(c).to_numpy() for c in ("anchor", "content", "source"))
            yield pa.RecordBatch.from_arrays([pa.array((content ^ source)[keep.passes(anchor)])], ["head"])

    return run


SPAN = ("doc_id", "start", "n", "content", "check", "source", "source_start")


def repeated_spans(docs: DataFrame, k: int = WINDOW, m: int = ANCHOR, bits: int = 64) -> DataFrame:
    """Spans whose every k-word window also starts in a document of smaller doc_id.

    doc_id, start (index of the first word), n (windows in a row), content and check (digest of the words at
    the source), source and source_start (the first document that has the span, and the word where it starts there).
    """
    spark = docs.sparkSession
    texts = textscan.bounded(docs).where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = texts.mapInArrow(_anchors(k, m, bits), "anchor long, doc_id long").groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    shared = staged(seen.where("lo < hi").select("anchor"), "anchors")
    wanted = spark.sparkContext.broadcast(keyfilter.build(shared, "anchor"))  # 32 MB at most
    paths = texts.mapInArrow(_paths(k, m, bits, wanted), "anchor long, content long, check int, doc_id long, start int, n int")
    paths = staged(paths, "paths")
    firsts = paths.groupBy("anchor", "content", "check").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("hi"), F.min_by("start", "doc_id").alias("source_start"))
    firsts = staged(firsts, "firsts")
    whole = paths.drop("anchor").join(firsts.where("source < hi").drop("anchor", "hi"), ["content", "check"]).where("doc_id > source").select(*SPAN)
    forks = firsts.groupBy("anchor").agg(F.min("source").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("contents")).where("lo < hi and contents > 1")
    branches = spark.sparkContext.broadcast(keyfilter.build(staged(forks.select("anchor"), "forks"), "anchor"))  # 32 MB at most
    heads = firsts.mapInArrow(_heads(branches), "head long")
    heads = spark.sparkContext.broadcast(keyfilter.build(staged(heads, "heads"), "head"))  # 32 MB at most
    arrays = staged(texts.mapInArrow(_edges(k, m, bits, branches, heads), "doc_id long, start int, contents array<long>, checks array<int>"), "edges")
    edges = arrays.select("doc_id", "start", F.posexplode(F.arrays_zip("contents", "checks")).alias("i", "e"))
    edges = edges.select("doc_id", (F.col("start") + F.col("i")).alias("start"), F.col("e.contents").alias("content"), F.col("e.checks").alias("check"))
    return whole.unionByName(_later(edges).withColumn("n", F.lit(1)).select(*SPAN))


def _later(rows: DataFrame) -> DataFrame:
    """The rows whose words also start in a smaller doc_id, with that source.

    Words with more than one in `HOT_SHARE` of the rows - fewer than `HOT_SHARE`, hence a bounded
    broadcast - are joined where their rows are; only the others are shuffled, once, and meet in a window.
    Hot words are counted exactly, but only where all the words of their bucket together are that many.
    """
    key = ["content", "check"]
    limit = rows.count() / HOT_SHARE
    bucket = F.pmod(F.col("content"), F.lit(HOT_BUCKETS)).cast("int")
    crowded = [r["bucket"] for r in rows.groupBy(bucket.alias("bucket")).count().where(F.col("count") > limit).select("bucket").collect()]  # fewer than HOT_SHARE
    first = rows.where(bucket.isin(crowded)).groupBy(*key).agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("rows"))
    hot = staged(first.where(F.col("rows") > limit).select(*key, F.col("first.doc_id").alias("source"), F.col("first.start").alias("source_start")), "hot")
    often = rows.join(F.broadcast(hot), key)
    alike = F.min(F.struct("doc_id", "start")).over(W.partitionBy(*key))
    others = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").withColumn("first", alike)
    others = others.select(*rows.columns, F.col("first.doc_id").alias("source"), F.col("first.start").alias("source_start"))
    return often.select(*others.columns).unionByName(others).where("doc_id > source")


def _untouched(touched):
    def run(batches):
        seen = touched.value
        for batch in batches:
            ids = batch.column(0)
            other = ids.is_null().to_numpy(zero_copy_only=False) | ~seen.passes(ids.fill_null(0).to_numpy(zero_copy_only=False))
            own = batch.filter(pa.array(other))
            words, digests = [], []
            for text in own.column(1):
                parts = (text.as_py() or "").encode().split()
                words.append(len(parts))
                digests.append(hashlib.sha256(b" ".join(parts)).hexdigest())
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(words, pa.int64()), pa.array([0] * len(words), pa.int64()), pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def _touched(touched):
    def run(batches):
        seen = touched.value
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(known & seen.passes(ids.fill_null(0).to_numpy(zero_copy_only=False))))

    return run


def _cut(k: int, keep_text: bool, bits: int):
    def run(batches):
        for batch in batches:
            rows = ([], [], [], [])
            spans = batch.column(2)
            for r in range(batch.num_rows):
                raw = (batch.column(1)[r].as_py() or "").encode()
                parts = raw.split()
                found = spans[r].values if spans[r].is_valid else None
                gone = np.zeros(len(parts) + 1, dtype=np.int64)
                if found is not None and len(found):
                    start = found.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
                    stop = start + found.field("n").to_numpy(zero_copy_only=False) + k - 1
                    inside = stop <= len(parts)
                    start, stop = start[inside], stop[inside]
                    data = np.frombuffer(raw, np.uint8)
                    own = Paths(textscan.scan(data, np.array([0, len(data)])), k, k, bits).digests(start, stop)
                    at_source = [found.field(c).to_numpy(zero_copy_only=False)[inside] for c in ("content", "check")]
                    good = (own[0] == at_source[0]) & (own[1] == at_source[1])
                    np.add.at(gone, start[good], 1)
                    np.add.at(gone, stop[good], -1)
                cut = np.cumsum(gone[:-1]) > 0
                kept = b" ".join([w for w, c in zip(parts, cut.tolist(), strict=True) if not c]) if cut.any() else b" ".join(parts)
                for column, value in zip(rows, (len(parts), int(cut.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string())] + ([pa.array(rows[3], pa.string())] if keep_text else []),
                ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text,
            )

    return run


def _with_spans(texts: DataFrame, k: int, m: int, bits: int = 64) -> DataFrame:
    spans = repeated_spans(texts, k, m, bits)
    return staged(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "content", "check")).alias("spans")), "spans")


def deduplicate(docs: DataFrame, k: int = WINDOW, m: int = ANCHOR, bits: int = 64) -> DataFrame:
    """doc_id and kept_text: each document's words, joined by one space, without its repeated spans."""
    texts = textscan.bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = texts.join(_with_spans(texts, k, m, bits), "doc_id", "left").select("doc_id", "text", "spans")
    return cut.mapInArrow(_cut(k, True, bits), RESULT + ", kept_text string").select("doc_id", "n_words", "n_removed", "kept_text")


def digest(docs: DataFrame, k: int = WINDOW, m: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document.

    Only the texts of documents that have spans are shuffled; the others' are digested where they are read.
    """
    texts = textscan.bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = _with_spans(texts, k, m)
    touched = docs.sparkSession.sparkContext.broadcast(keyfilter.build(spans, "doc_id"))  # 32 MB at most
    plain = texts.mapInArrow(_untouched(touched), RESULT)
    own = texts.mapInArrow(_touched(touched), "doc_id long, text string")
    cut = own.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_cut(k, False, 64), RESULT)
    return plain.unionByName(cut)
