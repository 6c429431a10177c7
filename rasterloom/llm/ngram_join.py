"""Near duplicates by n-gram Jaccard similarity: MinHash banding, then full n-gram sets.

1. Each text becomes its set of distinct 5-word shingles (64-bit hashes; words are maximal
   runs of characters other than 0x20 and 0x09-0x0D, unchanged; a text of one to four words
   is one shingle), a digest of that set, and MinHash values.  Texts with equal sets form a
   class, which takes part once.
2. The values are banded; `banding` chooses bands and rows for the target recall at the
   threshold.  Classes are shuffled on (band, hash) and linked to the smallest class of each
   bucket - one row for each member, never all pairs.  Components of these links hold every
   pair that shares a band.
3. The full shingle sets of a component that fits one block go to one task.  In a larger one, which
   may be a chain of unlike texts, the links to the buckets' smallest classes are verified first and
   closed into groups: a group's sets go to blocks of bounded size, every pair of blocks being
   one task, and beyond that only buckets in which groups meet are compared, each pair of classes
   in the first bucket that both share.  All similarities of a task are computed
   exactly as a matrix product and only counts and a spanning forest of the links leave it.
4. Components of the true links are the duplicate groups.

Rows are never dropped: a group with a third of all texts is spread over (m / block)^2 / 2 tasks.
Classes are told apart by 128 bits and the number of their shingles, and numbered from there on.

Defined results.  Texts that are null, empty or blank have no shingles: they link to nothing
and are classes of their own.  Repeated rows and repeated doc_ids count as copies.  Rows with
a null doc_id pass through with null columns.  Of rows equal in doc_id and text `keep_one` keeps the
one whose other columns, as text, have the smallest hash.  A text of any length takes part whole; one larger than a
block is a block of its own.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import keyfilter, textscan
from rasterloom.llm.components import connected_components
from rasterloom.llm.staging import staged
from rasterloom.llm.textscan import U64

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9995
HASHES = 128
BLOCK_SHINGLES = 400_000  # of one block: 3.2 MB of hashes
BLOCK_NODES = 2_048  # in one block: a pair of blocks gives a matrix of 32 MB
HUB_NODES = 1_024  # compared with one hub in a task
BROADCAST_UNITS = 100_000  # rows of 24 bytes


@lru_cache(maxsize=8)
def banding(threshold: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """The (bands, rows) of the most selective banding that finds a pair at the threshold with the recall."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        miss = 1 - threshold**rows
        bands = int(np.ceil(np.log(1 - recall) / np.log(miss))) if miss < 1 else hashes + 1
        if bands * rows <= hashes:
            best = (max(1, bands), rows)
    return best


def shingle_sets(scan: textscan.Scan, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within a text, and the bounds of each text."""
    words = scan.word_hashes()
    _, row, grams = textscan.word_windows(words, scan.first, size)
    counts = np.diff(scan.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        grams = np.append(grams, textscan.words_hash(words, scan.first[short], scan.first[short + 1]))
        row = np.append(row, short)
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[fresh], row[fresh]
    return grams, np.searchsorted(row, np.arange(scan.texts + 1))


def _names(grams: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over the distinct hashes of each set, which together name it."""
    if not len(begin):
        return np.zeros(0, U64), np.zeros(0, U64)
    return np.add.reduceat(grams, begin), np.add.reduceat(textscan.mix(grams ^ U64(0x2545F4914F6CDD1D)), begin)


def _signatures(size: int, bands: int, rows: int):
    seeds = textscan.mix(np.arange(1, bands * rows + 1, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)

    def run(batches):
        for batch in batches:
            for part, scan in textscan.slices(batch, "text"):
                grams, bounds = shingle_sets(scan, size)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                node, key = np.zeros(len(n), U64), np.zeros(len(n), U64)
                out = np.zeros((len(n), bands), U64)
                if len(full):
                    begin = bounds[:-1][full]
                    node[full], key[full] = _names(grams, begin)
                    for band in range(bands):
                        acc = np.full(len(full), band + 1, U64)
                        for seed in seeds[band * rows : band * rows + rows]:
                            low = np.minimum.reduceat(grams * seed, begin)
                            acc = textscan.mix(acc * U64(0x9E3779B97F4A7C15) + low)
                        out[full, band] = acc
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(n.astype(np.int64)), pa.array(textscan.signed(node)), pa.array(textscan.signed(key)),
                     textscan.list_column(textscan.signed(out.ravel()), np.arange(len(n) + 1) * bands)],
                    ["doc_id", "text_key", "n", "node", "key", "bands"],
                )

    return run


def _sets(size: int, wanted):
    def run(batches):
        keep = wanted.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            chosen = batch.filter(pa.array(keep.passes(ids)))
            for _, scan in textscan.slices(chosen, "text"):
                grams, bounds = shingle_sets(scan, size)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                node, key = _names(grams, bounds[:-1][full])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(n[full].astype(np.int64)), pa.array(textscan.signed(node)), pa.array(textscan.signed(key)), textscan.list_column(textscan.signed(grams), np.append(bounds[:-1][full], bounds[-1]))],
                    ["n", "node", "key", "grams"],
                )

    return run


def shared_counts(sets: list[np.ndarray], left: int) -> np.ndarray:
    """|A and B| for the first `left` sets against all of them, as products of 0/1 matrices over slices of the shingles."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[column] > 1  # others are shared with no one
    row, column = row[common], (np.cumsum(seen > 1) - 1)[column[common]]
    out = np.zeros((left, len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    columns = int(column[-1]) + 1 if len(column) else 0
    width = min(max(256, (1 << 22) // len(sets)), max(columns, 1))  # no more than there are: most blocks are a few texts
    for lo in range(0, columns, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        dense = np.zeros((len(sets), width), dtype=np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        out += dense[:left] @ dense.T
    return out


def _verify(threshold: float, batch: pa.Table) -> pa.Table:
    """Links within a block, or between two: counts for each class and a spanning forest of the links.

    A pair of blocks of which one is empty has none: those within the other are counted in its own task.
    In a bucket (band >= 0) only links between groups count, and only if no earlier band is shared.
    """
    batch = batch.combine_chunks().sort_by([("side", "ascending"), ("id", "ascending")])
    names = batch["id"].to_numpy()
    side = batch["side"].to_numpy()
    copies = batch["copies"].to_numpy().astype(np.float64)
    flat = batch["grams"].chunk(0) if batch["grams"].num_chunks else batch["grams"].combine_chunks()
    sets = [flat[i].values.to_numpy() for i in range(len(names))]
    split = bool(side[-1] != side[0])
    if not split and batch["p"][0] != batch["q"][0]:
        none = pa.array([], pa.int64())
        return pa.table({"id": none, "root": none, "links": none})
    left = int((side == side[0]).sum())
    shared = shared_counts(sets, left)
    sizes = np.array([len(s) for s in sets], dtype=np.float32)
    linked = shared >= threshold * (sizes[:left, None] + sizes[None, :] - shared) - 1e-4
    band = batch["band"][0].as_py()
    if band >= 0:
        group = batch["tight"].to_numpy()
        linked &= group[:left, None] != group[None, :]
        bands = np.array(batch["bands"].to_pylist(), dtype=np.int64)
        for earlier in range(band):
            linked &= bands[:left, earlier, None] != bands[None, :, earlier]
    if split:
        linked = linked[:, left:]
        found = np.concatenate([linked @ copies[left:], linked.T @ copies[:left]])
    else:
        np.fill_diagonal(linked, False)
        found = linked @ copies
    # Forest: from each unseen class, spread over its links.
    at = left if split else 0
    links = lambda i: np.flatnonzero(linked[i]) + at if i < left else np.flatnonzero(linked[:, i - at])
    group = np.arange(len(names))
    seen = np.zeros(len(names), dtype=bool)
    for root in range(len(names)):
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            near = links(todo.pop())
            near = near[~seen[near]]
            seen[near] = True
            group[near] = root
            todo.extend(near.tolist())
    return pa.table({"id": pa.array(names), "root": pa.array(names[group]), "links": pa.array(found.astype(np.int64))})


def _hub_links(threshold: float, batch: pa.Table) -> pa.Table:
    """The members of one hub's share that are linked to it."""
    hub = batch["hub"][0].as_py()
    names = batch["id"].to_numpy()
    flat = batch["grams"].combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    own = np.sort(flat[int(np.flatnonzero(names == hub)[0])].values.to_numpy())
    near = []
    for i in np.flatnonzero(names != hub):
        other = flat[int(i)].values.to_numpy()
        place = np.minimum(np.searchsorted(own, other), len(own) - 1)
        shared = int((own[place] == other).sum())
        if shared >= threshold * (len(own) + len(other) - shared) - 1e-9:
            near.append(int(names[i]))
    return pa.table({"a": pa.array(near, pa.int64()), "b": pa.array([hub] * len(near), pa.int64())})


def _blocks(members: DataFrame, unit: list[str]) -> DataFrame:
    """members with blocks, the number of blocks that their unit's shingles and classes need.

    Units of several blocks are few, so they are broadcast after a check of their number, and the members of a hot unit stay where they are.
    """
    count = F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_NODES)).cast("int")
    several = staged(members.groupBy(*unit).agg(count.alias("blocks")).where("blocks > 1"), "blocks")
    several = F.broadcast(several) if several.count() <= BROADCAST_UNITS else several
    return members.join(several, unit, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))


UNIT = ["band", "component", "p", "q"]


def _paired(members: DataFrame) -> DataFrame:
    """A row for each member (band, component, blocks, id, n, copies, tight, bands) and each pair of blocks that its own is in."""
    dealt = members.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.select(
        "band", "component", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), F.col("own").alias("side"), "id", "copies", "tight", "bands"
    )


def _units(classes: DataFrame, stars: DataFrame, grams: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """The comparisons that hold every pair of classes which shares a band, each pair once: UNIT, side, id, copies, tight, bands."""
    plain = [F.lit(-1).alias("band"), "component", "blocks", "id", "copies", F.lit(None).cast("long").alias("tight"), F.lit(None).cast("array<long>").alias("bands")]
    sized = staged(_blocks(members, ["component"]), "sized")
    units = _paired(sized.where("blocks = 1").select(*plain))
    large = sized.where("blocks > 1").select("id", "n", "copies")
    if large.isEmpty():
        return units
    # Links to the buckets' smallest classes, verified and closed into groups.
    own = staged(stars.join(large.select(F.col("id").alias("a")), "a", "left_semi").distinct(), "stars")
    hubs = own.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count("*") / HUB_NODES).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")
    asked = own.select(F.col("a").alias("id"), F.col("b").alias("hub")).join(hubs, "hub").select("hub", share.alias("share"), "id")
    asked = asked.unionByName(hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("hub").alias("id")))
    true = asked.join(grams, "id").groupBy("hub", "share").applyInArrow(lambda t: _hub_links(threshold, t), "a long, b long")
    tight = connected_components(staged(true, "hub-links")).withColumnRenamed("node", "id").withColumnRenamed("component", "tight")
    large = staged(large.join(tight, "id", "left"), "large")
    groups = _blocks(large.where("tight is not null").withColumn("component", F.col("tight")), ["component"])
    large = large.withColumn("tight", F.coalesce("tight", "id"))
    units = units.unionByName(_paired(groups.select(*plain)))
    # Buckets in which groups meet.
    met = large.join(classes.select("id", "bands"), "id").select("id", "n", "copies", "tight", "bands", F.posexplode("bands").alias("band", "component"))
    mixed = met.groupBy("band", "component").agg(F.min("tight").alias("one"), F.max("tight").alias("other")).where("one <> other")
    met = _blocks(met.join(mixed.select("band", "component"), ["band", "component"]), ["band", "component"])
    return units.unionByName(_paired(met.select("band", "component", "blocks", "id", "copies", "tight", "bands")))


def _found(docs: DataFrame, threshold: float, size: int, recall: float) -> DataFrame:
    """For each row: doc_id, text_key (xxhash64 of its text), n shingles, cluster (null if it has no shingles), class_id, copy_of, n_links."""
    bands, rows = banding(threshold, recall)
    texts = textscan.bounded(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    signed = keyed.mapInArrow(_signatures(size, bands, rows), "doc_id long, text_key long, n long, node long, key long, bands array<long>")
    signed = staged(signed, "signatures")
    classes = signed.where("n > 0 and doc_id is not null").groupBy("n", "node", "key")
    classes = classes.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    classes = staged(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # the table fixes the numbers
    banded = classes.selectExpr("id", "posexplode(bands) as (band, hash)")
    hubs = banded.groupBy("band", "hash").agg(F.min("id").alias("hub"), F.count("*").alias("members")).where("members > 1")
    stars = banded.join(hubs.select("band", "hash", "hub"), ["band", "hash"]).where("id <> hub").selectExpr("id as a", "hub as b")
    stars = staged(stars.distinct(), "candidates")
    candidates = connected_components(stars).withColumnRenamed("node", "id")
    members = staged(candidates.join(classes.select("id", "n", "node", "key", "rep", "copies"), "id"), "members")
    wanted = docs.sparkSession.sparkContext.broadcast(keyfilter.build(members, "rep"))  # 32 MB at most
    grams = texts.where("doc_id is not null and text is not null").mapInArrow(_sets(size, wanted), "n long, node long, key long, grams array<long>")
    grams = staged(grams.join(members.select("id", "n", "node", "key"), ["n", "node", "key"]).dropDuplicates(["id"]).select("id", "grams"), "sets")
    units = _units(classes, stars, grams, members.select("id", "n", "copies", "component"), threshold)
    found = units.join(grams, "id").groupBy(*UNIT).applyInArrow(lambda t: _verify(threshold, t), "id long, root long, links long")
    found = staged(found, "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("id <> root").selectExpr("id as a", "root as b")).withColumnRenamed("node", "id")

    known = classes.select("n", "node", "key", "id", "rep", "copies").join(counts, "id", "left").join(groups, "id", "left")
    known = known.withColumn("cluster", F.coalesce("component", "id"))
    known = known.join(known.groupBy("cluster").agg(F.min("rep").alias("least")), "cluster")
    out = signed.drop("bands").withColumn("n", F.when(F.col("doc_id").isNotNull(), F.col("n")))
    return out.join(known, ["n", "node", "key"], "left").selectExpr(
        "doc_id", "text_key", "n", "cluster",
        "coalesce(least, doc_id) as class_id",
        "coalesce(rep, doc_id) as copy_of",
        "if(doc_id is null, null, coalesce(links, 0) + coalesce(copies, 1) - 1) as n_links",
    )


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """One row for each row of docs: doc_id, class_id, copy_of, n_links.

    copy_of: smallest doc_id with the same shingle set.  class_id: smallest doc_id that a chain of
    links (similarity >= threshold) leads to.  n_links: other rows with such a similarity.
    """
    return _found(docs, threshold, size, recall).select("doc_id", "class_id", "copy_of", "n_links")


def classes(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text) and class_id of each different row of docs; a row with a null doc_id goes by its text_key."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("doc_id"), "text")
    return _found(rows, threshold, size, recall).select("doc_id", "text_key", "class_id").dropDuplicates(["doc_id", "text_key"])


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """The rows of docs without near duplicates: one row of each group stays, that with the smallest doc_id.

    Rows without words or with a null doc_id all stay.  The columns are those of docs.

    Texts hardly move: a filter of the ids that may lose a row lets most rows stay where they are, a second
    one of the kept ids that the first passes lets most others go, and only what passes both is joined.
    """
    found = _found(docs.select("doc_id", "text"), threshold, size, recall).where("cluster is not null")
    found = staged(found.select("doc_id", "text_key", "cluster", "class_id"), "found")
    first = found.groupBy("cluster").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    first = staged(first.selectExpr("first.doc_id as _id", "first.text_key as _key"), "first")
    again = found.where("doc_id = class_id").groupBy("doc_id").count().where("count > 1")
    unsure = found.where("doc_id <> class_id").select("doc_id").unionByName(again.select("doc_id")).distinct()
    unsure = _passes(unsure, "doc_id")
    likely = _passes(first.where(unsure("_id")), "_id")

    bare = F.col("doc_id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # 0: stays, 1: must be looked up, 2: goes.
    fate = F.when(bare | ~unsure("doc_id"), 0).when(likely("doc_id"), 1).otherwise(2)
    own = [F.col(c).alias(f"own_{i}") for i, c in enumerate(docs.columns)]
    as_docs = [F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)]
    judged = docs.select(*own, fate.alias("_fate"), F.col("doc_id").cast("long").alias("_id"), "text")
    other = F.xxhash64(*[F.col(f"own_{i}").cast("string") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")], F.lit(0))
    rest = judged.where("_fate = 1").withColumns({"_key": F.xxhash64("text"), "_other": other}).join(first, ["_id", "_key"])
    once = rest.groupBy("_id", "_key").agg(F.min("_other").alias("_other"))
    once = rest.join(once, ["_id", "_key", "_other"]).dropDuplicates(["_id", "_key"])
    return judged.where("_fate = 0").select(*as_docs).unionByName(once.select(*as_docs))


def _passes(keys: DataFrame, column: str):
    """A test of a column of ids against the filter of the keys, 32 MB at most; null passes as 0 does."""
    held = keys.sparkSession.sparkContext.broadcast(keyfilter.build(keys, column))

    @F.arrow_udf("boolean")
    def passes(ids: pa.Array) -> pa.Array:
        return pa.array(held.value.passes(ids.to_numpy(zero_copy_only=False)))

    return lambda c: passes(F.coalesce(F.col(c).cast("long"), F.lit(0)))
