"""Benchmark decontamination by template windows, with built-in functions only.

A text becomes a template: numbers, names (capitalised words inside a sentence, not words in capitals) and units after
numbers turn into typed placeholders, other words are lower-cased and lose punctuation.  Windows
of `WINDOW` template words are hash-joined with those of the benchmark's items, so a question
that was re-parameterised still matches.  For windows with placeholders the slots are then
compared: along one alignment of document and item, a value of the item must stand for one
value of the document, and the other way round; alignments that break this don't count.

A document holds an item if it matches `LEAST` different windows of it (13 words in a row do),
or all windows of a shorter item.

Items with at most `LEAST` windows that count - short ones and those mostly of numbers and names - are
also searched literally, by their lower-cased words without punctuation: in windows of `WINDOW`
words, of which `LEAST` or all must match, or as a whole if they have fewer words.

Only the exploded windows meet the benchmark's, which are broadcast after a check of their
number (`BROADCAST_WINDOWS`; beyond it the join shuffles).  Nothing is grouped before the join,
so hot sources or passages cost no more than others.

Defined results.  Null and empty texts and items without words match nothing; template windows with under `LITERALS` ordinary words do not count
(items that have few others are found literally).  Rows with a null doc_id are not reported.  Repeated doc_ids are reported once.  Items of equal
text are each reported.  A text of any length is searched whole, in one row's arrays.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.staging import staged

WINDOW = 8
LITERALS = 4
LEAST = 6
BROADCAST_WINDOWS = 1_000_000
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"  # private-use characters
# Words read as units when they follow a number.
UNITS = (
    "km cm mm m kg mg g lb lbs oz ml l ft in mi s ms min mins h hr hrs hours hour minutes minute seconds second days day weeks week months "
    "month years year percent dollars dollar euros euro cents cent meters metres miles grams kilograms liters litres degrees mph kmh"
).split()


def _spaced(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _bare(text: Column) -> Column:
    """Lower case without punctuation, symbols and sentence marks; words apart by one space."""
    bare = F.regexp_replace(F.lower(text), r"[\p{P}\p{S}\x01]+", "")
    return F.trim(F.regexp_replace(bare, " +", " "))


def template(text: Column) -> Column:
    """The template of a text, words apart by one space."""
    units = "|".join(UNITS)
    out = F.regexp_replace(_spaced(text), r"[0-9]+([.,:/][0-9]+)*", NUMBER)
    numbered = F.regexp_replace(F.regexp_replace(out, f"{NUMBER}({units})\\b", NUMBER + UNIT), f"{NUMBER} ({units})\\b", f"{NUMBER} {UNIT}")
    out = F.when(F.contains(out, F.lit(NUMBER)), numbered).otherwise(out)
    out = F.regexp_replace(out, r"([.!?:]) (\p{Lu})", "$1 \x01$2")
    return _bare(F.regexp_replace(out, r" \p{Lu}[\p{Lu}'’-]*\p{Ll}[\p{L}'’-]*", f" {NAME}"))


def _words(text: Column) -> Column:
    return F.split(text, " ", -1)


def _windows(words: Column, size: int) -> Column:
    """Hash of each window of `size` words; none if there are fewer words.

    The word hashes are bound once, as the element of a one-element array: an expression used
    inside a lambda would be evaluated again for every window.
    """
    starts = F.sequence(F.lit(0), F.size(words) - size)
    bound = F.array(F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.get(F.transform(bound, lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))), F.lit(0))
    return F.when(F.size(words) >= size, windows)


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """hash, item_id, ip (index of the window), slots (placeholders in it), item_windows (windows that count)."""
    items = benchmark.where("text is not null").select("item_id", _words(template(F.col("text"))).alias("words"))
    windows = items.select("item_id", "words", F.posexplode(_windows(F.col("words"), size)).alias("ip", "hash"))
    held = F.slice("words", F.col("ip") + 1, size)
    slots = F.size(F.filter(held, lambda w: w.rlike(f"[{NUMBER}{NAME}{UNIT}]")))
    windows = windows.select("hash", "item_id", "ip", slots.alias("slots")).where(F.col("slots") <= size - LITERALS)
    total = windows.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    return windows.join(total, "item_id").select("hash", "item_id", "ip", "slots", "item_windows")


def _consistent(docs: DataFrame, benchmark: DataFrame, slotted: DataFrame, size: int) -> DataFrame:
    """The alignments (doc_id, item_id, shift) whose slot values map one to one."""
    words = lambda frame, name: frame.select(
        f"{name}_id", F.xxhash64("text").alias(f"{name}_key"), _words(template(F.col("text"))).alias(f"{name}_template"), _words(_bare(_spaced(F.col("text")))).alias(f"{name}_words")
    )
    own = docs.join(slotted.select("doc_id").distinct(), "doc_id", "left_semi")
    found = slotted.join(words(own, "doc"), "doc_id").join(words(benchmark.join(slotted.select("item_id").distinct(), "item_id", "left_semi"), "item"), "item_id")
    # Only the window's words travel on, and of those only the slots.
    held = lambda c, p: F.slice(c, F.col(p) + 1, size).alias(c)
    found = found.select("doc_id", "item_id", "doc_key", (F.col("dp") - F.col("ip")).alias("shift"), held("doc_words", "dp"), held("doc_template", "dp"), held("item_words", "ip"))
    zipped = F.explode(F.filter(F.arrays_zip("item_words", "doc_words", "doc_template"), lambda w: w["doc_template"].rlike(f"[{NUMBER}{NAME}{UNIT}]")))
    values = found.select("doc_id", "item_id", "doc_key", "shift", zipped.alias("w")).select("doc_id", "item_id", "doc_key", "shift", F.col("w.item_words").alias("a"), F.col("w.doc_words").alias("b")).distinct()
    each = values.groupBy("doc_id", "item_id", "doc_key", "shift").agg(F.count("*").alias("n"), F.countDistinct("a").alias("na"), F.countDistinct("b").alias("nb"))
    return each.where("n = na and n = nb").select("doc_id", "item_id", "shift").distinct()


def _literal(texts: DataFrame, items: DataFrame, windows: DataFrame, size: int, least: int) -> DataFrame | None:
    """doc_id, item_id, n_matched, n_windows by literal words, of the items with at most `least` template windows; None without such items."""
    many = windows.where(F.col("item_windows") > least).select("item_id").distinct()
    few = items.join(many, "item_id", "left_anti").select("item_id", _words(_bare(_spaced(F.col("text")))).alias("words"))
    few = few.where(F.array_join("words", "") != "").withColumn("width", F.least(F.size("words"), F.lit(size)))
    widths = sorted(r["width"] for r in few.select("width").distinct().collect())  # `size` rows at most
    if not widths:
        return None
    own = texts.select("doc_id", _words(_bare(_spaced(F.col("text")))).alias("words"))
    found = None
    for width in widths:
        wanted = few.where(F.col("width") == width).select("item_id", F.posexplode(_windows(F.col("words"), width)).alias("ip", "hash"))
        wanted = staged(wanted.join(wanted.groupBy("item_id").agg(F.countDistinct("ip").alias("item_windows")), "item_id"), "literal-windows")
        small = wanted.count() <= BROADCAST_WINDOWS
        held = own.select("doc_id", F.explode(_windows(F.col("words"), width)).alias("hash"))
        hits = held.join(F.broadcast(wanted) if small else wanted, "hash").select("doc_id", "item_id", "ip", "item_windows")
        found = hits if found is None else found.unionByName(hits)
    pairs = found.groupBy("doc_id", "item_id").agg(F.countDistinct("ip").alias("n_matched"), F.max("item_windows").alias("n_windows"))
    return pairs.where(F.col("n_matched") >= F.least(F.lit(least), F.col("n_windows")))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, least: int = LEAST) -> DataFrame:
    """doc_id, item_id, n_matched (windows of the item found), n_windows (windows of the item) of each item that a document holds."""
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null").dropDuplicates()
    windows = staged(item_windows(items, size), "item-windows")
    small = windows.count() <= BROADCAST_WINDOWS
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    own = texts.select("doc_id", _words(template(F.col("text"))).alias("words"))
    own = own.select("doc_id", F.posexplode(_windows(F.col("words"), size)).alias("dp", "hash"))
    hits = staged(own.join(F.broadcast(windows) if small else windows, "hash").drop("hash"), "hits")
    slotted = hits.where("slots > 0")
    good = hits.where("slots = 0").select("doc_id", "item_id", "ip", "item_windows")
    if not slotted.isEmpty():
        fine = _consistent(texts, items, slotted, size)
        slotted = slotted.withColumn("shift", F.col("dp") - F.col("ip")).join(fine, ["doc_id", "item_id", "shift"], "left_semi")
        good = good.unionByName(slotted.select("doc_id", "item_id", "ip", "item_windows"))
    pairs = good.groupBy("doc_id", "item_id").agg(F.countDistinct("ip").alias("n_matched"), F.max("item_windows").alias("n_windows"))
    pairs = pairs.where(F.col("n_matched") >= F.least(F.lit(least), F.col("n_windows")))
    literal = _literal(texts, items, windows, size, least)
    if literal is None:
        return pairs
    pairs = staged(pairs, "template-pairs")
    return pairs.unionByName(literal.join(pairs, ["doc_id", "item_id"], "left_anti").select(*pairs.columns))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose id is not reported as holding a benchmark item."""
    held = staged(contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(held, "doc_id", "left_anti").select(*docs.columns)
