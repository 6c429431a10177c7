"""Secret scan with built-in functions only: fixed patterns, and character Markov models.

Two first-order Markov models over the 67 key characters - of random strings and of ordinary
identifiers - are estimated from labelled samples: random strings drawn here from the usual key
alphabets, and ordinary words of a bounded number of different documents without pattern matches
(about `SAMPLE_DOCS`, chosen by a hash of id and text, at most twice as many), plain and joined to
identifiers.  Transitions that a sample lacks get what the character's own counts leave open (Witten-Bell),
by the counts of its kind (lower, upper, digit, sign), and `NOISE` of all transitions may be any, so that
no single one (as in `mail1` or `3D`) makes a secret.  A run of
key characters is a secret if the log-likelihood ratio of the two models exceeds `MARGIN`.  Runs
of any length are scored, but those so short that the model's largest ratios could not
add up to the margin.  Such spans (kind `markov`) are added to those of the patterns unless they overlap one.

Positions come from splitting a text by a pattern: a match starts where the lengths of the pieces
and matches before it end.  They count code points, end exclusive.

All work is per row: nothing is shuffled but the sample and its few thousand pair counts.

Defined results.  Null and empty texts have no spans.  A text of any length is scanned whole; adding
up its spans takes time with the square of their number.  Rows are judged one by one, so
repeated rows and ids get equal results.  Without documents only the random sample speaks.  Other
columns are kept by `redact` and ignored by `find`, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import sampling

SAMPLE_DOCS = 2_000
MARGIN = 12.0
NOISE = 0.02
KINDS = ("assign", "access", "hex", "markov")
# The patterns of the base kinds; each letter of a keyword in either case.
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in _KEYWORDS)
ASSIGN = rf"({_EITHER})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"  # runs are maximal, so the lengths can be asked for within the pattern
HEX = r"[0-9a-f]{32,}"
CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_KIND_SIZES = (26, 26, 10, 5)
# Key alphabets that random strings use.
ALPHABETS = (
    "0123456789abcdef",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "abcdefghijklmnopqrstuvwxyz0123456789",
)


def random_pairs(seed: int = 11, strings: int = 4000, size: int = 40) -> np.ndarray:
    """Counts of character pairs in random strings over the key alphabets, all alphabets weighing the same."""
    rng, k = np.random.default_rng(seed), len(CHARACTERS)
    out = np.zeros((k, k))
    for alphabet in ALPHABETS:
        codes = np.array([CHARACTERS.index(c) for c in alphabet])[rng.integers(0, len(alphabet), (strings, size))]
        np.add.at(out, (codes[:, :-1].ravel(), codes[:, 1:].ravel()), 1)
    return out


def ordinary_pairs(docs: DataFrame, sample: int = SAMPLE_DOCS) -> np.ndarray:
    """Counts of character pairs in words of a bounded sample of documents without pattern matches, plain and joined to identifiers."""
    chosen = sampling.different_texts(docs, sample).repartition(32, "key")
    chosen = chosen.where(~(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX)))
    words = chosen.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{3,}"), F.lit(0))).alias("word")).groupBy("word").count()
    # Every word counts as it is, and as one part of snake_case, of CamelCase and of CONSTANT names.
    forms = F.array("word", F.concat(F.lit("_"), F.lower("word"), F.lit("_")), F.concat(F.initcap("word"), F.lit("A")), F.concat(F.lit("_"), F.upper("word"), F.lit("_")))
    text = words.select(F.explode(forms).alias("word"), "count")
    pairs = text.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"), "count")
    out = np.zeros((len(CHARACTERS),) * 2)
    for r in pairs.groupBy("pair").agg(F.sum("count").alias("count")).collect():  # len(CHARACTERS) squared at most
        out[CHARACTERS.index(r["pair"][0]), CHARACTERS.index(r["pair"][1])] = r["count"]
    return out


def transitions(pairs: np.ndarray) -> np.ndarray:
    """P(b | a) from counts: what a character's own counts leave open, as much as it has different successors, goes by kind."""
    kind = np.repeat(np.arange(len(_KIND_SIZES)), _KIND_SIZES)
    member = np.eye(len(_KIND_SIZES))[kind]
    kinds = member.T @ (pairs + 0.5) @ member
    of_kind = (kinds / kinds.sum(axis=1, keepdims=True) / np.array(_KIND_SIZES))[kind][:, kind]
    total, different = pairs.sum(axis=1, keepdims=True), (pairs > 0).sum(axis=1, keepdims=True) + 1
    return (1 - NOISE) * (pairs + different * of_kind) / (total + different) + NOISE / len(CHARACTERS)


def ratios(random: np.ndarray, ordinary: np.ndarray) -> list[float]:
    """log P(b | a) under the random model less that under the ordinary one, for each pair in order of CHARACTERS."""
    return np.log(transitions(random) / transitions(ordinary)).ravel().tolist()


def train(docs: DataFrame) -> list[float]:
    return ratios(random_pairs(), ordinary_pairs(docs))


def candidates(table: list[float]) -> str:
    """The pattern of the runs whose score can exceed the margin."""
    return rf"[A-Za-z0-9+/_=-]{{{int(MARGIN / max(max(table), 1e-9)) + 2},}}" if max(table) * 1e6 > MARGIN else r"[^\s\S]"


def _bind(value: Column, use) -> Column:
    """use(value) with value evaluated once, also where use has lambdas of its own."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def score(text: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a run of key characters."""
    values, k = F.split(F.lit(" ".join(map(repr, table))), " ").cast("array<double>"), len(CHARACTERS)  # folded to one literal

    def ratio(codes: Column) -> Column:
        pair = lambda i: F.get(codes, i - 1) * k + F.get(codes, i)
        return F.aggregate(F.sequence(F.lit(1), F.size(codes) - 1), F.lit(0.0), lambda acc, i: acc + F.get(values, pair(i)))

    # One character a code, bound once: the time is linear in the run's length.
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(CHARACTERS), c) - 1)
    return F.when(F.length(text) > 1, _bind(codes, ratio)).otherwise(0.0)


SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: str, keep: Column) -> Column:
    """Spans (start, kind number, end) of the matches of the pattern for which keep, an array, has true."""
    parts = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), keep.alias("keep"))
    empty = F.array().cast(SPANS)

    def fold(p: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(p["pieces"], i))
            end = begin + F.length(F.get(p["matches"], i))
            span = F.array(F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(F.get(p["keep"], i), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(p["matches"]) - 1), F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    return F.when(text.rlike(pattern), _bind(parts, fold)).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the three patterns by start, then kind."""
    long = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 8)
    always = lambda pattern: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: F.lit(True))
    assign = _spans(text, ASSIGN, "assign", long)
    return F.array_sort(F.concat(assign, _spans(text, ACCESS, "access", always(ACCESS)), _spans(text, HEX, "hex", always(HEX))))


def with_spans(docs: DataFrame, table: list[float]) -> DataFrame:
    """docs with base (spans of the patterns) and spans (all spans), by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    runs = candidates(table)
    likely = F.transform(F.regexp_extract_all(text, F.lit(runs), F.lit(0)), lambda w: score(w, table) > MARGIN)
    out = docs.withColumns({"base": base_spans(text), "likely": likely})
    markov = _spans(text, runs, "markov", F.col("likely"))
    markov = F.when(F.exists("likely", lambda x: x), markov).otherwise(F.array().cast(SPANS))
    free = F.filter(markov, lambda m: ~F.exists("base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])))
    return out.withColumn("spans", F.array_sort(F.concat("base", free))).drop("likely")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row; the model is trained on docs if none is given."""
    found = with_spans(docs.select("doc_id", "text"), table or train(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, table: list[float] | None = None, mark: str = "<secret>") -> DataFrame:
    """docs with each stretch of overlapping spans replaced by a mark, and n_chars brought up to date; null texts stay null."""
    names = [c for c in docs.columns if c not in ("text", "n_chars")]
    base = docs.withColumnsRenamed({c: f"own_{c}" for c in names})
    found = with_spans(base, table or train(docs))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        plain = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["out"], plain, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    out = found.withColumn("text", F.when(F.size("spans") > 0, done).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop("base", "spans").withColumnsRenamed({f"own_{c}": c for c in names}).select(*docs.columns)
