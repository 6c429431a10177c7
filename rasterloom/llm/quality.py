"""Text quality from a weak-label model and a hashed linear scorer.

1. Heuristic labellers look at each whole text and vote good (1), bad (0) or abstain (-1).
2. The votes of all documents are counted by pattern (at most 3**labellers patterns), and
   expectation-maximisation on these counts estimates each labeller's accuracy and the share of
   good texts, assuming labellers err independently given the label.  No labels are used.
3. The posterior labels of a bounded sample (about `TRAIN_DOCS` different documents, at most twice as
   many, chosen by a hash of id and text; texts over `TRAIN_CHARS` characters are passed over) train a
   linear scorer over hashed features: the words and the shares and shapes of characters, words and lines.
4. The scorer reads every text whole.

Defined results.  Null, empty and blank texts: score 0, not kept.  Without any document that
votes differ on, or without a sample, the score is the posterior of the votes.  Repeated rows
get equal results, and count once in training.  A text of any length is read whole, by itself if it is
longer than a slice.  Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import sampling, textscan
from rasterloom.llm.textscan import U64

BUCKETS = 1 << 14
TRAIN_DOCS = 4_000
TRAIN_CHARS = 20_000
ROUNDS = 100
EPOCHS = 12
LABELLERS = (
    "symbols", "symbol_words", "digits", "capitals", "repeated_lines", "stutter", "repeated_pairs", "repeated_words",
    "word_length", "function_words", "sentences", "bars", "length",
)
STATS = (
    "words", "symbols", "digits", "capitals", "repeated_lines", "distinct", "word_length", "common", "sentences", "bars",
    "symbol_words", "stutter", "pairs",
)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~!"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!:"]] = True


def _inside(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    if not len(keys):
        return np.zeros(n)
    pairs = np.unique(textscan.mix(keys) ^ textscan.mix(row.astype(U64) + U64(1)), return_index=True)[1]
    return np.bincount(row[pairs], minlength=n).astype(np.float64)


def statistics(scan: textscan.Scan, words: np.ndarray) -> np.ndarray:
    """One row of STATS for each text."""
    n, raw, offsets = scan.texts, scan.raw, scan.offsets
    row = scan.row_of_word()
    count = np.diff(scan.first).astype(np.float64)
    some = np.maximum(count, 1)
    size = np.maximum(np.bincount(row, scan.stop - scan.start, minlength=n), 1)
    letters = np.maximum(_inside(_LETTER[raw], offsets), 1)
    # Lines are the stretches between line feeds; repeated ones are counted by their hashes.
    breaks = np.flatnonzero(raw == 10)
    edges = np.unique(np.concatenate([offsets, breaks + 1]))
    start, stop = edges[:-1], edges[1:]
    line_row = np.searchsorted(offsets, start, side="right") - 1
    first, last = np.searchsorted(scan.start, start), np.searchsorted(scan.start, stop)
    line_row, first, last = line_row[last > first], first[last > first], last[last > first]
    lines = np.bincount(line_row, minlength=n).astype(np.float64)
    line_hash = textscan.words_hash(words, first, last)
    last_byte = raw[scan.stop - 1] if len(scan.stop) else np.zeros(0, np.uint8)
    length = scan.stop - scan.start
    at, pair_row, pair = textscan.word_windows(words, scan.first, 2)
    at = at.astype(np.int64)
    pairs = np.maximum(np.bincount(pair_row, minlength=n), 1)
    return np.stack(
        [
            count,
            _inside(_SYMBOL[raw], offsets) / size,
            _inside(_DIGIT[raw], offsets) / size,
            _inside(_UPPER[raw], offsets) / letters,
            1 - _distinct(line_hash, line_row, n) / np.maximum(lines, 1),
            _distinct(words, row, n) / some,
            size / some,
            np.bincount(row, length <= 3, minlength=n) / some,
            np.bincount(row, _STOP[last_byte], minlength=n) / some,
            np.bincount(row, (length == 1) & _SYMBOL[last_byte], minlength=n) / some,
            np.bincount(row, _SYMBOL[last_byte], minlength=n) / some,
            np.bincount(pair_row, words[at] == words[at + 1], minlength=n) / pairs,
            np.where(count > 1, _distinct(pair, pair_row, n) / pairs, 1.0),
        ],
        axis=1,
    )


def votes(stats: np.ndarray) -> np.ndarray:
    """One vote (1 good, 0 bad, -1 abstain) of each labeller for each text."""
    s = {name: stats[:, i] for i, name in enumerate(STATS)}
    enough = s["words"] >= 20
    steady = (s["stutter"] <= 0.1) & (s["symbols"] <= 0.03)  # else shares of words say nothing good about a text
    clean = (s["symbols"] < 0.005) & (s["stutter"] < 0.02)
    no = np.zeros(len(stats), bool)  # a labeller that only knows signs of bad texts

    def vote(good, bad):
        return np.where(bad, 0, np.where(good, 1, -1))

    return np.stack(
        [
            vote(no, s["symbols"] > 0.03),
            vote(no, s["symbol_words"] > 0.08),
            vote(no, s["digits"] > 0.3),
            vote(no, s["capitals"] > 0.25),
            vote(no, s["repeated_lines"] > 0.4),
            vote(no, s["stutter"] > 0.1),
            vote(clean & enough & (s["pairs"] > 0.6), enough & (s["pairs"] < 0.4)),
            vote(no, enough & (s["distinct"] < 0.2)),
            vote(no, (s["word_length"] < 2.5) | (s["word_length"] > 9)),
            vote(steady & enough & (s["common"] > 0.15) & (s["common"] < 0.45), enough & (s["common"] < 0.1)),
            vote(steady & enough & (s["sentences"] > 0.02) & (s["sentences"] < 0.2), enough & ((s["sentences"] < 0.004) | (s["sentences"] > 0.5))),
            vote(no, s["bars"] > 0.1),
            vote((s["words"] >= 2) & clean & (s["capitals"] < 0.1), s["words"] < 1),
        ],
        axis=1,
    ).astype(np.int8)


@dataclass
class LabelModel:
    prior: float
    accuracy: np.ndarray  # share of each labeller's votes that are right

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        odds = np.log(self.prior / (1 - self.prior)) + ((patterns == 1) * 1.0 - (patterns == 0)) @ np.log(self.accuracy / (1 - self.accuracy))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many documents have each; a few votes' worth of prior keeps rare labellers sane."""
    model = LabelModel(0.7, np.full(patterns.shape[1], 0.85))
    if not len(patterns):
        return model
    for _ in range(rounds):
        p = model.posterior(patterns)
        right = (p * counts) @ (patterns == 1) + ((1 - p) * counts) @ (patterns == 0)
        total = counts @ (patterns >= 0)
        model = LabelModel(float(np.clip((p * counts).sum() / counts.sum(), 0.05, 0.95)), np.clip((right + 8.5) / (total + 10), 0.55, 0.98))
    return model


def features(scan: textscan.Scan, words: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bag of words, as (bucket of each word), and dense features of each text."""
    dense = np.concatenate([np.log1p(stats[:, :1]) / 10, np.minimum(stats[:, 1:6], 1), stats[:, 6:7] / 10, stats[:, 7:], (votes(stats) == 1), (votes(stats) == 0)], axis=1)
    return (textscan.mix(words) & U64(BUCKETS - 1)).astype(np.int64), dense


@dataclass
class Scorer:
    labels: LabelModel
    weights: np.ndarray | None = None  # of hashed words
    dense: np.ndarray | None = None
    bias: float = 0.0

    def score(self, scan: textscan.Scan) -> tuple[np.ndarray, np.ndarray]:
        """Score of each text, and the posterior of its votes."""
        words = scan.word_hashes()
        stats = statistics(scan, words)
        weak = self.labels.posterior(votes(stats))
        if self.weights is None:
            out = weak
        else:
            bucket, dense = features(scan, words, stats)
            mean = np.bincount(scan.row_of_word(), self.weights[bucket], minlength=scan.texts) / np.maximum(stats[:, 0], 1)
            out = 1 / (1 + np.exp(-np.clip(self.bias + mean + dense @ self.dense, -60, 60)))
        blank = stats[:, 0] == 0
        return np.where(blank, 0.0, out), np.where(blank, 0.0, weak)


def _patterns(batches):
    for batch in batches:
        for _, scan in textscan.slices(batch, "text"):
            v = votes(statistics(scan, scan.word_hashes()))
            code = (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))
            kinds, n = np.unique(code[np.diff(scan.first) > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], ["code", "n"])


def fit_labels(docs: DataFrame) -> LabelModel:
    """The label model of the votes of all documents."""
    rows = textscan.bounded(docs).select("text").mapInArrow(_patterns, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    code = np.array([r["code"] for r in rows], dtype=np.int64)
    patterns = (code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1).astype(np.int8)
    return estimate(patterns, np.array([r["n"] for r in rows], dtype=np.float64))


def train(texts: list[str], labels: LabelModel, seed: int = 5) -> Scorer:
    """Logistic regression against the posterior labels, by adaptive gradient steps."""
    scorer = Scorer(labels)
    parts = []  # slice by slice, only the compact features of a slice are kept
    for _, scan in textscan.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), "text"):
        words = scan.word_hashes()
        stats = statistics(scan, words)
        bucket, dense = features(scan, words, stats)
        parts.append((bucket.astype(np.int32), dense, labels.posterior(votes(stats)), np.diff(scan.first)))
    if not parts:
        return scorer
    bucket, dense, target, size = (np.concatenate([p[i] for p in parts]) for i in range(4))
    first = np.append(0, np.cumsum(size))
    own = np.flatnonzero(size)
    if len(own) < 20:
        return scorer
    w, d, b = np.zeros(BUCKETS), np.zeros(dense.shape[1]), 0.0
    sw, sd, sb = np.full(BUCKETS, 1e-3), np.full(dense.shape[1], 1e-3), 1e-3
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        rng.shuffle(own)
        for lo in range(0, len(own), 64):
            rows = own[lo : lo + 64]
            n = size[rows]
            at = np.append(0, np.cumsum(n))
            feats = bucket[np.arange(at[-1]) + np.repeat(first[rows] - at[:-1], n)]
            place = np.repeat(np.arange(len(rows)), n)
            z = b + np.bincount(place, w[feats], minlength=len(rows)) / n + dense[rows] @ d
            g = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target[rows]) / len(rows)
            gw = np.bincount(feats, (g / n)[place], minlength=BUCKETS) + 1e-5 * w
            gd, gb = dense[rows].T @ g + 1e-4 * d, g.sum()
            sw += gw**2
            sd += gd**2
            sb += gb**2
            w -= 0.3 * gw / np.sqrt(sw)
            d -= 0.3 * gd / np.sqrt(sd)
            b -= 0.3 * gb / np.sqrt(sb)
    scorer.weights, scorer.dense, scorer.bias = w, d, b
    return scorer


def fit(docs: DataFrame, sample: int = TRAIN_DOCS) -> Scorer:
    labels = fit_labels(docs)
    rows = sampling.different_texts(docs, sample, F.length("text") <= TRAIN_CHARS).select("place", "text").collect()
    return train([r["text"] for r in sorted(rows)], labels)


def score(docs: DataFrame, model: Scorer) -> DataFrame:
    """doc_id, score, weak_label (posterior of the votes) and keep (score of at least one half) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 128 KB

    def run(batches):
        for batch in batches:
            for part, scan in textscan.slices(batch, "text"):
                found, weak = shared.value.score(scan)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found), pa.array(weak), pa.array(found >= 0.5)], ["doc_id", "score", "weak_label", "keep"])

    return textscan.bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, score double, weak_label double, keep boolean")
