"""Language of words and texts by a linear-chain conditional random field.

Every word has a score for each language: a sum of learned weights of its hashed features
(prefixes and suffixes of one to three bytes, all 2- and 3-byte n-grams with word edges, and the
whole word as a lexicon entry).  Learned transitions couple neighbouring words.
Forward-backward gives each word's posterior over the languages, so words of code-switched
text get labels of their own; a text's language is the one with the largest sum of posteriors
over words with letters, and its score the mean posterior of that language.

Training uses a bounded sample of labelled rows: about `TRAIN_DOCS` different ones a language, at most
twice as many, chosen by a hash of id and text; a text over `TRAIN_CHARS` characters lends a stretch
of that length, from a place chosen by the hash.  The sample is cut into chains, all of which
are used; some chains join stretches of two languages, from which the transitions learn that
switches are possible but rare.  Steps follow the exact gradient of the likelihood, for the
weights and the transitions (expected neighbour pairs come from the same forward-backward pass).
The model takes 256 KB a language, and the languages of the labels are taken to be few.

Prediction reads every text whole.  Forward-backward runs over blocks of words: the product of
a block's transfer matrices carries the state across it, so all blocks of a slice advance
together and the result is that of the plain recursion.

Defined results.  Null, empty or letterless texts: language `und`, score 0.  Without any labelled
row every text is `und`.  A single learned language is predicted with score 1.  Repeated rows get
equal results, and count once in training.  Equal sums: the first language by name.  A text of any
length is read whole, by itself if it is longer than a slice.  Columns other than doc_id and text
are ignored in prediction, whatever their names; `keep_known` returns all columns as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rasterloom.llm import textscan
from rasterloom.llm.textscan import U64

UNKNOWN = "und"
BUCKETS = 1 << 16
TRAIN_DOCS = 400
TRAIN_CHARS = 20_000
CHAIN = 32
EPOCHS = 2
BLOCK = 32


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # float32[BUCKETS, languages]
    transitions: np.ndarray  # float32[languages, languages], log


def _distinct_words(scan: textscan.Scan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and lexicon hash of one occurrence of each distinct word, and each word's index among them."""
    hashes = scan.word_hashes()
    _, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    return scan.start[first], scan.stop[first], hashes[first], index


def word_features(raw: np.ndarray, start: np.ndarray, stop: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all features of the words raw[start:stop], and the bounds of each word."""
    size = stop - start
    padded = size + 2
    bounds = np.append(0, np.cumsum(padded))
    inner = np.arange(bounds[-1]) - np.repeat(bounds[:-1], padded)
    code = np.full(bounds[-1], U64(0x632BE59BD9B4E019))  # a word edge
    body = (inner > 0) & (inner <= np.repeat(size, padded))
    place = (inner - 1 + np.repeat(start, padded))[body]
    lower = raw | np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))
    code[body] = textscan.BYTE_CODE[lower[place]]
    last = np.repeat(bounds[1:], padded)
    at = np.arange(bounds[-1])
    word = np.repeat(np.arange(len(size)), padded)
    parts, owners = [], []
    acc = code
    for n in (2, 3):
        acc = acc[:-1] * U64(0x9E3779B97F4A7C15) + code[n - 1 :]
        ok = at[: len(acc)] + n <= last[: len(acc)]
        parts.append(textscan.mix(acc[ok] + U64(n)))
        owners.append(word[: len(acc)][ok])
    for n in (1, 2, 3):
        own = np.flatnonzero(size >= n)
        head = np.zeros(len(own), U64)
        tail = np.zeros(len(own), U64)
        for i in range(n):
            head = head * U64(0x9E3779B97F4A7C15) + code[bounds[own] + 1 + i]
            tail = tail * U64(0x9E3779B97F4A7C15) + code[bounds[own + 1] - 1 - n + i]
        parts += [textscan.mix(head + U64(16 + n)), textscan.mix(tail + U64(32 + n))]
        owners += [own, own]
    parts.append(textscan.mix(lexicon + U64(64)))
    owners.append(np.arange(len(size)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(parts)[order] & U64(BUCKETS - 1)).astype(np.int64)
    return bucket, np.append(0, np.cumsum(np.bincount(owner, minlength=len(size))))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, bounds[:-1], axis=0) if len(bounds) > 1 else np.zeros((0, values.shape[1]), values.dtype)


def emissions(model: Model, scan: textscan.Scan) -> tuple[np.ndarray, np.ndarray]:
    """Scores [words, languages], and which words have a letter (an ASCII letter or a non-ASCII byte)."""
    start, stop, lexicon, index = _distinct_words(scan)
    bucket, bounds = word_features(scan.raw, start, stop, lexicon)
    scores = _sums(model.weights[bucket], bounds)
    lettered = (scan.raw >= 128) | ((scan.raw | 32) >= 97) & ((scan.raw | 32) <= 122)
    total = np.append(0, np.cumsum(lettered))
    has = total[stop] > total[start]
    scores[~has] = 0
    return scores[index], has[index]


def posteriors(scores: np.ndarray, transitions: np.ndarray, first: np.ndarray, block: int = BLOCK, pairs: bool = False):
    """Forward-backward over chains (chain c has words first[c]..first[c+1]): posteriors [words, languages].

    Before its first word a chain is in any state, all alike.  With pairs, also the expected number of
    transitions [languages, languages], those into the first words included.
    """
    words, k = scores.shape
    if not words:
        return (scores, np.zeros((k, k))) if pairs else scores
    a = np.exp(transitions - transitions.max()).astype(np.float64)
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    size = np.diff(first)
    own = np.flatnonzero(size)
    count = -(-size[own] // block)  # blocks of each chain
    lead = np.append(0, np.cumsum(count))
    chain = np.repeat(np.arange(len(own)), count)
    begin = first[:-1][own][chain] + (np.arange(lead[-1]) - lead[:-1][chain]) * block
    length = np.minimum(begin + block, first[1:][own][chain]) - begin
    step = [np.flatnonzero(length > i) for i in range(int(length.max()))]

    product = np.broadcast_to(np.eye(k), (len(begin), k, k)).copy()
    for i, live in enumerate(step):
        m = (product[live].reshape(-1, k) @ a).reshape(-1, k, k) * e[begin[live] + i][:, None, :]
        product[live] = m / m.max(axis=(1, 2), keepdims=True)
    enter = np.full((len(begin), k), 1.0 / k)  # state before a block's first transition
    leave = np.ones((len(begin), k))  # weight of what follows a block
    for i in range(1, int(count.max())):
        at = lead[:-1][count > i] + i
        v = np.einsum("bi,bij->bj", enter[at - 1], product[at - 1])
        enter[at] = v / v.sum(axis=1, keepdims=True)
        back = lead[1:][count > i] - 1 - i
        v = np.einsum("bij,bj->bi", product[back + 1], leave[back + 1])
        leave[back] = v / v.max(axis=1, keepdims=True)
    alpha = np.empty((words, k))
    state = enter
    for i, live in enumerate(step):
        v = (state[live] @ a) * e[begin[live] + i]
        v /= v.sum(axis=1, keepdims=True)
        alpha[begin[live] + i] = v
        state[live] = v
    entered = np.zeros((len(begin), k)) if pairs else None
    if pairs:  # the state before each block, which `state` has overwritten
        entered[:] = 1.0 / k
        inner = np.flatnonzero(begin > first[:-1][own][chain])
        entered[inner] = alpha[begin[inner] - 1]
    joint = np.zeros((k, k))
    gamma = np.empty((words, k)) if pairs else alpha
    for i in range(len(step) - 1, -1, -1):
        live = step[i]
        at = begin[live] + i
        ahead = e[at] * leave[live]
        g = alpha[at] * leave[live]
        gamma[at] = g / g.sum(axis=1, keepdims=True)
        if pairs:  # before(i) A(i, j) e(j) beta(j)
            before = alpha[at - 1] if i else entered[live]
            x = before[:, :, None] * a[None] * ahead[:, None, :]
            joint += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        v = ahead @ a.T
        leave[live] = v / v.max(axis=1, keepdims=True)
    return (gamma, joint) if pairs else gamma


def transition_gradient(transitions: np.ndarray, hit: np.ndarray, first: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Gradient of the chains' log-likelihood: observed less expected transitions; hit has a 1 for each word's own label."""
    inside = np.ones(len(hit), dtype=bool)
    starts = first[:-1][np.diff(first) > 0]
    inside[starts] = False
    at = np.flatnonzero(inside)
    a = np.exp(transitions - transitions.max()).astype(np.float64)
    into = a / a.sum(axis=0, keepdims=True) * hit[starts].sum(axis=0)  # from the unknown state before a first word
    return np.einsum("ni,nj->ij", hit[at - 1].astype(np.float64), hit[at].astype(np.float64)) + into - joint


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Maximum-likelihood weights by adaptive gradient steps over chains of labelled words."""
    languages = sorted(set(labels))
    k = len(languages)
    model = Model(languages, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32))
    if k < 2:
        return model
    held = []  # slice by slice, only compact features are kept
    for _, scan in textscan.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), "text"):
        start, stop, lexicon, index = _distinct_words(scan)
        bucket, bounds = word_features(scan.raw, start, stop, lexicon)
        held.append((lexicon, bucket.astype(np.int32), np.diff(bounds), lexicon[index], np.diff(scan.first)))
    lexicon, flat, size, sequence, count = (np.concatenate([h[i] for h in held]) for i in range(5))
    words, at = np.unique(lexicon, return_index=True)
    bounds = np.append(0, np.cumsum(size[at]))
    bucket = flat[np.arange(bounds[-1]) + np.repeat((np.cumsum(size) - size)[at] - bounds[:-1], size[at])].astype(np.int64)
    index, ends = np.searchsorted(words, sequence), np.append(0, np.cumsum(count))
    truth = np.repeat(np.array([languages.index(x) for x in labels]), count)
    rng = np.random.default_rng(seed)
    chains = [np.arange(lo, min(lo + CHAIN, hi)) for lo, hi in zip(ends[:-1], ends[1:], strict=True) for lo in range(lo, hi, CHAIN)]
    rng.shuffle(chains)
    for i in range(0, len(chains) - 1, 8):  # code-switched chains: two halves of others
        cut = int(rng.integers(4, CHAIN - 4))
        chains[i] = np.concatenate([chains[i][:cut], chains[i + 1][: CHAIN - cut]])
    squares_w, squares_t = np.full_like(model.weights, 1e-2), np.full_like(model.transitions, 1e-2)
    for _ in range(EPOCHS):
        rng.shuffle(chains)
        for lo in range(0, len(chains), 64):
            own = chains[lo : lo + 64]
            words = np.concatenate(own)
            first = np.append(0, np.cumsum([len(c) for c in own]))
            local, where = np.unique(index[words], return_inverse=True)
            n = bounds[local + 1] - bounds[local]
            edge = np.append(0, np.cumsum(n))
            feats = bucket[np.arange(edge[-1]) + np.repeat(bounds[local] - edge[:-1], n)]
            scores = _sums(model.weights[feats], edge)[where]
            gamma, joint = posteriors(scores, model.transitions, first, pairs=True)
            hit = np.eye(k, dtype=np.float32)[truth[words]]
            delta = np.zeros((len(local), k), np.float32)
            np.add.at(delta, where, hit - gamma)
            touched, back = np.unique(feats, return_inverse=True)
            grad = np.zeros((len(touched), k), np.float32)
            np.add.at(grad, back, np.repeat(delta, n, axis=0))
            grad = grad / 64 - 1e-5 * model.weights[touched]
            squares_w[touched] += grad**2
            model.weights[touched] += 0.2 * grad / np.sqrt(squares_w[touched])
            grad_t = transition_gradient(model.transitions, hit, first, joint) / 64
            squares_t += grad_t**2
            model.transitions += (0.1 * grad_t / np.sqrt(squares_t)).astype(np.float32)
    return model


def training_rows(labelled: DataFrame, per_language: int = TRAIN_DOCS) -> tuple[list[str], list[str]]:
    """A bounded sample of (text, lang) rows: about `per_language` different ones of each language, at most twice as many."""
    usable = labelled.where("lang is not null and text is not null and text <> ''").withColumn("key", F.xxhash64("doc_id", "text"))
    usable = usable.withColumn("place", F.pmod("key", F.lit(1 << 30)))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()}  # a row a language
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & (F.col("place") < int((1 << 30) * min(1.0, per_language / max(1, n)))))
    begin = F.pmod(F.shiftright("key", 32), F.greatest(F.lit(1), F.length("text") - TRAIN_CHARS + 1)).cast("int") + 1
    excerpt = F.when(F.length("text") > TRAIN_CHARS, F.substring("text", begin, F.lit(TRAIN_CHARS))).otherwise(F.col("text"))
    rows = usable.where(chosen).select("key", "place", "lang", excerpt.alias("text")).groupBy("lang", "key").agg(F.min("place").alias("place"), F.min("text").alias("text"))
    first = F.row_number().over(W.partitionBy("lang").orderBy("place", "key"))
    rows = rows.withColumn("first", first).where(F.col("first") <= 2 * per_language).select("place", "lang", "text").collect()
    rows = sorted((r["place"], r["lang"], r["text"]) for r in rows)
    return [r[2] for r in rows], [r[1] for r in rows]


def fit(labelled: DataFrame, per_language: int = TRAIN_DOCS) -> Model:
    return train(*training_rows(labelled, per_language))


def classify(model: Model, batch: pa.RecordBatch, text: str = "text"):
    """For each slice of the batch: the slice, language and score of each text, and word posteriors with their scan."""
    for part, scan in textscan.slices(batch, text):
        n, k = scan.texts, len(model.languages)
        names = np.full(n, UNKNOWN, dtype=object)
        score = np.zeros(n)
        gamma, has = np.zeros((0, k)), np.zeros(0, bool)
        if k and len(scan.start):
            values, has = emissions(model, scan)
            gamma = posteriors(values, model.transitions, scan.first) if k > 1 else np.ones((len(values), 1))
            row = scan.row_of_word()[has]
            total = np.stack([np.bincount(row, gamma[has, j], minlength=n) for j in range(k)], axis=1)
            words = np.bincount(row, minlength=n)
            own = np.flatnonzero(words)
            ascii_letter = np.append(0, np.cumsum(((scan.raw | 32) >= 97) & ((scan.raw | 32) <= 122)))
            plain = ascii_letter[scan.offsets[1:]] > ascii_letter[scan.offsets[:-1]]
            own = np.array([r for r in own if plain[r] or any(map(str.isalpha, scan.text_bytes(r).decode("utf-8", "replace")))], dtype=np.int64)
            if len(own):
                best = total[own].argmax(axis=1)
                names[own] = np.array(model.languages, dtype=object)[best]
                score[own] = np.minimum(1.0, total[own, best] / words[own])
        yield part, names, score, gamma, scan


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 256 KB a language

    def run(batches):
        for batch in batches:
            for part, names, score, _, _ in classify(shared.value, batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return textscan.bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def word_labels(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and, for each word of its text in order, the language with the largest posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, _, _, gamma, scan in classify(shared.value, batch):
                names = np.array(shared.value.languages, dtype=object)[gamma.argmax(axis=1)] if len(gamma) else np.full(len(scan.start), UNKNOWN, dtype=object)
                labels = textscan.list_column(pa.array(names, pa.string()), scan.first)
                yield pa.RecordBatch.from_arrays([part.column(0), labels], ["doc_id", "labels"])

    return textscan.bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, labels array<string>")


def held_out() -> F.Column:
    """Rows that are never learned from: crc32 of the id's text is divisible by 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_known(docs: DataFrame, least: float = 0.35) -> DataFrame:
    """The rows of docs whose language is known: not `und`, with a score of at least `least`.  Learns from docs' own labels."""
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, names, score, _, _ in classify(shared.value, batch):
                yield part.filter(pa.array((names != UNKNOWN) & (score >= least)))

    return textscan.bounded(docs).mapInArrow(run, docs.schema)
