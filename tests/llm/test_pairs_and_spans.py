"""N-gram join, substring removal, components and the key filter against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from rasterloom.llm import keyfilter, ngram_join, substring_dedup
from rasterloom.llm.components import connected_components
from rasterloom.llm.staging import staged

WORDS = [f"w{i}" for i in range(400)]


def texts(seed=1, n=60):
    """Originals, exact copies, near copies, shared passages, odd texts."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = [rng.choice(WORDS) for _ in range(rng.randint(1, 120))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            out.append(rng.choice([" ", "\n", "\t  "]).join(copy))
    passage = " ".join(rng.choice(WORDS) for _ in range(55))
    out += [f"{rng.choice(WORDS)} {passage} {rng.choice(WORDS)}" for _ in range(5)]
    out += ["", "   ", None, "a", "a", "a b c", "é à é à é à é à é à é à é à é à", "x " * 300]
    rng.shuffle(out)
    return list(enumerate(out))


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_links(rows, threshold=0.8):
    sets = {d: shingles(t) for d, t in rows}
    links = {d: set() for d in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    return sets, links


def groups_of(links):
    name = {}
    for root in sorted(links):
        todo = [] if root in name else [root]
        while todo:
            v = todo.pop()
            if v not in name:
                name[v] = root
                todo += links[v]
    return name


@pytest.mark.parametrize(("shingles", "nodes"), [(400_000, 2048), (300, 2048), (400_000, 2)])
def test_ngram_join_equals_brute_force(documents, monkeypatch, shingles, nodes):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)  # small values make many blocks
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", nodes)
    rows = texts()
    sets, links = brute_links(rows)
    found = {r["doc_id"]: r for r in ngram_join.near_duplicates(documents(rows)).collect()}
    names = groups_of(links)
    assert len(found) == len(rows)
    assert {d: r["class_id"] for d, r in found.items()} == names
    assert {d: r["n_links"] for d, r in found.items()} == {d: len(x) for d, x in links.items()}
    assert all(r["copy_of"] == min([d, *(o for o in links[d] if sets[o] == sets[d])]) for d, r in found.items())


def test_chains_of_unlike_texts_cost_no_squares(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 4)
    rng = random.Random(8)
    stream = [rng.choice(WORDS) for _ in range(60 + 25 * 500)]
    rows = [(i, " ".join(stream[25 * i : 25 * i + 60])) for i in range(500)]  # neighbours share 31 of 81 shingles
    rows += [(900, rows[40][1].replace(" ", "  ")), (901, " ".join([*rows[77][1].split(), "end"]))]
    sent = []
    paired = ngram_join._paired
    monkeypatch.setattr(ngram_join, "_paired", lambda members: sent.append(paired(members)) or sent[-1])
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(documents(rows)).collect()}
    want = {d: (d, 0) for d, _ in rows} | {40: (40, 1), 900: (40, 1), 77: (77, 1), 901: (77, 1)}
    assert found == want
    assert sum(f.count() for f in sent) < 20 * len(rows)


def test_banding_reaches_its_recall():
    bands, rows = ngram_join.banding(0.8, 0.9995)
    assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8**rows) ** bands >= 0.9995


def test_ngram_join_edges(spark, documents):
    assert ngram_join.near_duplicates(documents([(1, "a b c d e f")]).limit(0)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "k l m n o p"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None)]
    found = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(documents(rows)).collect()), key=str)
    assert found == sorted([(1, 1, 2), (1, 1, 2), (1, 1, 0), (None, None, None), (2, 1, 2), (3, 3, 0)], key=str)
    kept = ngram_join.keep_one(documents(rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "a b c d e f"), (1, "k l m n o p"), (None, "a b c d e f"), (3, None)], key=str)
    assert kept.columns == documents(rows).columns


def brute_dedup(rows, k=13):
    seen, out = {}, {}
    for d, t in sorted(rows):
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - k + 1):
            if seen.setdefault(tuple(w[i : i + k]), d) < d:
                gone.update(range(i, i + k))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_equals_brute_force(documents, seed):
    rows = texts(seed)
    want = brute_dedup(rows)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.digest(documents(rows)).collect()}
    assert got == {d: x[:3] for d, x in want.items()} and any(x[1] for x in want.values())
    kept = {r["doc_id"]: r["kept_text"] for r in substring_dedup.deduplicate(documents(rows)).collect()}
    assert kept == {d: x[3] for d, x in want.items()}


def test_colliding_hashes_cut_nothing_wrong(documents):
    rows = texts(3)
    want = brute_dedup(rows)
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup.deduplicate(documents(rows), bits=5).collect()}
    assert got == {d: x[3] for d, x in want.items()}


def test_spans_carry_their_source(documents):
    rows = texts(4)
    words = {d: (t or "").split() for d, t in rows}
    spans = substring_dedup.repeated_spans(documents(rows)).collect()
    assert spans
    for s in spans:
        size = s["n"] + substring_dedup.WINDOW - 1
        own, there = words[s["doc_id"]][s["start"] :][:size], words[s["source"]][s["source_start"] :][:size]
        assert s["source"] < s["doc_id"] and own == there and len(own) == size


def test_words_that_differ_from_the_source_stay(documents):
    import pyarrow as pa

    text = " ".join(WORDS[:20])
    data = np.frombuffer(text.encode(), np.uint8)
    content, check = substring_dedup.Paths(substring_dedup.textscan.scan(data, np.array([0, len(data)])), 13, 5).digests(np.array([0]), np.array([13]))
    span = lambda c: {"start": 0, "n": 1, "content": int(content[0]), "check": c}
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("content", pa.int64()), ("check", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, text]), pa.array([[span(int(check[0]))], [span(int(check[0]) ^ 1)]], kind)], ["doc_id", "text", "spans"])
    (out,) = substring_dedup._cut(13, False, 64)([batch])
    assert out.column(2).to_pylist() == [13, 0]


def test_substring_dedup_edges(documents):
    long = " ".join(WORDS[:20])
    assert substring_dedup.digest(documents([(1, long)]).limit(0)).count() == 0
    rows = [(1, long), (1, long), (None, long), (5, "x " + long), (5, "y"), (7, None)]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.digest(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 20, 0), (1, 20, 0), (None, 20, 0), (5, 21, 20), (5, 1, 0), (7, 0, 0)], key=str)


def test_long_text_in_one_slice(documents):
    rows = [(1, " ".join(WORDS) * 3 + " z" * 200_000), (2, " ".join(WORDS[:50]))]
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.digest(documents(rows)).collect()}
    assert got == {1: 0, 2: 50}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(90, 80), (80, 70), (5, 5)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(31)} | {70: 70, 80: 70, 90: 70}


def test_key_filter_never_stops_a_key(spark):
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 5000)
    held = keyfilter.build(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert held.passes(keys).all()
    others = np.random.default_rng(2).integers(-(2**62), 2**62, 5000)
    assert held.passes(others).mean() < 0.1


def test_staged_tables_are_in_the_shared_folder(spark):
    frame = staged(spark.range(3).toDF("x"), "t")
    assert spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://") in frame.inputFiles()[0]


def test_edges_are_shuffled_once(spark, monkeypatch):
    from rasterloom.llm import substring_dedup as module

    monkeypatch.setattr(module, "HOT_SHARE", 4)  # one key in over a quarter of the rows is hot, the others are not
    rows = [(d, s, 7, 7) for d in range(3, 33) for s in (0, 5)] + [(d, k, k, 1) for k in range(20, 40) for d in (k % 3, 2, 4)]
    later = module._later(spark.createDataFrame(rows, "doc_id long, start int, content long, check int"))
    assert later._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    first = {}
    for d, s, c, k in sorted(rows):
        first.setdefault((c, k), (d, s))
    want = sorted((d, s, c, k, *first[c, k]) for d, s, c, k in rows if d > first[c, k][0])
    assert sorted(tuple(r) for r in later.select("doc_id", "start", "content", "check", "source", "source_start").collect()) == want


def test_copies_of_branching_paths_stay_whole(documents, monkeypatch):
    from rasterloom.llm import substring_dedup as module

    rng = random.Random(5)
    base = [rng.choice(WORDS) for _ in range(60)]
    near = [" ".join([*base[:at], "other", *base[at + 1 :]]) for at in (10, 30, 50)]
    rows = [(d, near[d % 3]) for d in range(90)]
    sent = []
    later = module._later
    monkeypatch.setattr(module, "_later", lambda edges: sent.append(edges) or later(edges))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in module.digest(documents(rows)).collect()}
    assert got == {d: x[:3] for d, x in brute_dedup(rows).items()}
    assert 0 < sent[0].count() < 2 * 3 * 48  # windows of the three texts, not of their 90 copies


def test_small_blocks_take_small_matrices():
    import tracemalloc

    sets = [np.arange(at, at + 100, dtype=np.int64) for at in (0, 10, 300)]
    tracemalloc.start()
    shared = ngram_join.shared_counts(sets, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert shared.tolist() == [[90, 90, 0], [90, 90, 0], [0, 0, 0]] and peak < 1 << 20
