"""Near copies in packing, and giant ones in the n-gram join."""

import random

import pytest

from rasterloom.llm import keyfilter, ngram_join, queries


def test_near_copies_share_no_bin(spark, documents, tmp_path):
    rng = random.Random(5)
    rows, group = [], {}
    for g in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(100)]
        for c in range(4):
            copy = [*base[:-1], f"end{g}x{c}"]
            d = None if (g, c) == (0, 0) else len(rows)
            group[d] = g
            rows.append((d, " ".join(copy), "en", f"s{len(rows)}", 0))
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    bins = {}
    for r in queries.op4_best_fit_packing(spark, str(tmp_path)).collect():
        bins.setdefault(r["bin"], []).append(group[r["doc_id"]])
    assert sum(map(len, bins.values())) == len(rows)
    assert all(len(own) == len(set(own)) for own in bins.values())


def test_giant_near_copies_count_their_links_once(spark, documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 60)  # two copies of 96 shingles need four blocks
    rng = random.Random(6)
    rows = []
    for _ in range(24):
        base = [f"w{rng.randrange(500)}" for _ in range(100)]
        rows += [(len(rows) + c, " ".join([*base[:-1], f"end{c}"])) for c in range(2)]
    found = ngram_join.near_duplicates(documents(rows)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found} == {d: (d - d % 2, 1) for d, _ in rows}


@pytest.mark.parametrize("words", [1, keyfilter.MAX_WORDS])
def test_one_of_each_group_stays_whatever_the_filters_pass(spark, documents, monkeypatch, words):
    monkeypatch.setattr(keyfilter, "MAX_WORDS", words)  # a filter of one word passes nearly all
    rng = random.Random(7)
    rows, want = [], set()
    for g in range(30):
        base = [f"w{rng.randrange(500)}" for _ in range(60)]
        copies = [(100 * g + c, " ".join([*base[:-1], f"end{c}"])) for c in range(1 + g % 3)]
        want.add(copies[0])
        rows += copies + copies[: g % 2]  # the first of every other group comes twice
    shared = (100, "quite another text of some seven words")  # under a doc_id that a group's first has
    loose = [(None, "a b c d e f"), (None, "a b c d e f"), (5000, None), (5001, " \t ")]
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one(documents([*rows, shared, *loose])).collect()]
    assert sorted(kept, key=str) == sorted([*want, shared, *loose], key=str)
