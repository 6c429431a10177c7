"""Decontamination, packing, chat formatting, page extraction, top-k and the pipeline."""

import hashlib
import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rasterloom.llm import chat, decontam, html_extract, packing, queries, topk

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog while seven birds sing loudly above the old mill near town"),
    (2, "Train Alpha leaves at 10 km per hour and meets Mary after 25 minutes so how far did Mary walk in total that day"),
    (3, "too short"),
    (4, None),
]


def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def held(spark, docs, **k):
    return {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, benchmark(spark), **k).collect()}


def test_decontamination(spark, documents):
    one, two = ITEMS[0][1], ITEMS[1][1]
    other = two.replace("10 km", "47 mi").replace("25", "90").replace("Mary", "Peter")
    loose = two.replace("10 km", "47 mi").replace("meets Mary", "meets Peter").replace("did Mary", "did Susan")
    words = one.split()
    rows = [
        (1, "Intro words here. " + one + " and more"), (2, one.upper()), (3, " ".join(w + "***" for w in words)), (4, " ".join(words[:13])), (5, " ".join(words[:12])),
        (6, other), (7, loose), (8, "nothing of the sort " * 20), (9, None), (10, ""), (None, one), (11, one), (11, one), (12, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"),
        (13, "z " * 200_000 + one),
    ]
    assert held(spark, documents(rows)) == {(d, 1) for d in (1, 2, 3, 4, 11, 13)} | {(6, 2)}
    kept = decontam.keep_clean(documents(rows), benchmark(spark))
    assert {r["doc_id"] for r in kept.collect()} == {5, 7, 8, 9, 10, 12, None} and kept.columns == documents(rows).columns
    assert held(spark, documents(rows).limit(0)) == set()
    assert decontam.contaminated(documents(rows), benchmark(spark).limit(0)).count() == 0


def test_template(spark):
    text = "We met  John Smith at 5 km, then paid 3.50 dollars. Then Anna left."
    got = spark.range(1).select(decontam.template(F.lit(text))).first()[0]
    assert got == "we met   at   then paid   then  left"


def test_decontamination_equals_brute_force(spark, documents):
    rng = random.Random(6)
    words = [f"v{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(8, 40)))) for i in range(12)]
    rows = []
    for d in range(80):
        w = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            own = rng.choice(items)[1].split()
            lo = rng.randrange(len(own))
            at = rng.randint(0, len(w))
            w[at:at] = own[lo : lo + rng.randint(1, len(own))]
        rows.append((d, " ".join(w)))
    grams = lambda t: {tuple(t.split()[i : i + 8]) for i in range(len(t.split()) - 7)}
    want = {(d, i) for d, t in rows for i, b in items if len(grams(t) & grams(b)) >= min(6, len(grams(b)))}
    found = decontam.contaminated(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and want


def brute_best_fit(sizes, masks, capacity):
    bins, out = [], []
    for s, m in zip(sizes, masks, strict=True):
        fits = [(b["free"], i) for i, b in enumerate(bins) if b["free"] >= s and not b["mask"] & m]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"free": capacity, "mask": 0})
            i = len(bins) - 1
        out.append((i, capacity - bins[i]["free"]))
        bins[i]["free"] -= s
        bins[i]["mask"] |= m
    return out


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_equals_brute_force(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 60) for _ in range(300)), reverse=True)
    masks = [1 << rng.randrange(40) if rng.random() < 0.8 else 1 for _ in sizes]
    assert packing.best_fit(sizes, masks, 64) == brute_best_fit(sizes, masks, 64)


def test_packing(spark, documents):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 70), "en", rng.choice(["hot", "hot", f"s{i % 9}", None]), 0) for i in range(400)]
    rows += [(500 + i, "same text " * 8, "en", None, 0) for i in range(30)] + [(600, "w " * 1000, "en", "hot", 0), (601, None, "en", "hot", 0), (602, "", "en", "x", 0), (603, "a b", "en", "x", 0), (603, "a b", "en", "x", 0)]
    out = packing.pack(documents(rows), 64, 200).collect()
    texts = {}
    for d, t, _, s, _ in rows:
        texts.setdefault(d, []).append((t, s))
    assert sorted(d for d in texts for _ in texts[d]) == sorted(r["doc_id"] for r in out if r["piece"] == 0)
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_words"]
    assert total == {d: sum(len((t or "").split()) for t, _ in x) for d, x in texts.items()}
    bins = {}
    for r in out:
        if r["bin"] is not None:
            bins.setdefault(r["bin"], []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [0, *itertools.accumulate(r["n_words"] for r in own[:-1])] and sum(r["n_words"] for r in own) <= 64
        sources = [texts[r["doc_id"]][0][1] for r in own if texts[r["doc_id"]][0][1]]
        assert len(sources) == len(set(sources))
        copies = [texts[r["doc_id"]][0][0] for r in own]
        assert len(copies) == len(set(copies))
    assert packing.pack(documents(rows).limit(0)).count() == 0


TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<\\s>", "[/ROLE][ROLE]", "", "a\nb", "<s", "[INST", "\\[INST]\\", "𝄞<s>é"]


def test_escape_round_trip():
    rng = random.Random(1)
    parts = [*chat.CONTROLS, "\\", "<", ">", "s", "/", "[", "INST]", "x", "\n"]
    for text in TRICKY + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]:
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)
    messages = [(r, t) for t in TRICKY for r in ("user", "assistant", "odd[/ROLE]\\")]
    assert chat.read("".join(chat.render(r, t)[0] for r, t in messages)) == messages


def test_chat_events_fold(spark):
    events = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "he"), (1, 1, 3, "delta", None, "llo"), (1, 1, 4, "regenerate", None, None),
        (1, 1, 5, "delta", None, "good"), (1, 1, 6, "delta", None, "bye"), (1, 0, 7, "edit", None, "hey"), (2, 0, 0, "delta", "user", "lone"), (None, 0, 0, "message", None, None),
    ]
    rng = random.Random(1)
    rng.shuffle(events)
    frame = spark.createDataFrame(events, "conv_id long, turn int, seq int, kind string, role string, text string").withColumn("part", F.lit(9))
    rows = chat.format_events(frame).collect()
    got = {}
    for r in rows:
        got.setdefault(r["conv_id"], []).append((r["part"], r["formatted"]))
    read = {c: chat.read("".join(t for _, t in sorted(p))) for c, p in got.items()}
    assert read == {1: [("user", "hey"), ("assistant", "goodbye")], 2: [("user", "lone")], None: [("", "")]}
    assert chat.format_events(frame.limit(0)).count() == 0


def test_chat_digests_equal_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([*TRICKY, None, "x" * 5000])) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(3, 0, "user", "again"), (3, 0, "user", "again")] + [(77, t, "assistant", "long " * 50) for t in range(3000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash")).write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r["conv_id"]: r for r in queries.op5_chat_format(spark, str(tmp_path)).collect()}
    probe = "</s>[INST] ok [/INST]"
    full = rows + [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    for c in {r[0] for r in full}:
        own = sorted((t, r or "", x or "") for d, t, r, x in full if d == c)
        turns = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        want = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.render(r, x)[0]) for _, r, x in own))
        assert tuple(found[c])[1:] == want


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar"><header>Site</header>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div><div id="cookie-notice">We use</div>
<article><h1>Head &amp; line</h1><p><b>One <i>t</i>wo.<br><p>Three&nbsp;&#x41;&am</p><aside>Side</aside><form><input>Send</form><div class="comments"><p>Nice!</p></div><p>Last</p></article>
<footer>Foot</footer></body></html>"""


def test_page_text():
    assert html_extract.main_text(PAGE) == "Head & line One two. Three A&am Last"
    assert html_extract.main_text("") == "" and html_extract.main_text("no tags < here") == "no tags < here"
    assert html_extract.main_text("<main><p>a</main><p>b") == "a" and html_extract.main_text("<script>x") == ""
    assert html_extract.main_text("<div><p>a<p>b</div></b></i>c<span>d</span>") == "a b cd"


def test_templates_and_extraction(spark):
    page = lambda i: f"<html><body><div class='box'>Welcome here</div><div class='body'><p>Story {i} about {i * 7}.</p></div><div class='end'>All rights</div></body></html>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(6)] + [(10, "odd", PAGE), (11, None, None), (12, "http://b.example/", "<p>alone</p>"), (0, "http://a.example/0", page(0))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "text": F.lit("y")})
    found = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract(pages).collect())
    stories = [(i, f"Story {i} about {i * 7}.") for i in [0, *range(6)]]
    want = stories + [(10, "Head & line One two. Three A&am Last"), (11, ""), (12, "alone")]
    assert found == sorted((i, t, len(t)) for i, t in want)
    tokens = html_extract.templates(pages).where("host = 'a.example'").collect()
    assert len({r["class"] for r in tokens}) < len(tokens) and {r["pages"] for r in tokens} == {7}
    twice = "<body><p>A</p><p>B</p><div><i>{0}</i></div>{1}</body>"
    nest = spark.createDataFrame([(i, "http://c.example/", twice.format(i, "<table><td>x</td></table>" if i % 2 else "")) for i in range(4)], "page_id long, url string, html string")
    found = html_extract.templates(nest).collect()
    rare = [r for r in found if r["pages"] == 2]
    assert len(rare) == 3 and len({(r["class"], r["outer"]) for r in rare}) == 1 and rare[0]["outer"] is not None
    classes = {}
    for r in found:
        classes.setdefault(r["class"], []).append(r["token"])
    assert sorted(map(len, classes.values())) == [1, 2, 3, 3]  # p; A and B inside p; body, div and i; the table's three
    assert html_extract.extract(pages.limit(0)).count() == 0


def quantise(x):
    return np.floor(256 * np.asarray(x, dtype=np.float32).astype(float)).astype(np.int64)


@pytest.mark.parametrize(("rows", "asked"), [(8192, 512), (16, 2)])
def test_topk_equals_brute_force(spark, rows, asked):
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.normal(size=8) * 0.3]) for i in range(120)]
    data += [(200 + i, data[5][1]) for i in range(12)] + [(300, [0.0] * 8), (350, [0.0] * 8), (400, [1.0, 2.0])]
    bad = [(500, None), (550, [float("nan")] * 8), (600, [1.0] * 7 + [float("inf")]), (None, [9.0] * 8), (650, [1.0] * 7 + [None])]
    frame = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>").withColumns({"q": F.lit(1), "r": F.lit(1)})
    got = {}
    for r in topk.search(frame, F.col("vec_id") % 50 == 0, 5, rows, asked).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    full = {i: np.pad(quantise(x), (0, 8 - len(x))) for i, x in data}
    want = {i: sorted(((int(q @ v), j) for j, v in full.items() if j != i), key=lambda p: (-p[0], p[1]))[:5] for i, q in full.items() if i % 50 == 0}
    assert got == want
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = topk.search(frame.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]


def test_topk_of_large_values_equals_whole_numbers(spark):
    rng = random.Random(7)
    large = [1e7, 4e9, -4e9, 3e38, -3e38, 1e9 + 0.3, 2.0**40, 0.01, 0.0, 1.7e308, -1.7e308, 2.0**54 + 4]
    data = [(i, [rng.choice(large) * rng.choice([1, 0.5, -1]) for _ in range(4)]) for i in range(60)]
    data += [(100, [1e7, 0.0]), (101, [1e8, 0.0]), (102, [8.4e6, 0.0]), (103, [8.388608e6, 0.0]), (150, [1e9] * 4), (151, [-1e9] * 4), (152, [1e9] * 4)]
    for kind in ("double", "float"):
        frame = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>")
        rows = {r["vec_id"]: [int(Fraction(x) * 256 // 1) for x in r["embedding"]] for r in frame.collect() if all(map(math.isfinite, r["embedding"]))}
        got = {}
        for r in topk.search(frame, F.col("vec_id") % 50 == 0, 5, 16, 2).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
        for i, q in rows.items():
            if i % 50 == 0:
                best = sorted(((dot(q, v), j) for j, v in rows.items() if j != i), key=lambda p: (-p[0], p[1]))[:5]
                assert got[i] == [(max(-(2**63), min(2**63 - 1, s)), j) for s, j in best]


def test_bytes_of_scores_sort_as_the_scores():
    scores = sorted({s * (2**e + d) for e in (0, 1, 7, 8, 15, 16, 62, 63, 64, 2100) for d in (-1, 0, 1) for s in (1, -1)} | {0})
    assert sorted(scores, key=topk.ordered_bytes) == scores


def test_threshold_search_stops_early_and_is_right():
    rng = np.random.default_rng(1)
    values = np.abs(rng.normal(size=(4000, 2)) * 100).astype(np.int64)
    values[:8] += 5000
    lists = np.argsort(values, axis=0, kind="stable").astype(np.int32)

    class Counting(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == np.int64 and key.ndim == 1:
                Counting.read += len(key)
            return super().__getitem__(key)

    query = np.array([3, 2])
    ids, scores = topk.threshold_search(values.view(Counting), np.arange(4000), lists, query, -1, 5)
    want = np.lexsort((np.arange(4000), -(values @ query)))[:5]
    assert ids.tolist() == want.tolist() and scores.tolist() == (values @ query)[want].tolist() and Counting.read < 1000


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(5)
    words = {k: [f"{p}{i}" for i in range(150)] for k, p in (("en", "the"), ("de", "sch"))}
    words = {k: [re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], w) for w in v] for k, v in words.items()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(80)), k, f"s{i % 7}", 0) for i, k in enumerate(["en", "de"] * 40)]
    copy = rows[3][1].split()
    copy[5] = "changed"
    item = " ".join(rng.choice(words["en"]) for _ in range(20))
    rows += [(200, " ".join(copy), "de", "x", 0), (201, rows[4][1], "en", "y", 0), (202, "12 34 !!", None, "x", 0), (203, f"{rows[6][1][:60]} {item}", "en", "x", 0)]
    secret = "0123456789abcdef" * 3
    rows += [(204, " ".join(rng.choice(words["en"]) for _ in range(30)) + f' token = "{secret}"', "en", "x", 0)]
    rows = [(*r[:4], len(r[1])) for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, gone = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        gone.append(before - {r["doc_id"] for r in docs.collect()})
    assert gone == [{202}, {200, 201}, {203}, set()]
    text = docs.where("doc_id = 204").first()
    assert secret not in text["text"] and "<secret>" in text["text"] and text["n_chars"] == len(text["text"])
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in final} == {r[0] for r in rows} - {200, 201, 202, 203}
