"""Template classes decide which texts of a page are slots."""

from rasterloom.llm import html_extract

SCHEMA = "page_id long, url string, html string"


def found(spark, rows):
    return {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_stories_of_page_copies_are_slots(spark):
    page = "<body><div class='top'>Welcome</div><div class='body'><p>{}</p></div><div class='end'>Bye</div></body>"
    stories = ["The same story", "The same story", "Another story", "A third one"]
    rows = [(i, f"http://a.example/{i}", page.format(s)) for i, s in enumerate(stories)]
    rows += [(10 + i, f"http://b.example/{i}", page.format("A mirror")) for i in range(2)]
    got = found(spark, rows)
    assert [got[i] for i in range(4)] == stories
    assert got[10] == got[11] == "Welcome A mirror Bye"


def test_template_texts_inside_articles_go(spark):
    page = "<body><article><h1>Head {0}</h1><p>A story of some length about {0}.</p><div class='box'>Read on below</div></article></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(4)]
    copy = "<body><article><p>A long text that both pages have.</p><i>{}</i></article></body>"
    rows += [(10 + i, f"http://b.example/{i}", copy.format(i)) for i in range(2)]
    got = found(spark, rows)
    assert [got[i] for i in range(4)] == [f"Head {i} A story of some length about {i}." for i in range(4)]
    assert [got[10 + i] for i in range(2)] == [f"A long text that both pages have. {i}" for i in range(2)]


def test_words_in_classes_do_not_reach_articles():
    for name in ("has-sidebar", "no-sidebar", "content-with-nav", "social-page"):
        for own in ("article", "main"):
            page = f"<body><div class='{name}'><p>Menu</p><{own}><p>Story</p><div class='comments'>Nice</div></{own}></div></body>"
            assert html_extract.main_text(page) == "Story"
    assert html_extract.main_text("<article>Story<div class='comments'><article>Nice</article></div></article>") == "Story"
    assert html_extract.main_text("<article>Story</article><div class='related'><article>Read this longer one</article></div>") == "Story"
    assert html_extract.main_text("<main><p>The story</p></main><div class='related'><article>Teaser</article></div>") == "The story"
    assert html_extract.main_text("<aside><article>Teaser</article></aside><p>Story</p>") == "Story"


def test_parts_of_articles_with_telling_names_stay():
    inner = "<div class='{}'>Part</div>"
    for name in ("related-work", "comments-on-method", "social-history", "title2 notice-of-motion", "x"):
        assert html_extract.main_text(f"<article>Story {inner.format(name)}</article>") == "Story Part"
    for name in ("related-posts", "comments", "comment-list", "ad ad-slot-1", "cookie-banner", "big sidebar", "notice"):
        assert html_extract.main_text(f"<article>Story {inner.format(name)}</article>") == "Story"
    assert html_extract.main_text("<article>See <svg><path d='M0'/><text>Axis</text></svg></article>") == "See Axis"


def test_very_long_pages_are_read_whole():
    page = "<body><nav>Menu</nav><article>" + "<p>word </p>" * 200_000 + "</article></body>"
    assert html_extract.main_text(page) == " ".join(["word"] * 200_000)


def test_classes_equal_brute_force(spark):
    """Tokens of a host with the same counts on all pages, inside the same other vector, are one class."""
    import random

    rng = random.Random(4)
    rows = []
    for i in range(8):
        body = "".join(f"<div class='c{j}'><p>T{j}</p>{'<i>S' + str(i) + '</i>' if rng.random() < 0.5 else ''}</div>" * (1 + (i % 2) * (j % 2)) for j in range(5) if rng.random() < 0.9)
        rows.append((i, "http://h.example/", f"<body>{body}</body>"))
    vectors, parent = {}, {}
    for i, _, page in rows:
        for path, text, *_ in html_extract.texts(page):
            token = (path, text)
            vectors.setdefault(token, [0] * 8)[i] += 1
            parent[token] = (path, None) if text is not None else (path.rpartition("/")[0], None)
    valid = {t: tuple(v) for t, v in vectors.items() if sum(map(bool, v)) >= 4}

    def outer(token):
        at = parent[token]
        while valid.get(at) == valid[token] and at != parent.get(at):
            at = parent[at]
        return valid.get(at)

    want = {}
    for t, v in valid.items():
        want.setdefault((v, outer(t)), set()).add(html_extract._key(*t))
    got = {}
    for r in html_extract.templates(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["class"], set()).add(r["token"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 3


def test_math_is_kept():
    assert html_extract.main_text("<article>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</article>") == "If x = 2 holds"
