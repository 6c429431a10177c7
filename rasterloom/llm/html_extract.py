"""Main text of web pages by template deduction over the pages of a host.

Tokens of a page are its elements (tag, classes and path of enclosing elements) and its texts
with their paths.  The occurrence vector of a token over a host's pages - how often each page
has it - is kept as an order-free digest next to its sums, so it aggregates before the shuffle.
Tokens of a host with equal vectors form an equivalence class; classes found on at
least half of the host's pages (and on two) are valid, and nest in the class of the elements
around them, by which they are told apart: together they are the host's template.  A text of
a valid class is template if it is on every page that has the element around it; one that is on
some of them only, as the story of page copies, fills a slot there.  So do the texts left over.
If a host's pages have no slot at all, they are copies of one page and have no template.

A page's main text comes from the slots inside its article (else its main element); without
either, from all slots.  One inside an element that only a word in its class or id marks counts
if there is no article outside such elements, and before a main element if it is longer.  An article (or main element) with less than half of its text in slots is a copy
and is taken whole.  Elements that hold navigation, headers, footers, sidebars, notices,
adverts, forms, scripts (and what stands in for them), styles or reader comments - by tag, role or
class - are passed over.  A class or id speaks by a word such as `comments`, with none beside it that
is not about place or shape: `related-posts` is other content, `related-work` is not.

A host's template has at most twice as many tokens as its mean page, so it travels as one row;
it meets the pages in a plain join, which adaptive execution broadcasts or splits by size.

Defined results.  Null and empty pages: empty text.  A null or odd url belongs to the host "".
Unclosed and stray tags are read as browsers do: a paragraph ends with the next one, an end tag
without a start is passed over.  Repeated rows are extracted each, and count each among the pages
of their host.  A page of any length is read whole, in one worker's memory.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import xxhash

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import textscan
from rasterloom.llm.staging import staged

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
# Elements, roles and words in classes or ids that mark other content than the article.
ASIDE_TAGS = frozenset("nav header footer aside form button head dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner promo sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar comment comments respond reply replies disqus share sharing social related recommended "
    "newsletter subscribe signup login paywall pagination pager skip".split()
)
# Words that say where or how a part is shown, and leave its kind to the other words of a class.
FRAME_WORDS = frozenset(
    "area bar block body bottom box button col column container content global group head heading inner item items left links list main outer page panel "
    "post posts right row section site slot small sticky text title top unit wrap wrapper".split()
)
MIN_SHARE = 0.5

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_SPLIT = re.compile(r"[^a-z]+")


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _aside(tag: str, attributes: str) -> tuple[int, str]:
    """Whether the element marks other content (1 by a word in its class or id, 2 by tag or role), and its name with its classes."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
    name = f"{tag}.{found['class'].replace('/', '|')}" if found.get("class") else tag
    if tag in ("html", "body", "main", "article") or found.get("role") == "main":
        return 0, name
    if tag in ASIDE_TAGS or found.get("role") in ASIDE_ROLES:
        return 2, name
    return int(any(map(_names_aside, f"{found.get('class', '')} {found.get('id', '')}".split()))), name


@lru_cache(maxsize=1 << 14)
def _names_aside(token: str) -> bool:
    """Whether a class or id says that a part is other content: by a word for it, with no word for something else."""
    words = {w for w in _SPLIT.split(token) if w}
    return bool(words & ASIDE_WORDS) and words <= ASIDE_WORDS | FRAME_WORDS


def texts(page: str):
    """The page's elements and texts in order: (path, text or None for an element, aside, in article, in main, glued to the text before, in an article or main inside an element marked by a word)."""
    stack: list[tuple[str, str, int, bool, bool, bool]] = []  # tag, path, aside, in article, in main, inside a mark
    at, raw_end, lower = 0, None, None
    glued = False
    top = ("", "", 0, False, False, False)
    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        here = stack[-1] if stack else top
        if m.start() > at:
            yield here[1], page[at : m.start()], here[2], here[3], here[4], glued, here[5]
            glued = True
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            if tag not in INLINE:
                glued = False
            continue
        if tag not in INLINE:
            glued = False
        if tag in RAW:
            lower = lower or page.lower()
            raw_end = lower.find(f"</{tag}", at)
            if raw_end < 0:
                at = len(page)
            else:
                close = page.find(">", raw_end)
                at = len(page) if close < 0 else close + 1
            continue
        if tag in VOID:
            continue
        closes = "p" if tag in ENDS_PARAGRAPH else tag if tag in ("li", "dt", "dd", "tr", "td", "th", "option") else None
        if closes:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == closes:
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
        here = stack[-1] if stack else top
        aside, name = _aside(tag, m[3])
        path = f"{here[1]}/{name}"
        article, main = tag == "article", tag == "main" or 'role="main"' in m[3]
        freed = here[2] == 1 and not here[3] and (article or main and not here[4])
        stack.append((tag, path, aside if freed else max(here[2], aside), here[3] or article, here[4] or main, here[5] or freed))
        yield path, None, stack[-1][2], stack[-1][3], stack[-1][4], False, stack[-1][5]
    if at < len(page):
        here = stack[-1] if stack else top
        yield here[1], page[at:], here[2], here[3], here[4], glued, here[5]


def _key(path: str, text: str | None) -> int:
    """A 63-bit name of a token."""
    data = f"{path}\x00{text}" if text is not None else path
    return xxhash.xxh3_64_intdigest(data.encode("utf-8", "surrogatepass")) >> 1


def _tokens(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            owners, keys, parents, counts, marks = [], [], [], [], []
            for row, (page_id, page) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)):
                seen: dict[tuple[int, int], int] = {}
                for path, text, *_ in texts(page or ""):
                    text = " ".join(text.split()) if text is not None else None
                    if text != "":
                        k = _key(path, text), _key(path if text is not None else path.rpartition("/")[0], None)
                        seen[k] = seen.get(k, 0) + 1
                for (k, parent), n in seen.items():
                    owners.append(row)
                    keys.append(k)
                    parents.append(parent)
                    counts.append(n)
                    marks.append(xxhash.xxh3_64_intdigest(f"{page_id}:{n}") >> 1)
            hosts = part.column(1).take(pa.array(owners, pa.int32()))
            yield pa.RecordBatch.from_arrays([hosts, pa.array(keys, pa.int64()), pa.array(parents, pa.int64()), pa.array(counts, pa.int64()), pa.array(marks, pa.int64())], ["host", "token", "parent", "n", "mark"])


def templates(pages: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """host, token, pages (of the host that have it), class, outer and fixed of each token of each host's valid classes.

    A class is the tokens of equal occurrence vectors inside the same other vector; outer is that
    vector, in whose class it is nested (null at the root).  fixed: it is on every page that has the
    element around it, so as a text it is template and no slot.
    """
    own = textscan.bounded(pages).select("page_id", host(F.col("url")).alias("host"), F.col("html").alias("html"))
    size = own.groupBy("host").agg(F.count("*").alias("total"))
    vectors = own.mapInArrow(_tokens, "host string, token long, parent long, n long, mark long").groupBy("host", "token")
    vectors = vectors.agg(F.min("parent").alias("parent"), F.count("*").alias("pages"), F.sum("n").alias("times"), F.bit_xor("mark").alias("digest"), F.sum(F.shiftright("mark", 24)).alias("marks"))
    vectors = staged(vectors, "vectors")
    size = size.join(vectors.groupBy("host").agg(F.count("*").alias("tokens")), "host")
    frequent = vectors.join(size, "host").where((F.col("pages") >= 2) & (F.col("pages") >= share * F.col("total")))
    frequent = frequent.selectExpr("host", "token", "parent", "pages", "xxhash64(pages, times, digest, marks) as vector", "total", "tokens")
    nested = frequent.groupBy("host").applyInArrow(_nest, "host string, token long, pages long, vector long, outer long, fixed boolean")
    return nested.selectExpr("host", "token", "pages", "xxhash64(vector, outer) as class", "outer", "fixed")


def _nest(table: pa.Table) -> pa.Table:
    """Adds outer to a host's template tokens: the vector of the nearest element around that has another one; and fixed.

    A host's tokens on at least half of its pages are at most twice as many as its mean page has.
    """
    vector = dict(zip(table["token"].to_pylist(), table["vector"].to_pylist(), strict=True))
    parent = dict(zip(table["token"].to_pylist(), table["parent"].to_pylist(), strict=True))
    pages = dict(zip(table["token"].to_pylist(), table["pages"].to_pylist(), strict=True))
    total, tokens = table["total"][0].as_py(), table["tokens"][0].as_py()
    fixed = [n == pages.get(parent[token], total) for token, n in pages.items()]
    if sum(fixed) == tokens:  # no slots
        fixed = [False] * len(fixed)
    outer = []
    for token, own in vector.items():
        at = parent[token]
        while vector.get(at) == own and at != parent.get(at):
            at = parent[at]
        outer.append(vector.get(at) if vector.get(at) != own else None)
    return table.select(["host", "token", "pages", "vector"]).append_column("outer", pa.array(outer, pa.int64())).append_column("fixed", pa.array(fixed, pa.bool_()))


def _extract(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = [main_text(page or "", frozenset(t or ())) for page, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], ["page_id", "url", "text", "n_chars"])


def _joined(pieces) -> str:
    return " ".join(entities.unescape("".join(pieces)).split())


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """The main text of one page; template holds the token keys of its host's template."""
    article: list[tuple[str, bool]] = []
    main: list[tuple[str, bool]] = []
    rest: list[tuple[str, bool]] = []
    marked: list[tuple[str, bool]] = []
    for path, text, aside, in_article, in_main, glued, inside in texts(page):
        if text is None or aside:
            continue
        slot = not template or _key(path, " ".join(text.split())) not in template
        pieces = marked if inside else article if in_article else main if in_main else rest
        pieces.append((text if glued else " " + text, slot))

    def held(pieces) -> str:
        text = _joined(t for t, slot in pieces if slot)
        whole = _joined(t for t, _ in pieces) if template else text
        return whole if len(text) < MIN_SHARE * len(whole) else text

    return held(article) or max(held(main), held(marked), key=len) or _joined(t for t, slot in rest if slot)


def extract(pages: DataFrame, share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text and n_chars (code points of text) of each row of pages."""
    held = templates(pages, share).where("fixed").groupBy("host").agg(F.collect_list("token").alias("template"))
    held = staged(held, "templates")
    own = textscan.bounded(pages).select("page_id", "url", "html", host(F.col("url")).alias("host"))
    rows = own.join(held, "host", "left").select("page_id", "url", "html", "template")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
