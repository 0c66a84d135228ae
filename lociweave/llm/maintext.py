"""Main text of web pages by composite text density.

A page becomes a tree (``dom``).  Elements that are never part of an article go first: by their tag, their role or a word
of their class or id.  Every remaining node has a composite text density: its characters for each tag, adjusted by its
links and by the share of links in the body, and a density sum, that of its children.  The subtree with the largest
sum is the article; the least density on its way up to the body is the threshold above which further subtrees
belong to it.  Where a page marks its article itself (``article``, ``main``), only what is inside competes, and a
chosen subtree grows to that element.

Defined results: a null, empty or text-free page gives an empty text; white space is what Unicode calls so; a ``br`` is
white space; character references are decoded as HTML5 says, with or without their semicolon; of equal sums the first
node in page order wins; null ids and urls and repeated rows stay; very long or deeply nested pages are read whole;
an empty table gives an empty one.  Other columns are left out, so their names do not matter.
"""

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lociweave.llm.common import slices, utf8
from lociweave.llm.dom import Page, read_page

# Elements, roles and words of class or id that mark what is no article.
NO_ARTICLE = frozenset(
    "head title script style noscript template nav aside footer form menu dialog iframe noembed noframes object svg math "
    "canvas audio video map button select textarea input label fieldset".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars aside footer masthead cookie cookies consent gdpr notice notices notification popup "
    "modal overlay newsletter subscribe subscription signup login comment comments commentlist reply replies respond disqus share "
    "sharing social related recommended pagination pager toolbar widget search searchform form skip alert alerts paywall "
    "disclaimer copyright".split()
)
NEGATIONS = frozenset("no with without has free".split())
LANDMARKS = frozenset("article main".split())
LINKS = frozenset(["a"])
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def is_landmark(tag: str, attributes: dict) -> bool:
    return tag in LANDMARKS or attributes.get("role", "").lower() in ("main", "article")


def names(attributes: dict) -> list[str]:
    return f"{attributes.get('class', '')} {attributes.get('id', '')}".split()


def names_noise(attributes: dict) -> bool:
    """True if a class or the id holds a word that marks what is no article."""
    for name in names(attributes):
        words = [w.lower() for w in PART.findall(name)]
        if WORDS.intersection(words) and not NEGATIONS.intersection(words):
            return True
    return False


def without_noise(page: Page) -> tuple[list[bool], list[int]]:
    """Whether each node stays, and the nearest landmark at or above it (0: none)."""
    n = len(page.tags)
    marked, holds_landmark, holds_text = [False] * n, [False] * n, [False] * n
    for owner, text in zip(page.owners, page.texts):
        holds_text[owner] = holds_text[owner] or not text.isspace()
    for i in range(n - 1, 0, -1):
        tag, attributes, parent = page.tags[i], page.attributes[i], page.parents[i]
        holds_text[parent] = holds_text[parent] or holds_text[i]
        # an article's classes often speak of what it allows, so only one that is such a word itself tells
        plain = holds_text[i] and is_landmark(tag, attributes)
        marked[i] = plain and not WORDS.intersection(name.lower() for name in names(attributes))
        holds_landmark[parent] = holds_landmark[parent] or marked[i] or holds_landmark[i]
    stays, landmark = [True] * n, [0] * n
    for i in range(1, n):
        tag, attributes, parent = page.tags[i], page.attributes[i], page.parents[i]
        noise = tag in NO_ARTICLE
        if not noise and attributes and tag not in ("html", "body") and not marked[i]:
            noise = (attributes.get("role", "").lower() in ROLES or names_noise(attributes)) and not holds_landmark[i]
        if tag == "header" and not landmark[parent] and not holds_landmark[i]:
            noise = True  # a page's header; an article's own holds its title
        stays[i] = stays[parent] and not noise
        landmark[i] = landmark[parent] or (i if marked[i] and stays[i] else 0)
    if any(landmark):
        for i in range(1, n):
            stays[i] = stays[i] and (landmark[i] > 0 or holds_landmark[i])
    return stays, landmark


def densities(page: Page, stays: list[bool], lengths: list[int], body: int) -> tuple[list[float], list[float]]:
    """Composite text density and density sum of every node; ``lengths`` are the characters of each text."""
    n = len(page.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parents[i]] or page.tags[i] in LINKS
    for owner, length in zip(page.owners, lengths):
        if stays[owner]:
            chars[owner] += length
            if in_link[owner]:
                link_chars[owner] += length
    for i in range(n - 1, 0, -1):
        if stays[i]:
            parent = page.parents[i]
            chars[parent] += chars[i]
            link_chars[parent] += link_chars[i]
            tags[parent] += tags[i] + 1
            link_tags[parent] += link_tags[i] + (page.tags[i] in LINKS)
    share = link_chars[body] / max(chars[body], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        if stays[i] and chars[i]:
            c, t = chars[i], max(tags[i], 1)
            lc, lt = max(link_chars[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - link_chars[i], 1) * lc + share * c + math.e)
            density[i] = c / t * math.log(c / lc * t / lt) / math.log(base)
        sums[page.parents[i]] += density[i]
    return density, sums


def chosen(page: Page, stays: list[bool], landmark: list[int], density: list[float], sums: list[float], body: int) -> list[bool]:
    """Whether each node is in a subtree that belongs to the article."""
    n = len(page.tags)
    if any(landmark):
        sums = [s if landmark[i] else -1.0 for i, s in enumerate(sums)]
    best = list(range(n))  # the node with the largest sum in each subtree
    inside = [False] * n
    inside[body] = True
    for i in range(body + 1, n):
        inside[i] = inside[page.parents[i]] and stays[i]
    for i in range(n - 1, body, -1):
        if inside[i]:
            parent = page.parents[i]
            if sums[best[i]] > sums[best[parent]] or (sums[best[i]] == sums[best[parent]] and best[i] < best[parent]):
                best[parent] = best[i]
    threshold, i = density[body], best[body]
    while i > body:
        threshold = min(threshold, density[i])
        i = page.parents[i]
    taken, wanted = [False] * n, [False] * n
    for i in range(body, n):
        if not inside[i]:
            continue
        taken[i] = wanted[i] or (i > body and taken[page.parents[i]])
        if not taken[i] and density[i] >= threshold:
            top = landmark[best[i]] or best[i]
            wanted[max(top, i)] = True
            taken[i] = wanted[i]
    return taken


def main_text(html: str) -> str:
    """The blocks of a page's article, one a line."""
    page = read_page(html)
    stays, landmark = without_noise(page)
    marked = any(landmark)
    kept = [stays[o] and (not marked or landmark[o] > 0) for o in page.owners]
    texts = [unescape(t) if k else "" for t, k in zip(page.texts, kept)]
    lengths = [len("".join(t.split())) for t in texts]
    body = next((i for i, tag in enumerate(page.tags) if tag == "body"), 0)
    density, sums = densities(page, stays, lengths, body)
    taken = chosen(page, stays, landmark, density, sums, body)
    blocks: dict[int, list[str]] = {}
    for text, owner, block in zip(texts, page.owners, page.blocks):
        if text and taken[owner]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` of every page.  No shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(x.decode("utf-8", "replace")) for x in part["html"].to_pylist()]
            columns = [part["id"], part["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, url_col, "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    schema = f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long"
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), utf8(html_col).alias("html"))
    return rows.mapInArrow(work, schema)
