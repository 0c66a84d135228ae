"""A tolerant reader of HTML: flat lists of nodes and texts, in page order.

Tags are read as browsers read them: quoted attributes, raw text elements, comments, void elements, end tags that are
left out.  Nodes are numbers; a node's parent is smaller than itself, so sums over subtrees need no recursion and
no page nests too deeply.  Every tag costs constant time on average, whatever is left open.
"""

import re
from dataclasses import dataclass, field

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*+(=?[^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+""")
COMMENT_END = re.compile(r"--!?>")

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption html legend option select tbody td tfoot th thead title tr".split())
SCOPES = frozenset("html table td th caption button object template marquee applet".split())
TABLE_PARTS = frozenset("table caption colgroup tbody thead tfoot tr td th".split())
CLOSED_BY = {  # an open element, nearest first, that a start tag ends; not beyond the elements after it
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "option": ("option", "select"),
    "optgroup": ("option optgroup", "select"),
    "tr": ("tr td th caption", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th caption", "table"),
    "thead": ("tbody thead tfoot tr td th caption", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption", "table"),
}
CLOSED_BY = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSED_BY.items()}


@dataclass
class Page:
    """Nodes (``tags``, ``parents``, ``attributes``) and texts (``texts``, their nodes ``owners``, their ``blocks``)."""

    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    attributes: list[dict] = field(default_factory=lambda: [{}])
    texts: list[str] = field(default_factory=list)
    owners: list[int] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)


class Builder:
    """Nodes that are open, outermost first; node 0 is the page itself."""

    def __init__(self):
        self.page, self.block = Page(), 0
        self.open, self.scope = [0], [0]  # node, and how far down end tags reach from there
        self.last: dict[str, list[int]] = {}  # depths at which a tag is open

    def text(self, value: str) -> None:
        self.page.texts.append(value)
        self.page.owners.append(self.open[-1])
        self.page.blocks.append(self.block)

    def depth_of(self, tag: str) -> int:
        depths = self.last.get(tag)
        return depths[-1] if depths else -1

    def close_to(self, depth: int) -> None:
        """Close the node at that depth and all inside."""
        while len(self.open) > depth:
            tag = self.page.tags[self.open.pop()]
            self.scope.pop()
            self.last[tag].pop()
            if tag in BLOCKS:
                self.block += 1

    def start(self, tag: str, attributes: dict, self_closed: bool) -> None:
        if tag in CLOSES_P and self.depth_of("p") > self.scope[-1]:
            self.close_to(self.depth_of("p"))
        if tag in CLOSED_BY:
            ended, fence = CLOSED_BY[tag]
            limit = max(map(self.depth_of, fence))
            depth = min((d for d in map(self.depth_of, ended) if d > limit), default=-1)
            if depth > 0:
                self.close_to(depth)
        if tag == "body" and self.depth_of("head") > 0:
            self.close_to(self.depth_of("head"))
        if tag in ("html", "body") and self.depth_of(tag) > 0:
            return  # a second one only adds attributes
        page = self.page
        page.tags.append(tag)
        page.parents.append(self.open[-1])
        page.attributes.append(attributes)
        if tag in BLOCKS:
            self.block += 1
        if tag == "br":
            self.text(" ")
        if tag in VOID or (self_closed and tag in ("svg", "math", "path", "use")):
            return
        self.last.setdefault(tag, []).append(len(self.open))
        self.scope.append(len(self.open) if tag in SCOPES else self.scope[-1])
        self.open.append(len(page.tags) - 1)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return  # what follows still belongs to the page
        depth = self.depth_of(tag)
        reach = self.depth_of("table") if tag in TABLE_PARTS else self.scope[-1]
        if depth > 0 and depth >= reach:
            self.close_to(depth)
        elif tag == "br":
            self.text(" ")


def read_tag(html: str, at: int) -> tuple[str, dict, bool, int]:
    """Name, attributes, whether it closes itself, and the place after a tag whose name begins at ``at``; -1 if it never ends."""
    name = NAME.match(html, at)
    at, attributes = name.end(), {}
    while at < len(html):
        if html[at] == ">":
            return name.group().lower(), attributes, html[at - 1] == "/", at + 1
        found = ATTRIBUTE.match(html, at)
        key, value = found.group(1), found.group(2)
        if found.end() == at:  # a quote that never ends
            break
        if key:
            attributes.setdefault(key.lower(), value.strip("\"'") if value else "")
        at = found.end()
    return "", {}, False, -1


def read_page(html: str) -> Page:
    """The page's nodes and texts; a tag or comment that never ends takes the rest of the page."""
    builder, at = Builder(), 0
    while at < len(html):
        sign = html.find("<", at)
        if sign < 0:
            builder.text(html[at:])
            break
        if sign > at:
            builder.text(html[at:sign])
        following = html[sign + 1 : sign + 3]
        if following[:1].isascii() and following[:1].isalpha():
            tag, attributes, self_closed, at = read_tag(html, sign + 1)
            if at < 0:
                break
            builder.start(tag, attributes, self_closed)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                builder.text(html[at : end.start()] if end else html[at:])
                at = end.start() if end else len(html)
        elif following[:1] == "/" and following[1:].isascii() and following[1:].isalpha():
            tag, _, _, at = read_tag(html, sign + 2)
            if at < 0:
                break
            builder.end(tag)
        elif html.startswith("<!--", sign):
            if html.startswith((">", "->"), sign + 4):
                at = html.index(">", sign) + 1
                continue
            end = COMMENT_END.search(html, sign + 4)
            at = end.end() if end else len(html)
        elif following[:1] in ("!", "?", "/"):
            end = html.find(">", sign)
            at = end + 1 if end >= 0 else len(html)
        else:
            builder.text("<")
            at = sign + 1
    return builder.page
