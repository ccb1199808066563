"""Main text of HTML pages by tree scoring.

A page becomes a small tree, in time linear in its length.  Scripts, menus, notices and the like are dropped by
tag, role or class name.  A name counts if all its words say so (``ad``, ``share-buttons``, not ``share-price``); containers
outside an article go by their name's first or last word, and inside one if most of their text is links besides.  Every paragraph gives points for its length and commas to
its ancestors, full to the parent and less further up; a container's points are
discounted by the share of its text inside links.  The best container, or the article it is in, is kept with
those of its siblings (beside an article: other articles) that also read like text, its blocks one per line.

Defined results: a null or empty page has an empty text; broken markup is closed
where the next block begins; every input row gives one row; other input columns are
ignored.  No page is cut.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A start tag: its name, and attributes whose quotes are closed; neither goes past a ``<``.
_TAG = re.compile(r"<([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_NAME = re.compile(r"[a-zA-Z][^\s/<>]*+")
_ATTRIBUTE = re.compile(r"([^\s/=>\"'][^\s/=>]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template svg math canvas audio video object select xmp".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
SCOPE = {"table", "td", "th", "caption", "button", "html", "body"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"}),
}
# What is not article text.
DROPPED_TAGS = {"nav", "aside", "form", "button", "dialog", "menu", "footer", "fieldset", "search", "datalist"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar"}
DROPPED_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners cookie "
    "cookies consent gdpr notice notices alert alerts popup popups modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended recommendations sidebar sidebars widget widgets menu menus nav navbar "
    "navigation navi breadcrumb breadcrumbs footer foot masthead comment comments disqus respond replies reply pagination "
    "pager toolbar login outbrain taboola topbar skip tracking paywall".split()
)
KEPT_NAMES = {"article", "entry", "post", "story"}
# Words that say nothing about what a block is for.
PLAIN_NAMES = set(
    "area articles bar block blocks body bottom box btn btns button buttons c col column container content group header icons inner item items "
    "js label left level line link links list main media msg message module outer page panel placeholder posts primary right row "
    "secondary section site slot slots text title tool tools top unit units view wrap wrapper zone".split()
)
#: Containers outside an article that one word of their name is enough for, and the link share that is enough inside.
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "header", "figure", "details", "address"}
MOSTLY_LINKS = 0.5
PARAGRAPHS = {"p", "pre", "td", "blockquote", "li", "dd", "figcaption"}
TAG_POINTS = {"article": 10, "main": 5, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3}
TAG_POINTS |= dict.fromkeys(("address", "ol", "ul", "dl", "dd", "dt", "li", "table", "tr"), -3)
TAG_POINTS |= dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "th", "header"), -5)
HEADINGS = {"h1", "h2", "h3"}


class Node:
    __slots__ = (
        "tag", "parent", "children", "names", "dropped", "suspect", "inside", "depth", "block", "score", "length", "linked", "links", "commas",
    )

    def __init__(self, tag: str, parent: Node | None, names: tuple[str, ...] = (), dropped: bool = False, suspect: bool = False):
        self.tag, self.parent, self.names, self.dropped, self.suspect = tag, parent, names, dropped, suspect
        self.children: list[Node | str] = []
        self.score = 0.0
        self.length = self.linked = self.links = self.commas = 0
        self.depth = parent.depth + 1 if parent else 0
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.block = self if tag in BLOCK or parent is None else parent.block

    def link_density(self) -> float:
        return self.linked / self.length if self.length else 0.0


def attributes_of(text: str) -> dict[str, str]:
    """Attributes by lower-case name, read one after the other; the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), double or single or bare)
    return found


def _unwanted(tag: str, attributes: str, parent: Node) -> tuple[bool, tuple[str, ...], bool]:
    """Whether an element is dropped, its class names, and whether it is to be dropped if it is mostly links."""
    if tag in DROPPED_TAGS or tag in RAW:
        return True, (), False
    if tag == "header" and not parent.inside:
        return True, (), False
    if not attributes or tag in ("html", "body", "article", "main") and "class" not in attributes.lower():
        return False, (), False
    given = attributes_of(attributes)
    if given.get("role", "").strip().lower() in DROPPED_ROLES or "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true":
        return True, (), False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I):
        return True, (), False
    names, suspect = (*given.get("class", "").split(), *given.get("id", "").split()), False
    for name in names:
        parts = [part.lower() for part in _NAME_PARTS.findall(name)]
        if not parts or parts[0] in ("has", "with", "no", "js"):
            continue
        if DROPPED_NAMES.intersection(parts) and all(part in DROPPED_NAMES or part in PLAIN_NAMES or part.isdigit() for part in parts):
            return True, (), False
        if tag in ("article", "main"):
            continue
        if parts[0] in DROPPED_NAMES or parts[-1] in DROPPED_NAMES:
            if not parent.inside and tag in CONTAINERS:
                return True, (), False
            suspect = True
        if parts[-1] == "header" and not parent.inside and tag in CONTAINERS and not KEPT_NAMES.intersection(parts):
            return True, (), False
    return False, names, suspect


class Builder:
    """The open elements of a page, and the way up from the innermost one."""

    def __init__(self):
        self.root = self.node = Node("html", None)
        self.open: dict[str, list[Node]] = {}

    def down(self, child: Node) -> None:
        self.open.setdefault(child.tag, []).append(child)
        self.node = child

    def up(self, to: Node) -> None:
        """Close everything up to ``to``, which stays open."""
        while self.node is not to:
            self.open[self.node.tag].pop()
            self.node = self.node.parent

    def innermost(self, tags) -> Node | None:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), key=lambda n: n.depth, default=None)

    def end_inside(self, kinds, until) -> None:
        """Close the innermost open element of ``kinds`` unless one of ``until`` is inside it."""
        found, stop = self.innermost(kinds), self.innermost(until)
        if found is not None and (stop is None or stop.depth < found.depth):
            self.up(found.parent)

    def end(self, tag: str) -> None:
        found = self.innermost((tag,))
        # an inline end tag does not close blocks
        if found is not None and (tag in BLOCK or found.block is self.node.block):
            self.up(found.parent)


def _marks(page: str) -> Iterator[tuple[str, str, str, int]]:
    """Text, end tags and start tags in order, as (kind, name or text, attributes, where it ends); send a place to go on from there.

    Every character is looked at a bounded number of times: what is searched for ahead is remembered.
    """
    at, end, close = 0, len(page), -1
    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            yield "text", page[at:], "", end
            return
        if begin > at:
            yield "text", page[at:begin], "", begin
        at = begin
        if close < at:
            close = page.find(">", at)
            if close < 0:
                close = end
        if page.startswith("<!--", at):
            found = page.find("-->", at + 4)
            at = end if found < 0 else found + 3
            continue
        following = page[at + 1 : at + 2]
        if following in ("!", "?"):
            at = min(close + 1, end)
            continue
        if following == "/":
            name = _NAME.match(page, at + 2)
            if name and close < end:
                at = close + 1
                yield "end", name[0].lower(), "", at
                continue
        elif following.isascii() and following.isalpha() and close < end:
            tag, found = _TAG.match(page, at), None
            if tag is not None:
                found = tag[1].lower(), tag[2], tag.end()
            else:
                cut = page.find("<", at + 1, close)
                # quotes that are not closed: the tag ends where it seems to, unless another begins before
                if cut < 0 or page.count('"', at, cut) % 2 or page.count("'", at, cut) % 2:
                    name = _NAME.match(page, at + 1)
                    found = name[0].lower(), page[name.end() : close], close + 1
            if found is not None:
                place = yield "start", *found
                at = place or found[2]
                continue
        yield "text", "<", "", at + 1
        at += 1


def parse(page: str) -> Node:
    """The tree of a page without its dropped elements' contents."""
    build, raw_ends = Builder(), {}
    marks, place = _marks(page), None
    while True:
        try:
            kind, name, attributes, at = marks.send(place)
        except StopIteration:
            return build.root
        place, node = None, build.node
        if kind == "text":
            if not node.dropped:
                node.children.append(html.unescape(name) if "&" in name else name)
            continue
        if kind == "end":
            build.end(name)
            continue
        if name in ("html", "body", "head"):
            continue
        if name in BLOCK:
            build.end_inside(("p",), SCOPE)
        if name in ENDS:
            build.end_inside(*ENDS[name])
        node = build.node
        if name in VOID:
            if not node.dropped:
                node.children.append(" " if name not in BLOCK else Node(name, node))
            continue
        dropped, names, suspect = (True, (), False) if node.dropped else _unwanted(name, attributes, node)
        if name in RAW:
            place = _after_raw(page, at, name, attributes.endswith("/"), raw_ends)
            continue
        child = Node(name, node, names, dropped, suspect)
        if not dropped:
            node.children.append(child)
        elif not node.dropped and name in BLOCK:
            node.children.append(Node("hr", node))  # the block's place still parts what is around it
        build.down(child)


def _after_raw(page: str, at: int, tag: str, self_closed: bool, known: dict) -> int:
    """Where a raw element's contents end.

    Self-closed ones have none, unless their own end tag follows before another such element.
    ``known`` remembers the next tag of each kind, so a page is searched once for it.
    """
    if self_closed and tag in ("svg", "math"):
        return at
    key = tag, self_closed
    found = known.get(key)
    if key not in known or found is not None and found.start() < at:
        slash = "/?" if self_closed else "/"
        found = known[key] = re.compile(rf"<({slash}){re.escape(tag)}(?=[\s/>])[^<>]*+>", re.I).search(page, at)
    if self_closed and (found is None or not found[1]):
        return at
    return found.end() if found else len(page)


def _ordered(root: Node) -> list[Node]:
    """Nodes, parents before children."""
    nodes = [root]
    for node in nodes:
        nodes += [child for child in node.children if not isinstance(child, str)]
    return nodes


def _measure(nodes: list[Node]) -> None:
    """Text, link text, links and commas of every node with all below it."""
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                node.length += len(" ".join(child.split()))
                node.commas += child.count(",") + child.count("、") + child.count("，")
            else:
                node.length += child.length
                node.linked += child.length if child.tag == "a" else child.linked
                node.links += child.links + (child.tag == "a")
                node.commas += child.commas


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        plain = node.tag in ("div", "section") and not any(not isinstance(c, str) and c.tag in BLOCK for c in node.children)
        if not node.length or not (node.tag in PARAGRAPHS or plain):
            continue
        points = (node.length >= 25) + node.commas + min(node.length / 100, 3)
        level, above = 0, node.parent if node.tag in PARAGRAPHS else node
        while above is not None and level < 5:
            if not above.score:
                above.score = float(TAG_POINTS.get(above.tag, 0)) or 1e-6
            above.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = above.parent, level + 1
    for node in nodes:
        node.score *= 1 - node.link_density()


def _best(nodes: list[Node]) -> list[Node]:
    """The best container and its kept siblings, in page order."""
    best = max((n for n in nodes if n.score), key=lambda n: n.score, default=None)
    if best is None:
        return [next((n for n in nodes if n.tag in ("article", "main")), nodes[0])]
    above = best
    while above is not None:
        if above.tag == "article" and above.parent is not None:
            beside = [n for n in above.parent.children if not isinstance(n, str) and n.tag == "article"]
            return [n for n in beside if n is above or n.length >= 0.2 * above.length and n.link_density() < MOSTLY_LINKS]
        above = above.parent
    if best.parent is None:
        return [best]
    least, kept, before = max(10.0, 0.2 * best.score), [], True
    for sibling in best.parent.children:
        if isinstance(sibling, str):
            continue
        if sibling is best:
            before = False
            kept.append(sibling)
            continue
        density = sibling.link_density()
        bonus = 0.2 * best.score if sibling.names and sibling.names == best.names else 0.0
        if (
            sibling.score and sibling.score + bonus >= least
            or sibling.tag == "p" and (sibling.length > 80 and density < 0.25 or 0 < sibling.length <= 80 and not density)
            or sibling.tag in HEADINGS and before and sibling.length and not density
        ):
            kept.append(sibling)
    return kept


def _blocks(top: Node) -> Iterator[str]:
    """Text of the blocks below ``top``, white space as it is."""
    inline: list[str] = []
    stack: list[tuple[Node, Iterator]] = [(top, iter(top.children))]
    while stack:
        node, children = stack[-1]
        for child in children:
            if isinstance(child, str):
                inline.append(child)
                continue
            if child.tag in BLOCK:
                yield "".join(inline)
                inline.clear()
                if child.suspect and child.links and child.link_density() > MOSTLY_LINKS:
                    continue  # named like a menu, and one
                if not child.inside and child.links > 2 and child.link_density() > 0.6 and child.tag not in PARAGRAPHS:
                    continue  # a menu among the text of a page without an article
            stack.append((child, iter(child.children)))
            break
        else:
            stack.pop()
            if node.tag in BLOCK:
                yield "".join(inline)
                inline.clear()
    yield "".join(inline)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes = _ordered(parse(page))
    _measure(nodes)
    _score(nodes)
    lines = (" ".join(block.split()) for top in _best(nodes) for block in _blocks(top))
    return "\n".join(line for line in lines if line)


def _texts(batches):
    for batch in batches:
        texts = [main_text(page) for page in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [*batch.schema.names[:-1], "text", "n_chars"],
        )


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), page: str = "html") -> DataFrame:
    """``keys``, ``text`` and ``n_chars`` (code points) of every page."""
    chosen = pages.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], F.col(f"`{page}`").cast("string").alias("_page"))
    added = StructType.fromDDL("text string, n_chars bigint")
    schema = StructType([*chosen.schema.fields[:-1], *added.fields])
    found = chosen.mapInArrow(_texts, schema)
    return found.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], "text", "n_chars")
