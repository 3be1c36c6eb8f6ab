"""Main text of web pages by composite text density.

The page becomes a tree.  For every node the characters per tag below it are adjusted for links: of
two nodes with the same characters and tags, the one with more of them in links is less dense.  A
node's density sum adds the densities of its children.  The threshold is the smallest density on
the path from the densest node to the body; of the nodes above it the one with the largest density
sum holds the main text, together with its siblings above the threshold.  Parts that never belong to it are taken out of the tree first, and forms
and parts with telling names where they do not hold the article or most of the text.
"""

import math
import re
from html.parser import HTMLParser

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.llm.common import map_batches, pick

# Elements without content, elements that end an open paragraph, elements that are
# blocks of their own, and elements that are not main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
LEFT_OUT = set("""script style noscript template head title nav footer aside button select textarea option iframe object
embed svg canvas audio video menu dialog input fieldset""".split())
# Closed by an element of the same kind, looked for below the elements that hold them.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
HOLDERS = set("ul ol menu dl table tbody thead tfoot div section article body".split())
# Class names, ids and roles of parts that are not main text, as whole words; a name
# made of several of them by '-' or '_' is one too.
HINTS = set("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent
disqus footer menu nav navbar navigation newsletter notice notices pagination popup promo promoted related reply replies respond
share sharing sidebar signup skip social sponsor sponsored subscribe teaser teasers toolbar widget masthead alert complementary
contentinfo search""".split())
# Names of reader comments, and names of adverts and sidebars; a name that begins with one of them is that of such a part.
COMMENTS = set("comment comments disqus reply replies respond".split())
BESIDE = set("ad ads advert adverts advertisement advertising sidebar sponsor sponsored".split())
# What follows in names of comment parts that are ids, or names of articles.
COMMENT_PARTS = COMMENTS | set("area body box container content entry form item list section text thread wrapper".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
MAIN = ("article", "main")
BLANK = {"display:none", "visibility:hidden"}


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum", "dropped", "hint")

    def __init__(self, tag, parent, dropped=False, hint=None):
        self.tag, self.parent, self.children, self.dropped, self.hint = tag, parent, [], dropped, hint
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def is_left_out(tag, attributes, inside_article):
    if tag in LEFT_OUT or (tag == "header" and not inside_article):
        return True
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if value and name == "style" and any(b in value.replace(" ", "").lower() for b in BLANK):
            return True
    return False


def hint_of(tag, attributes, inside_article):
    """``comments`` or ``other`` for a part named like one that is not main text, and for a form; else none.

    Ids of headings, and other ids than those of comments inside an article, name their topic.
    """
    if tag in ("body", "html", "main"):
        return None
    found = "other" if tag == "form" else None
    for name, value in attributes:
        if not value or name not in ("class", "role", "id") or (name == "id" and tag in HEADINGS):
            continue
        for word in value.lower().split():
            pieces = [p for p in re.split("[_-]+", word) if p]
            if not pieces:
                continue
            if pieces[0] in COMMENTS and (COMMENT_PARTS.issuperset(pieces) or (name != "id" and tag != "article")):
                return "comments"
            if name == "id" and inside_article:
                continue
            if HINTS.issuperset(pieces) or (pieces[0] in BESIDE and tag != "article"):
                found = "other"
    return found


class TreeBuilder(HTMLParser):
    """A tree of elements and texts; tags that are missing or left open are put right."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("#page", None)
        self.articles = 0

    def _leave(self, node):
        while True:
            if self.here.tag == "article":
                self.articles -= 1
            left, self.here = self.here, self.here.parent
            if left is node:
                return

    def _close_open(self, kinds, until):
        node = self.here
        while node.parent is not None and node.tag not in until:
            if node.tag in kinds:
                self._leave(node)
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and any(c.tag == tag for c in self._open()):
            return
        if tag in BLOCKS:
            self._close_open(("p",), BLOCKS - {"p"})
        if tag in SIBLINGS:
            self._close_open(SIBLINGS[tag], HOLDERS - set(SIBLINGS[tag]))
        dropped = self.here.dropped or is_left_out(tag, attrs, self.articles > 0)
        node = Node(tag, self.here, dropped, hint_of(tag, attrs, self.articles > 0))
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node
            if tag == "article":
                self.articles += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _open(self):
        node = self.here
        while node is not None:
            yield node
            node = node.parent

    def handle_endtag(self, tag):
        # an end tag of something inside does not close the block around it
        for node in self._open():
            if node.tag == tag and node.parent is not None:
                self._leave(node)
                return
            if node.tag in BLOCKS and tag not in BLOCKS:
                return

    def handle_data(self, data):
        if not self.here.dropped:
            self.here.children.append(data)


def drop_hinted(root):
    """Drop hinted parts but those that hold the article.

    The article is an article or main element with text that is not hinted: one outside all hinted
    parts if there is one, else one outside all comments, else any.  Where there is none, a
    hinted part stays that holds more than half of the page's text, and comments that hold more
    than nine tenths of it.
    """
    order, stack = [], [(root, 0)]
    while stack:        # within: 2 inside comments, 1 inside another hinted part
        node, within = stack.pop()
        within = max(within, {"comments": 2, "other": 1}.get(node.hint, 0))
        order.append((node, within))
        stack.extend((c, within) for c in node.children if isinstance(c, Node) and not c.dropped)
    chars, mains = {}, {}
    for node, within in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        chars[node] = sum(len("".join(c.split())) for c in node.children if isinstance(c, str)) + sum(chars[c] for c in inner)
        held = [0, 0, 0]
        if node.tag in MAIN and node.hint is None and chars[node] > 0:
            held[within] = 1
        mains[node] = [a + sum(mains[c][k] for c in inner) for k, a in enumerate(held)]
    kind = next((k for k in range(3) if mains[root][k]), None)
    for node, _ in order:
        if node.hint and (kind is None or not mains[node][kind]):
            share = 0.9 if node.hint == "comments" else 0.5
            node.dropped = kind is not None or chars[node] <= share * chars[root]


def measure(root):
    """Counts, densities and density sums of all nodes, children before parents; nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    for node in reversed(order):
        linked = node.tag == "a"
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if linked:
            node.link_chars = node.chars
    body = next((n for n in order if n.tag == "body"), root)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        node.density = density(node, share)
    for node in order:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node) and not c.dropped)
    return order, body


def density(node, share):
    """Characters per tag, times a logarithm that falls with the links among them."""
    if not node.chars:
        return 0.0
    tags, free = max(1, node.tags), max(1, node.chars - node.link_chars)
    links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
    base = math.log(node.chars / free * node.link_chars + share * node.chars + math.e)
    return node.chars / tags * math.log(max(1.0, node.chars / links * tags / link_tags) + 1e-9) / math.log(base + 1e-9 + 1)


def main_node(root):
    """The main text's node: of the nodes above the threshold of the body path the one with the
    largest density sum, or the part around it that holds the siblings above the threshold too."""
    order, body = measure(root)
    full = [n for n in order if n.chars]
    if not full:
        return None
    path, node = [], max(full, key=lambda n: n.density)
    while node is not None:
        path.append(node.density)
        node = None if node is body else node.parent
    threshold = min(path)
    found = max((n for n in full if n.density >= threshold), key=lambda n: n.sum)
    article = whole_article(found)
    return article if article.tag in MAIN else with_siblings(found, body, threshold)


def with_siblings(node, body, threshold):
    """The outermost part up to the body in which siblings of the node, or of a part around it, reach the threshold.

    The parts beside them stay, whatever their density, unless most of their text is in links; of
    the body, only what is between the first and the last that reach it, and the headings before.
    """
    reaches = lambda c: isinstance(c, Node) and not c.dropped and c.chars > 0 and c.density >= threshold
    found, around = node, node
    while around is not body and around.parent is not None:
        inner, around = around, around.parent
        if any(reaches(c) for c in around.children if c is not inner):
            found = around
    around = node
    while around is not found:
        inner, around = around, around.parent
        kept = [c is inner or reaches(c) for c in around.children]
        first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
        while first and is_heading(around.children[first - 1]):
            first -= 1
        for i, c in enumerate(around.children):
            if not kept[i] and isinstance(c, Node):
                c.dropped |= 2 * c.link_chars > c.chars
        if around is body:
            around.children = around.children[first:last + 1]
    return found


def is_heading(item):
    return not item.strip() if isinstance(item, str) else item.dropped or item.tag in HEADINGS


def whole_article(node):
    """The article or main part around a node, if there is one: its headings and lists belong to it."""
    around, found = node, None
    while around is not None and around.tag != "body":
        if around.tag in MAIN:
            found = around
        around = around.parent
    return found or node


def blocks_of(node):
    """Texts of the blocks below a node, in page order, white space joined."""
    blocks, parts = [], []

    def close():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append(text)

    # (node, done): a block ends the text before it and the text in it
    stack = [(node, False)]
    while stack:
        item, done = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif done:
            close()
        elif not item.dropped:
            if item.tag in BLOCKS:
                close()
                stack.append((item, True))
            if item.tag == "br":
                parts.append(" ")
            stack.extend((c, False) for c in reversed(item.children))
    close()
    return blocks


def main_text(html):
    """The main text: its blocks joined by line ends, empty if there is none."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    drop_hinted(builder.root)
    node = main_node(builder.root)
    return "\n".join(blocks_of(node)) if node else ""


def extract_pages(pages):
    """(page_id, url, text, n_chars), one row per row of ``pages`` (page_id, url, html).

    Null, empty and textless pages have an empty text; markup left open is closed where its parent
    ends.  Equal rows get equal results; other columns are not read.
    """
    def start():
        def compute(batch):
            return [[main_text(h) for h in batch.column("html").to_pylist()]]
        return compute

    rows = map_batches(pick(pages, "page_id", "url", "html"), ["page_id", "url"], [("text", T.StringType())], start)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
