"""Main text of web pages by composite text density.

Every element gets its density: characters for each tag, lowered where links hold
them. The element whose children's densities sum up highest is the heart of the
text. The lowest density on the path from it to the body is the threshold: what lies
beside the path stays where its density reaches it. Elements that say what they
are (menus, forms, adverts, comments and so on) are left out before; a class, an id
or a form counts as a penalty only, so that none that holds the heart goes.

Pages pass one by one in a map without a shuffle.
"""

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import types as T

from barworks.llm.common import keep_columns, with_fields

# Fixed values of HTML and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noframes noembed textarea title xmp".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
                   "tfoot th thead tr ul caption".split())
LEFT_OUT = frozenset("nav footer aside form button select menu dialog svg object canvas audio video head map".split())
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption option optgroup legend body html".split())
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
                  "option": {"select"}}
FURNITURE = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion sidebar sidenav menu "
                      "nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice alert popup modal "
                      "overlay newsletter subscribe subscription social share sharing related recommended comment comments disqus replies widget "
                      "toolbar pagination pager login signup search skip".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
#: Beginnings of names of furniture, for words written together.
FURNITURE_STARTS = ("sidebar", "comment", "advert", "adsby", "sponsor", "cookie", "breadcrumb", "newsletter", "navbar", "disqus", "footer")
#: Furniture that pages also mark up as articles of their own.
REMARKS = frozenset("comment comments reply replies ad ads advert advertisement sponsor sponsored promo related".split())
#: Names of a page's head, and those that say that it is the article's.
HEADS, OF_TEXT = frozenset("header masthead banner navbar".split()), frozenset("post entry article story content".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEARTS = frozenset(("article", "main"))
CONTAINERS = frozenset("div section center table address details".split())
#: What the densities in an element are worth where its class, its id or a form speaks against it.
PENALTY = 0.25

MARKUP = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|$)|([a-zA-Z][^\s/>]*)[^>]*(?:>|$))", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CAMEL, TOKEN = re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "hinted", "chars", "tags", "link_chars", "link_tags", "heart", "density", "total", "weight")

    def __init__(self, tag, parent, hinted=None):
        self.tag, self.parent = tag, parent
        self.hinted = hinted  # None, "head", "furniture" or "hidden"
        self.children = []  # nodes, and texts as strings
        # What keeps furniture around it: an article, or the title of one.
        self.heart = tag in HEARTS and not hinted or tag == "h1"


def _attributes(text):
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _hint(tag, text):
    """What an element's attributes say that it is: "furniture" or the page's "head" by its names, "hidden" by a state or role, or None."""
    if not text or text.isspace() or tag in ("html", "body", "main"):
        return None
    attributes = _attributes(text)
    names = set(TOKEN.findall(CAMEL.sub(" ", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower()))
    if tag == "article":
        return "furniture" if names & REMARKS else None
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
        return "hidden"
    if "display:none" in "".join(attributes.get("style", "").split()).lower():
        return "hidden"
    if names & HEADS and not names & OF_TEXT:
        return "head"
    return "furniture" if names & FURNITURE or any(n.startswith(FURNITURE_STARTS) for n in names) else None


def parse(text):
    """The tree of a page; tags that are left open or closed twice are mended as they come."""
    root = node = Node("html", None)
    open_tags = Counter(["html"])
    at = 0
    for m in MARKUP.finditer(text):
        if m.start() < at:
            continue
        if m.start() > at:
            node.children.append(text[at:m.start()])
        at = m.end()
        close, tag, attributes = m[1], m[2] or m[4], m[3] or ""
        if close:
            close = close.lower()
            if open_tags[close] and close != "html":
                node = _leave(node, close, open_tags)
        elif tag:
            tag = tag.lower()
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(text, at)
                at = end.end() if end else len(text)
                continue
            if tag in ("html", "body") and open_tags[tag]:
                continue
            if (ended := _ended_by(node, tag)) is not None:
                node = _leave(node, ended.tag, open_tags)
            child = Node(tag, node, _hint(tag, attributes))
            node.children.append(child)
            if tag not in VOID and not attributes.endswith("/"):
                node = child
                open_tags[tag] += 1
    if at < len(text):
        node.children.append(text[at:])
    return root


def _leave(node, tag, open_tags):
    """The parent of the nearest open element of a tag, which ends with all inside it."""
    while node.tag != tag:
        open_tags[node.tag] -= 1
        node = node.parent
    open_tags[tag] -= 1
    return node.parent


def _path(node):
    while node is not None:
        yield node
        node = node.parent


def _ended_by(node, tag):
    """The open element that a new element ends, if there is one."""
    same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
    limits = CLOSED_BY_SAME.get(tag)
    if not limits and tag not in CLOSES_P:
        return None
    for n in _path(node):
        if limits and n.tag in same or not limits and n.tag == "p":
            return n
        if n.tag in (limits or BLOCKS) or n.parent is None:
            return None
    return None


def _nodes(root):
    """All elements, parents before their children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return order


def _is_furniture(node, inside):
    """Whether an element goes; ``inside``: it lies in an article. An article or title inside keeps furniture, but not the page's head."""
    if node.tag in LEFT_OUT:
        return True
    if node.tag == "header" or node.hinted == "head":
        return not (inside and node.heart) and not any(n.tag in HEARTS and not n.hinted for n in _nodes(node))
    return bool(node.hinted) and not node.heart


def _prune(root):
    """Leaves out furniture: by tag, state or role at once, by names or as a form where it does not hold the heart."""
    for node in reversed(_nodes(root)):
        if node.parent is not None and node.heart:
            node.parent.heart = True
    stack = [root]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or c.tag == "form"
                         or not (c.tag in LEFT_OUT or c.hinted == "hidden" and not c.heart)]
        stack += [c for c in node.children if isinstance(c, Node)]
    kept = _heart_path(root)
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in HEARTS
        node.children = [c for c in node.children if isinstance(c, str) or c in kept or not _is_furniture(c, inside)]
        stack += [(c, inside) for c in node.children if isinstance(c, Node)]


def _heart_path(root):
    """The elements that hold the heart, as densities are after the penalties of names and forms."""
    order = _measure(root)
    for node in order:
        against = node.hinted or node.tag in ("form", "header")
        node.weight = (node.parent.weight if node.parent else 1.0) * (PENALTY if against else 1.0)
    worth = {n: sum(c.density * c.weight for c in n.children if isinstance(c, Node)) for n in order if n.chars}
    if not worth:
        return set()
    heart = max(worth, key=worth.get)
    # Where most of the heart's sum is one element's, or all its text, that element holds it too.
    down = heart
    while down is not None:
        heart, texts = down, any(isinstance(c, str) and not c.isspace() for c in down.children)
        down = next((c for c in heart.children if isinstance(c, Node) and c.density * c.weight > worth[heart] / 2
                     or isinstance(c, Node) and not texts and c.chars == heart.chars and c.chars), None)
    return set(_path(heart))


def _measure(root):
    order = _nodes(root)
    for node in reversed(order):
        texts = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        own = [c for c in node.children if isinstance(c, Node)]
        node.chars = texts + sum(c.chars for c in own)
        node.tags = sum(c.tags + 1 for c in own)
        node.link_chars = node.chars if node.tag == "a" else sum(c.link_chars for c in own)
        node.link_tags = (node.tag == "a") + sum(c.link_tags for c in own)
    body_share = root.link_chars / max(1, root.chars)
    for node in order:
        chars, tags, links = node.chars, max(1, node.tags), max(1, node.link_chars)
        # The base is above 1, as a logarithm of more than e; links raise it and lower the ratio.
        base = math.log(chars / max(1, chars - links) * links + body_share * chars + math.e)
        ratio = chars / links * tags / max(1, node.link_tags)
        node.density = chars / tags * math.log(max(1.0, ratio)) / math.log(base) if chars else 0.0
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node))
    return order


def _mostly_links(node):
    return node.chars and 2 * node.link_chars >= node.chars


def _content(root):
    """The element that holds the text: the maximum-sum subtree with what lies beside its path at or above the threshold.

    Above the heart, blocks below the threshold go, as comments and footers in plain elements do; headings
    before it stay. Inside an article, marked as one, only menus of links go, as its short lists and captions
    have low densities too. Where the heart is the body itself, the containers in it are held
    against the threshold, not its paragraphs.
    """
    order = _measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    heart = max((n for n in order if n.chars), key=lambda n: n.total, default=body)
    path = list(_path(heart))
    if body not in path:
        return heart
    path = path[:path.index(body) + 1]
    threshold = min(n.density for n in path)
    article = next((n for n in reversed(path) if n.tag in HEARTS), None)
    if article is None:
        for below, node in zip(path, path[1:]):
            place = node.children.index(below)
            node.children = [c for k, c in enumerate(node.children) if isinstance(c, str) or c is below or c.density >= threshold
                             or (k < place and c.tag in HEADINGS) or (c.tag not in BLOCKS and not _mostly_links(c))]
        if heart is body:
            body.children = [c for c in body.children if isinstance(c, str) or c.tag not in CONTAINERS or c.density >= threshold]
    stack = [article or body]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or c in path or c.tag not in BLOCKS or c.link_tags < 2
                         or c.density >= threshold or not _mostly_links(c)]
        stack += [c for c in node.children if isinstance(c, Node)]
    return article or body


def _blocks(node):
    """The texts of blocks in page order, white space as it is."""
    blocks, current, stack = [], [], [(node, 0)]

    def end():
        if current:
            blocks.append("".join(current))
            current.clear()

    while stack:
        node, k = stack.pop()
        if k == 0 and node.tag in BLOCKS:
            end()
        while k < len(node.children):
            child = node.children[k]
            k += 1
            if isinstance(child, str):
                current.append(child)
            elif child.tag == "br":
                current.append(" ")
            else:
                stack += [(node, k), (child, 0)]
                break
        else:
            if node.tag in BLOCKS:
                end()
    end()
    return blocks


def main_text(page):
    """The article of a page: its blocks, each on a line, references decoded and white space made one."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    lines = (" ".join(html.unescape(block).split()) for block in _blocks(_content(root)))
    return "\n".join(line for line in lines if line)


def extract_text(pages, html_col="html", text_col="text"):
    """The pages with ``text_col``, the main text, instead of ``html_col``, and ``n_chars``, its code points.

    Null and empty pages, and pages of nothing but furniture, have an empty text. Pages of
    any length are read whole. Rows pass one by one, repeated ones alike. Input
    columns of the names added are replaced.
    """
    pages = pages.drop(*({text_col, "n_chars"} - {html_col}))

    def run(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column(html_col).to_pylist()]
            yield keep_columns(batch.drop_columns([html_col]), **{
                text_col: pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    schema = with_fields(pages.drop(html_col).schema, **{text_col: T.StringType(), "n_chars": T.LongType()})
    return pages.mapInArrow(run, schema)
