"""Main text of web pages by a minimum cut (operator 5).

A page is cut into **blocks**: runs of text between tags that break lines. A
block knows the elements it stands in. Then every block is labelled content or
boilerplate at once:

* a classifier gives each block a cost for either label, from its elements
  (their names, classes, ids and roles), its length, its share of link text and
  its sentence marks. The costs become the capacities of its edges to the two
  terminals;
* neighbouring blocks, and blocks whose elements are children of one element
  with others between them, are joined by smoothness edges: the deeper the
  element they share, the dearer it is to label them differently;
* the minimum cut between the terminals is the cheapest labelling; blocks on
  the content side, in page order, are the text.

Text in scripts, styles, templates, buttons and other elements that are never
shown as text, comments and markup are no blocks at all; an element whose end
tag is missing hides nothing (but a script or style, which has no other end).
A form speaks against its text as far as that is no more than its controls
need, so a form around a whole page does not. Character references are decoded,
white space in a block becomes one space, blocks are trimmed and joined by one
space; nothing else is dropped or cut.

NULL reads as the empty page, whose text is empty. Markup may be broken: an
unclosed or stray tag never loses text, and blocks are found in time
proportional to the page however it is nested or quoted. Pages are handled one by one; repeated
rows give repeated results. Columns other than those named are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from .arrow import only, texts, with_columns

# Element names of HTML by their part in a page.
SILENT = frozenset("script style template noscript svg math iframe object select textarea button "
                   "title head canvas audio video map datalist".split())
CONTROLS = frozenset("input select textarea button".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
BOILERPLATE = frozenset("nav header footer aside menu dialog".split())
CONTENT = frozenset(("article", "main"))
HEAD_ONLY = frozenset("base link meta noscript script style template title head".split())
OUTER = frozenset(("html", "body"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

#: Parts of class, id and role names that speak for either label.
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|disclaimer|footer|"
    r"header|legal|login|masthead|menu|modal|nav\w*|newsletter|notice|pagination|pager|popup|promo\w*|recommend\w*|"
    r"related|replies|reply|responses|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|tags?|toolbar|"
    r"widget)(?:$|[\s_-])", re.IGNORECASE)
GOOD_NAME = re.compile(
    r"(?:^|[\s_-])(?:article\w*|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.IGNORECASE)
#: Words of BAD_NAME that are ordinary words of a subject as well: beside a word
#: that is no part of a layout (social-history) they are weighed with the text.
ORDINARY = frozenset("banner disclaimer header legal login notice related reply responses search share sharing "
                     "social tag tags".split())
LAYOUT = frozenset("area article articles bar block bottom box button buttons col column container content entry form "
                   "group head icon icons inner item items left link links list main media news outer page panel post "
                   "posts right row section site text title top wrap wrapper".split())
#: A line that only says whose the page is.
RIGHTS = re.compile(r"(?:©|\(c\)|copyright\s*(?:©|\(c\)|\d{4})).*|.*\ball rights reserved\W*", re.IGNORECASE)
#: A name that tells what stands beside the content (has-sidebar) is no hit.
LAYOUT_NAME = re.compile(r"(?:has|with|no|without)[_-]", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)type\s*=\s*["']?hidden\b""", re.IGNORECASE)

MARKUP = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
NAME_END = re.compile(r"[\s/>]")
QUOTE_OR_END = re.compile(r"[>\"']")
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

# Costs of the classifier, in nats of evidence for (+) content or (-) boilerplate.
IN_BOILERPLATE = -9.0    # inside an element meant for it, or named so
NAMED_ORDINARY = -1.5    # named by a word for boilerplate that may be one of the subject
IN_CONTENT = 4.0         # inside an element meant for the article, or named so
CONTROL_TEXT = 40        # characters of a form for each control that do not speak for text
LONG_TEXT = 0.02         # a character of text, up to LONG_AT
LONG_AT = 100
SENTENCE = 1.0           # the block ends as a sentence does
LINKS = -4.0             # all text is link text
HEADING = 1.0
RIGHTS_LINE = -7.0       # a short line of RIGHTS, in no element meant for the article
RIGHTS_AT = 200          # characters of such a line at most
PRIOR = -1.0

NEXT = 0.3               # smoothness of neighbours
SHARED = 0.35            # and of each element that both stand in, below the body,
SHARED_AT = 12           # up to so many: a cut costs a bounded sum, at any depth


class Element:
    """An element that is not inline; what its ancestors say is summed up in it,
    so that a block needs its innermost element only."""

    __slots__ = ("name", "parent", "depth", "good", "bad", "heading", "form", "hidden", "inline", "controls", "chars",
                 "against")

    def __init__(self, name: str, standing: float, parent: Element | None):
        self.name, self.parent = name, parent
        self.depth = parent.depth + (name not in OUTER) if parent else 0  # elements below the body
        # what stands around a form does not speak for the text in it
        self.good = 0.0 if name == "form" or not parent else max(parent.good, standing)
        self.bad = min(parent.bad, standing) if parent else 0.0
        self.heading = name in HEADINGS or (parent is not None and parent.heading)
        self.form = self if name == "form" else parent.form if parent else None
        self.hidden = False  # is silent and has an end tag (later: or stands in such an element)
        self.inline: list[Inline] = []  # inline elements opened in it
        self.controls = self.chars = 0  # of a form
        self.against = 0.0  # share of a form's text that its controls need


class Inline:
    __slots__ = ("name", "owner", "open")

    def __init__(self, name: str, owner: Element):
        self.name, self.owner, self.open = name, owner, True


class Block:
    """A run of text; ``shared`` is the number of elements below the body that
    it has in common with the block before it."""

    __slots__ = ("text", "evidence", "element", "shared")

    def __init__(self, text: str, evidence: float, element: Element, shared: int):
        self.text, self.evidence, self.element, self.shared = text, evidence, element, shared


class Ahead:
    """Where a pattern comes next (the page's end if nowhere). A gap that is
    asked for again, from a later place in it, is not searched again."""

    def __init__(self, pattern: re.Pattern, page: str):
        self.pattern, self.page, self.first, self.found = pattern, page, 0, -1

    def __call__(self, at: int) -> int:
        if not self.first <= at <= self.found:
            m = self.pattern.search(self.page, at)
            self.first, self.found = at, m.start() if m else len(self.page)
        return self.found


class Tags:
    """Ends of tags. Quoted values may hold ``>``; a tag without an end is none.

    What follows an opening quote does not depend on the tag it was met in, so a
    quote from which no end was reached is remembered: all tags together read
    the page a bounded number of times.
    """

    def __init__(self, page: str):
        self.page, self.endless = page, set()
        self.name_end, self.first, self.later = (Ahead(p, page) for p in (NAME_END, QUOTE_OR_END, QUOTE_OR_END))

    def end(self, at: int) -> int | None:
        """The place of the ``>`` of the tag whose attributes begin at ``at``."""
        opened, ahead = [], self.first
        while True:
            at = ahead(at)
            if at < len(self.page) and self.page[at] == ">":
                return at
            if at == len(self.page) or at in self.endless:
                break
            opened.append(at)
            at = self.page.find(self.page[at], at + 1) + 1
            if not at:
                break
            ahead = self.later
        self.endless.update(opened)
        return None


def _standing(name: str, attributes: str) -> float:
    """What an element says about the blocks in it."""
    if name in BOILERPLATE:
        return IN_BOILERPLATE
    if name in CONTENT:
        return IN_CONTENT
    if name in OUTER or "=" not in attributes:
        return 0.0  # names of the whole page say nothing about a block
    names = [n for m in NAMED.findall(attributes) for x in m for n in x.split() if not LAYOUT_NAME.match(n)]
    bad = [_against(n) for n in names]
    if any(GOOD_NAME.search(n) for n, b in zip(names, bad) if not b):
        return IN_CONTENT  # "content with-ads"; but "ads-content" is a hit
    return min(bad, default=0.0)


def _against(name: str) -> float:
    if not BAD_NAME.search(name):
        return 0.0
    words = [w for w in re.split(r"[_-]", name.lower()) if w and not w.isdigit()]
    subject = any(not BAD_NAME.search(w) and w not in LAYOUT for w in words)
    if subject and all(w in ORDINARY for w in words if BAD_NAME.search(w)):
        return NAMED_ORDINARY
    return IN_BOILERPLATE


def blocks(page: str) -> list[Block]:
    """The page's text blocks with their evidence and elements. The time is in
    proportion to the page, whatever its markup: ends of tags and open elements
    are found without searching the page or the open elements again."""
    found: list[Block] = []
    root = Element("", 0.0, None)
    open_ = [root]
    elements = [root]  # all, parents first
    times: dict[str, int] = {}  # how many elements of a name are open
    inline: dict[str, list[Inline]] = {}  # open inline elements by name
    words: list[str] = []
    links = linked = 0  # open links, characters in them
    lowest = 0  # fewest elements open since the last block
    endless: set[str] = set()  # names of raw elements without a further end tag

    def end_block() -> None:
        nonlocal linked, lowest
        if not words:
            return
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            on = open_[-1]
            evidence = (PRIOR + on.good + on.bad + LONG_TEXT * min(len(text), LONG_AT)
                        + SENTENCE * (text[-1] in ".!?:;\"”") + LINKS * min(1.0, linked / len(text))
                        + HEADING * on.heading)
            if on.good <= 0 and len(text) <= RIGHTS_AT and RIGHTS.fullmatch(text):
                evidence += RIGHTS_LINE
            found.append(Block(text, evidence, on, lowest))
            lowest = on.depth
        linked = 0

    def read(text: str) -> None:
        nonlocal linked
        if text:
            words.append(html.unescape(text) if "&" in text else text)
            if links:
                linked += len(words[-1].strip())

    def leave(gone: Inline) -> None:
        nonlocal links
        if gone.open:
            gone.open = False
            inline[gone.name].pop()
            links -= gone.name == "a"

    def close(name: str, tagged: bool = False) -> None:
        nonlocal lowest
        if not times.get(name):
            return
        while True:
            gone = open_.pop()
            times[gone.name] -= 1
            for x in reversed(gone.inline):
                leave(x)
            if gone.name == name:
                break
        lowest = min(lowest, open_[-1].depth)
        if tagged and name in SILENT:
            gone.hidden = True

    def close_inline(name: str) -> None:
        if not inline.get(name):
            return
        gone, own = inline[name][-1], open_[-1].inline
        if gone.owner is open_[-1]:
            while own[-1] is not gone:
                leave(own.pop())
            own.pop()
        # a stray end otherwise: it does not close blocks around
        leave(gone)

    tags = Tags(page)
    at = text_from = 0
    end = len(page)
    while m := MARKUP.search(page, at):
        start, closing = m.start(), page[m.end() - 2] == "/"
        if not page[m.end() - 1].isalpha() or m[0] == "<![CDATA[":  # a comment or declaration
            stop = "-->" if m[0] == "<!--" else "]]>" if len(m[0]) > 2 else ">"
            read(page[text_from:start])
            at = page.find(stop, m.end())
            at = text_from = end if at < 0 else at + len(stop)
            continue
        named = tags.name_end(m.end() - 1)
        stop = tags.end(named)
        if stop is None:
            at = start + 1  # no tag: its characters are text
            continue
        read(page[text_from:start])
        name, attributes = page[m.end() - 1:named].lower(), page[named:stop]
        at = text_from = stop + 1
        if name in INLINE:
            if closing:
                close_inline(name)
                continue
        else:
            end_block()
            if closing:
                close(name, tagged=True)
                continue
        if name in CONTROLS and not (name == "input" and HIDDEN.search(attributes)) and open_[-1].form:
            open_[-1].form.controls += 1
        if name not in HEAD_ONLY:
            close("head")  # its end tag may be left out
        if name in VOID:
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
            # a paragraph, list item or cell ends where the next of its kind begins
            around = open_[-1]
            while around.name == "p" != name:
                around = around.parent
            if around.name == name:
                close(name)
        if name in INLINE:
            one = Inline(name, open_[-1])
            open_[-1].inline.append(one)
            inline.setdefault(name, []).append(one)
            links += name == "a"
        else:
            open_.append(Element(name, _standing(name, attributes), open_[-1]))
            elements.append(open_[-1])
            times[name] = times.get(name, 0) + 1
        if name in RAW:  # its text is no markup, up to its own end tag
            stop = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            if stop:
                read(page[at:stop.start()])
                at = text_from = stop.start()
            elif name in ("script", "style"):
                at = text_from = end
            else:
                endless.add(name)
    read(page[text_from:])
    end_block()
    return _judge_forms(_shown(found, elements), elements)


def _shown(found: list[Block], elements: list[Element]) -> list[Block]:
    """The blocks that stand in no hidden element."""
    for e in elements[1:]:
        e.hidden = e.hidden or e.parent.hidden
    shown, shared = [], math.inf
    for b in found:
        shared = min(shared, b.shared)
        if not b.element.hidden:
            b.shared, shared = shared, math.inf
            shown.append(b)
    return shown


def _judge_forms(found: list[Block], elements: list[Element]) -> list[Block]:
    """Blocks in a form with evidence against them, less the more text it holds."""
    forms = [e for e in elements if e.form is e]
    for b in found:
        if b.element.form:
            b.element.form.chars += len(b.text)
    for form in reversed(forms):
        if outer := form.parent.form:
            outer.chars += form.chars
            outer.controls += form.controls
    for form in forms:
        around = form.parent.form.against if form.parent.form else 0.0
        form.against = max(around, 1 - form.chars / (CONTROL_TEXT * max(1, form.controls)))
    for b in found:
        if b.element.form:
            b.evidence += IN_BOILERPLATE * b.element.form.against
    return found


def minimum_cut(content: list[float], boilerplate: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (content or not) of least total cost.

    ``content[i]`` is the cost of labelling i content, ``boilerplate[i]`` of the
    other label, an edge's weight that of labelling its ends differently. Found
    as a maximum flow by shortest augmenting paths in level graphs.
    """
    n = len(content)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(there)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        direct = min(content[i], boilerplate[i])  # flows through at once
        if boilerplate[i] > direct:
            join(source, i, boilerplate[i] - direct, 0.0)
        if content[i] > direct:
            join(i, sink, content[i] - direct, 0.0)
    for a, b, weight in edges:
        join(a, b, weight, weight)

    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        next_edge = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                cut = next(i for i, e in enumerate(path) if room[e] <= tiny)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while next_edge[a] < len(heads[a]):
                e = heads[a][next_edge[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                next_edge[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                next_edge[a] += 1
                continue
            path.append(e)
            a = to[e]


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between a block and the last one before it
    whose element stands in the same element (a paragraph and the next one
    behind a list or an advert): two a block at most."""
    edges = []
    last: dict[int, int] = {}  # element -> the last block of its children
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, NEXT + SHARED * min(b.shared, SHARED_AT)))
        around = b.element.parent
        if around is not None and around.depth:
            before = last.get(id(around), i)
            if before < i - 1:
                edges.append((before, i, SHARED * min(around.depth, SHARED_AT)))
            last[id(around)] = i
    return edges


def main_text(page: str) -> str:
    """The text of the blocks that the cheapest labelling calls content."""
    found = blocks(page)
    if not found:
        return ""
    content = [max(0.0, -b.evidence) for b in found]
    boilerplate = [max(0.0, b.evidence) for b in found]
    keep = minimum_cut(content, boilerplate, smoothness(found))
    return " ".join(b.text for b, kept in zip(found, keep) if kept)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """One row per page: ``id``, ``url``, ``text`` (empty if there is none) and
    ``n_chars``, its code points."""

    def factory():
        def work(batch):
            found = [main_text(t) for t in texts(batch, markup)]
            return [found, [len(t) for t in found]]

        return work

    return with_columns(only(pages, id, url, markup), factory,
                        [StructField("text", StringType()), StructField("n_chars", LongType())], drop=[markup])
