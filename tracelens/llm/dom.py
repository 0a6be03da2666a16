"""A lenient reading of HTML into block nodes with the text they hold."""

from __future__ import annotations

import html
import re

# Elements inside a line of text; they make no node of their own.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small
    span strike strong sub sup time tt u var""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is never shown as text of the page.
HIDDEN = frozenset("""script style template noscript head title textarea select option button iframe svg object
    canvas audio video datalist""".split())
RAW = frozenset("script style textarea title iframe".split())
LINKING = frozenset("a img link script iframe area form source".split())
# Start tags that may stand in a head, or are ignored there; any other ends it, as text does.
IN_HEAD = frozenset("html head title base basefont bgsound link meta noframes noscript script style template".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split())
# Start tags that end an open element of these kinds, searched up to a boundary.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "tr": (("tr",), ("table", "tbody", "thead", "tfoot")), "body": (("head",), ())}

# Words in tag names, classes, ids and roles that speak for or against main text.
AGAINST = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav
    navbar navigation menu breadcrumb breadcrumbs footer foot header masthead topbar toolbar sidebar side aside rail
    widget related recommended recommend share sharing social comment comments reply replies disqus cookie cookies
    consent notice alert popup modal overlay newsletter subscribe subscription signup login form search pagination
    pager tags taglist copyright legal disclaimer complementary contentinfo dialog skip""".split())
IN_FAVOUR = frozenset("""article articlebody content main post entry story text body-text maincontent main-content
    post-content entry-content article-body prose""".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_REST = re.compile(r"""(?:"[^"]*"|'[^']*'|[^>"'])*+>""")
_SPECIAL = re.compile(r"""[>"']""")
_LONG_NUMBER = re.compile(r"&#[0-9]{8,};?")
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECES = re.compile(r"[^a-z0-9-]+")


def hints(tag: str, attributes: str) -> tuple[bool, bool]:
    """Do the tag and its class, id, role and itemprop words speak (against, for) main text?"""
    words = {tag}
    if "=" in attributes:
        for m in NAMES.finditer(attributes):
            for w in PIECES.split((m[1] or m[2] or m[3] or "").lower()):
                words.add(w)
                words.update(w.split("-"))
    return not words.isdisjoint(AGAINST), not words.isdisjoint(IN_FAVOUR)


def unescape(text: str) -> str:
    """Character references decoded; numbers beyond all code points, of any length, are U+FFFD."""
    return html.unescape(_LONG_NUMBER.sub("\ufffd", text)) if "&" in text else text


class Tags:
    """The tags of a source, found from left to right in time that grows with its length, whatever it holds.

    A tag ends at the first ``>`` outside quotes, or, where quotes do not close, at the first one.
    What starts like a tag or declaration but has no ``>`` is text.  A comment that is not closed
    reaches to the end.
    """

    def __init__(self, source: str):
        self.source = source
        self.last_end = source.rfind(">")
        self.dead: set[int] = set()  # quotes from which on, read as opening ones, no tag ends

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, closing, name, attributes) of the first tag from ``at`` on; no name: a comment or declaration."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                return start, len(source) if end < 0 else end + 3, False, "", ""
            if start > self.last_end:
                at = start + 1
                if (start := source.find("<!--", at)) < 0:
                    return None
                at = start
                continue
            if source.startswith(("<!", "<?"), start):
                return start, source.index(">", start) + 1, False, "", ""
            closing = source.startswith("/", start + 1)
            name = _NAME.match(source, start + 1 + closing)
            if name:
                end = self._end(name.end())
                return start, end + 1, closing, name[0].lower(), source[name.end():end]
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        """The ``>`` of a tag whose name ends at ``at``."""
        source = self.source
        if not self.dead and (m := _REST.match(source, at)):
            return m.end() - 1
        passed, here = [], at
        while m := _SPECIAL.search(source, here):
            if m[0] == ">":
                return m.start()
            if m.start() in self.dead:
                break
            passed.append(m.start())
            here = source.find(m[0], m.end()) + 1
            if not here:
                break
        self.dead.update(passed)
        return source.index(">", at)


def raw_end(source: str, tag: str, at: int) -> tuple[int, int]:
    """Where the raw text of a script, style, title and the like that starts at ``at`` ends, and its end tag."""
    m = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
    end = source.find(">", m.end()) if m else -1
    return (len(source), len(source)) if end < 0 else (m.start(), end + 1)


class _Stack:
    """Open elements, with the places of each name, so that the nearest one is found without a search."""

    def __init__(self):
        self.items: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if tag not in INLINE:
            self.blocks.append(len(self.items))
        self.items.append((tag, node))

    def nearest(self, *tags: str) -> int:
        """Place of the innermost open element with one of these names, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, at: int) -> None:
        """Close the element at this place and all inside it."""
        while len(self.items) > at:
            tag, _ = self.items.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()


class Page:
    """Block nodes in page order (a parent before its children) and the text pieces.

    ``parent``, ``tag``, ``against``, ``favour`` by node; node 0 is the page itself.
    Text outside every block element is a ``p`` of its own, up to the next block at top level.
    ``pieces``: (node, text, inside a link) in page order; breaks between blocks are pieces of one space.
    ``linking``: (name, attributes) of every tag that may link, shown or not; ``title``: the source of the first title.
    """

    def __init__(self, source: str):
        self.parent, self.tag = [-1], ["#page"]
        self.against, self.favour = [False], [False]
        self.pieces: list[tuple[int, str, bool]] = []
        self.linking: list[tuple[str, str]] = []
        self.title: str | None = None
        stack, hidden = _Stack(), _Stack()  # hidden: open hidden elements
        tags, loose = Tags(source), 0  # loose: node of the text at top level, since the last block there
        link, at, size = False, 0, len(source)

        def top() -> int:
            return stack.items[-1][1] if stack.items else 0

        def in_head() -> bool:
            return len(hidden.items) == 1 and hidden.items[0][0] == "head"

        while at < size:
            found = tags.next(at)
            upto = found[0] if found else size
            if in_head() and source[at:upto].strip():
                hidden.cut(0)
            if upto > at and not hidden.items:
                text, node = unescape(source[at:upto]), top()
                if node == 0 and text.strip():
                    if not loose:
                        loose = self._add(0, "p", False, False)
                    node = loose
                self.pieces.append((node, text, link))
            if not found:
                break
            _, at, closing, tag, attributes = found
            if not tag:
                continue
            if closing:
                if hidden.items:
                    if (place := hidden.nearest(tag)) >= 0:
                        hidden.cut(place)
                    continue
                if tag == "a":
                    link = False
                if (place := stack.nearest(tag)) >= 0:
                    stack.cut(place)
                    if tag not in INLINE:
                        link = False
                        self.pieces.append((top(), " ", False))
                continue
            if in_head() and tag not in IN_HEAD:
                hidden.cut(0)
            if tag in LINKING:
                self.linking.append((tag, attributes))
            if tag in HIDDEN:
                if tag == "head" and hidden.items:
                    continue
                if tag in RAW:
                    begin, (end, at) = at, raw_end(source, tag, at)
                    if tag == "title" and self.title is None:
                        self.title = source[begin:end]
                elif not attributes.endswith("/") or tag not in ("svg", "object"):
                    if tag != "option":
                        hidden.push(tag, 0)
                continue
            if hidden.items:
                if tag == "body":
                    hidden.cut(0)
                else:
                    continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.pieces.append((top(), " ", False))
                continue
            against, favour = hints(tag, attributes)
            if tag in INLINE:
                if tag == "a":
                    link = True
                if not against or tag == "a":
                    continue
            else:
                if tag in CLOSES_P:
                    if stack.blocks and stack.items[stack.blocks[-1]][0] == "p":
                        stack.cut(stack.blocks[-1])
                elif tag in ENDS:
                    ended, bound = ENDS[tag]
                    if (place := stack.nearest(*ended)) > stack.nearest(*bound):
                        stack.cut(place)
                link = False
                self.pieces.append((top(), " ", False))
                if top() == 0:
                    loose = 0
            node = self._add(top(), tag, against, favour)
            if not attributes.endswith("/") or tag in CLOSES_P or tag in INLINE:
                stack.push(tag, node)

    def _add(self, parent: int, tag: str, against: bool, favour: bool) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.against.append(against)
        self.favour.append(favour)
        return len(self.tag) - 1

    def text(self, kept) -> str:
        """The text of the kept nodes in page order, white space as single spaces."""
        return " ".join("".join(t if kept[n] else " " for n, t, _ in self.pieces).split())
