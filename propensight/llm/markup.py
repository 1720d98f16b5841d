"""A tolerant reader of HTML: elements with a hash of their paths, blocks of text, and the order of both."""

from __future__ import annotations

import html
import re
from functools import lru_cache

import xxhash

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Elements by their role in HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr img").split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                      "h5 h6 header hgroup hr main menu nav ol p pre section summary table ul").split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot"}}
CLOSED_BY |= {"thead": CLOSED_BY["tbody"], "tfoot": CLOSED_BY["tbody"]}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "optgroup": {"select"}}
SCOPE = {"table"}
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote figcaption pre caption".split())  # where inline elements are words of a text


def digest(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


class Element:
    __slots__ = ("parent", "tag", "names", "key")

    def __init__(self, parent: Element | None, tag: str, names: str):
        self.parent, self.tag, self.names = parent, tag, names
        # Not negative, so that the complement is free for the end of the element; digits in names (`post-17`) do not count.
        self.key = digest(f"{tag}.{' '.join(words(names))}" if names else tag, parent.key) >> 1 if parent else 0

    def above(self):
        e = self
        while e is not None:
            yield e
            e = e.parent


def read(page: str, splits=frozenset()) -> tuple[list[Element], list[tuple[Element, str | None]]]:
    """All elements, and the stream of the page: each element that is not inline where it starts (with an empty text) and ends (with
    None), and the blocks of text with the element they are in, white space as single blanks, references decoded.

    Inline elements do not end a block unless a word of their class or id is in ``splits`` and they stand in no paragraph."""
    root = Element(None, "", "")
    elements, stream = [root], [(root, "")]
    split: set[Element] = set()
    stack: list[Element] = [root]
    piece: list[str] = []
    owner = root

    def flush() -> None:
        nonlocal piece
        text = " ".join("".join(piece).split())
        if text:
            stream.append((owner, text))
        piece = []

    def is_inline(e: Element) -> bool:
        return e.tag in INLINE and e not in split

    def pop_to(i: int) -> None:
        nonlocal owner
        if any(not is_inline(e) for e in stack[i:]):
            flush()
        stream.extend((e, None) for e in reversed(stack[i:]) if not is_inline(e))
        del stack[i:]
        owner = next(e for e in reversed(stack) if not is_inline(e))

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            piece.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            piece.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE and tag not in SCOPE:
                    break
            else:
                if tag == "br":
                    piece.append(" ")
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            closing, limits = ({"p"}, {"table", "td", "th", "button"}) if tag in CLOSES_P else (CLOSED_BY[tag], LISTS.get(tag, {"table"}))
            low = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closing:
                    low = i
                elif stack[i].tag in limits:
                    break
            if low is not None:
                pop_to(low)
        if tag == "br":
            piece.append(" ")
            continue
        attributes = m[3] or m[6]
        names = " ".join(" ".join(next(filter(None, a.groups()[1:]), "").split()) for a in _ATTRIBUTE.finditer(attributes)) if attributes else ""
        element = Element(stack[-1], tag, names)
        if tag in INLINE and splits.intersection(words(names)) and owner.tag not in RUNNING:
            split.add(element)
        if not is_inline(element):
            flush()
        if tag in VOID:
            continue
        elements.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        stack.append(element)
        if not is_inline(element):
            stream.append((element, ""))
            owner = element
    pop_to(1) if len(stack) > 1 else flush()
    flush()
    stream.append((root, None))
    return elements, stream


@lru_cache(maxsize=1 << 14)
def words(names: str) -> list[str]:
    """Lower-case words of class and id, also inside hyphens, underscores and camel case."""
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower())
