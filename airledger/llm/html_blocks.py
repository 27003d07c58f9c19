"""Leaf blocks of an HTML page: runs of text between block elements, with the elements around them."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

# Element names of the HTML standard, by what they do to the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
SKIPPED = frozenset("script style title noscript template textarea iframe svg math object canvas select".split())
RAW = frozenset("script style title textarea iframe".split())  # never closed, they run to the end of the page
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
CLOSES_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPES = frozenset("ul ol dl table body div article section main td th".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)

TOKEN = re.compile(r"<!--|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)|<[!?/]")
# The attributes of a tag and its end, as HTML reads them: a quote opens a value after "=" only.
ATTRIBUTE = r"""[\s/]*+[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+"""
ONE_ATTRIBUTE = re.compile(ATTRIBUTE)
TAG_END = re.compile(r"[\s/]*+>")
REST = re.compile(rf"(?:{ATTRIBUTE})*+[\s/]*+>")
MARKS = re.compile(r"""(?<![\w-])(?:class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+))?""")
REMEMBERED = 1 << 12  # characters of an element or path worth keeping between pages
MARK_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Path:
    """An element inside others. Blocks of the same element share it, so deep pages cost no more than flat ones."""

    __slots__ = ("parent", "element", "score")

    def __init__(self, parent: Path | None, element: str):
        self.parent, self.element = parent, element  # name and marking attributes
        self.score = None  # what a decoder worked out for it

    def elements(self) -> tuple[str, ...]:
        """From the outermost one on."""
        out, here = [], self
        while here is not None:
            out.append(here.element)
            here = here.parent
        return tuple(reversed(out))


@dataclass(slots=True)
class Block:
    text: str
    around: Path | None
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        return self.around.elements() if self.around else ()


@lru_cache(maxsize=1 << 14)
def _described(element: str) -> tuple[str, tuple[str, ...]]:
    name, _, rest = element.partition(" ")
    return name, tuple(dict.fromkeys(w.lower() for w in MARK_WORD.findall(rest)))


def described(element: str) -> tuple[str, tuple[str, ...]]:
    """Name of an element and the words of its marking attributes; long ones are not remembered."""
    return _described(element) if len(element) <= REMEMBERED else _described.__wrapped__(element)


class Tags:
    """Where the tags of a page end, in time linear in the page."""

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")  # no tag ends after it
        self.endless: set[int] | None = None  # places from which attributes run to the end of the page

    def end(self, at: int) -> int:
        """The place after the tag whose attributes start here; after the next ">" if they never end."""
        if self.endless is None:
            found = REST.match(self.html, at)
            if found:
                return found.end()
            self.endless = set()
        # Some tag does not end: go by attributes, and from no place twice.
        seen, place = [], at
        while place not in self.endless:
            found = TAG_END.match(self.html, place)
            if found:
                return found.end()
            seen.append(place)
            found = ONE_ATTRIBUTE.match(self.html, place)
            if not found:
                break
            place = found.end()
        self.endless.update(seen)
        return self.html.index(">", at) + 1


def closing_tag(html: str, name: str, at: int, nested: bool) -> int:
    """The place after the closing tag of an element whose content starts here; -1 without one.

    ``nested`` counts elements of the same name inside it; where they do not balance, the last closing tag counts.
    """
    depth, last = 1, -1
    for found in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])", re.I).finditer(html, at):
        end = html.find(">", found.end()) + 1
        if not end:
            break
        if not found[1]:
            depth += nested and html[end - 2] != "/"
            continue
        depth, last = depth - 1, end
        if not depth:
            break
    return last


def blocks(html: str) -> list[Block]:
    """The page's non-empty leaf blocks in order: references decoded, white space made one blank."""
    out: list[Block] = []
    path: list[Path] = []
    names: list[str] = []
    opened: Counter[str] = Counter()  # names among them
    texts: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join(unescape("".join(texts)).split())
            if text:
                out.append(Block(text, path[-1] if path else None, linked))
            texts.clear()
        linked = 0

    def leave(place: int) -> None:
        opened.subtract(names[place:])
        del path[place:], names[place:]

    size, tags = len(html), Tags(html)
    unclosed: set[str] = set()  # names without a closing tag in the rest of the page
    while at < size:
        found = TOKEN.search(html, at)
        if found and found.start() > tags.last:  # only a comment needs no end
            start = html.find("<!--", found.start())
            found = TOKEN.match(html, start) if start >= 0 else None
        end = found.start() if found else size
        if end > at:
            piece = html[at:end]
            texts.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not found:
            break
        name, after = found["name"], found.end()
        if name is None:
            if found[0] == "<!--":
                # "<!-->" and "<!--->" are whole comments.
                closing = html.find("-->", after - 2)
                at = closing + 3 if closing >= 0 else size
            else:
                at = html.index(">", after) + 1
            continue
        at = tags.end(after)
        name = name.lower()
        if found["close"]:
            if name in INLINE:
                if name == "a":
                    in_link = False
                continue
            flush()
            if opened[name]:
                leave(len(names) - 1 - names[::-1].index(name) if names[-1] != name else len(names) - 1)
            continue
        rest = html[after : at - 1]
        if name in SKIPPED:
            if not rest.rstrip().endswith("/"):
                closing = -1 if name in unclosed else closing_tag(html, name, at, name not in RAW)
                if closing >= 0:
                    at = closing
                elif name in RAW:
                    at = size
                else:
                    unclosed.add(name)
            texts.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                in_link = True
            elif name == "br":
                texts.append(" ")
            continue
        flush()
        in_link = in_link and name not in ("li", "nav", "footer", "article")
        if name in VOID:
            continue
        closed = CLOSES_ITSELF.get(name, frozenset())
        ends = name in ENDS_PARAGRAPH and opened["p"] or any(opened[other] for other in closed)
        for place in range(len(names) - 1, -1, -1) if ends else ():
            if names[place] in closed or names[place] == "p" and name in ENDS_PARAGRAPH:
                leave(place)
                break
            if names[place] in SCOPES:
                break
        names.append(name)
        opened[name] += 1
        element = " ".join([name, *MARKS.findall(rest)]) if rest and not rest.isspace() else name
        path.append(Path(path[-1] if path else None, element))
    flush()
    return out
