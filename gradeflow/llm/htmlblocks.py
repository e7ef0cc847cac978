"""HTML pages as leaf blocks: runs of text between block-level tags, with features of the
elements they lie in and of their text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

#: A comment, a declaration, or a tag: end mark, name, attributes. A tag whose quotes do not
#: close ends at the next ">".
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text of the page, and no tag inside counts.
RAW = frozenset("script style iframe noembed noframes xmp textarea title".split())
#: Their content is not shown as text.
UNSEEN = frozenset("template noscript svg math select datalist audio video canvas object".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: Elements that say what they hold even without a class or id.
TELLING = frozenset("article aside footer form header main nav".split())
#: What a start tag ends, and the elements beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: A paragraph ends at any block-level tag, but not beyond these.
P_SCOPE = frozenset("table td th caption button html".split())
LABEL = re.compile(r'data-main="([01])"')


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    path: frozenset  # features of all elements around it
    own: str  # the nearest block-level element
    near: tuple  # features of the nearest element that says what it holds
    main: bool | None  # its label on a labelled page


class _Open:
    __slots__ = ("tag", "path", "own", "near", "link", "unseen", "main")

    def __init__(self, tag, path, own, near, link, unseen, main):
        self.tag, self.path, self.own, self.near, self.link, self.unseen, self.main = tag, path, own, near, link, unseen, main


def element_features(tag: str, attributes: str) -> list[str]:
    """The tag, and the words of its class, id and role."""
    out = [f"t={tag}"]
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                out += [f"c={w}" for w in WORD.findall(value.lower())]
            elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                out.append("c=hidden")
    return out


def blocks(html: str | None) -> Iterator[Block]:
    """The leaf blocks of a page with any text, in order; white space in a block is one space."""
    root = _Open("", frozenset(), "", (), False, False, None)
    stack, parts, linked, top = [root], [], 0, root
    html = html or ""
    at, end = 0, len(html)

    def finish():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                yield Block(text, linked, where.path, where.own, where.near, where.main)
            parts, linked = [], 0

    where = root
    while at < end:
        m = TAG.search(html, at)
        stop = m.start() if m else end
        if stop > at and not top.unseen:
            text = unescape(html[at:stop])
            if not parts:
                where = top
            elif not where.main and top.main:
                where = top
            parts.append(text)
            if top.link:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            yield from finish()
        elif tag == "br":
            parts.append(" ")
        if closing:
            inline = tag not in BLOCKS
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if inline and stack[i].tag in BLOCKS:
                    break  # an inline end tag closes no block
            top = stack[-1]
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            found = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            at = found.start() if found else end
            if found:
                at = (html.find(">", at) + 1) or end
            continue
        if tag in BLOCKS:
            for ended, scope in ([({"p"}, P_SCOPE)] if tag != "body" else []) + ([ENDS[tag]] if tag in ENDS else []):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ended:
                        first = i
                        while first > 1 and stack[first - 1].tag in ended:
                            first -= 1
                        del stack[first if len(ended) > 2 else i :]
                        break
                    if stack[i].tag in scope:
                        break
            top = stack[-1]
        if attributes.endswith("/") and tag not in BLOCKS:
            continue
        features = element_features(tag, attributes)
        path = top.path if top.path.issuperset(features) else top.path.union(features)
        label = LABEL.search(attributes) if "data-main" in attributes else None
        near = tuple(f"near:{f}" for f in features) if tag in TELLING or len(features) > 1 and tag in BLOCKS else top.near
        top = _Open(tag, path, tag if tag in BLOCKS else top.own, near, top.link or tag == "a", top.unseen or tag in UNSEEN, label[1] == "1" if label else top.main)
        stack.append(top)
    yield from finish()


SIZES = (1, 3, 6, 11, 21, 41)
#: Words of blocks of at most so many words are features.
SHORT = 25


def text_features(block: Block) -> list[str]:
    """Size, share of links, punctuation, digits; the words of a short block."""
    words = block.text.split(" ")
    size = sum(len(words) >= s for s in SIZES)
    share = block.linked / len(block.text)
    link = 0 if not share else 1 if share < 0.3 else 2 if share < 0.8 else 3
    last = block.text[-1]
    out = [f"size={size}", f"link={link}", f"size,link={size},{link}", f"own={block.own}", f"own,size={block.own},{size}", "end=stop" if last in ".!?…。" else "end=" + ("word" if last.isalnum() else "other")]
    if "©" in block.text:
        out.append("sign=c")
    if "," in block.text:
        out.append("comma")
    if sum(map(str.isdigit, block.text[:200])) * 3 > min(200, len(block.text)):
        out.append("digits")
    if len(words) <= SHORT:
        out += {f"w={w}" for w in WORD.findall(block.text.lower())}
    return out


def features(page: list[Block]) -> list[list[str]]:
    """The features of each block of a page: of its elements, its text, and of how large its
    neighbours are."""
    texts = [text_features(b) for b in page]
    out = []
    for i, (block, own) in enumerate(zip(page, texts)):
        around = [f"before={texts[i - 1][2]}" if i else "first", f"after={texts[i + 1][2]}" if i + 1 < len(page) else "last"]
        out.append(["any", *block.path, *block.near, *own, *around])
    return out
