"""A page as a stream of structure tokens with the text between them.

Containers open and close; block tags only begin, as their ends are optional in practice; inline
tags are part of the text. Every run of text carries the containers it lies in, how many of its
words are link words, and its characters with references decoded and white space collapsed.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# fixed values: element names of HTML by how they nest
CONTAINERS = frozenset(
    "html head body div section article main aside header footer nav form fieldset table thead tbody tfoot ul ol dl "
    "menu figure details dialog template noscript select button svg iframe object video audio canvas map "
    "blockquote center address search label textarea datalist optgroup math picture".split()
)
BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption pre hr figcaption summary legend option title hgroup".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_ATTRIBUTES = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_DIGITS = re.compile(r"\d+")
TEXT = "#text"


@dataclass
class Token:
    key: str  # "<name.class#id" , "</name" or TEXT
    path: tuple[str, ...]  # keys of the containers around it, and of the block it is in
    text: str = ""
    link_words: int = 0
    words: int = 0


def _key(name: str, attributes: str) -> str:
    """A tag with what names its purpose; numbers in names are one and the same."""
    found = {}
    for m in _ATTRIBUTES.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = [found.get("class", ""), found.get("id", ""), found.get("role", ""), found.get("itemprop", "")]
    marks = sorted({_DIGITS.sub("N", w.lower()) for n in names for w in n.split()})
    hidden = ["hidden"] if "hidden" in found or found.get("aria-hidden", "").lower() == "true" else []
    return "<" + ".".join([name, *marks, *hidden])


def tokens(page: str) -> list[Token]:
    """Structure and text in page order; comments, scripts and styles leave nothing."""
    out: list[Token] = []
    stack: list[str] = []
    block = ""
    parts: list[str] = []
    links: list[str] = []
    in_link = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = (*stack, block) if block else tuple(stack)
            out.append(Token(TEXT, path, text, len(html.unescape(" ".join(links)).split()), len(text.split())))
        parts.clear()
        links.clear()

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            parts.append(page[at:lt])
            if in_link:
                links.append(page[at:lt])
        if lt == n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if not m:
            parts.append("<")
            at = lt + 1
            continue
        closing, name, at = bool(m[1]), m[2].lower(), m.end()
        if name in RAW and not closing:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else n
            after = page.find(">", stop) if end else n - 1
            if name in ("title", "textarea"):
                flush()
                inside = " ".join(html.unescape(page[at:stop]).split())
                if inside:
                    out.append(Token(TEXT, (*stack, f"<{name}"), inside, 0, len(inside.split())))
            at = n if after < 0 else after + 1
        elif name in CONTAINERS:
            flush()
            block = ""
            if not closing:
                key = _key(name, m[3])
                out.append(Token(key, tuple(stack)))
                if not m[3].rstrip().endswith("/") or name not in ("svg", "iframe", "object"):
                    stack.append(key)
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][1:].split(".", 1)[0] == name:
                        del stack[k:]
                        out.append(Token("</" + name, tuple(stack)))
                        break
        elif name in BLOCKS:
            flush()
            block = "" if closing or name == "hr" else _key(name, m[3])
            if block:
                out.append(Token(block, tuple(stack)))
        elif name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = 0 if closing else 1
    flush()
    return out
