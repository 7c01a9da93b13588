"""What one landed page says about itself, read from its token stream.

This module is shipped to the Python workers as it is, so that they need no
installation of the package; it must not import from it.
"""

from __future__ import annotations

import html
import json
import math
import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

NO_HEAD = "no <head> found"
JSON_LD = "application/ld+json"

# --- fixed values: tags and columns of the output ---------------------------

#: (column, attribute value) of the metadata tags, by identifying attribute.
NAMED_META = (
    ("meta_description", "description"),
    ("meta_keywords", "keywords"),
    ("meta_robots", "robots"),
    ("meta_author", "author"),
)
OG_META = tuple(
    (name.replace(":", "_"), name)
    for name in ("og:title", "og:description", "og:url", "og:type", "og:image",
                 "og:site_name", "og:image:width", "og:image:height")
)
TWITTER_META = tuple(
    (name.replace(":", "_"), name)
    for name in ("twitter:card", "twitter:title", "twitter:description",
                 "twitter:image", "twitter:site")
)

#: Elements without content in HTML, obsolete ones included.
VOID = {
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img",
    "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
}
#: Elements whose text is not text of the surrounding element.
NOT_TEXT = {"rp", "rt", "script", "style", "template"}

# --- end of fixed values -----------------------------------------------------


class PageReader(HTMLParser):
    """Collects the metadata of one page from the token stream.

    Keeps the stack of open elements: a closing tag ends the nearest open
    element of its name with everything left open inside it, and is ignored
    when there is none. That decides what lies within the head, a title or a
    heading in malformed pages too.
    """

    # Newer tokenizers would treat titles as raw text; results must not depend on that.
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open: list[str] = []
        self.open_by_name: Counter[str] = Counter()
        self.open_not_text = 0
        self.head_depth: int | None = None
        self.in_head = False
        self.named: dict[str, str | None] = {}
        self.props: dict[str, str | None] = {}
        self.canonical: list[str | None] = []
        self.alternates: list[dict] = []
        self.title: list[str] | None = None
        self.headings: list[list[str]] = []
        self.blocks: list[str] = []
        self._pending: list[str] = []
        self._texts: list[tuple[int, list[str]]] = []
        self._block: list[str] | None = None

    def updatepos(self, i, j):
        return j  # line numbers are not needed, and counting them takes time

    # -- tokens ---------------------------------------------------------------

    def handle_starttag(self, tag, attrs):
        self._enter(tag, attrs)
        if tag in VOID:
            self._leave(tag)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs)
        self._leave(tag)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._leave(tag)

    def handle_data(self, data):
        if self._block is not None:
            self._block.append(data)
        elif self._texts:
            self._pending.append(data)

    def handle_charref(self, name):
        self.handle_data(html.unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.handle_data(html5.get(name + ";", "&" + name))

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_text()
        if data[:6].upper() == "CDATA[":
            self.handle_data(data[6:])
            self._end_text()

    def finish(self) -> dict:
        self.close()
        self._end_text()
        if self.head_depth is None:
            return {"error": NO_HEAD}
        found: dict = {"title": None if self.title is None else "".join(self.title)}
        for column, name in NAMED_META + TWITTER_META:
            found[column] = self.named.get(name)
        for column, name in OG_META:
            found[column] = self.props.get(name)
        found["canonical"] = self.canonical[0] if self.canonical else None
        found["alternates"] = self.alternates
        found["schema_json_ld"] = [b for b in map(valid_json, self.blocks) if b is not None] or None
        found["h1"] = [text for text in map("".join, self.headings) if text]
        return found

    # -- elements -------------------------------------------------------------

    def _enter(self, tag, attrs):
        self._end_text()
        values = {name: value or "" for name, value in attrs}
        self.open.append(tag)
        self.open_by_name[tag] += 1
        self.open_not_text += tag in NOT_TEXT
        if self.in_head:
            self._enter_in_head(tag, values)
        elif tag == "head" and self.head_depth is None:
            self.head_depth, self.in_head = len(self.open), True
        if tag == "h1":
            self.headings.append(self._collect_text())
        elif tag == "script" and values.get("type") == JSON_LD:
            self._block = []

    def _enter_in_head(self, tag, values):
        if tag == "title" and self.title is None:
            self.title = self._collect_text()
        elif tag == "meta":
            content = values.get("content") or None
            self.named.setdefault(values.get("name"), content)
            self.props.setdefault(values.get("property"), content)
        elif tag == "link":
            rel = values.get("rel", "").split()
            href = values.get("href") or None
            if "canonical" in rel:
                self.canonical.append(href)
            if "alternate" in rel and href:
                self.alternates.append({"href": href, "hreflang": values.get("hreflang")})

    def _leave(self, tag):
        self._end_text()
        if not self.open_by_name[tag]:
            return
        closed = None
        while closed != tag:
            closed = self.open.pop()
            self.open_by_name[closed] -= 1
            self.open_not_text -= closed in NOT_TEXT
        depth = len(self.open)
        if self.in_head and depth < self.head_depth:
            self.in_head = False
        while self._texts and depth < self._texts[-1][0]:
            self._texts.pop()
        if self._block is not None and tag == "script":
            self.blocks.append("".join(self._block))
            self._block = None

    # -- text -----------------------------------------------------------------

    def _collect_text(self) -> list[str]:
        pieces: list[str] = []
        self._texts.append((len(self.open), pieces))
        return pieces

    def _end_text(self):
        """Close the current run of text: each run is stripped on its own."""
        if not self._pending:
            return
        text = "".join(self._pending).strip()
        self._pending.clear()
        if text and not self.open_not_text:
            for _, pieces in self._texts:
                pieces.append(text)


#: Digits that a reader's exact decimals hold.
EXACT_DIGITS = 38
#: Levels of nesting that are kept; readers downstream refuse many more.
MAX_DEPTH = 200


def _finite(number: str) -> float | None:
    value = float(number)
    return value if math.isfinite(value) else None


def _integer(number: str) -> int | float | None:
    return int(number) if len(number) <= EXACT_DIGITS else _finite(number)


def _cut(value, depth: int = MAX_DEPTH):
    """The value without what is nested deeper than ``depth``."""
    if isinstance(value, dict):
        return {k: _cut(v, depth - 1) for k, v in value.items()} if depth else None
    if isinstance(value, list):
        return [_cut(v, depth - 1) for v in value] if depth else None
    return value


_BRACKET = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', re.DOTALL)


def _shallow(text: str, depth: int = MAX_DEPTH) -> str:
    """The JSON text with null for what is nested deeper than ``depth``, found without recursion."""
    kept, closers, at = [], [], 0
    for found in _BRACKET.finditer(text):
        mark = found[0]
        if mark in "[{":
            closers.append("]" if mark == "[" else "}")
            if len(closers) == depth + 1:
                kept += [text[at:found.start()], "null"]
        elif mark in "]}":
            if not closers or closers.pop() != mark:
                raise ValueError("brackets do not match")
            if len(closers) == depth:
                at = found.end()
    if closers:
        raise ValueError("brackets are left open")
    return "".join([*kept, text[at:]])


def _parsed(text: str):
    return _cut(json.loads(text, parse_constant=lambda _: None, parse_float=_finite, parse_int=_integer))


def valid_json(text: str) -> str | None:
    """Normal form of a JSON text, NULL when it is none.

    Repeated keys keep the last value, numbers beyond the range of doubles become
    null like other non-finite ones, overlong integers become doubles, and what is
    nested too deep becomes null: stricter readers downstream would reject the block.
    A block is never dropped for its depth.
    """
    try:
        try:
            value = _parsed(text)
        except RecursionError:
            value = _parsed(_shallow(text))
        normal = json.dumps(value, ensure_ascii=False, allow_nan=False)
        normal.encode()
    except UnicodeEncodeError:
        return json.dumps(value)
    except ValueError:
        return None
    return normal


def read_page(text: str) -> dict:
    reader = PageReader()
    reader.feed(text)
    return reader.finish()
