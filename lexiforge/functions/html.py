"""HTML to ordered paragraphs with ruby readings kept, on the standard library's parser.

Deviations, on purpose: a <p> ends at the next <p> or block start, comments are dropped.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiforge.functions.text import EXPORT_NOISE, WORD_SIGN

# Elements that hold no text, those that make paragraphs, and those without an end.
SKIPPED = frozenset({"style", "script", "svg", "head", "title"})
BLOCKS = frozenset({"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "li"})
#: Characters of pages that are parsed before the results go into Arrow memory.
SLICE = 1_000_000
VOID = frozenset({"br", "img", "hr", "meta", "link", "input", "wbr", "col", "area", "base", "embed", "source", "track"})


class Node:
    __slots__ = ("kids", "name", "up")

    def __init__(self, name: str, up: Node | None):
        self.name, self.up, self.kids = name, up, []

    def walk(self):
        """All elements below, in document order; without recursion, for deep documents."""
        stack = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(k for k in reversed(node.kids) if isinstance(k, Node))

    def text(self) -> str:
        out, stack = [], list(reversed(self.kids))
        while stack:
            kid = stack.pop()
            if isinstance(kid, str):
                out.append(kid)
            else:
                stack.extend(reversed(kid.kids))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", None)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._close({"p"}, BLOCKS - {"p"})
        if tag in ("rt", "rp", "rb"):
            self._close({"rt", "rp", "rb"}, {"ruby"})
        if tag == "li":
            self._close({"li"}, {"ul", "ol"})
        node = Node(tag, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, names, walls):
        """Ends the nearest open element of these names, unless a wall stands before it."""
        node = self.at
        while node is not None and node.name not in names and node.name not in walls:
            node = node.up
        if node is not None and node.name in names:
            self.at = node.up

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.name != tag:
            node = node.up
        if node is not None and node.up is not None:
            self.at = node.up

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _ruby(node: Node) -> tuple[str, str]:
    base = read = ""
    for kid in node.kids:
        if isinstance(kid, str):
            base += kid if kid.strip() else ""
        elif kid.name == "rt":
            read += kid.text()
        elif kid.name != "rp":
            base += kid.text()
    return base.strip(), read.strip()


def segments(node: Node) -> list[tuple[str, str, str]]:
    """(kind, text, reading) of everything below, in order."""
    out, stack = [], list(reversed(node.kids))
    while stack:
        kid = stack.pop()
        if isinstance(kid, str):
            out.append(("plain", kid, ""))
        elif kid.name == "ruby":
            base, read = _ruby(kid)
            if base:
                out.append(("ruby", base, read))
        elif kid.name == "br":
            out.append(("plain", "\n", ""))
        elif kid.name not in SKIPPED:
            stack.extend(reversed(kid.kids))
    return out


def _clean(text: str) -> str:
    return " ".join(text.split())


_NOISE, _SIGN = re.compile(EXPORT_NOISE), re.compile(WORD_SIGN.removeprefix("(?U)"))


def junk(text: str) -> bool:
    return len(text) < 2 or bool(_NOISE.search(text)) or not _SIGN.search(text)


def paragraphs_of(root: Node) -> list[dict]:
    """[{text, annot}]: all <p>; with fewer than three that hold text, the innermost block elements."""
    found = [n for n in root.walk() if n.name == "p"]
    if sum(bool(n.text().strip()) for n in found) < 3:
        found = [n for n in root.walk() if n.name in BLOCKS and not any(k.name in BLOCKS for k in n.walk())]
    out = []
    for node in found:
        parts = segments(node)
        text = _clean("".join(t for _, t, _ in parts))
        if parts and not junk(text):
            out.append({"text": text, "annot": _clean("".join(f"{t}[{r}]" if k == "ruby" and r else t for k, t, r in parts))})
    return out


def title_of(root: Node) -> str | None:
    for node in root.walk():
        if node.name in ("h1", "h2", "h3", "h4") and (text := "".join(x.strip() for x in node.text().split("\n"))):
            return text.strip()[:80]
    return None


_PARAS = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("annot", T.StringType())]))


@F.arrow_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("paras", _PARAS)]))
def document(html: pa.Array) -> pa.Array:
    """Title and paragraphs from one parse; of a batch no more than some SLICE characters are Python objects at a time."""
    kind = pa.struct([("title", pa.string()), ("paras", pa.list_(pa.struct([("text", pa.string()), ("annot", pa.string())])))])
    done, rows, size = [pa.array([], kind)], [], 0
    for page in html:
        text = page.as_py()
        root = parse(text)
        rows.append({"title": title_of(root), "paras": paragraphs_of(root)})
        size += len(text or "")
        if size > SLICE:
            done.append(pa.array(rows, kind))
            rows, size = [], 0
    return pa.concat_arrays([*done, pa.array(rows, kind)])


def paragraphs(html) -> F.Column:
    return document(html)["paras"]


def chapter_title(html) -> F.Column:
    return document(html)["title"]
