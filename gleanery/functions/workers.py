"""All code that runs inside Python workers.

Kept in one small module that is shipped with the closure (pickled by value),
so executors need no copy of the package. Everything else is built-in
expressions.
"""

from __future__ import annotations

import html
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(T.StringType())
def unescape(values: pd.Series) -> pd.Series:
    """Character references to characters; NULL in, NULL out."""
    return values.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_each(lists: pd.Series) -> pd.Series:
    """Character references to characters in every entry of a list without NULL entries."""
    return lists.map(lambda entries: [html.unescape(x) for x in entries], na_action="ignore")


def _automaton(terms: list[str]):
    """Multi-pattern matcher whose values are the positions of equal terms."""
    import ahocorasick

    places: dict[str, list[int]] = {}
    for position, term in enumerate(terms):
        places.setdefault(term, []).append(position)
    automaton = ahocorasick.Automaton()
    for term, positions in places.items():
        automaton.add_word(term, positions)
    automaton.make_automaton()
    return automaton


def term_finder(terms: list[str]):
    """Column function: which of many terms does a lower-cased text contain?

    Returns the positions of the terms, ascending. One automaton walks each
    text once whatever the number of terms; overlapping terms are all found.
    """
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(terms)

        def positions_in(text):
            if text is None:
                return None
            return sorted({p for _, found in automaton.iter(text) for p in found})

        for batch in batches:
            yield batch.map(positions_in)

    return find


# Elements without an end tag.
VOID = frozenset([
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
])
ELEMENT = T.StructType([
    T.StructField("ord", T.IntegerType()), T.StructField("parent", T.IntegerType()),
    T.StructField("last", T.IntegerType()), T.StructField("tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("t0", T.IntegerType()), T.StructField("t1", T.IntegerType()),
    T.StructField("up", T.ArrayType(T.IntegerType())),
])
PAGE_TREE = T.StructType([
    T.StructField("elems", T.ArrayType(ELEMENT)),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("owners", T.ArrayType(T.IntegerType())),
    T.StructField("scripts", T.ArrayType(T.StringType())),
])


def _reader():
    """A parser whose `read` gives (elements, texts, owners, scripts) of one page.

    Elements in document order and the text nodes between them.
    An element covers the text nodes t0 up to t1 and the elements up to
    `last`; `up` holds the elements around it, outermost first; `owners` holds the element each text node sits in directly. Script
    and style bodies are no text; script bodies are returned on their own.
    """
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def read(self, markup):
            self.reset()
            self.elems, self.texts, self.owners, self.scripts = [], [], [], []
            self.stack, self.up = [], []
            self.feed(markup)
            self.close()
            while self.stack:
                self.close_top()
            return self.elems, self.texts, self.owners, self.scripts

        def handle_starttag(self, tag, attrs):
            place, texts, up = len(self.elems), len(self.texts), self.up
            here = [place, up[-1] if up else -1, place, tag, {k: v or "" for k, v in attrs},
                    texts, texts, up.copy()]
            self.elems.append(here)
            if tag not in VOID:
                self.stack.append(here)
                up.append(place)

        def handle_endtag(self, tag):
            if any(e[3] == tag for e in self.stack):
                while self.close_top() != tag:
                    pass

        def handle_data(self, data):
            inside = self.stack[-1][3] if self.stack else ""
            if inside == "script":
                self.scripts.append(data)
            elif inside != "style" and data.strip():
                self.texts.append(data)
                self.owners.append(self.up[-1] if self.up else -1)

        def close_top(self):
            top = self.stack.pop()
            self.up.pop()
            top[2], top[6] = len(self.elems) - 1, len(self.texts)
            return top[3]

    return Reader(convert_charrefs=True)


#: Trees that a worker holds at once, by the characters of their pages and by their number.
PIECE_CHARS = 1 << 20
PIECE_PAGES = 256


def _pieces(pages):
    """Runs of a batch's pages that are parsed together."""
    piece, held = [], 0
    for page in pages:
        piece.append(page.as_py())
        held += len(piece[-1] or "")
        if held >= PIECE_CHARS or len(piece) >= PIECE_PAGES:
            yield piece
            piece, held = [], 0
    if piece:
        yield piece


# Markup about which every parser agrees: quoted or plain attribute values, tags without oddities.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^ \t\n\r\f"'<>=/`&]+)"""
_NAME = r"[a-zA-Z_:][-a-zA-Z0-9_:.]*"
_PLAIN = rf"""<(?:([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+{_NAME}(?:={_VALUE})?)*)[ \t\n\r\f]*(/?)>
|/([a-zA-Z][a-zA-Z0-9]*)>|!--(?:[^->]|-(?!-))*-->|![dD][oO][cC][tT][yY][pP][eE][^<>]*>)([^<]*)""".replace("\n|", "|")
_ATTRIBUTE = rf"""({_NAME})(?:=("[^"]*"|'[^']*'|[^ \t\n\r\f"'<>=/`&]+))?"""


class _Trees:
    """Trees of some pages as columns: elements, texts and scripts of all pages one after the other.

    A page of plain markup is cut into tags by one pattern; any other page is left to the library's
    parser (`_reader`), and both give the same tree.
    """

    def __init__(self, reader):
        import re
        from html.parser import HTMLParser

        self.reader = reader
        self.plain, self.attribute = re.compile(_PLAIN), re.compile(_ATTRIBUTE)
        self.ends = {t: re.compile(rf"</\s*{t}", re.I) for t in ("script", "style")}
        # elements whose content some versions of the library read as text
        self.odd = frozenset([*HTMLParser.CDATA_CONTENT_ELEMENTS, "plaintext", "noscript",
                              *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ())]) - self.ends.keys()
        self.clear()

    def clear(self):
        self.ord, self.parent, self.last, self.tag, self.t0, self.t1 = [], [], [], [], [], []
        self.names, self.values, self.attrs, self.up, self.ups = [], [], [0], [], [0]
        self.texts, self.owners, self.scripts = [], [], []
        self.counts = {"elems": [0], "texts": [0], "scripts": [0]}

    def add(self, page):
        marks = (len(self.ord), len(self.names), len(self.up), len(self.texts), len(self.scripts))
        if page is not None and not self.read(page, marks[0], marks[3]):
            e, n, u, t, s = marks
            for column in (self.ord, self.parent, self.last, self.tag, self.t0, self.t1):
                del column[e:]
            del self.names[n:], self.values[n:], self.attrs[e + 1:], self.up[u:], self.ups[e + 1:]
            del self.texts[t:], self.owners[t:], self.scripts[s:]
            self.take(self.reader.read(page))
        self.counts["elems"].append(len(self.ord))
        self.counts["texts"].append(len(self.texts))
        self.counts["scripts"].append(len(self.scripts))

    def take(self, found):
        for place, parent, last, tag, attrs, t0, t1, up in found[0]:
            self.start(place, parent, last, tag, t0, t1, up)
            self.names += attrs.keys()
            self.values += attrs.values()
            self.attrs.append(len(self.names))
        self.texts += found[1]
        self.owners += found[2]
        self.scripts += found[3]

    def start(self, place, parent, last, tag, t0, t1, up):
        self.ord.append(place)
        self.parent.append(parent)
        self.last.append(last)
        self.tag.append(tag)
        self.t0.append(t0)
        self.t1.append(t1)
        self.up += up
        self.ups.append(len(self.up))

    def read(self, page, first, first_text):
        """Append the tree of a page of plain markup; False, with a part of it, if it is no such page."""
        match, unescape, last, t1 = self.plain.match, html.unescape, self.last, self.t1
        texts, owners, tags, up = self.texts, self.owners, [], []
        at = page.find("<")
        text = page[:at] if at >= 0 else page
        end = len(page)
        place = 0
        at = at if at >= 0 else end
        while True:
            if text and not text.isspace():
                text = unescape(text)
                if text.strip():
                    texts.append(text)
                    owners.append(up[-1] if up else -1)
            if at == end:
                break
            found = match(page, at)
            if found is None:
                return False
            tag, attrs, empty, closed, text = found.groups()
            at = found.end()
            if tag is not None:
                tag = tag.lower()
                if tag in self.odd:
                    return False
                here = len(texts) - first_text
                self.start(place, up[-1] if up else -1, place, tag, here, here, up)
                if attrs:
                    some = {}
                    for name, value in self.attribute.findall(attrs):
                        if value[:1] in ('"', "'"):
                            value = value[1:-1]
                        some[name.lower()] = unescape(value) if value else ""
                    self.names += some.keys()
                    self.values += some.values()
                self.attrs.append(len(self.names))
                if empty:
                    closed = tag
                if tag not in VOID:
                    tags.append(tag)
                    up.append(place)
                place += 1
                if not empty and tag in self.ends:
                    begin = at - len(text)
                    over = self.ends[tag].search(page, begin)
                    if over is None or not page.startswith(">", over.end()) or over.end() - over.start() != len(tag) + 2:
                        return False
                    if tag == "script" and over.start() > begin:
                        self.scripts.append(page[begin:over.start()])
                    at, text = over.start(), ""
            if closed is not None:
                closed = closed.lower()
                if closed in tags:
                    done, here = first + place - 1, len(texts) - first_text
                    while True:
                        top = first + up.pop()
                        last[top], t1[top] = done - first, here
                        if tags.pop() == closed:
                            break
        for top in up:
            last[first + top], t1[first + top] = place - 1, len(texts) - first_text
        return True

    def columns(self) -> pa.StructArray:
        ints = lambda values: pa.array(values, pa.int32())
        strings = lambda values: pa.array(values, pa.string())
        attrs = pa.MapArray.from_arrays(ints(self.attrs), strings(self.names), strings(self.values))
        up = pa.ListArray.from_arrays(ints(self.ups), ints(self.up))
        element = pa.StructArray.from_arrays(
            [ints(self.ord), ints(self.parent), ints(self.last), strings(self.tag), attrs, ints(self.t0),
             ints(self.t1), up], names=ELEMENT.names)
        lists = lambda name, values: pa.ListArray.from_arrays(ints(self.counts[name]), values)
        return pa.StructArray.from_arrays(
            [lists("elems", element), lists("texts", strings(self.texts)), lists("texts", ints(self.owners)),
             lists("scripts", strings(self.scripts))], names=PAGE_TREE.names)


@F.arrow_udf(PAGE_TREE)
def page_tree(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Parse each page once; all extraction works on the result with expressions.

    A batch's trees leave the worker piece by piece, so its memory doesn't grow with the batch.
    """
    trees = _Trees(_reader())
    for pages in batches:
        for piece in _pieces(pages):
            for page in piece:
                trees.add(page)
            yield trees.columns()
            trees.clear()


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def assignments(scripts: pd.Series) -> pd.Series:
    """`var x = ...;` and `variables.x = ...;` to name and right-hand side.

    The right-hand side ends at the first semicolon outside strings and
    brackets; a name assigned twice keeps the later value.
    """
    import re

    start = re.compile(r"(?:variables\.|var\s+)([A-Za-z0-9_]+)\s*=\s*")
    token = re.compile(r"\"(?:\\.|[^\"\\])*\"?|'(?:\\.|[^'\\])*'?|[{}\[\]();]", re.S)

    def right_side(text, begin):
        open_brackets = {"{": 0, "[": 0, "(": 0}
        partner = {"}": "{", "]": "[", ")": "("}
        for found in token.finditer(text, begin):
            mark = found.group()
            if mark in open_brackets:
                open_brackets[mark] += 1
            elif mark in partner:
                open_brackets[partner[mark]] -= 1
            elif mark == ";" and not any(open_brackets.values()):
                return text[begin:found.start()].strip()
        return text[begin:].strip()

    def read(bodies):
        if bodies is None:
            return None
        return {m.group(1): right_side(body, m.end()) for body in bodies
                for m in start.finditer(body)}

    return scripts.map(read)
