"""HTML pages as nodes, selections in a page, and column expressions that select from node arrays.

A small parser turns a page into nodes in document order.  Records of the boards are read off them in the
same pass (``record_reader``); for any other use they become one array per page, a Spark column.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.functions.text import bind, strip

# Send the Python functions of this module to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE = T.StructType(
    [
        T.StructField("at", T.IntegerType()),       # position in the array
        T.StructField("last", T.IntegerType()),     # position of the last node inside it
        T.StructField("parent", T.IntegerType()),
        T.StructField("tag", T.StringType()),       # "#text" for text
        T.StructField("cls", T.StringType()),       # class attribute
        T.StructField("link", T.StringType()),      # href
        T.StructField("data", T.StringType()),      # a data-…-url… attribute
        T.StructField("job", T.StringType()),       # data-job-id
        T.StructField("text", T.StringType()),
    ]
)

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
_TEXT = ("#text", None, None, None, None)
_TAGS = re.compile(r"<([^<>]*)>")
_NAME = r"[a-zA-Z][a-zA-Z0-9]*"
_START = re.compile(rf"({_NAME})((?:[ \t\n\r\f]+[a-zA-Z][-a-zA-Z0-9_]*=(?:\"[^\"]*\"|'[^']*'))*)[ \t\n\r\f]*(/?)")
_END = re.compile(rf"/({_NAME})")
_SKIPPED = re.compile(r"!--(?!-?$|-?>)(?:(?!--).)*--|!doctype [^<>\[\]]*", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-a-zA-Z0-9_]*)=(?:\"([^\"]*)\"|'([^']*)')")
_SPACES = re.compile(r"[ \t\n\x0b\f\r]+")
#: Distinct tags, and tests of class attributes, that a task remembers.
_REMEMBERED = 20_000


def _kind(tag: str, attributes: list[tuple[str, str | None]]) -> tuple:
    """Tag, class, href, a data-…-url… attribute, data-job-id."""
    named = dict(attributes)
    data = next((v for k, v in attributes if k.startswith("data-") and "url" in k), None)
    return tag, named.get("class"), named.get("href"), data, named.get("data-job-id")


class Page:
    """The nodes of a page by position: last node inside, parent, kind (see ``_kind``), text."""

    def __init__(self, tests: dict | None = None) -> None:
        self.last: list[int] = []
        self.parent: list[int] = []
        self.kind: list[tuple] = []
        self.text: list[str | None] = []
        self.open: list[int] = []
        self.tests = {} if tests is None else tests  # of class attributes, shared by the pages of a task
        self.by_tag: dict[str, list[int]] | None = None

    def add(self, kind: tuple, text: str | None = None) -> None:
        self.last.append(len(self.last))
        self.parent.append(self.open[-1] if self.open else -1)
        self.kind.append(kind)
        self.text.append(text)

    def start(self, kind: tuple, closed: bool = False) -> None:
        self.add(kind)
        if kind[0] not in _VOID and not closed:
            self.open.append(len(self.last) - 1)

    def close(self, depth: int) -> None:
        for at in self.open[depth:]:
            self.last[at] = len(self.last) - 1
        del self.open[depth:]

    def end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.kind[self.open[depth]][0] == tag:
                self.close(depth)
                return

    def data(self, text: str) -> None:
        if not self.open or self.kind[self.open[-1]][0] not in ("script", "style"):
            self.add(_TEXT, text)

    def all(self, tag: str, cls: str | None = None, like: str | None = None) -> list[int]:
        """Positions of elements by tag, class name or class pattern."""
        if self.by_tag is None:
            self.by_tag = {}
            for at, kind in enumerate(self.kind):
                self.by_tag.setdefault(kind[0], []).append(at)
        return self._fitting(self.by_tag.get(tag, []), cls, like)

    def within(self, box: int | None, tag: str, cls: str | None = None, like: str | None = None) -> list[int]:
        """The same inside another node; nothing is inside a missing one."""
        if box is None:
            return []
        found = self.all(tag)
        return self._fitting(found[bisect_right(found, box):bisect_right(found, self.last[box])], cls, like)

    def _fitting(self, found: list[int], cls: str | None, like: str | None) -> list[int]:
        if cls is None and like is None:
            return found
        return [at for at in found if (own := self.kind[at][1]) is not None and self._fits(own, cls, like)]

    def _fits(self, own: str, cls: str | None, like: str | None) -> bool:
        known = self.tests.get((own, cls, like))
        if known is None:
            known = (cls is None or own == cls or cls in _SPACES.split(own)) and (like is None or re.search(like, own) is not None)
            if len(self.tests) >= _REMEMBERED:
                self.tests.clear()
            self.tests[own, cls, like] = known
        return known

    def first(self, tag: str, cls: str | None = None, like: str | None = None) -> int | None:
        return get(self.all(tag, cls, like), 0)

    def first_within(self, box: int | None, tag: str, cls: str | None = None, like: str | None = None) -> int | None:
        return get(self.within(box, tag, cls, like), 0)

    def headed(self, pattern: str, tag: str, cls: str | None = None) -> int | None:
        """First element of that kind whose text matches ``pattern`` (any letter case)."""
        return next((at for at in self.all(tag, cls) if re.search(pattern, self.text_of(at), re.IGNORECASE)), None)

    def text_of(self, at: int | None, separator: str = "") -> str | None:
        """Text pieces inside a node, stripped, empty ones dropped, joined."""
        if at is None:
            return None
        return separator.join([t for piece in self.text[at:self.last[at] + 1] if piece and (t := piece.strip())])

    def texts_of(self, found: Sequence[int], separator: str = "") -> list[str]:
        return [self.text_of(at, separator) for at in found]

    def next_siblings(self, at: int | None, tag: str, cls: str | None = None) -> list[int]:
        """Later elements with the same parent."""
        if at is None:
            return []
        found = self.all(tag)
        return self._fitting([i for i in found[bisect_right(found, at):] if self.parent[i] == self.parent[at]], cls, None)

    def next_element(self, at: int, tag: str) -> int | None:
        """The element right after a node, texts aside, if it is of that kind."""
        after = self.last[at] + 1
        while after < len(self.last) and self.parent[after] == self.parent[at]:
            if self.kind[after][0] != "#text":
                return after if self.kind[after][0] == tag else None
            after += 1
        return None


def get(found: Sequence, position: int):
    """An item counted from the start, or from the end if negative; None beyond."""
    return found[position] if -len(found) <= position < len(found) else None


class _Nodes(HTMLParser):
    """Any page."""

    def __init__(self, page: Page) -> None:
        super().__init__(convert_charrefs=True)
        self.page = page

    def handle_starttag(self, tag, attrs):
        self.page.start(_kind(tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self.page.start(_kind(tag, attrs), closed=True)

    def handle_endtag(self, tag):
        self.page.end(tag)

    def handle_data(self, data):
        self.page.data(data)

    def parse(self, html: str) -> Page:
        self.feed(html)
        self.close()
        self.page.close(0)
        return self.page


class Parser:
    """Pages → nodes.  Distinct tags are analysed once; pages with unusual markup go to the standard parser."""

    def __init__(self) -> None:
        self.tags: dict[str, tuple[int, object]] = {}
        self.tests: dict = {}

    def page(self, html: str | None) -> tuple[Page | None, str | None]:
        if html is None:
            return None, "no page"
        try:
            return self._plain(html) or _Nodes(Page(self.tests)).parse(html), None
        except (AssertionError, ValueError, RecursionError) as problem:
            return None, repr(problem)

    def _tag(self, body: str) -> tuple[int, object]:
        """What stands between < and >: 0 unusual, 1 start (kind), 2 closed start (kind), 3 end (tag), 4 skipped."""
        if (m := _START.fullmatch(body)) and "&" not in m[2]:
            kind = _kind(m[1].lower(), [(k.lower(), a or b) for k, a, b in _ATTRIBUTE.findall(m[2])])
            known = (2 if m[3] else 1, kind)
        elif m := _END.fullmatch(body):
            known = (3, m[1].lower())
        else:
            known = (4 if _SKIPPED.fullmatch(body) else 0, None)
        if len(self.tags) >= _REMEMBERED:
            self.tags.clear()
        self.tags[body] = known
        return known

    def _plain(self, html: str) -> Page | None:
        """The page if all its markup is plain: quoted attributes, no lone <, nothing but text in scripts and the like."""
        parts = _TAGS.split(html)
        if html.count("<") != len(parts) // 2:
            return None
        page, raw, tags = Page(self.tests), None, self.tags
        last, parent, kinds, texts, opened = page.last, page.parent, page.kind, page.text, page.open
        for i, part in enumerate(parts):
            if i % 2:
                what, of = tags.get(part) or self._tag(part)
                if what == 1:
                    if raw:
                        return None
                    at = len(last)
                    last.append(at)
                    parent.append(opened[-1] if opened else -1)
                    kinds.append(of)
                    texts.append(None)
                    if of[0] not in _VOID:
                        opened.append(at)
                        raw = of[0] if of[0] in _RAW else None
                elif what == 3:
                    if raw and raw != of:
                        return None
                    raw = None
                    if opened and kinds[opened[-1]][0] == of:
                        last[opened.pop()] = len(last) - 1
                    else:
                        page.end(of)
                elif raw or not what:
                    return None
                elif what == 2:
                    page.start(of, closed=True)
            elif part:
                if raw:
                    if "&" in part:
                        return None
                    page.data(part)
                else:
                    last.append(len(last))
                    parent.append(opened[-1] if opened else -1)
                    kinds.append(_TEXT)
                    texts.append(unescape(part) if "&" in part else part)
        if raw:
            return None
        page.close(0)
        return page


# Pages whose nodes are held at the same time; bounds a task's memory whatever the batch size.
_PAGES_AT_ONCE = 64


def page_parser(html: str, keep: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow``: the ``keep`` columns, then ``nodes`` and ``page_error``.

    A page that cannot be parsed has an error and no nodes.
    """
    names = ["tag", "cls", "link", "data", "job"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            for start in range(0, batch.num_rows, _PAGES_AT_ONCE):
                part = batch.slice(start, _PAGES_AT_ONCE)
                pages = [parser.page(h) for h in part.column(html).to_pylist()]
                good = [page for page, _ in pages if page]
                numbers = [[i for p in good for i in values(p)] for values in (
                    lambda p: range(len(p.last)), lambda p: p.last, lambda p: p.parent)]
                kinds = list(zip(*(k for p in good for k in p.kind))) or [[]] * len(names)
                struct = pa.StructArray.from_arrays(
                    [*(pa.array(v, pa.int32()) for v in numbers), *(pa.array(v, pa.string()) for v in kinds),
                     pa.array([t for p in good for t in p.text], pa.string())], ["at", "last", "parent", *names, "text"])
                offsets, end = [], 0
                for page, _ in pages:
                    offsets.append(end if page else None)
                    end += len(page.last) if page else 0
                nodes = pa.ListArray.from_arrays(pa.array([*offsets, end], pa.int32()), struct)
                errors = pa.array([e for _, e in pages], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), nodes, errors], [*keep, "nodes", "page_error"]
                )

    return run


def _page_of(nodes: list[dict] | None, tests: dict) -> Page | None:
    """A page from its node array."""
    if nodes is None:
        return None
    page = Page(tests)
    for n in nodes:
        page.add((n["tag"], n["cls"], n["link"], n["data"], n["job"]), n["text"])
    page.last, page.parent = [n["last"] for n in nodes], [n["parent"] for n in nodes]
    return page


def record_reader(
    read: Callable[[Page], list[tuple]], fields: dict[str, str], keep: list[str], html: str | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow``: the ``keep`` columns and the ``fields`` of the rows that ``read`` finds in each good page.

    Pages come as text in the column ``html``, or, if that is None, as arrays in ``nodes``.
    """
    text = pa.string()
    pair = lambda names: pa.list_(pa.struct([(n, text) for n in names]))
    forms = {"string": text, "array<string>": pa.list_(text)}
    kinds = [forms.get(f) or pair(re.findall(r"(\w+):string", f)) for f in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            for start in range(0, batch.num_rows, _PAGES_AT_ONCE):
                part = batch.slice(start, _PAGES_AT_ONCE)
                stored = part.column(html or "nodes").to_pylist()
                pages = [parser.page(x)[0] if html else _page_of(x, parser.tests) for x in stored]
                rows = [(i, row) for i, page in enumerate(pages) if page for row in read(page)]
                of = pa.array([i for i, _ in rows], pa.int64())
                columns = list(zip(*(row for _, row in rows))) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(of) for c in keep), *(pa.array(v, k) for v, k in zip(columns, kinds))], [*keep, *fields])

    return run


def has_class(node: Column, name: str) -> Column:
    """The class attribute is, or contains the word, ``name``."""
    return (node["cls"] == name) | F.array_contains(F.split(node["cls"], r"\s+"), name)


def find_all(
    nodes: Column, tag: str | None = None, cls: str | None = None, cls_like: str | None = None,
    inside: Column | None = None,
) -> Column:
    """Nodes by tag, class name or class pattern, optionally inside another node."""
    def fits(n: Column) -> Column:
        test = n["tag"] == tag if tag else n["tag"] != "#text"
        if cls:
            test = test & has_class(n, cls)
        if cls_like:
            test = test & n["cls"].rlike(cls_like)
        if inside is not None:
            test = test & (n["at"] > inside["at"]) & (n["at"] <= inside["last"])
        return F.coalesce(test, F.lit(False))

    return F.filter(nodes, fits)


def find(nodes: Column, *args, **kwargs) -> Column:
    return F.get(find_all(nodes, *args, **kwargs), F.lit(0))


def text_of(nodes: Column, node: Column, separator: str = "") -> Column:
    """Text pieces inside a node, stripped, empty ones dropped, joined."""
    def joined(n: Column) -> Column:
        inner = F.slice(nodes, n["at"] + 1, n["last"] - n["at"] + 1)
        pieces = F.filter(inner, lambda x: x["tag"] == "#text")
        return F.array_join(
            F.filter(F.transform(pieces, lambda x: strip(x["text"])), lambda t: t != ""), separator
        )

    return F.when(node.isNotNull(), bind(node, joined))


def texts_of(nodes: Column, found: Column, separator: str = "") -> Column:
    return F.transform(found, lambda n: text_of(nodes, n, separator))


def links(nodes: Column, found: Column) -> Column:
    """Distinct links of the nodes: ``href``, or else a data attribute with a url."""
    return F.array_distinct(F.filter(F.transform(found, lambda n: F.coalesce(n["link"], n["data"])), lambda x: x.isNotNull()))
