"""Raw HTML pages to arrays of selected elements.

A tolerant tokeniser emits one row per page with the elements that selectors ask for, in
document order. One pattern reads plain markup; a page with anything else is left to HTMLParser. Selectors are data, and everything after this (sections, typing, routing)
is column work on that row, so a page's elements never leave the task that read them.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, chain
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from pledgeflow.session import spread

# executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# an opening tag ends these open ones, unless one of the limits lies in between
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "p": ({"p"}, {"div", "td", "li", "section"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}


# elements, and characters of their texts, that fill a batch
_ELEMENTS, _CHARACTERS = 4_000, 4_000_000


class Selector(NamedTuple):
    """Which elements to keep; every given condition must hold."""

    tag: str | None = None
    id: str | None = None
    cls: str | None = None  # whole class attribute
    cls_has: str | None = None  # part of the class attribute
    attr: str | None = None  # attribute must exist
    where: tuple[str, str] | None = None  # attribute with exactly this value
    child_of: str | None = None  # parent matches this selector
    inside: str | None = None  # some ancestor matches this selector

    def accepts(self, tag: str, attrs: Mapping[str, str]) -> bool:
        """Whether all conditions on the element itself hold."""
        css = attrs.get("class", "")
        return (
            (self.tag is None or tag == self.tag)
            and (self.id is None or attrs.get("id") == self.id)
            and (self.cls is None or css == self.cls)
            and (self.cls_has is None or self.cls_has in css)
            and (self.attr is None or self.attr in attrs)
            and (self.where is None or attrs.get(self.where[0]) == self.where[1])
        )


class _Choice:
    """Which selectors accept an opening tag.

    What depends on the tag alone is kept for a bounded number of tags, so a class that many elements
    share is compared with the selectors once; what depends on the elements around it is looked up for each.
    """

    KEPT, LONGEST = 10_000, 200

    def __init__(self, selectors: Mapping[str, Selector]):
        self.selectors = selectors
        # those of the tag come before those of any tag
        self.order = {name: n for n, name in enumerate(sorted(selectors, key=lambda name: selectors[name].tag is None))}
        self.tags = {s.tag for s in selectors.values()}
        self.kept: dict[tuple[str, str], tuple | None] = {}

    def of(self, tag: str, source: str) -> tuple[dict, list[str], list[tuple]] | None:
        """What :meth:`judged` finds for a tag and the source of its attributes, None when no selector can accept it."""
        if tag not in self.tags and None not in self.tags:
            return None
        found = self.judged(tag, _attributes(source))
        if len(source) <= self.LONGEST:
            if len(self.kept) >= self.KEPT:
                self.kept.clear()
            self.kept[tag, source] = found
        return found

    def judged(self, tag: str, attrs: dict[str, str]) -> tuple[dict, list[str], list[tuple]] | None:
        """The attributes, the accepting selectors, and those that accept it below (parent, ancestor) of some selectors."""
        found = [name for name in self.order if self.selectors[name].accepts(tag, attrs)]
        if not found:
            return None
        around = [(name, self.selectors[name].child_of, self.selectors[name].inside) for name in found]
        return attrs, [name for name, *both in around if both == [None, None]], [a for a in around if a[1:] != (None, None)]


class _Row:
    """A selected element; its text is a stretch of the page's pieces of text."""

    __slots__ = ("attrs", "first", "last", "path", "pos", "sel", "texts", "within")

    def __init__(self, sel, pos, attrs, first, within, path):
        self.sel, self.pos, self.attrs, self.first, self.last, self.within, self.path = sel, pos, attrs, first, first, within, path
        self.texts: list[str] = []


class _Page:
    """Open and selected elements of one page."""

    def __init__(self, choice: _Choice):
        self.choice = choice
        self.rows: list[_Row] = []
        # tag, position, rows, their names, nearest enclosing element of each selector for what comes inside
        self.open: list[tuple[str, int, Sequence[_Row], Sequence[str], dict[str, int]]] = []
        self.pieces: list[str] = []
        self.count = 0

    def close(self, depth: int) -> None:
        for _, _, rows, _, _ in self.open[depth:]:
            for row in rows:
                row.last = len(self.pieces)
        del self.open[depth:]

    def start(self, tag: str, attrs: str | list) -> None:
        if tag in _ENDS:
            closes, limits = _ENDS[tag]
            for depth in range(len(self.open) - 1, -1, -1):
                name = self.open[depth][0]
                if name in limits:
                    break
                if name in closes:
                    self.close(depth)
        self.count += 1
        _, _, _, parent, within = self.open[-1] if self.open else _OUTSIDE
        matched = names = ()
        if not isinstance(attrs, str):
            judged = self.choice.judged(tag, {k: v or "" for k, v in attrs})
        elif (judged := self.choice.kept.get((tag, attrs), _OUTSIDE)) is _OUTSIDE:
            judged = self.choice.of(tag, attrs)
        if judged:
            values, names, around = judged
            below = [n for n, p, a in around if (p is None or p in parent) and (a is None or a in within)] if around else ()
            if below:
                names = sorted([*names, *below], key=self.choice.order.__getitem__)
            if names:
                path = [o[1] for o in self.open]
                matched = [_Row(name, self.count, values, len(self.pieces), within, path) for name in names]
                self.rows += matched
                within = within | dict.fromkeys(names, self.count)
        if tag not in _VOID:
            self.open.append((tag, self.count, matched, names, within))

    def end(self, tag: str) -> None:
        if self.open and self.open[-1][0] == tag:
            for row in self.open.pop()[2]:
                row.last = len(self.pieces)
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self.close(depth)
                return

    def data(self, text: str) -> None:
        if self.open:
            self.pieces.append(text)
            for row in self.open[-1][2]:
                row.texts.append(text)

    def read(self, source: str) -> None:
        """Take in a whole page; a row is open before those inside it, so rows come in document order."""
        start, end, data = self.start, self.end, self.data
        for text, raw, raw_attrs, script, tag, attrs, slash, ended, odd in _TOKEN.findall(source):
            if text:
                data(unescape(text) if "&" in text else text)
            elif tag:
                start(tag := tag.lower(), attrs)
                if slash:
                    end(tag)
            elif ended:
                end(ended.lower())
            elif raw:
                start(raw, raw_attrs)
                if script:
                    data(script)
                end(raw)
            elif odd:
                self.__init__(self.choice)
                parser = _Parser(self)
                parser.feed(source)
                parser.close()
                break
        self.close(0)


_OUTSIDE = ("", 0, [], (), {})


class _Parser(HTMLParser):
    """Reads pages with markup that the pattern of plain tokens does not cover."""

    def __init__(self, page: _Page):
        super().__init__(convert_charrefs=True)
        self.handle_starttag, self.handle_endtag, self.handle_data = page.start, page.end, page.data


# Tokens that HTMLParser reads in one way only; what else begins with "<" is odd and leaves the page to it.
_SPACE = r"[ \t\n\r\f]"
_ATTRIBUTE = r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:=(?:"([^"]*)"|'([^']*)'|([-a-zA-Z0-9_.:#%]+)(?=[ \t\n\r\f>]|$)))?"""
_ATTRIBUTES = rf"((?:{_SPACE}+{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)}(?=[ \t\n\r\f/>]))*+){_SPACE}*+"
_LITERAL = "|".join({*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"})
_TOKEN = re.compile(
    rf"([^<]++)|<(script|style){_ATTRIBUTES}>((?:[^<]|<(?![/!]))*+)</\2{_SPACE}*+>"
    rf"|<(?!(?i:{_LITERAL})[^-a-zA-Z0-9])([a-zA-Z][-a-zA-Z0-9]*+){_ATTRIBUTES}(/?)>|</([a-zA-Z][-a-zA-Z0-9]*+){_SPACE}*+>"
    r"|<!--[^->][^-]*+-->|<!(?i:doctype)[^>]*+>|(<)"
)
_ATTRIBUTE_TOKEN = re.compile(_ATTRIBUTE)


def _attributes(source: str) -> dict[str, str]:
    if not source:
        return {}
    found = {}
    for name, double, single, bare in _ATTRIBUTE_TOKEN.findall(source):
        value = double or single or bare
        found[name.lower()] = unescape(value) if "&" in value else value
    return found


def _sections(rows: Sequence[tuple[int, _Row]], name: str, inner: Sequence[str]) -> list[tuple]:
    """Sections ``name`` in document order: position, numbers of the elements whose nearest section it is.

    A section's own element belongs to it. With ``inner``, its elements are grouped by those sections too.
    """
    held = {row.pos: [] for _, row in rows if row.sel == name}
    for item in rows if held else ():
        row = item[1]
        home = row.pos if row.sel == name else row.within.get(name)
        if home in held:
            held[home].append(item)
    return [(pos, [n for n, _ in found], *[_sections(found, i, ()) for i in inner]) for pos, found in held.items()]


def _list_array(kind: pa.DataType, lists: Sequence[Sequence], values: Callable[[list, pa.DataType], pa.Array]) -> pa.Array:
    """Lists of one type, made from their joined items."""
    ends = pa.array([0, *accumulate(map(len, lists))], pa.int32())
    return pa.ListArray.from_arrays(ends, values([*chain.from_iterable(lists)], kind.value_type), type=kind)


def _map_array(kind: pa.DataType, maps: Sequence[Mapping]) -> pa.Array:
    ends = pa.array([0, *accumulate(map(len, maps))], pa.int32())
    keys = pa.array([*chain.from_iterable(maps)], kind.key_type)
    items = pa.array([*chain.from_iterable(m.values() for m in maps)], kind.item_type)
    return pa.MapArray.from_arrays(ends, keys, items).cast(kind)


class _Found:
    """Selected elements of some pages, laid out column by column."""

    def __init__(self, types: pa.Schema, wanted: Mapping[str, Sequence[str]]):
        self.types, self.wanted = types, wanted
        self.keys: list = []
        self.rows: list[_Row] = []
        self.texts: list[str] = []
        self.pages: list[range] = []
        self.sections: list[list[list[tuple]]] = [[] for _ in wanted]
        self.size = 0

    def add(self, key, page: _Page) -> None:
        start = len(self.rows)
        self.keys.append(key)
        self.rows += page.rows
        texts = ["".join(page.pieces[row.first : row.last]) for row in page.rows]
        self.texts += texts
        self.size += sum(map(len, texts))
        self.pages.append(range(start, len(self.rows)))
        for column, (name, inner) in zip(self.sections, self.wanted.items(), strict=True):
            column.append(_sections([*enumerate(page.rows, start)], name, inner))

    def batch(self) -> pa.RecordBatch:
        rows, listed = self.rows, self.types.field(1).type
        kind = listed.value_type
        columns = [
            pa.array([r.sel for r in rows], kind.field("sel").type),
            pa.array([r.pos for r in rows], kind.field("pos").type),
            _map_array(kind.field("attrs").type, [r.attrs for r in rows]),
            _list_array(kind.field("texts").type, [r.texts for r in rows], pa.array),
            pa.array(self.texts, kind.field("text").type),
            _map_array(kind.field("within").type, [r.within for r in rows]),
            _list_array(kind.field("path").type, [r.path for r in rows], pa.array),
        ]
        flat = pa.StructArray.from_arrays(columns, fields=[*kind])

        def section(found: list[tuple], kind: pa.DataType) -> pa.Array:
            parts = [*zip(*found, strict=True)] if found else [()] * kind.num_fields
            arrays = [pa.array(parts[0], kind.field(0).type)]
            arrays.append(_list_array(kind.field(1).type, parts[1], lambda numbers, _: flat.take(pa.array(numbers, pa.int64()))))
            arrays += [_list_array(kind.field(i).type, parts[i], section) for i in range(2, kind.num_fields)]
            return pa.StructArray.from_arrays(arrays, fields=[*kind])

        arrays = [pa.array(self.keys, self.types.field(0).type), _list_array(listed, self.pages, lambda *_: flat)]
        arrays += [_list_array(self.types.field(i).type, column, section) for i, column in enumerate(self.sections, 2)]
        return pa.RecordBatch.from_arrays(arrays, schema=self.types)


def _scan(
    batches: Iterator[pa.RecordBatch], selectors: Mapping[str, Selector], types: pa.Schema, wanted: Mapping[str, Sequence[str]]
) -> Iterator[pa.RecordBatch]:
    """Batches of pages to batches of their elements.

    Python holds one page and a bounded number of elements at a time, however many pages Spark puts into a batch.
    """
    choice = _Choice(selectors)
    found = _Found(types, wanted)
    for batch in batches:
        for key, source in zip(batch.column(0), batch.column(1), strict=True):
            if not source.is_valid:
                continue
            page = _Page(choice)
            page.read(source.as_py())
            if page.rows:
                found.add(key.as_py(), page)
            if len(found.rows) >= _ELEMENTS or found.size >= _CHARACTERS:
                yield found.batch()
                found = _Found(types, wanted)
    yield found.batch()


def elements(
    pages: DataFrame, key: str, html: str, selectors: Mapping[str, Selector], sections: Sequence[str] | Mapping[str, Sequence[str]] = ()
) -> DataFrame:
    """(key, elements): one row per page that has an element some selector accepts.

    ``sel`` names an element's selector, ``pos`` counts elements in document order, ``texts`` holds
    the element's own text nodes and ``text`` all text below it; ``within`` gives the position of
    the nearest enclosing element of each selector, ``path`` those of all enclosing elements.

    For every selector named in ``sections`` a column ``in_<name>`` lists its elements as sections: the
    position, and the elements whose nearest enclosing section it is. A mapping may name
    sections to be listed inside a section in the same way.
    """
    chosen = dict(selectors)
    wanted = {name: tuple(inner) for name, inner in sections.items()} if isinstance(sections, Mapping) else dict.fromkeys(sections, ())
    kind = pages.schema[key].dataType
    element = (
        "sel: string, pos: int, attrs: map<string,string>, texts: array<string>,"
        " text: string, within: map<string,int>, path: array<int>"
    )
    listed = f"array<struct<{element}>>"

    def section(inner: Sequence[str]) -> str:
        more = "".join(f", in_{i}: {section(())}" for i in inner)
        return f"array<struct<pos: int, elements: {listed}{more}>>"

    schema = f"`{key}` {kind.simpleString()}, elements {listed}"
    schema += "".join(f", in_{name} {section(inner)}" for name, inner in wanted.items())
    types = to_arrow_schema(_parse_datatype_string(schema))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, chosen, types, wanted)

    return spread(pages.select(key, html), key, html).mapInArrow(scan, schema)
