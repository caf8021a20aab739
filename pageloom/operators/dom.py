"""Pages to node arrays.

The only per-row Python of the HTML work: a tag reader that lists a page's nodes in document order.
Everything that gives the nodes a meaning is Column work on that array (``extract.py``), so a page
never leaves its row, no extraction step shuffles, and raw HTML is dropped right after this step.

A node is ``(id, end, parent, tag, path, attrs, text)``. ``id`` is its place in the array and ``end``
the place of its last descendant, so a subtree is one slice. Text nodes have the tag ``#text``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.sql import bind, each, fn, group, keep, last, matches, q, strip, struct

NODE_DDL = "struct<id:int,end:int,parent:int,tag:string,path:string,attrs:map<string,string>,text:string>"
TEXT = "#text"

# HTML nesting rules for documents with missing end tags.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEAD_ONLY = {"title", "meta", "link", "base", "style", "script"}
FORMATTING = {"b", "big", "font", "i", "s", "small", "strike", "sub", "sup", "tt", "u"}
BLOCKS = {
    "address", "blockquote", "center", "div", "dl", "fieldset", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "hr", "ol", "pre", "table", "ul",
}
CLOSED_BY = {
    "p": FORMATTING | {"p"}, "a": {"a"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "option": {"option"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "thead": {"tr", "td", "th", "tbody", "tfoot", "p"}, "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot", "p"},
    "tfoot": {"tr", "td", "th", "thead", "tbody", "p"}, **{block: {"p"} for block in BLOCKS},
}
STRENGTH = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190}

# Markup on which all readers agree: text, end tags, scripts and styles, start tags, comments and the document type.
_ATTRS = r'((?:[ \t\n][a-zA-Z][a-zA-Z0-9_-]*="[^"<>]*")*)'
_PLAIN = re.compile(
    r"([^<]+)|</([a-zA-Z][a-zA-Z0-9]*)>|<(script|style)" + _ATTRS + r">([^<]*(?:<(?!/[sS]|!)[^<]*)*)</\3>"
    r"|<([a-zA-Z][a-zA-Z0-9]*)" + _ATTRS + r">|<!--[^<>-]+(?:-[^<>-]+)*-->|<!(?:DOCTYPE|doctype) [a-zA-Z]+>"
)
_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9_-]*)="([^"]*)"')
# Elements whose content some versions of the standard library take as raw text.
_RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "plaintext", "title", "textarea"}


def _attributes(written: str) -> list[tuple[str, str]] | None:
    """Names and values; None if a value has references other than ``&amp;``."""
    found = [(name.lower(), value) for name, value in _ATTR.findall(written)]
    if "&" in written:
        if "&" in written.replace("&amp;", ""):
            return None
        found = [(name, value.replace("&amp;", "&")) for name, value in found]
    return found


class _NodeLister(HTMLParser):
    """Lists nodes in document order and repairs missing end tags by the rules above."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.seen: set[str] = set()
        self.text_goes_on = False

    def list_nodes(self, html: str) -> list[list]:
        if not self._read_plain(html):
            self.__init__()
            self.feed(html)
            self.close()
        if "body" not in self.seen:
            self._place("body")
            self._push("body", {})
        while self.open:
            self._pop()
        return self.rows

    def _read_plain(self, html: str) -> bool:
        """Read a page of plain markup in one pass of a pattern; false if it holds anything else."""
        done, raw = 0, ""
        for m in _PLAIN.finditer(html):
            if m.start() != done:
                return False
            done, kind = m.end(), m.lastindex
            if raw and not (kind == 2 and m[2] == raw):
                if kind != 1 or "&" in m[1] or not html.startswith(f"</{raw}>", done):
                    return False
            raw = raw if kind == 1 else ""
            if kind == 1:
                self.handle_data(unescape(m[1]) if "&" in m[1] else m[1])
            elif kind == 2:
                self.handle_endtag(m[2].lower())
            elif kind:
                tag, written = (m[6].lower(), m[7]) if kind == 7 else (m[3], m[4])
                attrs = _attributes(written) if written else []
                if attrs is None or (kind == 7 and tag in ("script", "style")):
                    return False
                self.handle_starttag(tag, attrs)
                if kind == 7:
                    raw = m[6] if tag in _RAW else ""
                else:
                    if m[5]:
                        self.handle_data(m[5])
                    self.handle_endtag(tag)
            else:
                self.text_goes_on = False
        return done == len(html) and not raw

    def _tag(self, depth: int = -1) -> str:
        return self.rows[self.open[depth]][3]

    def _pop(self) -> None:
        self.text_goes_on = False
        self.rows[self.open.pop()][1] = len(self.rows) - 1

    def _add(self, tag: str, attrs: dict, text: str | None) -> None:
        self.text_goes_on = False
        here, parent = len(self.rows), self.open[-1] if self.open else -1
        path = (self.rows[parent][4] if self.open else "") + "/" + tag
        self.rows.append([here, here, parent, tag, path, attrs, text])

    def _push(self, tag: str, attrs: dict) -> None:
        self._add(tag, attrs, None)
        self.open.append(len(self.rows) - 1)
        self.seen.add(tag)

    def _place(self, tag: str) -> None:
        """Open the html, head and body nodes that ``tag`` needs around it."""
        if not self.open:
            self._push("html", {})
        if "body" in self.seen:
            return
        if tag in HEAD_ONLY:
            if "head" not in self.seen:
                self._push("head", {})
            return
        while self._tag() != "html":
            self._pop()
        if tag not in ("body", "head"):
            self._push("body", {})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "head", "body") and (tag in self.seen or (tag == "head" and "body" in self.seen)):
            return
        named: dict = {}
        for key, value in attrs:
            named.setdefault(key, value or "")
        if tag != "html":
            self._place(tag)
        closes = CLOSED_BY.get(tag, ())
        while self._closable() and self._tag() in closes:
            self._pop()
        if tag in VOID:
            self._add(tag, named, None)
        else:
            self._push(tag, named)

    def _closable(self) -> bool:
        return len(self.open) > 1

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self._tag(depth)
            if name == tag:
                while len(self.open) > depth:
                    self._pop()
                return
            if name == "body" or STRENGTH.get(name, 100) > STRENGTH.get(tag, 100):
                return

    def handle_data(self, data: str) -> None:
        """The reader gives a text in several pieces, for instance around a single ``<`` or an end tag that
        closes nothing; until a node begins or ends or a comment comes, they are one text."""
        if self.text_goes_on:
            self.rows[-1][6] += data
            return
        if not self.open or self._tag() in ("html", "head"):
            if not data.strip():
                return
            self._place(TEXT)
        self._add(TEXT, {}, data)
        self.text_goes_on = True

    def handle_comment(self, data: str) -> None:
        self.text_goes_on = False

    handle_decl = handle_pi = unknown_decl = handle_comment


def _node_arrays(batches: Iterator[pa.RecordBatch], html: str, flush_at: int = 20_000) -> Iterator[pa.RecordBatch]:
    node_types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), None, pa.string()]
    names = ["id", "end", "parent", "tag", "path", "attrs", "text"]

    def build(keys: pa.RecordBatch, pages: list[list[list]]) -> pa.RecordBatch:
        offsets, flat = [0], []
        for nodes in pages:
            flat.extend(nodes)
            offsets.append(len(flat))
        columns = []
        for kind, values in zip(node_types, list(zip(*flat)) or [()] * len(node_types)):
            if kind is None:
                ends, ks, vs = [0], [], []
                for attrs in values:
                    ks.extend(attrs.keys())
                    vs.extend(attrs.values())
                    ends.append(len(ks))
                columns.append(
                    pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ks, pa.string()), pa.array(vs, pa.string()))
                )
            else:
                columns.append(pa.array(values, kind))
        nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, names))
        return pa.RecordBatch.from_arrays([*keys.columns, nodes], [*keys.schema.names, "nodes"])

    for batch in batches:
        filled = pa.compute.greater(pa.compute.binary_length(batch.column(html)), 0)
        if not pa.compute.all(pa.compute.fill_null(filled, False)).as_py():
            batch = batch.filter(filled)
        keys = batch.select([n for n in batch.schema.names if n != html])
        start, pages, size = 0, [], 0
        for i, page in enumerate(batch.column(html)):
            pages.append(_NodeLister().list_nodes(page.as_py()))
            size += len(pages[-1])
            if size >= flush_at:
                yield build(keys.slice(start, i + 1 - start), pages)
                start, pages, size = i + 1, [], 0
        if pages:
            yield build(keys.slice(start, len(pages)), pages)


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the ``html`` column by ``nodes``; pages without HTML are dropped (see ``rejected_pages``)."""
    keep = [f for f in pages.schema.fields if f.name != html]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + f", nodes array<{NODE_DDL}>"
    # dropped by the reader: a filter here would be pushed below the expression of a computed page and compute it anew
    return pages.mapInArrow(lambda it: _node_arrays(it, html), ddl)


def node_table(parsed: DataFrame) -> DataFrame:
    """One row per node, for ad-hoc work."""
    keep = [c for c in parsed.columns if c != "nodes"]
    return parsed.select(*keep, F.inline("nodes")).withColumnsRenamed(
        {"id": "node_id", "end": "end_id", "parent": "parent_id"}
    )


# ---- expressions on node arrays ------------------------------------------------------------------


def attr(n: str, key: str) -> str:
    return f"try_element_at({n}.attrs, {q(key)})"


def span(nodes: str, start: str, stop: str) -> str:
    """Nodes from the place ``start`` up to before ``stop``; null if a place is null. Spark's ``slice`` inside a
    lambda reads the whole array for every piece, so the nodes are fetched one by one."""
    there = f"transform(sequence({start}, {stop} - 1), {fn(lambda i: f'get({nodes}, {i})')})"
    return f"case when {start} < {stop} then {there} when {start} >= {stop} then array_repeat(get({nodes}, 0), 0) end"


def subtree(nodes: str, n: str) -> str:
    """Descendants of ``n`` in document order."""
    return bind(n, lambda m: span(nodes, f"({m}.id + 1)", f"({m}.end + 1)"))


def having(nodes: str, *tags: str) -> str:
    listed = ", ".join(q(t) for t in tags)
    return keep(nodes, lambda x: f"{x}.tag in ({listed})")


def class_like(n: str, pattern: str) -> str:
    return f"coalesce({matches(attr(n, 'class'), pattern)}, false)"


def has_class(n: str, name: str) -> str:
    return f"coalesce(array_contains(split({attr(n, 'class')}, {q(r'\s+')}), {q(name)}), false)"


def joined_text(nodes: str, n: str) -> str:
    """Text of the subtree: every text node stripped, joined with nothing between."""
    return f"array_join({each(having(subtree(nodes, n), TEXT), lambda x: strip(f'{x}.text'))}, '')"


def raw_text(nodes: str, n: str) -> str:
    return f"array_join({each(having(subtree(nodes, n), TEXT), lambda x: f'{x}.text')}, '')"


def mark(n: str, text: str = "cast(null as string)") -> str:
    return struct(id=f"{n}.id", end=f"{n}.end", text=text)


def overlay(nodes: str, marks: str) -> str:
    """Replace marked subtrees. ``marks`` is an array of ``(id, end, text)`` in document order; a
    subtree marked with a null text disappears, one with a text becomes that text. Marks inside an
    earlier mark are ignored. Places in the array stay the same, so ids stay valid; linear in nodes."""
    outermost = bind(
        marks,
        lambda ms: f"aggregate({ms}, slice({ms}, 1, 0), (acc, m) -> "
        "if(coalesce(m.id > try_element_at(acc, -1).end, true), concat(acc, array(m)), acc))",
    )

    def blank(x, m):
        shown = f"({x}.id = {m}.id and {m}.text is not null)"
        return struct(
            id=f"{x}.id", end=f"{x}.end", parent=f"{x}.parent",
            tag=f"if({shown}, {q(TEXT)}, '')",
            path=f"if({shown}, concat({group(f'{x}.path', '^(.*)/[^/]*$')}, {q('/' + TEXT)}), '')",
            attrs="cast(map() as map<string,string>)",
            text=f"if({shown}, {m}.text, null)",
        )

    def covered(m):
        return each(span(nodes, f"{m}.id", f"({m}.end + 1)"), lambda x: blank(x, m))

    def overlaid(ms):
        def piece(m, i):
            before = f"coalesce(get({ms}, {i} - 1).end + 1, 0)"
            return f"concat({bind(before, lambda b: span(nodes, b, f'{m}.id'))}, {covered(m)})"

        tail = f"({last(ms)}.end + 1)"
        return (
            f"if(size({ms}) = 0, {nodes}, concat(flatten({each(ms, piece, 2)}), "
            f"{bind(tail, lambda t: span(nodes, t, f'size({nodes})'))}))"
        )

    return bind(outermost, overlaid)
