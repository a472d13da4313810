"""HTML table repair: unclosed tags are closed, neighbouring tables with one header become one.

Texts without a table never reach Python. Of the others those whose tags are of plain form are taken apart by one scan into a flat row
of tags and data, where an element is a range; the rest (comments, scripts, tables in tables, stray marks) go to a lenient tree on the
standard library's tokenizer. Like the tree it models, writing out escapes bare ``&``, ``<`` and ``>`` of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import missing_closings

#: Elements that hold nothing and are written <tag/>; elements whose text is kept as it is.
VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr basefont bgsound command frame image isindex nextid spacer".split())
RAW = frozenset(("script", "style"))
_TABLE = re.compile(r"<table\b.*?</table>", re.I | re.S)


class Node:
    """An element (or the root, without a name); children are nodes and already escaped text."""

    __slots__ = ("name", "attrs", "parent", "children")

    def __init__(self, name: str, attrs: list[tuple[str, str | None]], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def find(self, *names: str) -> list[Node]:
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                if x.name in names:
                    out.append(x)
                stack += reversed(x.children)
        return out

    def words(self) -> str:
        """Text pieces, each stripped, run together."""
        got, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                stack += reversed(x.children)
            elif not x.startswith("<!"):
                got.append(x.strip())
        return "".join(got)

    def leave(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def write(self) -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
                continue
            if x.name:
                attrs = "".join(f" {k}" if v is None else f' {k}={_quoted(v)}' for k, v in x.attrs)
                if x.name in VOID:
                    out.append(f"<{x.name}{attrs}/>")
                    continue
                out.append(f"<{x.name}{attrs}>")
                stack.append(f"</{x.name}>")
            stack += reversed(x.children)
        return "".join(out)


def _escaped(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quoted(v: str) -> str:
    v = _escaped(v)
    return f"'{v}'" if '"' in v and "'" not in v else '"' + v.replace('"', "&quot;") + '"'


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", [], None)

    def handle_starttag(self, tag, attrs):
        seen = {}
        for k, v in attrs:
            seen[k] = "" if v is None else v
        node = Node(tag, list(seen.items()), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        x = self.at
        while x is not self.root and x.name != tag:
            x = x.parent
        if x is not self.root:
            self.at = x.parent

    def handle_data(self, data):
        self.at.children.append(data if self.at.name in RAW else _escaped(data))

    def handle_comment(self, data):
        self.at.children.append(f"<!--{data}-->")

    def handle_decl(self, decl):
        self.at.children.append(f"<!{decl}>")

    def unknown_decl(self, data):
        self.at.children.append(f"<![{data}]]>")

    def handle_pi(self, data):
        self.at.children.append(f"<?{data}>")


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _row_key(row: Node) -> tuple[str, ...]:
    return tuple(c.words() for c in row.find("td", "th"))


def by_tree(html: str) -> str:
    """``repair_text`` for any text."""
    root = parse(html)
    tables = root.find("table")
    # from the back, so that a chain of tables collapses into its first
    for i in reversed(_adjacent(html, len(tables))):
        above, below = tables[i - 1].find("tr"), tables[i].find("tr")
        if not above or not below or _row_key(above[0]) != _row_key(below[0]):
            continue
        for row in below[1:]:
            row.leave()
            row.parent = tables[i - 1]
            tables[i - 1].children.append(row)
        tables[i].leave()
    return root.write()


def _adjacent(html: str, tables: int) -> list[int]:
    """Numbers of the tables that follow the one before them with nothing but white space between."""
    spans = [m.span() for m in _TABLE.finditer(html)] if tables > 1 else []
    return [i for i in range(1, min(len(spans), tables)) if not html[spans[i - 1][1] : spans[i][0]].strip()]


_MARKS = re.compile("(<[^<>]*>)")
#: A tag of plain form, and names whose content isn't read as tags. A text with any other mark goes to the tree.
_TAG = re.compile(r"""<(?:/([a-zA-Z][a-zA-Z0-9]*)[ \t\n]*|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][-a-zA-Z0-9_]*(?:="[^"&]*"|='[^'&]*')?)*)[ \t\n]*(/?))>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_]*)(?:="([^"]*)"|='([^']*)')?""")
_OPAQUE = RAW | frozenset(("textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"))


@lru_cache(maxsize=1 << 12)
def _tag(mark: str) -> tuple[bool, str, str, bool] | None:
    """(shuts, name, how it is written, whether nothing goes in it) of a tag; none of what isn't plain."""
    found = _TAG.fullmatch(mark)
    if found is None:
        return None
    shut, name, attributes, alone = found.groups()
    if shut:
        return True, shut.lower(), "", False
    name = name.lower()
    if name in _OPAQUE:
        return None
    seen = {m[1].lower(): m[2] if m[2] is not None else m[3] or "" for m in _ATTRIBUTE.finditer(attributes)}
    written = f"<{name}" + "".join(f" {k}={_quoted(v)}" for k, v in seen.items())
    return False, name, written + ("/>" if name in VOID else ">"), name in VOID or bool(alone)


class Flat:
    """A text's tags and data in a row as they will be written; an element is a range of them, and lies in another if its range does."""

    def __init__(self, html: str):
        self.pieces: list[str] = []
        self.data: list[bool] = []
        #: By name (those that matter): first piece and one past the last.
        self.ranges: dict[str, list[list[int]]] = {"table": [], "tr": [], "td": [], "th": []}
        #: Whether every mark was a plain tag; whether tables or rows lie in others of their kind.
        self.plain, self.nested = True, False
        open_: list[tuple[str, list[int]]] = []
        names: dict[str, int] = {}
        pieces, data = self.pieces, self.data

        def close(name: str) -> None:
            while True:
                last, own = open_.pop()
                names[last] -= 1
                pieces.append(f"</{last}>")
                data.append(False)
                own[1] = len(pieces)
                if last == name:
                    return

        parts = _MARKS.split(html)
        for i, part in enumerate(parts):
            if i & 1 == 0:
                if part:
                    if "<" in part:
                        self.plain = False
                        return
                    pieces.append(_escaped(unescape(part)) if "&" in part else part.replace(">", "&gt;"))
                    data.append(True)
                continue
            tag = _tag(part)
            if tag is None:
                self.plain = False
                return
            shuts, name, written, alone = tag
            if shuts:
                if names.get(name):
                    close(name)
                continue
            own = [len(pieces), 0]
            pieces.append(written)
            data.append(False)
            if name in self.ranges:
                self.ranges[name].append(own)
                self.nested |= name in ("table", "tr") and names.get(name, 0) > 0
            if name in VOID:
                continue
            open_.append((name, own))
            names[name] = names.get(name, 0) + 1
            if alone:
                close(name)
        while open_:
            close(open_[-1][0])

    def inside(self, own: list[int], *names: str) -> list[list[int]]:
        """Ranges of elements of these names in a range, in order."""
        return sorted(r for n in names for r in self.ranges[n] if own[0] < r[0] < own[1])

    def key(self, row: list[int]) -> list[str]:
        return ["".join(p.strip() for p, d in zip(self.pieces[a:b], self.data[a:b], strict=True) if d) for a, b in self.inside(row, "td", "th")]


def repair_text(html: str) -> str:
    """The text re-written with closed tags; a table right after one with the same first row gives its other rows to that one."""
    flat = Flat(html)
    tables, pieces = flat.ranges["table"], flat.pieces
    adjacent = _adjacent(html, len(tables)) if flat.plain else []
    if not flat.plain or adjacent and flat.nested:
        return by_tree(html)
    gone, more, rows = set(), {}, {}
    for i in reversed(adjacent):
        for k in (i - 1, i):
            if k not in rows:
                rows[k] = flat.inside(tables[k], "tr")
        if not rows[i - 1] or not rows[i] or flat.key(rows[i - 1][0]) != flat.key(rows[i][0]):
            continue
        more[i - 1] = rows[i][1:] + more.pop(i, [])
        gone.add(i)
    if not gone:
        return "".join(pieces)
    out, at = [], 0
    for i, (start, end) in enumerate(tables):
        if i in gone:
            out += pieces[at:start]
            at = end
        elif i in more:
            out += pieces[at : end - 1]
            for a, b in more[i]:
                out += pieces[a:b]
            at = end - 1
    return "".join(out + pieces[at:])


def repair(files: DataFrame, markdown: str = "markdown") -> DataFrame:
    """``files`` with ``markdown`` repaired and ``repaired_tags``; only rows that hold a table go through Python."""
    has = F.coalesce(F.contains(F.lower(markdown), F.lit("<table")), F.lit(False))
    plain = files.where(~has).withColumn("repaired_tags", F.lit(0))
    tagged = files.where(has).withColumn("repaired_tags", missing_closings(F.col(markdown)))

    place = tagged.columns.index(markdown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(map(repair_text, batch.column(place).to_pylist()), pa.string())
            yield batch.set_column(place, batch.schema.names[place], texts)

    return plain.unionByName(tagged.mapInArrow(run, tagged.schema))
