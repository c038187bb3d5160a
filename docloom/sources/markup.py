"""Lenient markup: documents that are not well-formed become node rows, grids and typed blocks.

One pass of the standard HTML tokenizer over a whole document; the tree lives in that document's call
only. Dialects differ in their tags: `filing` (SECTION-1.., TITLE, TU/TE cells, upper case), `page`
(HTML with h1..h6) and `viewer` (HTML with section-N classes).
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import ship

#: Elements without content, and elements that end when a like one begins.
VOID = frozenset("area base br col embed hr img input link meta pgbrk source track wbr".split())
CLOSES = {"p": ("p",), "li": ("li",), "tr": ("td", "th", "tu", "te", "tr"), "td": ("td", "th", "tu", "te"), "th": ("td", "th", "tu", "te"), "tu": ("td", "th", "tu", "te"), "te": ("td", "th", "tu", "te"), "option": ("option",)}
CELLS, HIDDEN, LIMITS = frozenset(("td", "th", "tu", "te")), frozenset(("script", "style")), frozenset(("table", "body", "ul", "ol", "div"))
BLOCKS = frozenset("p li div blockquote pre dd dt section article header footer main nav ul ol body html document".split())


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None = None
    content: list[Node | str] = field(default_factory=list)

    def nodes(self) -> Iterator[Node]:
        return (x for x in self.content if isinstance(x, Node))

    def find(self, *tags: str, stop: frozenset[str] = frozenset()) -> Iterator[Node]:
        """Descendants by tag in document order, without looking below a `stop`. A stack of its own: unclosed tags nest without end."""
        stack = [self.nodes()]
        while stack:
            x = next(stack[-1], None)
            if x is None:
                stack.pop()
                continue
            if x.tag in tags:
                yield x
            if x.tag not in stop:
                stack.append(x.nodes())

    def text(self, stop: frozenset[str] = frozenset()) -> str:
        out, stack = [], [iter(self.content)]
        while stack:
            x = next(stack[-1], None)
            if x is None:
                stack.pop()
            elif isinstance(x, str):
                out.append(x)
            elif x.tag == "br":
                out.append("\n")
            elif x.tag not in HIDDEN and x.tag not in stop:
                stack.append(iter(x.content))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.root = self.at = Node("#root", {})
        self.open: dict[str, int] = defaultdict(int)  # tags from the root to the current node

    def _leave(self, node: Node) -> None:
        """Goes on behind `node`."""
        while self.at is not node.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        closing, node = CLOSES.get(tag, ()), self.at
        while any(self.open[t] for t in closing) and node.parent is not None and node.tag not in LIMITS:
            above = node.parent
            if node.tag in closing:
                self._leave(node)
            node = above
        new = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.content.append(new)
        if tag not in VOID:
            self.at = new
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.content.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        if not self.open[tag]:  # an end without a beginning is ignored
            return
        node = self.at
        while node.tag != tag:
            node = node.parent
        self._leave(node)

    def handle_data(self, data: str) -> None:
        self.at.content.append(data)

    def handle_entityref(self, name: str) -> None:
        whole = f"&{name};"
        found = html.unescape(whole)
        self.at.content.append(found if found != whole else f"&{name}")  # an unknown name stays as it is, with no semicolon added

    def handle_charref(self, name: str) -> None:
        self.at.content.append(html.unescape(f"&#{name};"))


#: Tags and texts that read alike in any tokenizer: no references, comments, unusual attributes or elements whose content is no markup.
_PLAIN = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z]+=(?:"[^"<>&]*"|[A-Za-z0-9_.-]+))*)>|</([a-z][a-z0-9]*)>|([^<]+)')
_ATTRIBUTE = re.compile(r' ([a-z]+)=(?:"([^"]*)"|([^" ]+))')
_OPAQUE = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())


def _plain_tree(source: str) -> Node | None:
    """The tree of a document that is all plain; None for others."""
    if "&" in source or "<!" in source or "<?" in source:
        return None
    b, at = _Builder(), 0
    while at < len(source):
        m = _PLAIN.match(source, at)
        if m is None:
            return None
        begin, attrs, end, text = m.groups()
        if (begin or end) in _OPAQUE:
            return None
        if begin:
            b.handle_starttag(begin, [(k, q or v) for k, q, v in _ATTRIBUTE.findall(attrs)] if attrs else [])
        elif end:
            b.handle_endtag(end)
        else:
            b.handle_data(text)
        at = m.end()
    return b.root


def tree(source: str) -> Node:
    if (found := _plain_tree(source)) is not None:
        return found
    b = _Builder()
    b.feed(source)
    b.close()
    return b.root


def squeeze(text: str) -> str:
    return "\n".join(x for x in (" ".join(line.split()) for line in text.replace("\xa0", " ").split("\n")) if x)


#: Fixed value: the greatest span of a cell, as browsers have it.
GREATEST_SPAN = 1000


def span(value: str | None) -> int:
    """A span attribute as a number, 1 if it is none, GREATEST_SPAN at most."""
    try:
        return min(GREATEST_SPAN, int((value or "1").strip()))
    except ValueError:
        return 1


def grid(rows: list[list[tuple[int, int]]]) -> list[list[tuple[int, int] | None]]:
    """Cells, given by (rowspan, colspan), spread over a rectangle: each place names the row and number of its cell.

    A span of zero or less takes no place. Places that no cell takes are None.
    """
    taken: dict[tuple[int, int], tuple[int, int]] = {}
    for r, cells in enumerate(rows):
        c = 0
        for k, (down, across) in enumerate(cells):
            while (r, c) in taken:
                c += 1
            for i in range(max(0, min(down, len(rows) - r))):
                for j in range(max(0, across)):
                    taken.setdefault((r + i, c + j), (r, k))
    width = max((c + 1 for _, c in taken), default=0)
    return [[taken.get((r, c)) for c in range(width)] for r in range(len(rows))]


@dataclass
class Table:
    texts: list[list[str]]
    heads: int  # rows of the header band
    labels: list[list[bool]]


def read_table(node: Node) -> Table:
    rows = [[c for c in tr.nodes() if c.tag in CELLS] for tr in node.find("tr", stop=frozenset(("table",)))]
    rows = [r for r in rows if r]
    places = grid([[(span(c.attrs.get("rowspan")), span(c.attrs.get("colspan"))) for c in r] for r in rows])
    own = [[squeeze(c.text(frozenset(("table",)))) for c in r] for r in rows]
    texts = [[own[p[0]][p[1]] if p else "" for p in line] for line in places]
    labels = [[bool(p) and rows[p[0]][p[1]].tag == "th" for p in line] for line in places]
    heads = 0
    while heads < len(labels) and labels[heads] and all(labels[heads]):
        heads += 1
    return Table(texts, min(heads, 3) if heads < len(labels) else 0, labels)


def header(table: Table) -> list[str]:
    """The header band's rows joined by column; a part that is there already is not repeated."""
    out = []
    for c in range(len(table.texts[0]) if table.texts else 0):
        parts: list[str] = []
        for r in range(table.heads):
            if (t := table.texts[r][c]) and t not in parts:
                parts.append(t)
        out.append(" > ".join(parts))
    return out


def _block(kind: str, **more) -> dict:
    return {"kind": kind, "level": None, "text": None, "keys": None, "value": None, "headers": None, "rows": None} | more


def table_blocks(node: Node) -> Iterator[dict]:
    """A table of label and value columns is key-value blocks; a single row of one cell a paragraph; others are tables. Inner tables follow."""
    stack = [node]
    while stack:
        t = read_table(node := stack.pop())
        body = [r for r in t.texts[t.heads :] if any(r)]
        if not body:
            continue
        width = len(body[0])
        if width == 1:
            yield from (_block("p", text=r[0]) for r in body if r[0])
        elif not t.heads and width == 2 and all(row[0] and not row[1] for row in t.labels if row):
            for label, value in body:
                if label:
                    yield _block("kv", keys=[label], value=value or None)
        else:
            yield _block("t", headers=header(t) if t.heads else [], rows=body)
        stack += reversed(list(node.find("table", stop=frozenset(("table",)))))


def blocks(root: Node) -> Iterator[dict]:
    """Typed blocks h, p, kv and t in document order; unknown containers are entered."""
    pending: list[str] = []

    def flush() -> Iterator[dict]:
        text = squeeze("".join(pending))
        pending.clear()
        if text:
            yield _block("p", text=text)

    def title(x: Node, level: int) -> Iterator[dict]:
        yield from flush()
        if text := squeeze(x.text()).replace("\n", " "):
            yield _block("h", level=level, text=text)

    stack: list[tuple] = [(x, 1) for x in reversed(root.content)]  # what comes next lies on top; (None, 0) ends a paragraph
    while stack:
        x, depth = stack.pop()
        inside = None
        if x is None:
            yield from flush()
        elif isinstance(x, str):
            pending.append(x)
        elif x.tag in HIDDEN or "display:none" in x.attrs.get("style", "").replace(" ", ""):
            continue
        elif x.tag == "table":
            yield from flush()
            yield from table_blocks(x)
        elif (m := re.fullmatch(r"h([1-6])", x.tag)) or x.tag == "title":
            yield from title(x, int(m[1]) if m else max(1, depth))
        elif x.tag != "div" and (m := re.search(r"\bsection-([1-6])\b", x.attrs.get("class", ""))):  # a viewer's title
            yield from title(x, int(m[1]))
        elif x.tag == "img" and x.attrs.get("alt", "").strip():
            yield from flush()
            yield _block("p", text=x.attrs["alt"].strip())
        elif x.tag == "br":
            pending.append("\n")
        elif (m := re.fullmatch(r"section-(\d)", x.tag)) or x.tag in BLOCKS:
            yield from flush()
            stack.append((None, 0))
            inside = int(m[1]) if m else depth
        else:
            inside = depth
        if inside is not None:
            stack += [(y, inside) for y in reversed(x.content)]
    yield from flush()


def inside(node: Node, tag: str, limit: str = "table") -> bool:
    """Whether an ancestor has the tag, none beyond the first `limit` asked: a row in a table's head."""
    at = node.parent
    while at is not None and at.tag != limit:
        if at.tag == tag:
            return True
        at = at.parent
    return False


def rewrite_links(root: Node) -> None:
    """Links become `[text](address)`, or their text without an address."""
    for a in list(root.find("a")):
        label, address = " ".join(a.text().split()), a.attrs.get("href") or ""
        a.tag, a.content = "span", [f"[{label}]({address})" if address else label]


def strip_noprint(root: Node) -> None:
    """Spans that are not for print lose their content."""
    for x in root.find("span"):
        if "noprint" in x.attrs.get("class", ""):
            x.content = []


#: Classes of a viewer's markup. A title's level is in its class; table groups lie on level three; a cover on one.
VIEWER_TITLE, VIEWER_GROUP, VIEWER_COVER = re.compile(r"section-([1-9])"), frozenset(("table-group", "table-group-xbrl")), "cover-title"


def layout_table(node: Node) -> bool:
    """A viewer's table without borders: it lays out captions and notes, and holds no data."""
    return "nb" in node.attrs.get("class", "").split()


def retag_values(root: Node) -> int:
    """In layout tables a lone cell over the whole width is a value and no label; returns how many there were."""
    n = 0
    for table in root.find("table"):
        if not layout_table(table):
            continue
        rows = [r for tr in table.find("tr", stop=frozenset(("table",))) if (r := [c for c in tr.nodes() if c.tag in CELLS])]
        width = max((sum(span(c.attrs.get("colspan")) for c in r) for r in rows), default=0)
        for r in rows:
            if len(r) == 1 and r[0].tag == "td" and span(r[0].attrs.get("colspan")) >= width:
                r[0].tag, n = "te", n + 1
    return n


def nest_sections(body: Node, deepest: int = 6) -> Node:
    """A viewer's flat titles as sections that hold what follows them: a title closes those of its level and deeper ones."""
    out = Node("body", {})
    open_: list[tuple[int, Node]] = [(0, out)]
    for x in body.content:
        name = x.attrs.get("class", "").strip() if isinstance(x, Node) else ""
        title = VIEWER_TITLE.fullmatch(name)
        level = 1 if name == VIEWER_COVER else min(int(title[1]), deepest) if title else 3 if name in VIEWER_GROUP else None
        if level is None:
            open_[-1][1].content.append(x)
            continue
        while len(open_) > 1 and (name == VIEWER_COVER or open_[-1][0] >= level):
            open_.pop()
        section = Node("cover" if name == VIEWER_COVER else f"section-{level}", {}, open_[-1][1])
        section.content.append(Node("title", {}, section, [" ".join(x.text().split())]))
        open_[-1][1].content.append(section)
        open_.append((level, section))
    return out


def nodes(root: Node) -> Iterator[dict]:
    """A row for each element in document order: ids, depth, path, attributes, own text."""
    number, stack = 0, [(root, None, 0, 0, "")]
    while stack:
        node, parent, order, depth, path = stack.pop()
        own = number
        if node.tag != "#root":
            path = f"{path}/{node.tag}"
            yield {"node_id": own, "parent_id": parent, "ord": order, "depth": depth, "tag": node.tag, "path": path, "attrs": list(node.attrs.items()), "text": "".join(x for x in node.content if isinstance(x, str))}
        number += 1
        stack += [(x, own, k, depth + 1, path) for k, x in reversed(list(enumerate(node.nodes())))]


_BLOCK = pa.struct([("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("keys", pa.list_(pa.string())), ("value", pa.string()), ("headers", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))])
_NODE = pa.struct([("node_id", pa.int32()), ("parent_id", pa.int32()), ("ord", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("path", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string())])
BLOCK_DDL = "kind string, level int, text string, keys array<string>, value string, headers array<string>, rows array<array<string>>"
NODE_DDL = "node_id int, parent_id int, ord int, depth int, tag string, path string, attrs map<string,string>, text string"


class Memory:
    """What the sources met last give, and a rough count of its bytes, so that equal ones are parsed once; two generations of `limit` bytes each."""

    def __init__(self, what, limit: int = 64 << 20):
        self.what, self.limit, self.size, self.new, self.old = what, limit, 0, {}, {}

    def __call__(self, source: str) -> tuple[list[dict], int]:
        kept = self.new.get(source)
        if kept is None:
            kept = self.old.get(source)
            if kept is None:
                found = list(self.what(tree(source)))
                kept = found, 200 + 4 * len(source) + 400 * len(found) + sum(60 + 8 * len(r) + sum(map(len, r)) for x in found for r in x.get("rows") or ())
            if kept[1] <= self.limit >> 4:  # a long one is not kept
                if self.size + kept[1] > self.limit:
                    self.new, self.old, self.size = {}, self.new, 0
                self.new[source] = kept
                self.size += kept[1]
        return kept


#: Of a Python worker, by what is read of a tree.
_memories: dict[str, Memory] = {}


def _parsed(df: DataFrame, key: str, source: str, what, kind: pa.DataType, ddl: str) -> DataFrame:
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _memories.setdefault(what.__name__, Memory(what))
        for batch in batches:
            found, size, begin = [], 0, 0
            for k, x in enumerate(batch.column(1)):
                one, n = read(x.as_py() or "")
                found.append(one)
                size += n
                if size > 4 << 20 or len(found) == 1024 or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(found)), pa.array(found, pa.list_(kind))], [key, "found"])
                    found, size, begin = [], 0, k + 1

    names = [x.strip().split(" ")[0] for x in re.split(r",(?![^<]*>)", ddl)]
    rows = df.select(key, F.col(source).alias("source")).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, found array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in re.split(r',(?![^<]*>)', ddl))}>>")
    return rows.select(key, F.posexplode("found").alias("seq", "b")).select(key, "seq", *[F.col(f"b.{n}").alias(n) for n in names])


def parse_blocks(df: DataFrame, key: str, source: str) -> DataFrame:
    """key, seq and the typed blocks of each document; a null source has none."""
    return _parsed(df, key, source, blocks, _BLOCK, BLOCK_DDL)


def parse_nodes(df: DataFrame, key: str, source: str) -> DataFrame:
    """key, seq and a row for each element."""
    return _parsed(df, key, source, nodes, _NODE, NODE_DDL)


def tag_profile(elements: DataFrame, key: str) -> DataFrame:
    """For each tag: occurrences, documents, attributes, and the text lengths' sum, least and greatest."""
    n = F.length(F.trim("text"))
    return elements.groupBy("tag").agg(F.count("*").alias("n"), F.countDistinct(key).alias("n_docs"), F.sum(F.size("attrs")).alias("n_attrs"), F.sum(n).alias("sum_chars"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"))


def path_counts(elements: DataFrame) -> DataFrame:
    return elements.groupBy("path").agg(F.count("*").alias("n"))
