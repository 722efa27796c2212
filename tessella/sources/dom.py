"""HTML pages to node tables.

The only step of the page flow that needs Python: the tokenizer of the standard
library runs inside `mapInArrow`, one page at a time, and emits plain rows. All later
page operators are column expressions over those rows.
"""

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessella import schema

# --- Fixed values: HTML element classes ---------------------------------------
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HEAD_TAGS = frozenset("base link meta noscript script style title".split())
# Start tags that end an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dd dt".split()
)
# Start tags that end an open sibling, and the elements the search for it stops at.
ENDS_SIBLING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# An open paragraph is not looked for beyond these.
PARAGRAPH_SCOPE = frozenset({"html", "table", "td", "th", "caption", "button", "object", "marquee"})


# Elements whose content is not markup; the tokenizer reads their start tags itself.
RAW_TAGS = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
# Tags without attributes, blanks or capitals, as most are.
_PLAIN_START = re.compile("<([a-z][a-z0-9]*)>").match
_PLAIN_END = re.compile("</([a-z][a-z0-9]*)>").match


class _NodeRows(HTMLParser):
    """Collects elements and text leaves in document order, one list per field.

    `paths` holds the numbers of the nodes from the root to the node itself; `stack` those of the open elements.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.paths: list[list[int]] = []
        self.attrs: list[dict[str, str]] = []
        self.texts: list[str | None] = []
        self.stack: list[int] = []
        self.body_open = False
        self._open("html", [])

    def updatepos(self, i: int, j: int) -> int:
        return j  # lines are not counted

    def parse_starttag(self, i: int) -> int:
        plain = _PLAIN_START(self.rawdata, i)
        if plain is None or plain[1] in RAW_TAGS:
            return super().parse_starttag(i)
        self.handle_starttag(plain[1], [])
        return plain.end()

    def parse_endtag(self, i: int) -> int:
        plain = _PLAIN_END(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def _row(self, tag: str, attrs: dict, text: str | None) -> int:
        no = len(self.tags)
        self.tags.append(tag)
        self.paths.append([*self.paths[self.stack[-1]], no] if self.stack else [no])
        self.attrs.append(attrs)
        self.texts.append(text)
        return no

    def _open(self, tag: str, attrs: list) -> None:
        # The first of several equal attributes counts.
        self.stack.append(self._row(tag, {k: v or "" for k, v in reversed(attrs)}, None))

    def _close_open(self, tags: set | frozenset, scope: set | frozenset) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[depth]]
            if tag in tags:
                del self.stack[depth:]
                return
            if tag in scope:
                return

    def _enter_body(self) -> None:
        if not self.body_open:
            self.body_open = True
            del self.stack[1:]
            self._open("body", [])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag == "head":
            if not self.body_open and len(self.stack) == 1:
                self._open("head", attrs)
            return
        if tag == "body":
            if not self.body_open:
                self._enter_body()
                self.attrs[self.stack[-1]].update({k: v or "" for k, v in attrs})
            return
        if not self.body_open:
            if tag in HEAD_TAGS:
                if len(self.stack) == 1:
                    self._open("head", [])
            else:
                self._enter_body()
        if tag in ENDS_PARAGRAPH:
            self._close_open({"p"}, PARAGRAPH_SCOPE)
        if tag in ENDS_SIBLING:
            self._close_open(*ENDS_SIBLING[tag])
        self._open(tag, attrs)
        if tag in VOID_TAGS:
            self.stack.pop()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # Outside of void elements the slash means nothing in HTML.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "head":
            if not self.body_open:
                del self.stack[1:]
            return
        if tag in ("html", "body"):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.tags[self.stack[depth]] == tag:
                del self.stack[depth:]
                return

    def handle_data(self, data: str) -> None:
        in_head = not self.body_open and len(self.stack) > 1 and self.tags[self.stack[-1]] != "head"
        if not self.body_open and not in_head:
            if not data.strip():
                return
            self._enter_body()
        if self.tags[-1] == "-text" and self.paths[-1][-2] == self.stack[-1]:
            self.texts[-1] += data
        else:
            self._row("-text", {}, data)


# Characters of pages whose nodes a task holds at once.
BATCH_CHARS = 1 << 20


def _parsed(html: str) -> _NodeRows:
    parser = _NodeRows()
    parser.feed(html)
    parser.close()
    return parser


def _ends(paths: list[list[int]]) -> list[int]:
    """Number of every node's last descendant, its own for a leaf."""
    ends = list(range(len(paths)))
    # Children come after their parents, so one backward pass gives every subtree's last number.
    for no in range(len(paths) - 1, 0, -1):
        parent = paths[no][-2]
        if ends[no] > ends[parent]:
            ends[parent] = ends[no]
    return ends


def parse_nodes(html: str) -> list[dict]:
    """Node rows of one page: its elements and text leaves with their paths."""
    page = _parsed(html)
    return [
        {"pos": no, "tag": tag, "path": [{"tag": page.tags[n], "no": n} for n in path], "attrs": attrs, "text": text, "end": end}
        for no, (tag, path, attrs, text, end) in enumerate(zip(page.tags, page.paths, page.attrs, page.texts, _ends(page.paths)))
    ]


def _offsets(lengths: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def _node_lists(pages: list[_NodeRows | None], kind: pa.ListType) -> pa.Array:
    """The node arrays of some pages, field by field; None is an empty one."""
    parsed = [p for p in pages if p is not None]
    sizes = [len(p.tags) for p in parsed]
    flat = {name: list(chain.from_iterable(getattr(p, name) for p in parsed)) for name in ("tags", "paths", "attrs", "texts")}
    fields = {f.name: f.type for f in kind.value_type}
    tags = pa.array(flat["tags"], pa.string())
    depths = [len(p) for p in flat["paths"]]
    numbers = np.fromiter(chain.from_iterable(flat["paths"]), np.int64, sum(depths))
    first = np.repeat(np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes).astype(np.int64)
    entry = fields["path"].value_type
    entries = pa.StructArray.from_arrays(
        [tags.take(pa.array(numbers + np.repeat(first, depths))), pa.array(numbers, pa.int32())], fields=list(entry)
    )
    attrs = pa.MapArray.from_arrays(
        _offsets([len(a) for a in flat["attrs"]]),
        pa.array(list(chain.from_iterable(flat["attrs"])), pa.string()),
        pa.array(list(chain.from_iterable(a.values() for a in flat["attrs"])), pa.string()),
    )
    made = {
        "pos": pa.array(np.arange(len(tags)) - first, pa.int32()),
        "tag": tags,
        "path": pa.ListArray.from_arrays(_offsets(depths), entries, type=fields["path"]),
        "attrs": attrs.cast(fields["attrs"]),
        "text": pa.array(flat["texts"], pa.string()),
        "end": pa.array(list(chain.from_iterable(_ends(p.paths) for p in parsed)), pa.int32()),
    }
    nodes = pa.StructArray.from_arrays(
        [made[f.name] if f.name in made else pa.nulls(len(tags), f.type) for f in kind.value_type], fields=list(kind.value_type)
    )
    return pa.ListArray.from_arrays(_offsets([0 if p is None else len(p.tags) for p in pages]), nodes, type=kind)


def build_dom_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the HTML of each page by `nodes` and `dom_error`.

    A page that cannot be read gives an empty node array and an error text, so it is
    still there as an empty document.
    """
    kept = [f for f in pages.schema.fields if f.name != html]
    out = T.StructType(
        [*kept, T.StructField("nodes", schema.DOM_NODES), T.StructField("dom_error", T.StringType())]
    )
    nodes_type = to_arrow_type(schema.DOM_NODES)
    names = [f.name for f in kept]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_nodes, errors, start, size = [], [], 0, 0
            for row, page in enumerate(batch.column(html)):
                page = page.as_py()
                nodes, error = None, ""
                try:
                    if page:
                        nodes = _parsed(page)
                    else:
                        error = "no page"
                except Exception as failure:  # a bad page must not end the job
                    nodes, error = None, repr(failure)
                pages_nodes.append(nodes)
                errors.append(error)
                size += len(page or "")
                if size >= BATCH_CHARS or row + 1 == batch.num_rows:
                    # The nodes of a page take many times its size, so they do not wait for the whole batch.
                    part = batch.slice(start, row + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(n) for n in names], _node_lists(pages_nodes, nodes_type), pa.array(errors, pa.string())],
                        names=[*names, "nodes", "dom_error"],
                    )
                    pages_nodes, errors, start, size = [], [], row + 1, 0

    return pages.mapInArrow(parse, out)


def dom_nodes(pages_nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Flat node table: one row per element and text leaf."""
    return pages_nodes.select(key, F.inline("nodes"))
