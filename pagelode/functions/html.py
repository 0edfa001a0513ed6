"""Page parsing: one pass of the standard HTML tokeniser per page, on the executors."""

from __future__ import annotations

from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode import options as O
from pagelode.functions import urls

# Elements without content, elements whose text is not page text, default title.
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
))
HIDDEN = frozenset(("script", "style", "template", "rt", "rp"))
NO_TITLE = "No Title"

_ROWS_PER_OUTPUT = 256


class PageReader(HTMLParser):
    """Collects visible strings, the first title and anchor hrefs of one page at a time."""

    def __init__(self):
        super().__init__(convert_charrefs=False)

    def read(self, html: str) -> tuple[str, str, list[str]]:
        self.reset()
        self._open: list[str] = []
        self._hidden = 0
        self._run: list[str] = []
        self._strings: list[str] = []
        self._hrefs: list[str] = []
        self._title: list | None = None
        self._nodes: list[list] = []
        try:
            self.feed(html)
            self.close()
        except AssertionError:
            pass  # a broken marked section ends the page; what was read before it is kept
        self._end_run()
        return self._title_text(), " ".join(self._strings), self._hrefs

    def _title_text(self) -> str:
        node = self._title
        while isinstance(node, list):
            if len(node) != 1:
                return NO_TITLE
            node = node[0]
        return node.strip() if node else NO_TITLE

    def _end_run(self) -> None:
        if not self._run:
            return
        text = "".join(self._run)
        self._run.clear()
        if self._nodes:
            self._nodes[-1].append(text)
        if not self._hidden:
            text = text.strip()
            if text:
                self._strings.append(text)

    def handle_starttag(self, tag, attrs):
        self._push(tag, attrs)
        if tag in VOID:
            self._pop(tag)

    def handle_startendtag(self, tag, attrs):
        self._push(tag, attrs)
        self._pop(tag)

    def handle_endtag(self, tag):
        self._end_run()
        if tag in self._open:
            self._pop(tag)

    def _push(self, tag, attrs):
        self._end_run()
        if self._nodes:
            node: list = []
            self._nodes[-1].append(node)
            self._nodes.append(node)
        elif tag == "title" and self._title is None:
            self._title = []
            self._nodes.append(self._title)
        self._open.append(tag)
        if tag in HIDDEN:
            self._hidden += 1
        elif tag == "a":
            found = dict(attrs)
            if "href" in found:
                self._hrefs.append(found["href"] or "")

    def _pop(self, tag):
        # An end tag closes everything opened since its start tag.
        while self._open:
            top = self._open.pop()
            if top in HIDDEN:
                self._hidden -= 1
            if self._nodes:
                self._nodes.pop()
            if top == tag:
                return

    def handle_data(self, data):
        self._run.append(data)

    def handle_entityref(self, name):
        self._run.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            if 128 <= code < 256:
                char = bytes((code,)).decode("windows-1252", "ignore") or chr(code)
            elif 0xD800 <= code < 0xE000:
                char = ""  # half of a surrogate pair is no character
            else:
                char = chr(code)
        except (ValueError, OverflowError):
            char = ""
        self._run.append(char or "\N{REPLACEMENT CHARACTER}")

    def _apart(self, data):
        # Comments and declarations end a string; inside a title they count as a child.
        self._end_run()
        if self._nodes:
            self._nodes[-1].append(data)

    handle_comment = handle_decl = handle_pi = _apart

    def unknown_decl(self, data):
        self._apart(data)
        if data[:6].upper() == "CDATA[":
            text = data[6:].strip()
            if text:
                self._strings.append(text)


def _target(base: str, href: str) -> str | None:
    try:
        return urljoin(base, href)
    except ValueError:
        return None


_FIELDS = {
    "title": T.StringType(),
    "content": T.StringType(),
    "hrefs": T.ArrayType(T.StringType()),
    "targets": T.ArrayType(T.StringType()),
}


def read_pages(pages: DataFrame, want=("title", "content", "hrefs", "targets"), keep=("page_id", "url")) -> DataFrame:
    """Parse `html` and return the kept columns with the wanted ones.

    `targets` are hrefs resolved against the page URL. Rows without HTML are failed fetches
    and give no page. No shuffle: each input split is parsed where it is read.
    """
    keep = tuple(dict.fromkeys((*keep, "url")))
    out = T.StructType([pages.schema[c] for c in keep] + [T.StructField(c, _FIELDS[c]) for c in want])

    def parse(batches):
        reader = PageReader()
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_PER_OUTPUT):
                part = batch.slice(start, _ROWS_PER_OUTPUT)
                bases = part.column("url").to_pylist()
                read = [reader.read(h) for h in part.column("html").to_pylist()]
                made = {"title": [r[0] for r in read], "content": [r[1] for r in read]}
                if "hrefs" in want:
                    made["hrefs"] = [r[2] for r in read]
                if "targets" in want:
                    made["targets"] = [
                        [t for t in (_target(b or "", h) for h in r[2]) if t is not None]
                        for b, r in zip(bases, read)
                    ]
                lists = pa.list_(pa.string())
                cols = [part.column(c) for c in keep] + [
                    pa.array(made[c], pa.string() if c in ("title", "content") else lists) for c in want
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *want])

    source = pages.where(F.col("html").isNotNull() & (F.col("html") != "")).select(*keep, "html")
    return source.mapInArrow(parse, out)


def keep_links(targets: Column, domains=O.VALID_DOMAINS, junk=O.JUNK_PATTERNS) -> Column:
    """Cleaned, valid, non-junk targets, each once, in the order of their first occurrence."""
    cleaned = F.transform(targets, urls.clean_url)
    return F.array_distinct(
        F.filter(cleaned, lambda u: urls.valid_url(u, domains) & ~urls.junk_url(u, junk)))


def parse_pages(pages: DataFrame, domains=O.VALID_DOMAINS, junk=O.JUNK_PATTERNS,
                want=("title", "content", "links"), keep=("page_id", "url")) -> DataFrame:
    """Pages as documents: kept columns, then `title`, `content` and `links` as wanted."""
    raw = tuple("targets" if c == "links" else c for c in want)
    read = read_pages(pages, raw, keep)
    cols = [keep_links(F.col("targets"), domains, junk).alias("links") if c == "links" else F.col(c)
            for c in want]
    return read.select(*dict.fromkeys((*keep, "url")), *cols)
