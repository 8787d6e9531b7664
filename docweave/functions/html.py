"""F6 article extraction and F7 HTML -> Markdown (ATX headings) in one walk a page.

The walk reads a page tag by tag. Comments, declarations, scripts and styles are
tokens of their own, so nothing inside them counts as a tag, and a ``<`` that opens
no tag is text. Entities are decoded in text tokens, once. What is open stands in two
stacks: inline elements with their places in the output, and line prefixes (list
markers and indents, quotes, heading marks). A block boundary is only noted; the
next text writes it, with the marks of its line, so empty blocks leave nothing. An inline
element is marked when it is closed, in every block it spans; one that is
never closed leaves its text unmarked. Table cells are walked into an output of their own.

The functions are Arrow UDFs; ``article_markdown`` does both steps in one.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.arrow import mapped

#: elements whose content is no text of the page
_SILENT = "script|style|template"
#: tokens that are passed over whole
_SKIPPED = rf"<!--.*?(?:-->|\Z)|<(?P<silent>{_SILENT})(?=[\s/>])[^<>]*+>.*?(?:</(?P=silent)\s*+>|\Z)|<[!?][^<>]*+>"
_PRE = r"<pre(?=[\s>])[^<>]*+>(?P<pre>.*?)(?:</pre\s*+>|\Z)"
# a tag may hold "<" and ">" only between quotes, so what opens none is read no further than the next "<"
_TAG = r"<(?P<end>/?)(?P<tag>[a-z][^\s/<>]*+)(?P<rest>(?:[^'\"<>]++|\"[^\"]*+\"|'[^']*+')*+>|[^<>]*+>)"
_TOKEN = re.compile(f"{_SKIPPED}|{_PRE}|{_TAG}", re.IGNORECASE | re.DOTALL)
_ARTICLE = re.compile(rf"{_SKIPPED}|<(?P<end>/?)(?P<tag>article|main|body|html)(?=[\s/>])[^<>]*+>", re.IGNORECASE | re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_ENTITY = re.compile(r"&(?:#[xX][0-9a-fA-F]{1,6};|#[0-9]{1,7};|[a-zA-Z][a-zA-Z0-9]*;?)")
_BLANKS = re.compile(r"[ \t\r\n\f]+")
_HEADINGS = {f"h{n}": "#" * n + " " for n in range(1, 7)}
_MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~"}
_BLOCKS = frozenset(
    "address aside body caption dd details dialog div dl dt fieldset figcaption figure footer form head header "
    "html main nav p section summary title".split()
)


def _character(match: re.Match) -> str:
    e = match[0]
    if e[1] != "#":
        return " " if e == "&nbsp;" else entities.unescape(e)
    code = int(e[3:-1], 16) if e[2] in "xX" else int(e[2:-1])
    names_one = 0 < code < 0xD800 or 0xDFFF < code <= 0x10FFFF
    return (entities.unescape(e) or e) if names_one else e


def decode(text: str) -> str:
    """Entities as characters, each once; numbers that name no character stay."""
    return _ENTITY.sub(_character, text) if "&" in text else text


def _attribute(rest: str, name: str) -> str:
    for key, *values in _ATTRIBUTE.findall(rest):
        if key.lower() == name:
            return _BLANKS.sub(" ", decode("".join(values)))
    return ""


@dataclass
class _Inline:
    tag: str
    target: str
    spans: list[list[int]]  # first and end place in the output, per block


@dataclass
class _Prefix:
    tag: str
    first: str  # on the line that opens the element
    rest: str  # on its further lines
    used: bool = False


@dataclass
class _List:
    below: int  # prefixes outside
    item: int  # number of the last item, -1 for bullets


@dataclass
class _Page:
    """Output of one walk: a page, or a table cell."""

    out: list[str] = field(default_factory=list)
    inline: list[_Inline] = field(default_factory=list)
    prefixes: list[_Prefix] = field(default_factory=list)
    lists: list[_List] = field(default_factory=list)
    cells: list[str] | None = None  # of an open table row
    rows: int = 0  # of the open table
    tables: int = 0  # open ones
    gap: int = 0  # line ends to write before the next text
    breaks: int = 0  # <br> since the last text
    at_start: bool = True  # no text since the last block boundary

    def boundary(self, lines: int = 2) -> None:
        self.breaks = 0
        if not self.at_start:
            self.at_start = True
            for x in self.inline:
                x.spans[-1][1] = len(self.out)
                x.spans.append([len(self.out), len(self.out)])
        # nothing stands yet behind the marker of an item
        if not (self.prefixes and not self.prefixes[-1].used and self.gap):
            self.gap = max(self.gap, lines)

    def begin(self) -> None:
        """Write what is pending before a text."""
        rest = "".join(p.rest for p in self.prefixes if p.used)
        if self.at_start:
            line = "".join(p.rest if p.used else p.first for p in self.prefixes)
            lead = ("\n" if self.gap == 1 else f"\n{rest.rstrip()}\n") + line if self.out else line
            for p in self.prefixes:
                p.used = True
        elif any(p.tag in _HEADINGS for p in self.prefixes):
            lead = " " if self.breaks else ""
        else:
            lead = f"  \n{rest}" * self.breaks
        if lead:
            if self.out:
                self.out[-1] = self.out[-1].rstrip(" ")
            self.out.append(lead)
        if self.at_start:
            for x in self.inline:
                x.spans[-1][0] = len(self.out)
        self.gap, self.breaks, self.at_start = 0, 0, False

    def put(self, piece: str) -> None:
        if self.cells:  # a text between cells ends their row
            self.end_row()
        if self.at_start or self.breaks:
            self.begin()
        self.out.append(piece)

    def text(self, raw: str) -> None:
        t = _BLANKS.sub(" ", decode(raw))
        if self.at_start or self.breaks or self.out[-1].endswith(" "):
            t = t.lstrip(" ")
        if t:
            self.put(t)

    def pre(self, raw: str) -> None:
        code = decode(re.sub(r"<[^>]*>", "", raw))
        code = code[1:] if code.startswith("\n") else code
        code = code[:-1] if code.endswith("\n") else code
        self.boundary()
        self.begin()
        rest = "".join(p.rest for p in self.prefixes)
        self.out.append(f"```\n{code}\n```".replace("\n", "\n" + rest))
        self.boundary()

    def close_inline(self, tag: str) -> None:
        at = next((i for i in reversed(range(len(self.inline))) if self.inline[i].tag == tag), None)
        if at is None:
            return
        x = self.inline[at]
        del self.inline[at:]  # what was opened inside and not closed stays unmarked
        x.spans[-1][1] = len(self.out)
        for start, stop in x.spans:
            whole = "".join(self.out[start:stop])
            inner = whole.strip(" ")
            if not inner:
                continue
            lead, trail = whole[: len(whole) - len(whole.lstrip(" "))], whole[len(whole.rstrip(" ")) :]
            tick = "``" if "`" in inner else "`"
            mark = tick if tag == "code" else _MARKS.get(tag, "")
            marked = f"{mark}{inner}{mark}" if mark else f"[{inner}]({x.target})" if x.target else inner
            # places of outer elements stay right
            self.out[start:stop] = [lead + marked + trail] + [""] * (stop - start - 1)

    def close_prefix(self, tags, above: int = 0) -> bool:
        """Close the last open prefix of one of these elements, with all inside it."""
        at = next((i for i in reversed(range(above, len(self.prefixes))) if self.prefixes[i].tag in tags), None)
        if at is None:
            return False
        del self.prefixes[at:]
        while self.lists and self.lists[-1].below > at:
            self.lists.pop()
        return True

    def open(self, tag: str, rest: str) -> None:
        if tag in _MARKS or tag in ("a", "code"):
            self.inline.append(_Inline(tag, _attribute(rest, "href") if tag == "a" else "", [[len(self.out), len(self.out)]]))
        elif tag == "br":
            self.breaks += not self.at_start
        elif tag == "img":
            self.put(f"![{_attribute(rest, 'alt')}]({_attribute(rest, 'src')})")
        elif tag == "hr":
            self.boundary()
            self.put("---")
            self.boundary()
        elif tag in _HEADINGS:
            self.close_prefix(_HEADINGS)
            self.boundary()
            self.prefixes.append(_Prefix(tag, _HEADINGS[tag], ""))
        elif tag == "blockquote":
            self.boundary()
            self.prefixes.append(_Prefix(tag, "> ", "> "))
        elif tag in ("ul", "ol"):
            self.boundary(1 if self.lists else 2)
            self.lists.append(_List(len(self.prefixes), 0 if tag == "ol" else -1))
        elif tag == "li":
            self.close_prefix(("li",), self.lists[-1].below if self.lists else 0)
            self.boundary(1)
            marker = "* "
            if self.lists and self.lists[-1].item >= 0:
                self.lists[-1].item += 1
                marker = f"{self.lists[-1].item}. "
            self.prefixes.append(_Prefix(tag, marker, " " * len(marker)))
        elif tag == "table":
            self.boundary()
            self.rows, self.tables = 0, self.tables + 1
        elif tag == "tr":
            self.end_row()
            self.cells = []
        elif tag in _BLOCKS:
            self.boundary()

    def close(self, tag: str) -> None:
        if tag in _MARKS or tag in ("a", "code"):
            self.close_inline(tag)
        elif tag in _HEADINGS:
            self.close_prefix(_HEADINGS)
            self.boundary()
        elif tag in ("ul", "ol"):
            if self.lists:
                del self.prefixes[self.lists.pop().below :]
                self.boundary(1 if self.lists else 2)
        elif tag == "li":
            self.close_prefix(("li",), self.lists[-1].below if self.lists else 0)
            self.boundary(1)
        elif tag == "blockquote":
            self.close_prefix(("blockquote",))
            self.boundary()
        elif tag in ("tr", "table", "tbody", "thead", "tfoot"):
            self.end_row()
            self.tables -= tag == "table" and self.tables > 0
            self.boundary(2 if tag == "table" else 1)
        elif tag in _BLOCKS:
            self.boundary()

    def end_row(self) -> None:
        cells, self.cells = self.cells, None
        if cells:
            self.boundary(1 if self.rows else 2)
            self.put("| " + " | ".join(cells) + " |")
            if not self.rows:
                self.boundary(1)
                self.put("|" + " --- |" * len(cells))
            self.rows += 1
            self.boundary(1)

    def markdown(self) -> str:
        self.end_row()
        return "".join(self.out).rstrip(" ")


def to_markdown(html: str) -> str:
    """F7 on one page or article."""
    pages, at = [_Page()], 0

    def end_cell() -> None:
        cell = pages.pop().markdown()
        row = pages[-1].cells
        text = re.sub(r" *\n+ *", " ", cell).replace("|", "\\|")
        pages[-1].cells = [*(row or []), text]

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            pages[-1].text(html[at : m.start()])
        at = m.end()
        if m["pre"] is not None:
            pages[-1].pre(m["pre"])
        elif m["tag"]:
            tag = m["tag"].lower()
            # a table cell is a page of its own; it ends with the cell, its row or its table
            if tag in ("td", "th", "tr", "tbody", "thead", "tfoot") or tag == "table" and m["end"]:
                if len(pages) > 1 and not pages[-1].tables:
                    end_cell()
            if tag in ("td", "th"):
                if not m["end"]:
                    pages.append(_Page())
            elif m["end"]:
                pages[-1].close(tag)
            else:
                pages[-1].open(tag, m["rest"])
    pages[-1].text(html[at:])
    while len(pages) > 1:
        end_cell()
    return pages[0].markdown()


def article(html: str) -> str | None:
    """F6 on one page: its first article, nested ones included, or None. An article
    that is never closed reaches to the end of the page's main part."""
    start, stop, depth = None, len(html), 0
    for m in _ARTICLE.finditer(html):
        if not m["tag"]:
            continue
        if m["tag"].lower() == "article":
            if start is None and not m["end"]:
                start = m.end()
            depth += (start is not None) * (-1 if m["end"] else 1)
            if start is not None and depth == 0:
                stop = m.start()
                break
        elif start is not None and m["end"] and stop == len(html):
            stop = m.start()  # unless a closing tag of the article follows
    if start is None:
        return None
    return f"<article>{html[start:stop]}</article>"


def _article_markdown_of(page: str) -> str | None:
    found = article(page)
    return to_markdown(found) or None if found else None


@F.arrow_udf(T.StringType())
def _article(pages: pa.Array) -> pa.Array:
    return mapped(pages, article, pa.string())


@F.arrow_udf(T.StringType())
def _markdown(pages: pa.Array) -> pa.Array:
    return mapped(pages, lambda t: to_markdown(t) or None, pa.string())


@F.arrow_udf(T.StringType())
def _article_markdown(pages: pa.Array) -> pa.Array:
    return mapped(pages, _article_markdown_of, pa.string())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_article(html) -> Column:
    """the first <article> element (its own tag without attributes), nested ones
    included; NULL when there is none."""
    return _article(_col(html))


def html_to_markdown(html) -> Column:
    """HTML -> Markdown with ATX headings; '' becomes NULL."""
    return _markdown(_col(html))


def article_markdown(html) -> Column:
    """F6 then F7: the Markdown of the article; NULL without an article."""
    return _article_markdown(_col(html))
