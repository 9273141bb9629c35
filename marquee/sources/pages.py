"""Financial tables out of landed web pages."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.text import col, slugify

# Address forms of a title page, and the text that marks the wanted table.
URL_WITH_YEAR = "https://www.the-numbers.com/movie/%s-(%s)"
URL_PLAIN = "https://www.the-numbers.com/movie/%s#tab=summary"
MARKER = "Production Budget"


def candidate_urls(movies: DataFrame, title: str = "title", year: Column | None = None) -> DataFrame:
    """(…, pos, url): one or two addresses per movie, the one with the year first."""
    slug = slugify(title)
    year = F.year("release_date") if year is None else year
    urls = F.array_compact(F.array(
        F.when(F.coalesce(year, F.lit(0)) != 0, F.format_string(URL_WITH_YEAR, slug, year.cast("string"))),
        F.format_string(URL_PLAIN, slug)))
    return movies.select("*", F.posexplode(urls).alias("pos", "url"))


# A tag without quirks: a plain name, double-quoted attributes.
_TAG = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[\t\n\r\f ]+[a-zA-Z-]+="[^"<>]*")*)>')
# Elements whose content a parser may read as text.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


class _Tables(HTMLParser):
    """Cells of the tables of a page; what stands in a nested table belongs to the outer one too.

    A row, a cell or a table that is left open ends with the next one of its kind in the same table, or with the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.open: list[_Table] = []

    def read(self, html: str) -> None:
        """Parse a whole page; one that is all plain tags and text needs no tokenizer but one split."""
        parts = _TAG.split(html)
        names = [n.lower() for n in parts[2::4]]
        plain = not any("<" in t for t in parts[::4]) and _RAW.isdisjoint(names) and not any(a and b for a, b in zip(parts[1::4], parts[3::4]))
        if not plain:
            self.feed(html)
            self.close()
            return
        if parts[0]:
            self.handle_data(unescape(parts[0]))
        for ends, name, text in zip(parts[1::4], names, parts[4::4]):
            if ends:
                self.handle_endtag(name)
            else:
                self.handle_starttag(name, ())
            if text and self.open:
                self.handle_data(unescape(text))

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.open.append(_Table())
            self.tables.append(self.open[-1])
        elif self.open and tag in ("tr", "td"):
            (self.open[-1].start_row if tag == "tr" else self.open[-1].start_cell)()
            if tag == "tr":
                for outer in self.open[:-1]:
                    outer.rows.append(self.open[-1].rows[-1])
        self._break()

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif self.open and tag in ("tr", "td"):
            self.open[-1].cell = None
            if tag == "tr":
                self.open[-1].row = None
        self._break()

    def _break(self) -> None:
        for table in self.open:
            if table.cell is not None:
                table.cell.append("")

    def handle_data(self, data: str) -> None:
        for table in self.open:
            table.text.append(data)
            if table.cell is not None:
                table.cell[-1:] = [(table.cell[-1] if table.cell else "") + data]


class _Table:
    def __init__(self):
        self.text: list[str] = []
        self.rows: list[list[list[str]]] = []
        self.row: list[list[str]] | None = None
        self.cell: list[str] | None = None

    def start_row(self) -> None:
        self.row, self.cell = [], None
        self.rows.append(self.row)

    def start_cell(self) -> None:
        if self.row is None:
            self.start_row()
        self.cell = [""]
        self.row.append(self.cell)


def page_values(html: str | None, marker: str = MARKER) -> dict[str, str]:
    """Label -> value of the first table whose text holds ``marker``: its rows of two cells, the last of a label wins.

    A cell's text is the stretches between tags, each trimmed, joined without a gap.
    """
    if not html or "<table" not in html.lower():
        return {}
    parser = _Tables()
    parser.read(html)
    chosen = next((t for t in parser.tables if marker in "".join(t.text)), None)
    text = lambda cell: "".join(piece.strip() for piece in cell)
    return {text(r[0]): text(r[1]) for r in chosen.rows if len(r) == 2} if chosen else {}


def label_values(html: Column | str, marker: str = MARKER) -> Column:
    """Label -> value map of a page (``page_values``), empty without a table; pages go to Python in Arrow batches."""
    @F.pandas_udf("map<string,string>")
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: page_values(h, marker), na_action=None)

    return parse(col(html))


def pages_with_data(pages: DataFrame, marker: str = MARKER) -> DataFrame:
    """(url, data) of the pages that carry data (``page_values``).

    Pages without any are dropped where they are parsed: a filter on a parsed column would parse every page again.
    """
    kind = pa.map_(pa.string(), pa.string())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_values(h, marker) for h in batch.column("html").to_pylist()]
            keep = [i for i, data in enumerate(found) if data]
            data = pa.array([list(found[i].items()) for i in keep], kind)
            yield pa.RecordBatch.from_arrays([batch.column("url").take(pa.array(keep, pa.int64())), data], ["url", "data"])

    return pages.select("url", "html").mapInArrow(run, "url string, data map<string,string>")


def first_hit(candidates: DataFrame, pages: DataFrame, key: str = "movie_id") -> DataFrame:
    """Per movie, the first candidate address whose page carries data."""
    # Only pages that some candidate names are parsed, each once.
    wanted = pages.join(candidates.select("url").distinct(), "url", "left_semi")
    parsed = pages_with_data(wanted)
    best = F.min_by(F.struct("url", "data"), "pos").alias("hit")
    return (
        candidates.select(key, "pos", "url").join(parsed, "url").groupBy(key).agg(best)
        .select(key, "hit.url", "hit.data")
    )
