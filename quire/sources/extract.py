"""Page extraction: a plug-in turns each file into page rows.

Text that already sits in a column is cut by column expressions. Other formats run a Python
plug-in in ``mapInArrow``: one file row in, page rows out in batches of bounded size. A
plug-in that can jump to a page gets page ranges as its units of work, so one file with very
many pages is spread over many tasks.
"""

from __future__ import annotations

import codecs
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import identity, text
from quire.schemas import PAGES
from quire.sources.files import _open_row, open_uri, task_count

PAGES_PER_BATCH = 200
CHARS_PER_BATCH = 4_000_000
PAGES_PER_UNIT = 256

RAW_PAGE = (
    "document_id string, page_number int, page_label string, width_pt double, height_pt double, "
    "rotation int, image_count int, page_text string"
)


@dataclass(frozen=True)
class PageRange:
    first: int = 1
    last: int | None = None
    reveal_hidden_layers: bool = False

    def __contains__(self, page_number: int) -> bool:
        return page_number >= self.first and (self.last is None or page_number <= self.last)


@dataclass(frozen=True)
class Plugin:
    """``pages(stream, page_range)`` yields dicts with ``page_number``, ``page_text`` and, where
    known, the other page columns. ``random_access`` says that it can start at any page."""

    pages: Callable[[BinaryIO, PageRange], Iterable[dict]]
    inspect: Callable[[BinaryIO, str], dict] | None = None
    random_access: bool = False


def finish_pages(raw: DataFrame) -> DataFrame:
    """Add the derived page columns to what a plug-in reported."""
    missing = [f for f in PAGES.fields if f.name not in raw.columns]
    out = raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    body = F.coalesce("page_text", F.lit(""))
    return out.withColumns({
        "page_text": body,
        "page_id": identity.page_id(F.col("document_id"), F.col("page_number")),
        "page_label": F.nullif("page_label", F.lit("")),
        "rotation": F.coalesce("rotation", F.lit(0)),
        "image_count": F.coalesce("image_count", F.lit(0)),
        "extraction_method": F.when(text.is_nonblank(body), "native").otherwise("none"),
        "char_count": F.char_length(body),
    }).select(*[F.col(f.name).cast(f.dataType) for f in PAGES.fields])


def first_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    return pages if max_pages is None else pages.where(F.col("page_number") <= max_pages)


def pages_of_text(
    files: DataFrame,
    chars: int | None = None,
    max_pages: int | None = None,
    content: str = "content",
) -> DataFrame:
    """Pages of UTF-8 text held in a column: ``chars`` characters each, or split at form feeds."""
    body = F.col(content)
    if dict(files.dtypes)[content] == "binary":
        body = F.decode(body, "UTF-8")
    pieces = text.fixed_size_pages(body, chars) if chars else text.page_break_pages(body)
    if max_pages is not None:
        pieces = F.slice(pieces, 1, max_pages)
    # The outer form spares a size test that the optimizer would put before the plain one.
    cut = files.select("document_id", F.posexplode_outer(pieces).alias("_at", "page_text"))
    cut = cut.where(F.col("_at").isNotNull())
    return finish_pages(cut.select("document_id", (F.col("_at") + 1).alias("page_number"), "page_text"))


def extract_pages(
    files: DataFrame,
    plugin: Plugin,
    max_pages: int | None = None,
    reveal_hidden_layers: bool = False,
    opener: Callable[[str], BinaryIO] = open_uri,
) -> DataFrame:
    """Run a plug-in over file rows (document_id with file_path or content); a failing file fails the job."""
    raw = raw_pages(files, plugin, max_pages, reveal_hidden_layers, opener).where("seconds IS NULL").drop("seconds")
    failed = F.raise_error(F.concat(F.col("document_id"), F.lit(": "), F.col("error"))).cast("string")
    checked = raw.withColumn("document_id", F.when(F.col("error").isNull(), F.col("document_id")).otherwise(failed))
    return finish_pages(checked.drop("error"))


def raw_pages(
    files: DataFrame,
    plugin: Plugin,
    max_pages: int | None = None,
    reveal_hidden_layers: bool = False,
    opener: Callable[[str], BinaryIO] = open_uri,
) -> DataFrame:
    """What a plug-in reports, with ``error``: a file that fails has one more row with its message and no page number.

    Its pages before the failure stand beside that row; ``good_pages`` leaves them out. Every run of
    the plug-in, over a file or a range of its pages, ends with a row of nothing but its ``seconds``.
    """
    has_content = "content" in files.columns
    source = "content" if has_content else "file_path"
    last = F.lit(max_pages).cast("int")
    units = files.withColumns({"_first": F.lit(1), "_last": last})
    if not has_content:
        if plugin.random_access and "page_count" in files.columns:
            pages = F.least("page_count", last) if max_pages is not None else F.col("page_count")
            starts = F.sequence(F.lit(1), F.greatest(pages, F.lit(1)), F.lit(PAGES_PER_UNIT))
            units = files.withColumn("_first", F.explode(starts)).withColumn(
                "_last", F.least(F.col("_first") + PAGES_PER_UNIT - 1, pages)
            )
        units = units.repartition(task_count(files), "document_id", "_first")
    units = units.select("document_id", source, "_first", "_last")
    keys = [field.split()[0] for field in RAW_PAGE.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                wanted = PageRange(
                    batch.column("_first")[i].as_py(), batch.column("_last")[i].as_py(), reveal_hidden_layers
                )
                document, started = batch.column("document_id")[i].as_py(), time.perf_counter()
                try:
                    with _open_row(batch, i, has_content, opener) as stream:
                        for page in plugin.pages(stream, wanted):
                            if page["page_number"] not in wanted:
                                continue
                            yield {key: page.get(key) for key in keys} | {"document_id": document}
                except Exception as exc:
                    yield {"document_id": document, "error": f"{type(exc).__name__}: {exc}"}
                yield {"document_id": document, "seconds": time.perf_counter() - started}

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("document_id", pa.string()), ("page_number", pa.int32()), ("page_label", pa.string()),
            ("width_pt", pa.float64()), ("height_pt", pa.float64()), ("rotation", pa.int32()),
            ("image_count", pa.int32()), ("page_text", pa.string()), ("error", pa.string()),
            ("seconds", pa.float64()),
        ])
        for held in row_batches(rows(batches)):
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return units.mapInArrow(extracted, f"{RAW_PAGE}, error string, seconds double")


def row_batches(rows: Iterable[dict]) -> Iterator[list[dict]]:
    """Rows of pages in lists of at most ``PAGES_PER_BATCH``, and fewer where their text is long."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row.get("page_text") or "")
        if len(held) >= PAGES_PER_BATCH or chars >= CHARS_PER_BATCH:
            yield held
            held, chars = [], 0
    if held:
        yield held


def failures(raw: DataFrame) -> DataFrame:
    """(document_id, error) of files whose extraction failed, one row each."""
    return raw.where("error IS NOT NULL").groupBy("document_id").agg(F.min("error").alias("error"))


def good_pages(raw: DataFrame, failed: DataFrame) -> DataFrame:
    pages = raw.where("error IS NULL AND seconds IS NULL").drop("error", "seconds")
    return finish_pages(pages.join(failed, "document_id", "left_anti"))


def file_seconds(raw: DataFrame) -> DataFrame:
    """(document_id, extract_seconds): time that the plug-in took for each file, over all its runs."""
    return raw.where("seconds IS NOT NULL").groupBy("document_id").agg(F.sum("seconds").alias("extract_seconds"))


# --- plug-ins ---------------------------------------------------------------------------


def _decoded(stream: BinaryIO, block: int = 1 << 20) -> Iterator[str]:
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    while data := stream.read(block):
        yield decoder.decode(bytes(data))
    yield decoder.decode(b"", final=True)


def _text_pages(stream: BinaryIO, wanted: PageRange) -> Iterator[dict]:
    number, parts = 1, []
    for piece in _decoded(stream):
        *ended, rest = piece.split(text.PAGE_BREAK)
        for tail in ended:
            if number in wanted:
                yield {"page_number": number, "page_text": "".join(parts) + tail}
            number, parts = number + 1, []
        if wanted.last is not None and number > wanted.last:
            return
        parts.append(rest)
    if number in wanted:
        yield {"page_number": number, "page_text": "".join(parts)}


def _text_info(stream: BinaryIO, name: str) -> dict:
    breaks = sum(piece.count(text.PAGE_BREAK) for piece in _decoded(stream))
    return {"page_count": breaks + 1, "pdf_format": "text"}


class _HtmlText(HTMLParser):
    """Visible text, the title and the named meta values of an HTML page."""

    SILENT = {"script", "style", "template", "noscript"}
    BLOCK = {"p", "br", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "td", "th"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.title, self.meta, self.images = [], [], {}, 0
        self._silent, self._in_title = 0, False

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag in self.SILENT:
            self._silent += 1
        elif tag == "title":
            self._in_title = True
        elif tag == "meta" and values.get("name"):
            self.meta[values["name"].lower()] = values.get("content") or ""
        elif tag == "img":
            self.images += 1
        elif tag in self.BLOCK:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in self.SILENT:
            self._silent = max(0, self._silent - 1)
        elif tag == "title":
            self._in_title = False
        elif tag in self.BLOCK:
            self.parts.append("\n")

    def handle_data(self, data):
        if self._in_title:
            self.title.append(data)
        elif not self._silent:
            self.parts.append(data)


def _parse_html(stream: BinaryIO) -> _HtmlText:
    parser = _HtmlText()
    for piece in _decoded(stream):
        parser.feed(piece)
    parser.close()
    return parser


def _html_pages(stream: BinaryIO, wanted: PageRange) -> Iterator[dict]:
    if 1 in wanted:
        parsed = _parse_html(stream)
        lines = (" ".join(line.split()) for line in "".join(parsed.parts).split("\n"))
        body = "\n".join(line for line in lines if line)
        yield {"page_number": 1, "page_text": body, "image_count": parsed.images}


def _html_info(stream: BinaryIO, name: str) -> dict:
    parsed = _parse_html(stream)
    return {
        "page_count": 1, "pdf_format": "HTML", "title": "".join(parsed.title).strip(),
        "author": parsed.meta.get("author"), "subject": parsed.meta.get("description"),
        "keywords": parsed.meta.get("keywords"), "creator": parsed.meta.get("generator"),
    }


TEXT = Plugin(_text_pages, _text_info)
HTML = Plugin(_html_pages, _html_info)
