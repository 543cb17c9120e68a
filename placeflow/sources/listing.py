"""Captured listing pages -> merchant rows, and where paging stops.

A streaming HTML parser reads each page once, in Arrow batches: tables may be
nested, end tags of cells and rows may be missing, colspan and rowspan repeat a
cell. Leading rows of ``<th>`` cells (or a ``<thead>``) are a table's column
header, not data. The target is the first table with at least five columns
whose first data cell holds the header word; that row is the header, repeated
header rows are dropped, cells 0-3 are kept by position.

Paging stops (per batch, pages in order): before the first page that carries
the "no data" marker, and at the third consecutive page that has tables but
not the target (a target page resets the run; failed pages - no HTML, or no
table at all - neither add nor reset). This runs on a narrow per-page table
(codes, page_no, kind), never on the HTML, and without a window over a batch.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from placeflow.functions.text import PY_WHITESPACE
from placeflow.operators.prefix import exclusive_prefix_sum

BATCH = ["city_code", "zip_code", "ind_code"]

# ---- fixed values of the listing source ----
HEADER_WORD = "特店名稱"
NO_DATA_MARKERS = ("查無資料", "查無特店資訊")
MIN_COLUMNS = 5
EMPTY_PAGES_TO_STOP = 3
CELL_FIELDS = ["name", "industry_text", "phone", "address"]

# the plain forms of this markup, for the SQL checks
TABLE_RE = r"(?is)<table[^>]*>(.*?)</table>"
ROW_RE = r"(?is)<tr[^>]*>(.*?)</tr>"
CELL_RE = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"
TAG_RE = r"<[^>]*>"
# newlines, or runs of two or more whitespace characters, become one space
WS_RUN_RE = r"[\r\n]+|\s{2,}"
TRIM_RE = "^" + PY_WHITESPACE + "+|" + PY_WHITESPACE + "+$"


MAX_SPAN = 1000  # a span beyond this is a mistake in the markup, as browsers treat it


class _Table:
    def __init__(self):
        self.rows: list[tuple[bool, list]] = []  # (in thead, cells: [tag, text parts, colspan, rowspan])
        self.cell = None
        self.in_head = False

    def open_row(self):
        self.cell = None
        self.rows.append((self.in_head, []))

    def open_cell(self, tag, attrs):
        if not self.rows:
            self.open_row()
        spans = [attrs.get(k) or "1" for k in ("colspan", "rowspan")]
        self.cell = [tag, [], *(min(MAX_SPAN, max(1, int(x))) if x.strip().isdigit() else 1 for x in spans)]
        self.rows[-1][1].append(self.cell)

    def data(self) -> list[list[str]]:
        """Cell texts of the data rows, spans filled in."""
        rows = [(head, cells) for head, cells in self.rows if cells]
        first = 0
        while first < len(rows) and (rows[first][0] or all(c[0] == "th" for c in rows[first][1])):
            first += 1
        out, below = [], {}  # below: column -> (text, rows still covered)
        for _, cells in rows[first:]:
            line, todo, next_below = [], list(cells), {}
            while todo or any(c >= len(line) for c in below):
                if len(line) in below:
                    text, left = below[len(line)]
                    if left > 1:
                        next_below[len(line)] = (text, left - 1)
                    line.append(text)
                elif todo:
                    tag, parts, width, height = todo.pop(0)
                    text = cell_text("".join(parts))
                    for _ in range(width):
                        if height > 1:
                            next_below[len(line)] = (text, height - 1)
                        line.append(text)
                else:
                    line.append("")
            out.append(line)
            below = next_below
        return out


# no page has a table without it; most pages need no parsing
TABLE_START = re.compile("<table", re.IGNORECASE | re.ASCII)


class _Tables(HTMLParser):
    """All tables of a page, in the order they open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[_Table] = []
        self.open: list[_Table] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            table = _Table()
            self.found.append(table)
            self.open.append(table)
        elif self.open:
            table = self.open[-1]
            if tag in ("thead", "tbody", "tfoot"):
                table.cell, table.in_head = None, tag == "thead"
            elif tag == "tr":
                table.open_row()
            elif tag in ("td", "th"):
                table.open_cell(tag, dict(attrs))

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag == "table":
            self.open.pop()
        elif tag in ("td", "th", "tr", "thead", "tbody", "tfoot"):
            self.open[-1].cell = None
            if tag == "thead":
                self.open[-1].in_head = False

    def handle_data(self, data):
        for table in self.open:  # the text of a nested table is text of the cell around it too
            if table.cell is not None:
                table.cell[1].append(data)


def cell_text(text: str) -> str:
    """Whitespace runs folded, trimmed."""
    return re.sub(WS_RUN_RE, " ", text).strip()


def page_tables(html: str) -> list[list[list[str]]]:
    """The data rows of every table of a page."""
    parser = _Tables()
    parser.feed(html)
    parser.close()
    return [t.data() for t in parser.found]


def target_rows(tables: list[list[list[str]]]) -> list[list[str | None]] | None:
    """Cells 0-3 of the target table's rows, the header row first; None without a target."""
    for rows in tables:
        if rows and rows[0] and max(map(len, rows)) >= MIN_COLUMNS and HEADER_WORD in rows[0][0]:
            return [[*r, *[None] * len(CELL_FIELDS)][:len(CELL_FIELDS)] for r in rows]
    return None


@arrow_udf(T.StructType([T.StructField("n_tables", T.LongType()), T.StructField("target", T.ArrayType(T.ArrayType(T.StringType())))]))
def _parsed(pages: pa.Array) -> pa.Array:
    out = []
    for html in pages.to_pylist():
        tables = page_tables(html) if html and TABLE_START.search(html) else []
        out.append({"n_tables": len(tables), "target": target_rows(tables)})
    return pa.array(out, type=pa.struct([("n_tables", pa.int64()), ("target", pa.list_(pa.list_(pa.string())))]))


def classify_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``kind`` (marker / failed / target / empty), ``n_tables`` and ``_target`` (the cells)."""
    h = F.col(html)
    marker = F.lit(False)
    for m in NO_DATA_MARKERS:
        marker = marker | F.contains(h, F.lit(m))
    parsed = pages.withColumn("_page", _parsed(h))
    kind = (
        F.when(h.isNull(), "failed")
        .when(marker, "marker")
        .when(F.col("_page.n_tables") == 0, "failed")
        .when(F.col("_page.target").isNotNull(), "target")
        .otherwise("empty")
    )
    return parsed.withColumns({"n_tables": F.col("_page.n_tables"), "_target": F.col("_page.target"), "kind": kind}).drop("_page")


def extract_rows(classified: DataFrame, keep: Sequence[str] = (*BATCH, "page_no")) -> DataFrame:
    """Rows of each target table: header row dropped, repeated headers skipped."""
    after = F.slice("_target", F.lit(2), F.greatest(F.size("_target") - 1, F.lit(0)))
    rows = classified.filter(F.col("kind") == "target").select(*keep, F.posexplode(after).alias("row_no", "_c"))
    texts = [F.get("_c", i).alias(name) for i, name in enumerate(CELL_FIELDS)]
    out = rows.select(*keep, F.col("row_no").cast("bigint").alias("row_no"), *texts)
    return out.filter(F.col("name").isNull() | (F.col("name") != HEADER_WORD))


def page_cutoff(classified: DataFrame, batch_cols: Sequence[str] = BATCH) -> DataFrame:
    """Per page: kind and ``kept`` (strictly before the stop page of its batch).

    Skew-safe, without a window over a batch: counted (non-failed) pages get
    their rank by a bounded prefix count; each empty page votes for ranks r,
    r+1 and r+2; a rank with three votes is a stop (three empties in a row), at
    the page with the largest page_no among its voters. Stops and markers are
    reduced with min per batch (partial aggregation). ``classified`` is read
    more than once: pass a materialised page table when it is expensive.
    """
    batch_cols = list(batch_cols)
    narrow = classified.select(*batch_cols, "page_no", "kind")
    counted = narrow.filter(F.col("kind") != "failed").withColumn("_one", F.lit(1))
    ranked = exclusive_prefix_sum(counted, batch_cols, "page_no", "_one", "_rank")
    votes = ranked.filter(F.col("kind") == "empty").select(
        *batch_cols, "page_no",
        F.explode(F.sequence(F.col("_rank"), F.col("_rank") + (EMPTY_PAGES_TO_STOP - 1))).alias("_at"),
    )
    run_stops = (
        votes.groupBy(*batch_cols, "_at").agg(F.count(F.lit(1)).alias("_v"), F.max("page_no").alias("_page"))
        .filter(F.col("_v") >= EMPTY_PAGES_TO_STOP)
        .select(*batch_cols, F.col("_page").alias("page_no"))
    )
    markers = ranked.filter(F.col("kind") == "marker").select(*batch_cols, "page_no")
    stops = run_stops.unionByName(markers).groupBy(*batch_cols).agg(F.min("page_no").alias("_stop"))
    j = narrow.join(stops, batch_cols, "left")
    return j.withColumn("kept", F.col("_stop").isNull() | (F.col("page_no") < F.col("_stop"))).drop("_stop")


def page_cap(page_rows: DataFrame, max_limit: int, batch_cols: Sequence[str] = BATCH) -> DataFrame:
    """Row cap: a page is read only while the rows collected before it are < ``max_limit``
    (the last page read may overshoot). ``page_rows``: (codes, page_no, n_rows)."""
    out = exclusive_prefix_sum(page_rows, batch_cols, "page_no", "n_rows", "rows_before")
    return out.withColumn("kept", F.col("rows_before") < max_limit)


def classified_pages(pages: DataFrame, materialize_pages: bool = True) -> DataFrame:
    """Narrow classified pages (codes, page_no, kind, target cells; no page HTML),
    materialised once because the stop rule and the extraction both read them."""
    classified = classify_pages(pages).select(*BATCH, "page_no", "kind", "_target")
    if materialize_pages:
        from placeflow.session import materialize
        classified = materialize(classified)
    return classified


def listing_merchants(pages: DataFrame, materialize_pages: bool = True, max_rows_per_batch: int | None = None) -> DataFrame:
    """Pages -> merchant rows of the pages read before paging stopped (and,
    with ``max_rows_per_batch``, before the row cap was reached).

    The classified pages feed both the stop rule and the extraction; they are
    materialised once in narrow form (codes, page_no, kind, target table - the
    page HTML is dropped) so each page is parsed once.
    """
    classified = classified_pages(pages, materialize_pages)
    kept = page_cutoff(classified).filter("kept").select(*BATCH, "page_no")
    rows = extract_rows(classified.join(kept, [*BATCH, "page_no"], "left_semi"))
    if max_rows_per_batch is None:
        return rows
    per_page = rows.groupBy(*BATCH, "page_no").agg(F.count(F.lit(1)).alias("n_rows"))
    capped = page_cap(per_page, max_rows_per_batch).filter("kept").select(*BATCH, "page_no")
    return rows.join(capped, [*BATCH, "page_no"], "left_semi")
