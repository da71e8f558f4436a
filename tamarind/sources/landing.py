"""Readers of landed files: JSON listings and envelopes, snapshots, file manifests, text, archives, pages and messages.

Schemas are given and never inferred. Binary formats are opened in ``mapInPandas`` over landed bytes, one file at a time, so
memory follows the largest file. Files that cannot be opened give a row with ``error``, never a failed job.
"""

from __future__ import annotations

import email
import email.policy
import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarind.functions.scalars import award_instant, blank_to_null, plain_money, snake_key, url_parameter


def _objects(rows: DataFrame, array: Column, schema: str) -> DataFrame:
    """The objects of a JSON array's text, typed; items that are no objects are dropped."""
    items = rows.select(F.explode(F.from_json(array, "array<string>")).alias("item")).where(F.trim("item").startswith("{"))
    return items.select(F.from_json("item", schema).alias("r")).select("r.*")


def read_listing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of objects a file; items that are no objects are dropped, a file that is no array gives none."""
    return _objects(spark.read.text(path, wholetext=True), F.col("value"), schema)


def read_envelope(spark: SparkSession, path: str, schema: str, field: str = "records") -> DataFrame:
    """Records out of ``{field: [...]}`` or out of a bare array of them, whichever a file holds."""
    return _objects(spark.read.text(path, wholetext=True), F.coalesce(F.get_json_object("value", f"$.{field}"), F.col("value")), schema)


def newest_file(spark: SparkSession, pattern: str) -> str | None:
    """The file of a pattern that was changed last (by name where times tie); None for no file. File times only are read."""
    try:
        files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    row = files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).first()
    return None if row is None or row["m"] is None else row["m"]["path"]


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: ``path``, ``text``; bytes that are no UTF-8 are left out."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", F.regexp_replace(F.col("content").cast("string"), "\\uFFFD", "").alias("text"))


def file_manifest(spark: SparkSession, path: str, skip: str = ".manifest.json") -> DataFrame:
    """``folder``, ``file_name``, ``size``, ``md5`` of all files below a path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = raw.select(
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
        F.col("length").alias("size"), F.md5("content").alias("md5"),
    )
    return named.where(F.col("file_name") != skip)


class _Tables(HTMLParser):
    """Rows of cells of all tables of a page, and label/value pairs of its definition lists."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.links: list[list[str]] = []
        self.pairs: list[tuple[str, list[str]]] = []
        self._cell: list[str] | None = None
        self._term: str | None = None
        self._kind = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
            self.links.append([])
        elif tag in ("td", "th", "dt", "dd"):
            self._close()
            self._cell, self._kind = [""], tag
        elif tag == "br" and self._cell is not None:
            self._cell.append("")
        elif tag == "a" and self._kind in ("td", "th") and self.links:
            self.links[-1] += [v for k, v in attrs if k == "href" and v]

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "dt", "dd", "tr", "dl", "table"):
            self._close()

    def handle_data(self, data: str) -> None:
        if self._cell is not None:
            self._cell[-1] += data

    def _close(self) -> None:
        if self._cell is None:
            return
        lines = [" ".join(x.split()) for x in self._cell]
        if self._kind in ("td", "th") and self.rows:
            self.rows[-1].append(" ".join(x for x in lines if x))
        elif self._kind == "dt":
            self._term = " ".join(x for x in lines if x)
        elif self._kind == "dd" and self._term is not None:
            self.pairs.append((self._term, [x for x in lines if x]))
            self._term = None
        self._cell, self._kind = None, ""


def _parsed(html: str | None) -> _Tables:
    p = _Tables()
    p.feed(html or "")
    p.close()
    p._close()
    return p


def table_rows(pages: DataFrame, key: str, html: str, least_cells: int) -> DataFrame:
    """``key``, ``row_no`` (from 1), ``cells``, ``links`` of the tables' rows with at least ``least_cells`` cells."""
    kind = dict(pages.dtypes)[key]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for k, h in zip(pdf[key], pdf[html]):
                p = _parsed(h)
                kept = [(c, u) for c, u in zip(p.rows, p.links) if len(c) >= least_cells]
                out += [(k, i, c, u) for i, (c, u) in enumerate(kept, 1)]
            yield pd.DataFrame(out, columns=["k", "row_no", "cells", "links"])

    return pages.select(key, html).mapInPandas(run, f"k {kind}, row_no int, cells array<string>, links array<string>").withColumnRenamed("k", key)


def grid_fields(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key``, ``label``, ``values`` of a page's definition lists; breaks within a value make several."""
    kind = dict(pages.dtypes)[key]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = [(k, label, values) for k, h in zip(pdf[key], pdf[html]) for label, values in _parsed(h).pairs]
            yield pd.DataFrame(out, columns=["k", "label", "values"])

    return pages.select(key, html).mapInPandas(run, f"k {kind}, label string, values array<string>").withColumnRenamed("k", key)


def tender_listing(pages: DataFrame, key: str, html: str, least_cells: int = 10) -> DataFrame:
    """The rows of a tender listing's tables, typed: a row needs ten cells; blank cells are null, and the id comes from the row's link."""
    c = F.col("cells")
    names = ["row_number", "title", "procuring_entity", "description", "bids_submission_deadline", "procurement_type", "procedure", "status", "notice_pdf_url", "publication_date"]
    link = F.get("links", F.lit(0))
    fields = [blank_to_null(F.get(c, F.lit(i))).alias(n) for i, n in enumerate(names)]
    return table_rows(pages, key, html, least_cells).select(key, *fields, link.alias("title_url"), url_parameter(link).alias("resource_id"))


def award_listing(pages: DataFrame, key: str, html: str, least_cells: int = 6) -> DataFrame:
    """The rows of an award listing's tables, typed: number, method, entity, title, amount (raw and as a number), date raw and as ISO."""
    c = F.col("cells")
    names = ["row_number", "procurement_method", "procuring_entity", "title", "contract_amount_raw", "award_date_raw"]
    rows = table_rows(pages, key, html, least_cells).select(key, "links", *[blank_to_null(F.get(c, F.lit(i))).alias(n) for i, n in enumerate(names)])
    return rows.select(
        key, *names, plain_money(F.col("contract_amount_raw")).cast("double").alias("contract_amount"), award_instant(F.col("award_date_raw"))["value"].alias("award_date"),
        F.get("links", F.lit(0)).alias("contract_url"), url_parameter(F.get("links", F.lit(0))).alias("resource_id"), F.get("links", F.lit(1)).alias("pdf_url"),
        url_parameter(F.get("links", F.lit(1))).alias("pdf_resource_id"),
    )


def field_map(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key``, ``fields``: a page's definition list as a map from snake-case keys to values; of equal keys the first counts."""
    g = grid_fields(pages, key, html).where("label <> ''").groupBy(key, snake_key(F.col("label")).alias("k")).agg(F.min("values").alias("v"))
    return g.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("fields"))  # one page's labels


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_DRAWN = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_LINKED = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        if ch.isalpha():
            n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _sheets(z: zipfile.ZipFile) -> Iterator[tuple[str, list[list[str]]]]:
    names = set(z.namelist())
    shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
    links = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_SHEET}sheet"):
        target = links.get(sheet.get(_LINKED), "").lstrip("/")
        rows = []
        for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_SHEET}row"):
            cells: list[str] = []
            for c in row.iter(f"{_SHEET}c"):
                at = _column(c.get("r", "")) if c.get("r") else len(cells)
                cells += [""] * (at - len(cells))
                v = c.find(f"{_SHEET}v")
                if c.get("t") == "inlineStr":
                    text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t"))
                elif v is None or v.text is None:
                    text = ""
                else:
                    text = shared[int(v.text)] if c.get("t") == "s" else v.text
                cells.append(text)
            rows.append(cells)
        yield sheet.get("name", ""), rows


def spreadsheets(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path``, ``sheet``, ``row_no``, ``cells`` (header to text, blank cells ''), ``error``: the rows below each sheet's header.

    The files are archives of XML, read without a library for the format. A header that is missing or repeated takes its
    column's number. A file that cannot be opened gives one row with its error.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for p, data in zip(pdf[path], pdf[content]):
                out = []
                try:
                    with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
                        for sheet, rows in _sheets(z):
                            width = max((len(r) for r in rows), default=0)
                            head: list[str] = []
                            for i, h in enumerate((rows[0] if rows else []) + [""] * width):
                                head.append(h if h and h not in head else f"column {i + 1}")
                            for n, r in enumerate(rows[1:], 1):
                                out.append((p, sheet, n, dict(zip(head, r + [""] * (width - len(r)))), None))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError, IndexError, RuntimeError) as e:
                    out = [(p, None, None, None, type(e).__name__)]
                yield pd.DataFrame(out, columns=["path", "sheet", "row_no", "cells", "error"]).astype({"row_no": "Int32"})

    shape = "path string, sheet string, row_no int, cells map<string,string>, error string"
    return files.select(path, content).mapInPandas(run, shape)


def presentations(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path``, ``slide_number``, ``texts`` (a paragraph each, without blank ones), ``tables`` (rows of cells), ``error``.

    Slides come in the order of their numbers. A file that cannot be opened gives one row with its error.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        said = lambda p: "".join(t.text or "" for t in p.iter(f"{_DRAWN}t")).strip()
        for pdf in it:
            for p, data in zip(pdf[path], pdf[content]):
                out = []
                try:
                    with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
                        numbered = sorted((int(m.group(1)), n) for n in z.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
                        for i, (_, name) in enumerate(numbered, 1):
                            root = ElementTree.fromstring(z.read(name))
                            tables = [[[said(c) for c in r.iter(f"{_DRAWN}tc")] for r in t.iter(f"{_DRAWN}tr")] for t in root.iter(f"{_DRAWN}tbl")]
                            inside = {id(x) for t in root.iter(f"{_DRAWN}tbl") for x in t.iter(f"{_DRAWN}p")}
                            texts = [said(x) for x in root.iter(f"{_DRAWN}p") if id(x) not in inside and said(x)]
                            out.append((p, i, texts, tables, None))
                except (zipfile.BadZipFile, ElementTree.ParseError, RuntimeError) as e:
                    out = [(p, None, None, None, type(e).__name__)]
                yield pd.DataFrame(out, columns=["path", "slide_number", "texts", "tables", "error"]).astype({"slide_number": "Int32"})

    return files.select(path, content).mapInPandas(run, "path string, slide_number int, texts array<string>, tables array<array<array<string>>>, error string")


def read_sidecars(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """JSON sidecars, one object a file, with their ``path``; files that are no object are skipped."""
    raw = spark.read.text(pattern, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), "value")
    return raw.where(F.trim("value").startswith("{") & F.get_json_object("value", "$").isNotNull()).select("path", "r.*")


def anchored_rows(points: list[tuple[float, float, str]], tolerance: float = 5.0) -> list[list[str]]:
    """Texts placed on a page (x, y, text) in rows, top first: a row holds what lies within ``tolerance`` of the row's first point."""
    rows: list[tuple[float, list[tuple[float, str]]]] = []
    for x, y, text in sorted(points, key=lambda p: (-p[1], p[0])):
        if rows and abs(rows[-1][0] - y) <= tolerance:
            rows[-1][1].append((x, text))
        else:
            rows.append((y, [(x, text)]))
    return [[t for _, t in sorted(r)] for _, r in rows]


def checked_labels(operators: list[tuple[str, list]], tolerance: float = 5.0) -> list[str]:
    """The labels beside the filled boxes of a page, top first.

    ``operators`` are the page's drawing operators in order: ``q`` and ``Q`` save and restore the place, ``cm`` moves it
    (a, b, c, d, e, f), ``box`` draws a box ([filled]) and ``text`` writes ([label]) there. A row is what lies within
    ``tolerance`` of its first mark; a filled box stands for the next label to its right in its row.
    """
    stack: list[tuple[float, float]] = []
    at = (0.0, 0.0)
    marks: list[tuple[float, float, str]] = []
    for name, given in operators:
        if name == "q":
            stack.append(at)
        elif name == "Q":
            at = stack.pop() if stack else (0.0, 0.0)
        elif name == "cm":
            at = (at[0] + float(given[4]), at[1] + float(given[5]))
        elif name == "box":
            marks.append((*at, "\u2611" if given and given[0] else "\u2610"))
        elif name == "text":
            marks.append((*at, str(given[0])))
    out = []
    for row in anchored_rows(marks, tolerance):
        for mark, label in zip(row, row[1:]):
            if mark == "\u2611" and label not in ("\u2610", "\u2611"):
                out.append(label)
    return out


ARCHIVE_DEPTH = 5


def unzip(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path``, ``member``, ``content``, ``error`` of all files in archives, those in inner archives too, flat.

    Of members with the same base name the first of the outermost level counts. A broken archive, and one nested deeper than ``ARCHIVE_DEPTH``, gives
    one row with its error.
    """

    def members(data: bytes) -> Iterator[tuple[str | None, bytes | None, str | None]]:
        """Level by level: all plain members of a level come before those of the archives in it."""
        seen: set[str] = set()
        level: list[tuple[str | None, bytes]] = [(None, data)]
        for depth in range(ARCHIVE_DEPTH + 2):
            inner: list[tuple[str | None, bytes]] = []
            for outer, content in level:
                if depth > ARCHIVE_DEPTH:
                    yield outer, None, "nested too deep"
                    continue
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():
                            name = info.filename.replace("\\", "/").rsplit("/", 1)[-1]
                            if info.is_dir() or not name:
                                continue
                            if name.lower().endswith(".zip"):
                                inner.append((name, z.read(info)))
                            elif name not in seen:
                                seen.add(name)
                                yield name, z.read(info), None
                except (zipfile.BadZipFile, RuntimeError, NotImplementedError, EOFError, OSError) as e:
                    yield outer, None, type(e).__name__
            level = inner

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for p, data in zip(pdf[path], pdf[content]):
                for name, inner, error in members(data or b""):
                    yield pd.DataFrame([(p, name, inner, error)], columns=["path", "member", "content", "error"])

    shape = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "member")] + [T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])
    return files.select(path, content).mapInPandas(run, shape)


def messages(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``message_id``, ``subject``, ``sender``, ``received_at`` (UTC), ``body_plain``, ``body_html``, ``attachments`` of RFC 822 files."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for p, data in zip(pdf[path], pdf[content]):
                m = email.message_from_bytes(data or b"", policy=email.policy.default)
                plain, html, names = [], [], []
                for part in m.walk():
                    if part.get_filename():
                        names.append(part.get_filename())
                    elif part.get_content_type() in ("text/plain", "text/html"):
                        text = (part.get_payload(decode=True) or b"").decode(part.get_content_charset() or "utf-8", "replace")
                        (plain if part.get_content_type() == "text/plain" else html).append(text)
                try:
                    at = pd.Timestamp(email.utils.parsedate_to_datetime(str(m["Date"]))).tz_convert("UTC") if m["Date"] else None
                except (ValueError, TypeError):
                    at = None
                out.append((p, m["Message-ID"], m["Subject"], m["From"], at, "\n".join(plain), "\n".join(html), names))
            yield pd.DataFrame(out, columns=["path", "message_id", "subject", "sender", "received_at", "body_plain", "body_html", "attachments"])

    return files.select(path, content).mapInPandas(
        run, "path string, message_id string, subject string, sender string, received_at timestamp, body_plain string, body_html string, attachments array<string>"
    )
