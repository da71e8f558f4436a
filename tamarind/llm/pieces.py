"""Oversized texts cut at natural boundaries, by packing a structure tree.

A text is parsed into a tree of spans: headings by level, then blocks between blank lines, then lines (list items and table
rows among them), sentences, words and characters. A subtree that fits is never opened; an oversized one is opened one
level down, and its children are merged as long as they fit, siblings with siblings only: the end of one section never runs into
the next one's beginning. Pieces are spans of the text and cover it without a gap; each but the first repeats the last ``overlap`` characters of the text before it, which count
towards the limit.

Texts are handled one at a time in one pass without a shuffle, so memory follows the longest text and not the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import and_, or_

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.session import broadcast_if_small, cut_table, spread

#: The project's limit of a chunk, and the characters that each piece repeats.
LIMIT = 26_000
OVERLAP = 200
#: Keys of repeated and of outdated rows that are sent to all tasks, at most; more are joined by shuffle.
MOST_SENT = 200_000

_HEADING = re.compile(r"(?m)^(#{1,6})[ \t]+\S.*$|^(\d{1,3}(?:\.\d{1,3})*)\.?[ \t]+[A-Z][^\n.]{0,80}$")
# Where a span of each finer level ends.
_LEVELS = [
    re.compile(r"\n[ \t\r]*\n\s*"),
    re.compile(r"\n+"),
    re.compile(r"(?<=[.!?;:])\s+|(?<=[。！？；])"),
    re.compile(r"\s+"),
]


def _cut(text: str, a: int, b: int, at: re.Pattern) -> list[tuple[int, int]]:
    """The span a..b cut behind every match."""
    ends = [m.end() for m in at.finditer(text, a, b) if a < m.end() < b]
    marks = [a, *ends, b]
    return list(zip(marks, marks[1:]))


def _sections(text: str, a: int, b: int, heads: list[tuple[int, int]]) -> list[tuple[int, int, list]]:
    """The children of a span by its highest headings: (start, end, headings inside)."""
    if not heads:
        return []
    top = min(level for _, level in heads)
    starts = [p for p, level in heads if level == top]
    marks = ([a] if starts[0] > a else []) + starts + [b]
    return [(x, y, [(p, lv) for p, lv in heads if x < p < y]) for x, y in zip(marks, marks[1:])]


def _pack(spans: list[tuple[int, int, bool]], room: int) -> list[tuple[int, int]]:
    """Whole neighbours merged from left to right as long as they fit; what came out of an opened one stays by itself."""
    out: list[tuple[int, int, bool]] = []
    for a, b, whole in spans:
        if whole and out and out[-1][2] and b - out[-1][0] <= room:
            out[-1] = (out[-1][0], b, True)
        else:
            out.append((a, b, whole))
    return [(a, b) for a, b, _ in out]


def _open(text: str, a: int, b: int, heads: list, level: int, room: int) -> list[tuple[int, int]]:
    """The pieces of an oversized span: its children, siblings merged, each oversized one opened in turn."""
    if b - a <= room:
        return [(a, b)]
    children = _sections(text, a, b, heads)
    if len(children) > 1 or (children and children[0][2]):
        below = [(x, y, h, level) for x, y, h in children]
    elif level >= len(_LEVELS):
        return [(x, min(x + room, b)) for x in range(a, b, room)]
    else:
        below = [(x, y, [], level + 1) for x, y in _cut(text, a, b, _LEVELS[level])]
    spans: list[tuple[int, int, bool]] = []
    for x, y, h, lv in below:
        whole = y - x <= room
        spans += [(x, y, True)] if whole else [(p, q, False) for p, q in _open(text, x, y, h, lv, room)]
    return _pack(spans, room)


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Spans (from, to) of the pieces, overlap included; a text within the limit is one span, an empty one none."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text))]
    heads = [(m.start(), len(m.group(1)) if m.group(1) else 7 + m.group(2).count(".")) for m in _HEADING.finditer(text)]
    spans = _open(text, 0, len(text), heads, 0, limit - overlap)
    return [(max(0, a - overlap) if a else 0, b) for a, b in spans]


def document_text(content) -> str:  # noqa: ANN001
    """The text of the filled arm of an extracted document: parts trimmed, empty ones left out, one blank line between them."""
    if content is None:
        return ""
    for arm in ("markdown", "raw_text"):
        if content[arm] is not None and content[arm].strip():
            return content[arm].strip()
    parts: list[str] = []
    for chunk in _list(content["chunks"]):
        parts.append(chunk["text"] or "")
    for slide in _list(content["slides"]):
        parts += [t or "" for t in _list(slide["texts"])]
    for page in _list(content["pages"]):
        parts.append(page["text"] or "")
        for rows in _list(page["tables"]):
            lines = [" | ".join(c.strip() for c in _list(row) if c and c.strip()) for row in _list(rows)]
            parts.append("\n".join(x for x in lines if x))
    return "\n\n".join(x for x in (p.strip() for p in parts) if x)


def _list(value) -> list:  # noqa: ANN001
    return [] if value is None else [x for x in value if x is not None]


def split_documents(
    df: DataFrame, keys: list[str], content: str, limit: int = LIMIT, overlap: int = OVERLAP, version: str | None = None
) -> DataFrame:
    """``keys``, ``piece_no`` (from 1), ``n_pieces``, ``start_at`` and ``piece`` for the text of each row's ``content``.

    ``content`` is a string or the struct of arms of an extracted document. Null, blank and empty content gives no row. Rows
    that repeat a key give pieces each, unless ``version`` names a column: then the latest row with content counts (a digest
    of the content breaks ties, so nothing depends on the order of rows; rows alike in both still give pieces each).
    """
    shape = dict(df.dtypes)
    names = [f"__key{i}" for i in range(len(keys))]
    plain = shape[content] == "string"
    rows = df.where(F.col(content).isNotNull())
    if not plain:
        rows = rows.where(reduce(or_, [F.col(content)[a].isNotNull() for a in df.schema[content].dataType.fieldNames()]))
    if version:
        # keys alone tell which are repeated; only the rows of these are weighed by digest, and only what is outdated is taken out,
        # so no text is moved unless the outdated rows are too many to be sent to all
        own = [F.col(k).alias(n) for k, n in zip(keys, names)]
        repeated = cut_table(rows.groupBy(*own).agg(F.count("*").alias("__n")).where("__n > 1").select(*names))
        same = lambda: reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
        versions = rows.join(broadcast_if_small(repeated, MOST_SENT), same()).select(*names, F.col(version).alias("__v"), F.xxhash64(content).alias("__h"))
        best = F.max(F.struct("__v", "__h")).over(Window.partitionBy(*names))
        outdated = cut_table(versions.withColumn("__best", best).where(~F.struct("__v", "__h").eqNullSafe(F.col("__best"))).select(*names, "__v", "__h").distinct())
        match = same() & F.col(version).eqNullSafe(F.col("__v")) & (F.xxhash64(content) == F.col("__h"))
        rows = rows.join(broadcast_if_small(outdated, MOST_SENT), match, "left_anti")
    rows = spread(rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(content).alias("__text")))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for row in pdf.itertuples(index=False, name=None):
                text = (row[-1] or "").strip() if plain else document_text(row[-1])
                spans = split_text(text, limit, overlap)
                # a text's pieces go out on their own, so that no batch holds more than one text's
                if spans:
                    n = len(spans)
                    base = {x: [row[i]] * n for i, x in enumerate(names)}
                    yield pd.DataFrame(
                        {**base, "piece_no": range(1, n + 1), "n_pieces": n, "start_at": [a for a, _ in spans], "piece": [text[a:b] for a, b in spans]}
                    )

    out_shape = ", ".join(f"{n} {shape[k]}" for n, k in zip(names, keys)) + ", piece_no int, n_pieces int, start_at bigint, piece string"
    pieces = rows.mapInPandas(run, out_shape)
    return pieces.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "piece_no", "n_pieces", "start_at", "piece")
