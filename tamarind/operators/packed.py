"""Several values packed in one field: one row a value, with its position.

A value starts with its code. Each field is cut in front of its codes, and every piece is turned into a delimiter skeleton:
words are masked as ``a``, digits as ``9`` each, so that only delimiters, quotes, escapes and list marks stay as they are,
together with the quote in front of the code. Skeletons come from the notation and not from the contents, so there are
few; each distinct one is resolved once into a rule (how much of the piece's end is delimiter, how the value is escaped),
the rules are joined back and applied by position. The rules are broadcast if their counted number allows it, else joined by
shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.session import broadcast_if_small, cut

CPV_CODE = r"\d{8}-\d"
CATEGORY_CODE = r"[A-Z]{1,3}\d{2}"
SMALL_RULES = 50_000
_MARK = "\u0001"
#: A list mark in front of the next value: a bullet or a number.
_LIST = re.compile(r"(?:(?<=[\s ,;|/&\"'])|^)(?:[-*•·–—]|\(?\d{1,4}[.)])$")


def skeleton(piece: Column) -> Column:
    """Words become ``a``, a run of words one ``a``, each digit ``9``; all else stays.

    ``and`` in front of the next code becomes a mark of its own, since it is a delimiter.
    """
    kept = F.regexp_replace(piece, r"\s(and)\s*$", " \u0002 ")
    words = F.regexp_replace(kept, r"\p{L}+", "a")
    runs = F.regexp_replace(words, r"a(?:[ \-]{1,3}a)+", "a")
    return F.regexp_replace(runs, r"\d", "9")


def resolve(shape: str, last: bool) -> tuple[int, str]:
    """How many characters at the end of a piece are not the value's, and how the value is escaped.

    ``shape`` is the quote in front of the code (one character, blank for none) and the skeleton. The last piece of a field
    has nothing behind it but closers.
    """
    quote, text = shape[0], shape[1:]
    whole = len(text)
    text = text.replace("\u0002", "\u0003")
    end = text
    while True:
        cut_to = end.rstrip(" \t\r\n ,;|/&")
        if cut_to.endswith("\u0003"):
            cut_to = cut_to[:-1]
            end = cut_to
            continue
        if not last and (m := _LIST.search(cut_to)) and m.start() > 0 and cut_to[: m.start()].count("(") == cut_to[: m.start()].count(")"):
            cut_to = cut_to[: m.start()]
        elif cut_to.endswith(("]", "}")) and last:
            cut_to = cut_to[:-1]
        elif quote == " " and not last and re.search(r"[\s,;|/&][\"']$", cut_to):
            cut_to = cut_to[:-1]
        elif quote == " " and not last and re.search(r"[,;|/&]$", cut_to[:-1]) and cut_to[-1:] in ("\"", "'"):
            cut_to = cut_to[:-1]
        elif quote != " " and not last and re.search(r"[\"'][\s,;|/&]+[\"']$", cut_to):
            cut_to = cut_to[:-1]
        elif quote != " " and not last and re.search(r"[\"'][,;|/&]?[\"']$", cut_to) and re.search(r"[,;|/&\s]", cut_to[-2:]):
            cut_to = cut_to[:-1]
        if cut_to == end:
            break
        end = cut_to
    mode = "none"
    if quote in "\"'" and end.endswith(quote):
        end = end[:-1]
        body = end
        mode = "backslash" if "\\" in body else "doubled" if quote * 2 in body else "none"
    # the word mark stands for three letters
    gone = text[len(end) :]
    return len(gone) + 2 * gone.count("\u0003"), mode


def _rules(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        out = [(s, bool(z), *resolve(s, bool(z))) for s, z in zip(pdf["shape"], pdf["is_last"])]
        yield pd.DataFrame(out, columns=["shape", "is_last", "strip_n", "escape"])


def unpack(df: DataFrame, field: str, keep: list[str], code: str) -> DataFrame:
    """``keep``, ``pos_no`` (from 1), ``item_value`` and ``n_items``: a row for each value of ``field`` that starts with ``code``.

    Null and blank fields, empty lists and text without a code give no row. Empty values take no position, repeated values
    stay, and repeated rows each give their own. Values lack enclosing quotes, escapes, list marks and outer white space;
    delimiters in a title stay in it.
    """
    start = rf"(?<![A-Za-z0-9])(?=(?:{code})(?![A-Za-z0-9]))"
    pieces = F.split(F.regexp_replace(F.col(field), start, _MARK), _MARK)
    payload = F.struct(*[F.col(c) for c in keep])
    each = (
        df.where(F.col(field).rlike(code))
        .select(payload.alias("__keep"), pieces.alias("p"))
        .select("__keep", (F.size("p") - 1).alias("n_items"), F.posexplode(F.expr("transform(slice(p, 2, size(p) - 1), (x, i) -> struct(x as piece, right(p[i], 1) as q))")).alias("i", "s"))
        .select(
            "__keep", "n_items", (F.col("i") + 1).alias("pos_no"), F.col("s.piece").alias("piece"),
            (F.col("i") + 1 == F.col("n_items")).alias("is_last"),
            F.concat(F.when(F.col("s.q").isin('"', "'"), F.col("s.q")).otherwise(F.lit(" ")), skeleton(F.col("s.piece"))).alias("shape"),
        )
    )
    rules = cut(each.select("shape", "is_last").distinct().mapInPandas(_rules, "shape string, is_last boolean, strip_n int, escape string"))
    joined = each.join(broadcast_if_small(rules, SMALL_RULES), ["shape", "is_last"])
    body = F.expr("left(piece, length(piece) - strip_n)")
    plain = (
        F.when(F.col("escape") == "backslash", F.regexp_replace(body, r"\\(.)", "$1"))
        .when(F.col("escape") == "doubled", F.regexp_replace(body, "([\"'])\\1", "$1"))
        .otherwise(body)
    )
    return joined.select(
        *[F.col("__keep")[c].alias(c) for c in keep], "pos_no", F.regexp_replace(plain, r"^[\s ]+|[\s ]+$", "").alias("item_value"), "n_items"
    )
