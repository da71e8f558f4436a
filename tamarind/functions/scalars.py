"""Scalar functions of the pipeline as column expressions; all stay in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = "[\\s\\u00a0]+"


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, "\\u00a0", " ")), F.lit(""))


def url_parameter(url: Column, name: str = "resourceId") -> Column:
    """A parameter of a URL's query, percent signs decoded, trimmed; null where it is missing or blank, as it is if it can't be decoded."""
    raw = F.regexp_extract(url, f"[?&]{name}=([^&#]*)", 1)
    return F.nullif(F.trim(F.coalesce(F.try_url_decode(raw), raw)), F.lit(""))


def absolute_url(url: Column, host: str) -> Column:
    """A URL with its host: absolute ones as they are, rooted and bare paths behind ``host``; null for blank."""
    u = blank_to_null(url)
    return F.when(u.rlike("^https?://"), u).when(u.startswith("/"), F.concat(F.lit(host), u)).otherwise(F.concat(F.lit(host + "/"), u))


def local_to_utc(text: Column, zone: str = "America/Jamaica") -> Column:
    """Day-first local date and time, seconds optional, as a UTC instant; null for anything else."""
    s = F.trim(F.regexp_replace(text, _SPACE, " "))
    shaped = F.when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?$"), s)
    parsed = F.coalesce(F.try_to_timestamp(shaped, F.lit("d/M/yyyy H:m:s")), F.try_to_timestamp(shaped, F.lit("d/M/yyyy H:m")))
    return F.to_utc_timestamp(parsed, zone)


def pair_of_ints(text: Column) -> Column:
    """``struct<first, second>`` of 'a/b', nulls unless the whole text has that form."""
    pattern = r"^\s*(\d+)\s*/\s*(\d+)\s*$"
    return F.struct(*[F.regexp_extract(text, pattern, i).try_cast("int").alias(n) for i, n in ((1, "first"), (2, "second"))])


def safe_file_name(name: Column) -> Column:
    """A file name in plain letters, digits and ``-_.() ``; all else becomes an underscore."""
    return F.regexp_replace(name, r"[^A-Za-z0-9\-_.() ]", "_")


def safe_folder(name: Column) -> Column:
    """A folder name: every run of signs that are no letters, digits, hyphens, dots or underscores becomes one underscore."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_\-.]+", "_")


def swap_first(text: Column, old: str, new: str) -> Column:
    """``text`` with the first ``old`` (one sign) replaced."""
    at = F.locate(old, text)
    return F.when(at > 0, F.overlay(text, F.lit(new), at)).otherwise(text)


def snake_key(label: Column) -> Column:
    """A label as a key: lower case, runs of other signs one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def plain_money(text: Column) -> Column:
    """The digits, full stops and minus signs of a text as a decimal; null where that is no number."""
    return F.regexp_replace(text, r"[^0-9.\-]", "").try_cast("decimal(18,2)")


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down, by elapsed time and not by calendar days."""
    return F.floor((F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(86_400_000_000))


def to_boolean(text: Column) -> Column:
    """Whether a text says yes; null stays null."""
    return F.lower(F.trim(text)).isin("true", "yes", "1", "on")


def to_list(text: Column, delimiter: str = ",") -> Column:
    """The trimmed, non-blank parts of a text; an empty array for null and blank."""
    parts = F.filter(F.transform(F.split(text, delimiter), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def whole_number(text: Column) -> Column:
    """An integer of digits only, else null."""
    return F.when(F.trim(text).rlike(r"^\d+$"), F.trim(text).try_cast("int"))


def first_rule(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first pattern (case ignored) that a text holds."""
    out = F.lit(otherwise)
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(f"(?i){pattern}"), F.lit(label)).otherwise(out)
    return out


def estimated_tokens(text: Column, chars: int = 2) -> Column:
    """Characters over ``chars``, rounded down; 0 for null."""
    return F.coalesce(F.floor(F.length(text) / chars), F.lit(0))


def file_extension(name: Column) -> Column:
    """The lower-case extension with its full stop; '' for none."""
    return F.lower(F.regexp_extract(name, r"(\.[^./\\]+)$", 1))


def base_name(path: Column) -> Column:
    """The last part of a path with either kind of slash."""
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def from_base64url(text: Column) -> Column:
    """Text out of URL-safe base64 with or without padding."""
    plain = F.translate(text, "-_", "+/")
    padded = F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))
    return F.unbase64(padded).cast("string")


def first_keyword(text: Column, longer_than: int = 4, prefix: int = 20) -> Column:
    """The first word longer than ``longer_than``, else the text's first ``prefix`` characters."""
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: F.length(w) > longer_than)
    return F.coalesce(F.get(words, F.lit(0)), F.substring(text, 1, prefix))


def unfenced_json(text: Column, schema: str) -> Column:
    """JSON with or without a code fence around it, parsed; null where it is none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-z]*\s*", ""), r"\s*```$", "")
    return F.from_json(bare, schema)


def distinct_parts(parts: Column) -> Column:
    """Trimmed, non-blank, distinct elements in their order."""
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def distinct_ignoring_case(parts: Column) -> Column:
    """Distinct elements ignoring case, the first spelling kept, in their order; nulls go. Sorted once by key, never compared in pairs."""
    keyed = F.transform(parts, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x")))
    ordered = F.array_sort(F.filter(keyed, lambda s: s["x"].isNotNull()))
    first = F.filter(F.transform(ordered, lambda s, i: F.struct(s["i"].alias("i"), s["x"].alias("x"), (F.coalesce(F.get(ordered, i - 1)["k"], F.lit(None)).eqNullSafe(s["k"]) & (i > 0)).alias("again"))), lambda s: ~s["again"])
    return F.transform(F.array_sort(F.transform(first, lambda s: F.struct(s["i"].alias("i"), s["x"].alias("x")))), lambda s: s["x"])


# How answers that say nothing begin.
NOISE = [
    "not stated", "not specified", "not explicitly stated", "not explicitly stated in the provided", "no specific", "n/a", "none",
    "not provided", "not mentioned", "not applicable", "not detailed", "not listed",
]


def told_items(parts: Column, most: int = 40) -> Column:
    """Trimmed items that say something, distinct ignoring case, the first ``most``; null and empty items go."""
    kept = F.filter(parts, lambda x: x.isNotNull() & (x != ""))
    noise = "^(" + "|".join(NOISE) + ")"
    return F.slice(distinct_ignoring_case(F.filter(F.transform(kept, lambda x: F.trim(x)), lambda x: ~F.lower(x).rlike(noise))), 1, most)


def milestones(rows: Column) -> Column:
    """Distinct (event, date) structs in their order, events trimmed; those without an event go."""
    trimmed = F.transform(F.coalesce(rows, F.array().cast("array<struct<event:string,date:string>>")), lambda r: F.struct(F.trim(r["event"]).alias("event"), r["date"].alias("date")))
    return F.array_distinct(F.filter(trimmed, lambda r: F.coalesce(r["event"], F.lit("")) != ""))


_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"


def iso_instant(text: Column) -> Column:
    """An ISO date or date and time as an instant, without an offset in UTC; null for all other text."""
    zoned = F.when(text.rlike("(Z|[+-]\\d{2}:\\d{2})$") & (F.length(text) > 10), text).otherwise(F.concat(text, F.when(F.length(text) == 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z"))))
    return F.when(text.rlike(_ISO), zoned.try_cast("timestamp"))


def listing_instant(text: Column) -> Column:
    """ISO with an offset, else day-first local time with or without its 'UTC-5', as an instant; null for all other text."""
    raw = F.trim(text)
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})$"), raw.try_cast("timestamp"))
    return F.coalesce(iso, local_to_utc(F.regexp_replace(F.regexp_replace(text, _SPACE, " "), r"\s*UTC-5\s*$", "")))


def award_instant(text: Column) -> Column:
    """``struct<value, raw>``: a day-first date and time within a text as ISO in UTC, else the text itself; white space is one blank."""
    raw = F.nullif(F.trim(F.regexp_replace(text, _SPACE, " ")), F.lit(""))
    at = F.try_to_timestamp(F.regexp_extract(raw, r"(\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2})", 1), F.lit("dd/MM/yyyy HH:mm:ss"))
    return F.struct(F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), raw).alias("value"), raw.alias("raw"))


def to_array(text: Column) -> Column:
    """A list of what a field holds: the trimmed text alone, nothing for null and blank."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(F.trim(text)))


def action_url(body: Column, fragments: list[tuple[str, str]]) -> Column:
    """``struct<url, kind>``: the first URL of a text without a full stop at its end, and the kind of the first fragment in it."""
    url = F.nullif(F.regexp_replace(F.regexp_extract(body, r"(https?://[^\s<>\"')]+)", 1), r"\.+$", ""), F.lit(""))
    kind = F.lit(None).cast("string")
    for part, label in reversed(fragments):
        kind = F.when(url.contains(part), F.lit(label)).otherwise(kind)
    return F.struct(url.alias("url"), kind.alias("kind"))


def titled(field: str) -> str:
    return field.replace("_", " ").title()


def context_block(scalars: list[str], lists: list[str]) -> Column:
    """A record as text: filled scalars as 'Name: value' lines, then each filled list under its name in capitals, numbered."""
    lines = [F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{titled(f)}: "), F.col(f).cast("string"))) for f in scalars]
    blocks = [
        F.when(F.size(f) > 0, F.concat(F.lit(f"\n{f.replace('_', ' ').upper()}:\n"), F.array_join(F.transform(F.col(f), lambda x, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), x)), "\n")))
        for f in lists
    ]
    return F.concat_ws("\n", *lines, F.lit(""), *blocks)


def keyword_rank(name: Column, keywords: list[str], last: list[str], otherwise: int = 100, end: int = 999) -> Column:
    """The place of the first keyword a name holds, case ignored; ``end`` for names that hold one of ``last`` only, else ``otherwise``."""
    low = F.lower(name)
    rank = F.when(reduce(or_, [low.contains(x) for x in last]), F.lit(end)).otherwise(F.lit(otherwise))
    for i, k in reversed(list(enumerate(keywords))):
        rank = F.when(low.contains(k), F.lit(i)).otherwise(rank)
    return rank


def document_text(content: Column) -> Column:
    """The text of an extracted document from all its arms; null where no arm is filled.

    Chunks, then pages, each with its tables (a line a row, cells between bars), trimmed and without empty ones; markdown if
    those gave nothing; the slides' texts and the raw text as they are. One blank line between parts.
    """
    ends = "[\\s\\x1c-\\x1f\\x85\\p{Z}]+"
    strip = lambda c: F.regexp_replace(c, f"^{ends}|{ends}$", "")
    kept = lambda parts: F.filter(F.transform(parts, strip), lambda x: x != "")
    none = F.array().cast("array<string>")
    each = lambda arm, f: F.coalesce(F.flatten(F.transform(F.filter(content[arm], lambda x: x.isNotNull()), f)), none)
    line = lambda row: F.coalesce(F.array_join(kept(row), " | "), F.lit(""))
    lines = lambda rows: F.array_join(F.filter(F.transform(rows, line), lambda x: x != ""), "\n")
    tables = lambda p: F.coalesce(F.transform(p["tables"], lines), none)
    first = F.concat(kept(each("chunks", lambda c: F.array(c["text"]))), kept(each("pages", lambda p: F.concat(F.array(p["text"]), tables(p)))))
    markdown = F.when(F.size(first) == 0, F.array(content["markdown"])).otherwise(none)
    parts = F.concat(first, markdown, each("slides", lambda s: F.coalesce(s["texts"], none)), F.array(content["raw_text"]))
    arms = [content[a].isNotNull() for a in ("markdown", "raw_text", "chunks", "pages", "slides")]
    return F.when(reduce(or_, arms), F.array_join(parts, "\n\n"))
