"""All valid readings of a raw timestamp, as an array of (form, micros), in plain column expressions.

Nothing here is a UDF: the reading stays within code generation and prunes and pushes down as any projection does.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offsets in minutes of the North American and British zone abbreviations.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "BST": 60,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "HDT": -540,
}
# The months' first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|"
    "oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_TIME = r"(?:(?:[t ]|, | at )\s*(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?(?:\s*([ap])\.?m\.?(?![a-z]))?)?"
_ZONE = r"\s*(?:\(?\s*([a-z]+/[a-z_]+(?:/[a-z_]+)?|\[[a-z_/]+\]|(?:utc|gmt)?\s*[+-]\d{1,2}(?::?\d{2})?|[a-z]{1,4})\s*\)?)?"
_DAYNAME = r"(?:(?:mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun)(?:day|nesday|rsday|urday|sday)?,?\s+)?"

_ISO = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}{_ZONE}$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(\d{2})?()()" + _ZONE + "$"
_SLASH = rf"^{_DAYNAME}(\d{{1,2}})[/.](\d{{1,2}})[/.](\d{{4}}|\d{{2}}){_TIME}{_ZONE}$"
_DAY_MONTH = rf"^{_DAYNAME}(\d{{1,2}})(?:st|nd|rd|th)?[- ,]*{_MONTH}\.?[- ,]*(\d{{4}}|\d{{2}}){_TIME}{_ZONE}$"
_MONTH_DAY = rf"^{_DAYNAME}{_MONTH}\.?[- ]*(\d{{1,2}})(?:st|nd|rd|th)?[, ]+(\d{{4}}){_TIME}{_ZONE}$"

_BLANKS = "[\\s\\u00a0\\u1680\\u2000-\\u200b\\u202f\\u205f\\u3000\\ufeff]+"
_OFFSET = r"([+-])(\d{1,2}):?(\d{2})?$"


def _clean(raw: Column) -> Column:
    return F.trim(F.regexp_replace(raw, _BLANKS, " "))


def _int(c: Column) -> Column:
    """The number that a group of digits is; null for any other text, which a cast alone would meet with a costly exception."""
    return F.when(c.rlike(r"^\d+$"), c.try_cast("int"))


def _zone_known(zone: Column) -> Column:
    return F.create_map(*[x for k, v in ZONE_MINUTES.items() for x in (F.lit(k.lower()), F.lit(v))])[zone]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _wall(g: Column) -> Column:
    """The local wall clock of a cut-up reading, in micros; null for an impossible date or time."""
    hour, half = F.coalesce(_int(g[4]), F.lit(0)), g[8]
    h = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    month = F.coalesce(_int(g[2]), F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(g[2], 1, 3)).cast("int"))
    year = F.when(F.length(g[1]) == 2, _int(g[1]) + F.when(_int(g[1]) < 70, 2000).otherwise(1900)).otherwise(_int(g[1]))
    second = F.coalesce(_int(g[6]), F.lit(0)).cast("decimal(8,6)")
    at = F.try_make_timestamp(year, month, _int(g[3]), h, F.coalesce(_int(g[5]), F.lit(0)), second, F.lit("UTC"))
    return F.unix_micros(at) + F.coalesce(F.rpad(F.substring(g[7], 1, 6), 6, "0").try_cast("long"), F.lit(0))


def _zoned(wall: Column, zone: Column, local: str) -> Column:
    """Micros of a wall clock in a zone; null for an unknown zone and a local time that daylight saving skips.

    ``zone`` is the zone's text in lower case, '' where there is none. A local time that occurs twice is the first.
    """

    def in_region(name: Column) -> Column:
        at = F.to_utc_timestamp(F.timestamp_micros(wall), name)
        return F.when(F.from_utc_timestamp(at, name) == F.timestamp_micros(wall), F.unix_micros(at))

    sign = F.regexp_extract(zone, _OFFSET, 1)
    minutes = _int(F.regexp_extract(zone, _OFFSET, 2)) * 60 + F.coalesce(_int(F.regexp_extract(zone, _OFFSET, 3)), F.lit(0))
    offset = F.when(sign != "", F.when(sign == "-", -minutes).otherwise(minutes)).otherwise(_zone_known(zone))
    region = F.create_map(*[x for name in REGIONS for x in (F.lit(name.lower()), F.lit(name))])
    return (
        F.when(zone == "", in_region(F.lit(local)))
        .when(zone.contains("/"), F.when(F.map_contains_key(region, zone), in_region(region[zone])))
        .otherwise(wall - offset.cast("long") * 60_000_000)
    )


# The regions of North America, Britain and the Caribbean that are read by name.
REGIONS = [
    "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Toronto",
    "America/Halifax", "America/St_Johns", "America/Vancouver", "America/Jamaica", "America/Port_of_Spain",
    "America/Barbados", "Europe/London", "Europe/Dublin", "Europe/Paris", "Europe/Madrid", "Etc/UTC", "Asia/Kolkata",
]


def readings(raw: Column, local: str = "America/Jamaica", slashed: str = "day_first", first_year: int = 2021, last_year: int = 2027) -> Column:
    """``array<struct<form string, micros bigint>>`` of all valid readings of ``raw``; empty for null, blank and other text.

    No zone means ``local``; a date alone is local midnight. ``slashed`` is ``day_first``, ``month_first`` or ``both``.
    A bare number is read as seconds, milliseconds, microseconds, a spreadsheet's day number (local) and a compact date,
    as far as that falls between ``first_year`` and ``last_year``.
    """
    return _let(F.lower(_clean(raw)), lambda s: _readings(s, local, slashed, first_year, last_year))


def _readings(s: Column, local: str, slashed: str, first_year: int, last_year: int) -> Column:
    def cut_up(form: str, pattern: str, order: str) -> Column:
        at = [order.index(x) + 1 for x in "ymd"]
        return F.when(s.rlike(pattern), F.regexp_replace(s, pattern, "\u0001".join([form, *[f"${i}" for i in [*at, 4, 5, 6, 7, 8, 9]]])))

    forms = [cut_up("iso", _ISO, "ymd"), cut_up("basic", _BASIC, "ymd"), cut_up("day month", _DAY_MONTH, "dmy"), cut_up("month day", _MONTH_DAY, "mdy")]
    if slashed in ("day_first", "both"):
        forms.append(cut_up("d/m/y", _SLASH, "dmy"))
    if slashed in ("month_first", "both"):
        forms.append(cut_up("m/d/y", _SLASH, "mdy"))
    hits = F.filter(F.array(*forms), lambda x: x.isNotNull())

    def read(hit: Column) -> Column:
        def of(g: Column) -> Column:
            zone = F.regexp_replace(g[9], r"[\[\]\s]", "")
            return F.struct(g[0].alias("form"), _let(_wall(g), lambda w: _zoned(w, zone, local)).alias("micros"))

        return _let(F.split(hit, "\u0001"), of)

    return F.when(
        s.rlike(r"^\d{5,19}(\.\d+)?$"), F.filter(F.array(*_bare(s, local, first_year, last_year)), lambda x: x.isNotNull())
    ).otherwise(F.filter(F.transform(hits, read), lambda x: x["micros"].isNotNull()))


def _bare(s: Column, local: str, first_year: int, last_year: int) -> list[Column]:
    number = s.try_cast("double")
    exact = F.when(s.rlike(r"^\d{5,19}$"), s.try_cast("long"))
    low, high = (F.lit(int(datetime(y, 1, 1, tzinfo=timezone.utc).timestamp()) * 1_000_000) for y in (first_year, last_year + 1))

    def bare(form: str, micros: Column) -> Column:
        return F.when((micros >= low) & (micros < high), F.struct(F.lit(form).alias("form"), micros.alias("micros")))

    days = F.when(number.between(30_000, 60_000), F.round((number - 25_569) * 86_400_000).cast("long") * 1000)
    local_days = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(days), local))
    compact = F.when(
        s.rlike(r"^\d{8}$"),
        F.unix_micros(
            F.to_utc_timestamp(
                F.try_make_timestamp(_int(F.substring(s, 1, 4)), _int(F.substring(s, 5, 2)), _int(F.substring(s, 7, 2)), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"), F.lit("UTC")),
                local,
            )
        ),
    )
    seconds = F.when(number < 1e11, F.when(exact.isNotNull(), exact * 1_000_000).otherwise((number * 1_000_000).cast("long")))
    return [
        bare("seconds", seconds), bare("millis", F.when(number < 1e14, exact * 1000)), bare("micros", exact),
        bare("day number", local_days), bare("yyyymmdd", compact),
    ]


def instant(raw: Column, **kinds: object) -> Column:
    """Micros of the first reading, null where there is none: for sources whose notation leaves one reading a value."""
    return F.try_element_at(readings(raw, **kinds), F.lit(1))["micros"]  # type: ignore[arg-type]


def day_of(raw: Column) -> Column:
    """Days since 1970 of a raw timestamp, as it is written: of the date alone where the text begins with an ISO or a slashed date,
    which most do, else of the first reading. Zones may move it by a day."""

    def date(year: Column, month: Column, day: Column) -> Column:
        parts = [x.try_cast("int") for x in (year, month, day)]
        return F.unix_date(F.try_make_timestamp(*parts, F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"), F.lit("UTC")).cast("date"))

    slashed, iso = r"^\d{1,2}/\d{1,2}/\d{4}\b", r"^\d{4}-\d{2}-\d{2}(?:\D|$)"
    between = [F.split_part(raw, F.lit("/"), F.lit(i)) for i in (1, 2, 3)]
    of_slashed = date(F.substring(between[2], 1, 4), between[1], between[0])
    of_iso = date(F.substring(raw, 1, 4), F.substring(raw, 6, 2), F.substring(raw, 9, 2))
    other = F.floor(instant(raw) / 86_400_000_000).cast("int")
    return F.when(raw.rlike(slashed), of_slashed).when(raw.rlike(iso), of_iso).otherwise(other)
