"""Quantities recorded in different units, notations and scales, brought to one unit in plain SQL expressions.

The number, its scale and its unit are taken out of the text by pattern; the unit is normalised by a join with a table of
aliases; the unit of the text wins over the unit field, and that over the default of the source; then ``factor`` and
``offset`` of the unit apply. The alias table is as long as the list of units, and its size is counted before it is
broadcast; a longer one is joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.session import broadcast_if_small

# Number words and their values.
WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16,
    "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50,
    "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90,
    "hundred": 100, "thousand": 1_000, "million": 1_000_000, "billion": 1_000_000_000,
}
# How currencies are written in the sources, in lower case without blanks and full stops.
CURRENCY_ALIASES = {
    "JMD": ["jmd", "j$", "jm$", "ja$", "jamaicandollar", "jamaicandollars"],
    "USD": ["usd", "us$", "usdollar", "usdollars", "unitedstatesdollar", "unitedstatesdollars"],
    "EUR": ["eur", "€", "euro", "euros"],
    "GBP": ["gbp", "£", "poundsterling", "poundssterling", "sterling"],
    "CAD": ["cad", "ca$", "c$", "cdn$", "canadiandollar", "canadiandollars"],
    "TTD": ["ttd", "tt$", "trinidadandtobagodollar", "trinidadandtobagodollars", "trinidaddollars"],
    "XCD": ["xcd", "ec$", "easterncaribbeandollar", "easterncaribbeandollars"],
    "BBD": ["bbd", "bds$", "bd$", "barbadosdollar", "barbadosdollars", "barbadiandollars"],
}
_BLANKS = "[\\s\\u00a0\\u2000-\\u200b\\u202f\\u3000]+"
_UNIT = (
    r"(u\.?s\.?\s?\$|jmd|jm\$|ja\$|j\$|usd|us dollars?|united states dollars?|jamaican dollars?|eur(?:os?)?|€|gbp|£|"
    r"pounds? sterling|cad|cdn\$|ca\$|tt\$|ec\$|bds\$|bd\$|c\$|canadian dollars?|ttd|trinidad and tobago dollars?|xcd|"
    r"eastern caribbean dollars?|bbd|barbad(?:os|ian) dollars?)"
)
_PLAIN = r"(\d(?:[\d.,' ’]*\d)?(?:e[+-]?\d+)?)"
_WORD = "(?:" + "|".join(sorted(WORDS, key=len, reverse=True)) + ")"
_PERIOD = r"(?:per|a|an|each|every|/)\s?(month|quarter|year|annum|week|day)|\b(monthly|quarterly|yearly|annually|weekly)\b"
_TERM = r"(?:for|over|x|×|times|\*)\s+(?:a (?:period|term) of )?(\d+|[a-z]+(?:-[a-z]+)?)\s+(month|quarter|year|annum|week|day)s?\b"
SMALL_UNITS = 10_000


def aliases(spark: SparkSession, rates: DataFrame, code: str, factor: str, names: dict[str, list[str]] | None = None) -> DataFrame:
    """(alias, factor, offset) of each unit of ``rates``; a code is always its own alias."""
    names = CURRENCY_ALIASES if names is None else names
    known = spark.createDataFrame([(k, a) for k, v in names.items() for a in v], "code string, alias string")
    own = rates.select(F.col(code).alias("code"), F.lower(code).alias("alias"))
    return (
        known.unionByName(own).distinct()
        .join(rates.select(F.col(code).alias("code"), F.col(factor).cast("double").alias("factor")), "code")
        .select("alias", "code", "factor", F.lit(0.0).alias("offset"))
    )


def unit_alias(c: Column) -> Column:
    """A unit as written, in the alias table's form; null for none."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[\s .]+", ""), F.lit(""))


def word_number(text: Column) -> Column:
    """The value of a number in words ('Two million sixty thousand'), null without any number word."""
    words = F.filter(
        F.split(F.regexp_replace(F.lower(text), "[^a-z]+", " "), " "), lambda w: F.array_contains(F.array(*[F.lit(x) for x in WORDS]), w)
    )
    value = F.create_map(*[x for k, v in WORDS.items() for x in (F.lit(k), F.lit(float(v)))])
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("part"))

    def add(acc: Column, word: Column) -> Column:
        v = value[word]
        return (
            F.when(v == 100, F.struct(acc["total"].alias("total"), (F.greatest(acc["part"], F.lit(1.0)) * 100).alias("part")))
            .when(v >= 1000, F.struct((acc["total"] + F.greatest(acc["part"], F.lit(1.0)) * v).alias("total"), F.lit(0.0).alias("part")))
            .otherwise(F.struct(acc["total"].alias("total"), (acc["part"] + v).alias("part")))
        )

    return F.when(F.size(words) > 0, F.aggregate(words, start, add, lambda a: a["total"] + a["part"]))


def plain_number(digits: Column) -> Column:
    """A number with any marks for thousands and decimals; with both marks the last one is the decimal mark."""
    s = F.regexp_replace(digits, r"[\s '’]", "")
    mantissa, power = F.regexp_extract(s, r"^([\d.,]+)", 1), F.regexp_extract(s, r"e([+-]?\d+)$", 1)
    commas, dots = F.length(F.regexp_replace(mantissa, "[^,]", "")), F.length(F.regexp_replace(mantissa, "[^.]", ""))
    comma_last = F.locate(",", F.reverse(mantissa)) < F.locate(".", F.reverse(mantissa))
    as_comma = F.translate(F.regexp_replace(mantissa, r"\.", ""), ",", ".")
    as_dot = F.regexp_replace(mantissa, ",", "")
    text = (
        F.when((commas > 0) & (dots > 0), F.when(comma_last, as_comma).otherwise(as_dot))
        .when(commas > 1, as_dot)
        .when(commas == 1, F.when(mantissa.rlike(r"^\d{1,3},\d{3}$"), as_dot).otherwise(as_comma))
        .when(dots > 1, F.regexp_replace(mantissa, r"\.", ""))
        .otherwise(mantissa)
    )
    return text.try_cast("double") * F.pow(F.lit(10.0), F.coalesce(power.try_cast("double"), F.lit(0.0)))


def _months(period: Column) -> Column:
    p = F.substring(period, 1, 4)
    return (
        F.when(p.startswith("mont"), 1.0).when(p.startswith("quar"), 3.0).when(p.isin("year", "annu"), 12.0)
        .when(p == "week", 12.0 / 52).when(p.startswith("day"), 12.0 / 365)
    )


def parse_quantity(raw: Column) -> Column:
    """``struct<amount double, unit string>``: the amount over the whole term in the unit of the text; amount null for none.

    Thousands and millions are multiplied out, a rate per period with a term is taken over the term. Text without a number,
    null and blank text have no amount; ``unit`` is null where the text names none.
    """
    s = F.lower(F.trim(F.regexp_replace(raw, _BLANKS, " ")))
    unit = unit_alias(F.regexp_extract(s, _UNIT, 1))
    # the scale notes hold digits of their own, so they are read first and taken out
    thousands = s.rlike(r"\(?['’]?000['’]?s?\)?(?:\s*[:)]|\s*$)|000s|\bin thousands\b") & ~s.rlike(r"[\d][.,' ]000\s*$")
    bare = F.regexp_replace(s, r"\(\s*['’]?000s?['’]?\s*\)|\b000s\b:?|['’]000s?\b|\(in thousands\)", " ")
    rate = F.regexp_extract(bare, _PERIOD, 1)
    rate = F.when(rate != "", rate).otherwise(F.regexp_extract(bare, _PERIOD, 2))
    term, term_in = F.regexp_extract(bare, _TERM, 1), F.regexp_extract(bare, _TERM, 2)
    count = F.coalesce(term.try_cast("double"), word_number(term))
    head = F.regexp_replace(F.regexp_replace(bare, _TERM, " "), _PERIOD, " ")
    digits = F.regexp_extract(head, _PLAIN, 1)
    after = F.regexp_extract(head, r"\d\s*(thousand|k|million|mil|mn|mm|m|billion|bn|b)\b", 1)
    scale = (
        F.when(after.isin("thousand", "k"), 1e3).when(after.isin("million", "mil", "mn", "mm", "m"), 1e6)
        .when(after.isin("billion", "bn", "b"), 1e9).when(thousands, 1e3).otherwise(1.0)
    )
    amount = F.when(digits != "", plain_number(digits) * scale).when(
        head.rlike(rf"\b{_WORD}\b.*\b(?:hundred|thousand|million|billion)\b|\b{_WORD}\b.*dollars|\b{_WORD}\b.*(?:euro|pound)"), word_number(head)
    )
    whole = F.when(
        (rate != "") & count.isNotNull(), amount * count * F.coalesce(_months(term_in), F.lit(1.0)) / F.coalesce(_months(rate), F.lit(1.0))
    ).otherwise(amount)
    return F.struct(whole.alias("amount"), unit.alias("unit"))


def to_common_unit(
    df: DataFrame, raw: str, units: DataFrame, unit_field: str | None = None, default: str | None = None, out: str = "common_value"
) -> DataFrame:
    """``df`` with ``out``, the quantity of ``raw`` in the common unit; null where there is no readable one.

    The unit in the text wins over ``unit_field``, and that over ``default``. An unknown unit makes the value unreadable
    only where the text itself names it; an unknown ``unit_field`` falls back to the default. Rows are kept one for one,
    repeated ones too; the columns made on the way have names of their own and are dropped.
    """
    parsed = df.withColumn("__q", parse_quantity(F.col(raw)))
    if unit_field is None:
        parsed = parsed.withColumn("__f", F.lit(None).cast("string"))
    else:
        parsed = parsed.withColumn("__f", unit_alias(F.col(unit_field)))
    table = broadcast_if_small(units, SMALL_UNITS)
    text = table.select(F.col("alias").alias("__ta"), F.struct("factor", "offset").alias("__tu"))
    field = table.select(F.col("alias").alias("__fa"), F.struct("factor", "offset").alias("__fu"))
    base = table.where(F.col("code") == F.lit(default)).select(F.struct("factor", "offset").alias("__du"), F.lit(1).alias("__one")).limit(1)
    joined = (
        parsed.join(text, F.col("__q.unit") == F.col("__ta"), "left")
        .join(field, F.col("__f") == F.col("__fa"), "left")
        .withColumn("__one", F.lit(1))
        .join(F.broadcast(base), "__one", "left")
    )
    used = F.when(F.col("__q.unit").isNotNull(), F.col("__tu")).otherwise(F.coalesce("__fu", "__du"))
    return joined.withColumn(out, F.col("__q.amount") * used["factor"] + used["offset"]).select(*df.columns, out)
