"""The search over records with their enrichment: all filters, sort and page together; and candidates for a record by keyword."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.functions.scalars import first_keyword, floor_days, iso_instant
from tamarind.operators.relations import page

#: Fields of the enrichment that the search reads.
ENRICHMENT = ("contract_type", "scope_of_work", "contract_title")


def search(
    records: DataFrame, enrichment: DataFrame, key: str, now: str, *, q: str | None = None, contract_type: str | None = None,
    procurement_type: str | None = None, funding_source: str | None = None, cpv: str | None = None, deadline_after: str | None = None,
    deadline_before: str | None = None, closing_within_days: int | None = None, has_analysis: bool | None = None, sort: str = "deadline_asc",
    number: int = 1, size: int = 20, unique: str = "id",
) -> DataFrame:
    """One page of ``records`` that pass all given filters, each with its enrichment's fields, ``total_rows`` and ``has_next``.

    Filters on text ask whether a field holds it, case ignored, and a null field holds nothing; ``cpv`` asks whether any code of the
    array ``cpv_codes`` holds it. A bound that is no ISO date is ignored; with a bound, records without a readable deadline are
    out. Sorts are stable by ``unique``; unknown deadlines come last; an unknown sort sorts by ``unique`` only. Of several
    enrichments of a key the least counts. ``now`` is ISO text, so that a result can be had again.
    """
    one = enrichment.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*ENRICHMENT)).alias("__a"))
    joined = records.join(one, key, "left")
    deadline = iso_instant(F.col("submission_deadline"))
    holds = lambda c, text: F.lower(F.coalesce(c, F.lit(""))).contains(text.lower())
    tests: list[Column] = []
    if has_analysis is not None:
        tests.append(F.col("__a").isNotNull() == has_analysis)
    for value, column in ((contract_type, F.col("__a.contract_type")), (procurement_type, F.col("procurement_type")), (funding_source, F.col("funding_source"))):
        if value:
            tests.append(holds(column, value))
    if cpv:
        tests.append(F.coalesce(F.exists("cpv_codes", lambda c: c.contains(cpv)), F.lit(False)))
    if closing_within_days is not None:
        tests.append(F.coalesce(floor_days(deadline, F.lit(now).cast("timestamp")).between(0, closing_within_days), F.lit(False)))
    for text, after in ((deadline_after, True), (deadline_before, False)):
        if text:
            bound = iso_instant(F.lit(text))
            tests.append(bound.isNull() | F.coalesce((deadline >= bound) if after else (deadline <= bound), F.lit(False)))
    if q and q.strip():
        fields = [F.col(c) for c in ("title", "procuring_entity", "detailed_description")] + [F.col("__a.scope_of_work"), F.col("__a.contract_title")]
        tests.append(F.lower(F.concat_ws(" ", *[F.when(c != "", c) for c in fields])).contains(q.strip().lower()))
    kept = joined.where(reduce(and_, tests)) if tests else joined
    orders = {
        "deadline_asc": [deadline.asc_nulls_last()], "deadline_desc": [deadline.desc_nulls_last()],
        "published_desc": [iso_instant(F.col("publication_date")).desc_nulls_last()], "entity_asc": [F.lower(F.coalesce("procuring_entity", F.lit("")))],
    }
    slim = kept.select(*records.columns, *[F.col("__a")[c].alias(c) for c in ENRICHMENT], F.col("__a").isNotNull().alias("has_analysis"))
    return page(slim, [*orders.get(sort, []), F.col(unique)], number, size)


def keyword_candidates(asked: DataFrame, known: DataFrame, ask_key: str, ask_title: str, known_key: str, known_title: str, most: int = 20, blank_most: int = 50) -> DataFrame:
    """``ask_key``, ``ask_title``, ``known_key``, ``known_title``: for each record those whose title holds its first longer word.

    At most ``most`` candidates a record, the least keys; a record without a title gets the ``blank_most`` least keys of all. A word
    that is held lies within one word of the title, so distinct words are matched with distinct words, over the first five
    letters; each word keeps its least keys only before anything is joined, and no title is scanned for a pattern.
    """
    titles = known.where(F.col(known_key).isNotNull() & (F.trim(known_title) != "")).select(F.col(known_key).alias("ck"), F.col(known_title).alias("ct"))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("ck", "ct"))
    said = titles.select("ck", "ct", F.explode(F.array_distinct(F.split(F.lower("ct"), r"\s+"))).alias("w")).where("w <> ''")
    said = said.withColumn("n", rank("w")).where(F.col("n") <= most).drop("n")
    grams = said.select("w").distinct().select("w", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("w") - 4)), lambda i: F.substring("w", i, F.lit(5))))).alias("g"))
    asks = asked.select(F.col(ask_key), F.col(ask_title)).withColumn("k", F.lower(first_keyword(F.trim(F.col(ask_title)))))
    words = asks.select("k").where("k <> '' and not k rlike '\\\\s'").distinct().withColumn("g", F.substring("k", 1, 5))
    hits = words.join(grams, "g").where(F.col("w").contains(F.col("k"))).select("k", "w")
    by_word = hits.join(said, "w").select("k", "ck", "ct").distinct()
    # a title without a longer word is asked for by its first signs, which may hold blanks: by the first five of them in every place
    phrases = asks.select("k").where("k rlike '\\\\s'").distinct().withColumn("g", F.substring("k", 1, 5))
    sizes = sorted(r[0] for r in phrases.select(F.length("g")).distinct().collect())  # 1 to 5
    by_phrase = by_word.limit(0)
    if sizes:
        at = lambda n: lambda i: F.substring(F.lower("ct"), i, F.lit(n))
        places = [F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("ct") - n + 1)), at(n)) for n in sizes]
        pieces = titles.select("ck", "ct", F.explode(F.array_distinct(F.flatten(F.array(*places)))).alias("g"))
        by_phrase = pieces.join(phrases, "g").where(F.lower("ct").contains(F.col("k"))).select("k", "ck", "ct")
    best = by_word.unionByName(by_phrase).withColumn("n", rank("k")).where(F.col("n") <= most).drop("n")
    found = asks.join(best, "k")
    some = titles.orderBy("ck", "ct").limit(blank_most)
    blank = asks.where(F.coalesce(F.trim(ask_title), F.lit("")) == "").join(F.broadcast(some))  # blank_most rows
    return found.unionByName(blank.select(*found.columns)).select(ask_key, ask_title, F.col("ck").alias(known_key), F.col("ct").alias(known_title))


def best_match(candidates: DataFrame, by: str, score: Callable[[DataFrame], Column], other: str, threshold: float = 0.70) -> DataFrame:
    """The candidate with the highest ``confidence`` of each ``by`` (ties: least ``other``), if that reaches the threshold.

    ``score`` makes the confidence of the candidates' columns: a column expression, or a pandas UDF that asks a model.
    """
    scored = candidates.withColumn("confidence", score(candidates)).where(F.col("confidence") >= threshold)
    rest = [c for c in scored.columns if c not in (by, other, "confidence")]
    top = scored.groupBy(by).agg(F.min(F.struct((-F.col("confidence")).alias("s"), F.col(other), *rest)).alias("r"))
    return top.select(by, F.col(f"r.{other}").alias(other), *[F.col(f"r.{c}").alias(c) for c in rest], (-F.col("r.s")).alias("confidence"))


def word_overlap(a: Column, b: Column) -> Column:
    """Share of two texts' distinct words that both have: a scorer that needs no model."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != ""))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(words(a), words(b))), F.size(F.array_union(words(a), words(b)))), F.lit(0.0))
