"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.functions.instants import day_of
from tamarind.llm.leaks import find_leaks, find_paraphrases
from tamarind.llm.matching import match_records
from tamarind.llm.mixing import mix_documents, mix_report
from tamarind.llm.mojibake import restore_texts
from tamarind.llm.names import link_names, name_pairs
from tamarind.llm.pieces import split_documents
from tamarind.session import table


def p1_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with the entity it names."""
    fields = [
        ("tenders_all", "procuring_entity", "authority"),
        ("tender_snapshots", "procuring_entity", "authority"),
        ("awards_all", "procuring_entity", "authority"),
        ("award_details_all", "official_name", "authority"),
        ("award_details_all", "name_of_contractor", "contractor"),
    ]
    names = [table(spark, sf_dir, t).select(F.lit(k).alias("kind"), F.col(c).alias("raw")).distinct() for t, c, k in fields]
    return link_names(reduce(DataFrame.unionByName, names))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_pairs(p1_entities(spark, sf_dir))


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every extracted file, each within the project's limit."""
    files = table(spark, sf_dir, "extracted_documents")
    return split_documents(files, ["tender_resource_id", "source_file"], "content", version="extraction_timestamp").distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "extracted_documents")
    pieces = split_documents(files, ["tender_resource_id", "source_file"], "content", version="extraction_timestamp")
    return pieces.where("n_pieces > 1").select("tender_resource_id", "source_file").distinct()


def p7_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tenders and award notices as :func:`match_records` takes them."""

    def latest(df: DataFrame, *fields: str) -> DataFrame:
        row = F.max(F.struct("extraction_timestamp", "id", *fields)).alias("r")
        return df.where("resource_id is not null").groupBy("resource_id").agg(row).select("resource_id", *[F.col(f"r.{f}").alias(f) for f in fields])

    tenders = latest(table(spark, sf_dir, "tenders_all"), "title", "procuring_entity", "project_reference_number", "submission_deadline", "publication_date", "status")
    notices = latest(table(spark, sf_dir, "award_details_all").where("title is not null"), "title", "official_name", "tender_reference_number", "contract_award_date_raw")
    tenders = tenders.withColumn("closes", day_of(F.col("submission_deadline")))
    # a tender is dated by its deadline, else by its publication, which is parsed only then
    tenders = tenders.withColumn("day", F.coalesce("closes", day_of(F.when(F.col("closes").isNull(), F.col("publication_date")))))
    left = tenders.select(
        F.col("resource_id").alias("id"), "title", F.col("procuring_entity").alias("entity"), F.col("project_reference_number").alias("reference"),
        "day", F.col("closes").isNull().cast("int").alias("basis"), F.col("status").alias("trait"),
    )
    right = notices.select(
        F.col("resource_id").alias("id"), "title", F.col("official_name").alias("entity"), F.col("tender_reference_number").alias("reference"),
        day_of(F.col("contract_award_date_raw")).alias("day"),
    )
    return left, right


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each award notice's tender, with the confidence."""
    return match_records(*p7_sides(spark, sf_dir)).select(F.col("left_id").alias("tender_resource_id"), F.col("right_id").alias("award_resource_id"), "confidence")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_matches(spark, sf_dir).select("tender_resource_id", "award_resource_id").distinct()


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id", "item_text")


def p8_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage near an item's that is no repetition, by common subsequence and the answer's words."""
    return find_paraphrases(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id", "item_text")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn and how often each is used, at the largest total that meets every source's share."""
    return mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), "doc_id", "text", "source")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached."""
    return mix_report(p9_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"), "source")


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The restored text of every document with a wrongly decoded sequence, and the chains undone."""
    return restore_texts(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_restored(spark, sf_dir).select("doc_id").distinct()


def queries() -> dict:
    return {"p1_found": p1_found, "p1_entities": p1_entities, "p5_found": p5_found, "p5_pieces": p5_pieces, "p7_found": p7_found, "p7_matches": p7_matches, "p8_found": p8_found, "p8_paraphrases": p8_paraphrases, "p9_mix": p9_mix, "p9_report": p9_report, "p10_found": p10_found, "p10_restored": p10_restored}


_P5_SQL = r"""
WITH f AS (SELECT tender_resource_id, source_file, extraction_timestamp, content FROM extracted_documents WHERE content.markdown IS NOT NULL
  OR content.raw_text IS NOT NULL OR content.chunks IS NOT NULL OR content.pages IS NOT NULL OR content.slides IS NOT NULL),
t AS (SELECT tender_resource_id, source_file, content, rank() OVER (PARTITION BY tender_resource_id, source_file ORDER BY extraction_timestamp DESC) AS n FROM f),
p AS (SELECT tender_resource_id, source_file, CASE
  WHEN trim(coalesce(content.markdown, '')) <> '' THEN [content.markdown]
  WHEN trim(coalesce(content.raw_text, '')) <> '' THEN [content.raw_text]
  WHEN content.chunks IS NOT NULL THEN list_transform(content.chunks, lambda c: c.text)
  WHEN content.slides IS NOT NULL THEN flatten(list_transform(content.slides, lambda s: coalesce(s.texts, [])))
  ELSE flatten(list_transform(content.pages, lambda g: list_concat([g.text], list_transform(coalesce(g.tables, []), lambda t: array_to_string(list_filter(
    list_transform(t, lambda r: array_to_string(list_filter(list_transform(r, lambda c: trim(coalesce(c, ''))), lambda c: c <> ''), ' | ')),
    lambda l: l <> ''), chr(10)))))) END AS parts FROM t WHERE n = 1)
SELECT DISTINCT tender_resource_id, source_file FROM p
WHERE length(array_to_string(list_filter(list_transform(parts, lambda x: regexp_replace(coalesce(x, ''), '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10) || chr(10))) > 26000
"""


def oracle_sql() -> dict:
    return {"p5_found": _P5_SQL}
