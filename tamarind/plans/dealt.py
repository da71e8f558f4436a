"""The queries of the general problems: snapshots, units, packed fields, timestamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.functions.instants import instant
from tamarind.operators.packed import CATEGORY_CODE, CPV_CODE, unpack
from tamarind.operators.snapshots import plain, snapshot_changes
from tamarind.operators.timestamps import normalise_instants
from tamarind.operators.units import aliases, to_common_unit
from tamarind.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = table(spark, sf_dir, "tender_snapshots")
    deadline = F.coalesce(instant(F.col("submission_deadline")).cast("string"), F.lit(""))
    compared = [plain(F.col("title")), plain(F.col("procurement_type")), plain(F.col("status")), deadline, plain(F.col("detailed_description"))]
    return snapshot_changes(snaps, "snapshot_date", "resource_id", "extraction_timestamp", compared)


def p3_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of each award's contract in Jamaican dollars, from the listing and from the notice."""
    rates = table(spark, sf_dir, "currency_rates")
    units = aliases(spark, rates, "currency_code", "jmd_per_unit")
    listed = table(spark, sf_dir, "awards_all").select("resource_id", "contract_amount_raw").distinct()
    noticed = table(spark, sf_dir, "award_details_all").select("resource_id", "contract_price_raw", "contract_price_currency").distinct()
    a = to_common_unit(listed, "contract_amount_raw", units, None, "JMD", "listed_jmd").select("resource_id", "listed_jmd")
    b = to_common_unit(noticed, "contract_price_raw", units, "contract_price_currency", "JMD", "noticed_jmd").select("resource_id", "noticed_jmd")
    return a.join(b, "resource_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = p3_values(spark, sf_dir).where("listed_jmd is not null and noticed_jmd is not null")
    apart = F.abs(F.col("listed_jmd") - F.col("noticed_jmd")) > 0.01 * F.greatest("listed_jmd", "noticed_jmd")
    return both.where(apart).select("resource_id").distinct()


# The packed fields and the codes their values start with.
PACKED = [
    ("tenders_all", "cpv_codes", CPV_CODE),
    ("tenders_all", "ppc_ncc_categories", CATEGORY_CODE),
    ("award_details_all", "cpv_codes", CPV_CODE),
    ("award_details_all", "ppc_category_code_and_title", CATEGORY_CODE),
]


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        unpack(table(spark, sf_dir, t), f, ["id"], code).select(
            F.lit(t).alias("table_name"), "id", F.lit(f).alias("field_name"), "pos_no", "item_value", "n_items"
        )
        for t, f, code in PACKED
    ]
    return reduce(DataFrame.unionByName, parts).where("n_items > 1").drop("n_items").distinct()


# The timestamp fields.
DATED = [
    ("tenders_all", "submission_deadline"),
    ("tenders_all", "publication_date"),
    ("awards_all", "award_date_raw"),
    ("award_details_all", "contract_award_date_raw"),
]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), "id", F.lit(f).alias("field_name"), F.col(f).alias("raw")) for t, f in DATED
    ]
    values = reduce(DataFrame.unionByName, parts)
    found = normalise_instants(values, "raw", ["table_name", "field_name"], ["id"], ["table_name", "id", "field_name"])
    return found.select("table_name", "id", "field_name", "utc_micros").distinct()


def p6_both_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The award dates with the order of day and month left open: the path through each source's records decides it.

    ``day_first`` tells whether the reading chosen is that of the day in front, for values that have both.
    """
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), "id", F.lit(f).alias("field_name"), F.col(f).alias("raw")) for t, f in DATED]
    values = reduce(DataFrame.unionByName, parts)
    found = normalise_instants(values, "raw", ["table_name", "field_name"], ["id"], ["table_name", "id", "field_name", "raw"], slashed="both")
    return found.select("table_name", "id", "field_name", "utc_micros", "form", (F.col("utc_micros") == instant(F.col("raw"))).alias("day_first")).distinct()


def queries() -> dict:
    return {"p6_both_orders": p6_both_orders, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found}


# The deadlines of the snapshots come in two notations, day first and ISO, which this SQL reads on its own.
_P2_SQL = r"""
WITH c AS (SELECT snapshot_date, resource_id, extraction_timestamp, trim(regexp_replace(coalesce(submission_deadline, ''), '[\s\x{00a0}]+', ' ', 'g')) AS s,
  trim(regexp_replace(coalesce(title, ''), '[\s\x{00a0}]+', ' ', 'g')) AS title, trim(regexp_replace(coalesce(procurement_type, ''), '[\s\x{00a0}]+', ' ', 'g')) AS kind,
  trim(regexp_replace(coalesce(status, ''), '[\s\x{00a0}]+', ' ', 'g')) AS status, trim(regexp_replace(coalesce(detailed_description, ''), '[\s\x{00a0}]+', ' ', 'g')) AS descr
  FROM tender_snapshots WHERE snapshot_date IS NOT NULL AND resource_id IS NOT NULL),
z AS (SELECT *, regexp_extract(s, '^(\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?)', 1) AS day_first, replace(regexp_extract(s, '^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2})', 1), 'T', ' ') AS iso,
  CASE WHEN s LIKE '%Z' THEN '+00:00' ELSE coalesce(nullif(regexp_extract(s, '([+-]\d{2}:\d{2})$', 1), ''), '-05:00') END AS zone FROM c),
t AS (SELECT *, CASE WHEN day_first <> '' THEN epoch_us(coalesce(try_strptime(day_first, '%d/%m/%Y %H:%M:%S'), try_strptime(day_first, '%d/%m/%Y %H:%M'))) + 18000000000
  WHEN iso <> '' THEN epoch_us(try_strptime(iso, '%Y-%m-%d %H:%M:%S')) - (CASE WHEN zone LIKE '-%' THEN -1 ELSE 1 END) * (substr(zone, 2, 2)::BIGINT * 60 + substr(zone, 5, 2)::BIGINT) * 60000000 END AS due FROM z),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date, resource_id ORDER BY extraction_timestamp DESC) AS n FROM t) WHERE n = 1),
d AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before FROM (SELECT DISTINCT snapshot_date FROM c)),
n AS (SELECT l.*, d.before FROM l JOIN d USING (snapshot_date) WHERE d.before IS NOT NULL), o AS (SELECT l.*, d.snapshot_date AS later FROM l JOIN d ON l.snapshot_date = d.before)
SELECT coalesce(n.snapshot_date, o.later) AS snapshot_date, coalesce(n.resource_id, o.resource_id) AS resource_id,
  CASE WHEN o.resource_id IS NULL THEN 'added' WHEN n.resource_id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM n FULL JOIN o ON n.snapshot_date = o.later AND n.resource_id = o.resource_id
WHERE o.resource_id IS NULL OR n.resource_id IS NULL OR n.title <> o.title OR n.kind <> o.kind OR n.status <> o.status OR n.descr <> o.descr OR n.due IS DISTINCT FROM o.due
"""


def oracle_sql() -> dict:
    return {"p2_found": _P2_SQL}
