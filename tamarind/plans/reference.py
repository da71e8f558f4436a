"""The queries of the pipeline's own operators, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarind.functions import scalars as S
from tamarind.operators import relations as R
from tamarind.operators import summaries as G
from tamarind.session import table
from tamarind.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _tenders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tenders_all")


#: The moment that stands for now in the queries on dates, so that results are the same on every day.
NOW = "2024-01-15 12:00:00"


# --- scans, projections, filters -------------------------------------------------------------------------------------------
@query("a8_scan_filter_order_limit", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 1000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(spark, d):
    o = table(spark, d, "orders").where((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") >= 1000))
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_custkey", "o_totalprice")


@query("a4_last_duplicate_wins", "SELECT resource_id, id, title FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY id DESC) AS n FROM award_details_all) WHERE n = 1")
def _(spark, d):
    details = table(spark, d, "award_details_all").select("resource_id", "id", "title")
    return R.latest(details, ["resource_id"], [F.col("id")]).select("resource_id", "id", "title")


@query("a7_ordered_distinct_urls", "SELECT title_url, min(id) AS first_id FROM tenders_all WHERE title_url IS NOT NULL AND title_url <> '' GROUP BY title_url")
def _(spark, d):
    return _tenders(spark, d).where("title_url is not null and title_url <> ''").groupBy("title_url").agg(F.min("id").alias("first_id"))


@query("a17_a20_heading_sections", r"WITH d AS (SELECT tender_resource_id, source_file, content.markdown AS t FROM extracted_documents WHERE content.markdown IS NOT NULL), l AS (SELECT tender_resource_id, source_file, unnest(string_split(t, chr(10))) AS line FROM d) SELECT tender_resource_id, source_file, length(regexp_extract(line, '^(#{1,6})\s+\S', 1)) AS depth, count(*) AS n FROM l WHERE regexp_matches(line, '^#{1,6}\s+\S') GROUP BY 1, 2, 3".replace("\\\\", "\\"))
def _(spark, d):
    """Headings of each Markdown document by their depth."""
    docs = table(spark, d, "extracted_documents").where("content.markdown is not null").select("tender_resource_id", "source_file", F.explode(F.split("content.markdown", "\n")).alias("line"))
    heads = docs.where(F.col("line").rlike(r"^#{1,6}\s+\S")).withColumn("depth", F.length(F.regexp_extract("line", r"^(#{1,6})\s+\S", 1)))
    return heads.groupBy("tender_resource_id", "source_file", "depth").agg(F.count("*").alias("n"))


@query("b1_eq_neq", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'")
def _(spark, d):
    return table(spark, d, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "F")).select("o_orderkey")


@query("b2_ilike", "SELECT id, title FROM tenders_all WHERE title ILIKE '%bridge%'")
def _(spark, d):
    return _tenders(spark, d).where(F.col("title").ilike("%bridge%")).select("id", "title")


@query("b3_gte_lt", "SELECT o_orderkey FROM orders WHERE o_totalprice >= 50000 AND o_totalprice < 150000")
def _(spark, d):
    return table(spark, d, "orders").where((F.col("o_totalprice") >= 50000) & (F.col("o_totalprice") < 150000)).select("o_orderkey")


@query("b4_in_not_in", "SELECT id, procurement_type, status FROM tenders_all WHERE procurement_type IN ('Goods', 'Works') AND status NOT IN ('Cancelled', 'Closed')")
def _(spark, d):
    t = _tenders(spark, d)
    return t.where(F.col("procurement_type").isin("Goods", "Works") & ~F.col("status").isin("Cancelled", "Closed")).select("id", "procurement_type", "status")


@query("b6_has_details", "SELECT a.id, (d.resource_id IS NOT NULL) AS has_details FROM awards_all a LEFT JOIN (SELECT DISTINCT resource_id FROM award_details_all WHERE title IS NOT NULL) d USING (resource_id)")
def _(spark, d):
    known = table(spark, d, "award_details_all").where("title is not null").select("resource_id").distinct().withColumn("hit", F.lit(True))
    return table(spark, d, "awards_all").join(known, "resource_id", "left").select("id", F.col("hit").isNotNull().alias("has_details"))


@query("b7_b8_contains_ignoring_case", "SELECT id FROM tenders_all WHERE contains(lower(coalesce(procurement_type, '')), 'consult') OR contains(lower(coalesce(funding_source, '')), 'loan')")
def _(spark, d):
    has = lambda c, w: F.lower(F.coalesce(c, F.lit(""))).contains(w)
    return _tenders(spark, d).where(R.any_of(has(F.col("procurement_type"), "consult"), has(F.col("funding_source"), "loan"))).select("id")


@query("b9_any_code_contains", "SELECT id FROM tenders_all WHERE len(list_filter(string_split(coalesce(cpv_codes, ''), ';'), lambda x: contains(x, '45'))) > 0")
def _(spark, d):
    return _tenders(spark, d).where(F.exists(F.split(F.coalesce("cpv_codes", F.lit("")), ";"), lambda x: x.contains("45"))).select("id")


@query("b10_closing_within_days", f"SELECT o_orderkey, floor((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '{NOW}')) / 86400000000.0)::BIGINT AS days FROM orders WHERE floor((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '{NOW}')) / 86400000000.0) BETWEEN 0 AND 30")
def _(spark, d):
    days = S.floor_days(F.col("o_orderdate"), F.lit(NOW).cast("timestamp")).cast("bigint")
    return table(spark, d, "orders").select("o_orderkey", days.alias("days")).where("days between 0 and 30")


@query("b11_deadline_bounds", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1996-06-30'")
def _(spark, d):
    return table(spark, d, "orders").where("o_orderdate >= timestamp_ntz '1995-01-01 00:00:00' and o_orderdate <= timestamp_ntz '1996-06-30 00:00:00'").select("o_orderkey")


@query("b12_free_text", "SELECT id FROM tenders_all WHERE contains(lower(concat_ws(' ', CASE WHEN trim(title) <> '' THEN title END, CASE WHEN trim(procuring_entity) <> '' THEN procuring_entity END, CASE WHEN trim(detailed_description) <> '' THEN detailed_description END)), 'drainage works')")
def _(spark, d):
    return R.text_search(_tenders(spark, d), "drainage works", ["title", "procuring_entity", "detailed_description"]).select("id")


@query("b14_horizon_keeps_unknown", f"SELECT event_id FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '{NOW}' + INTERVAL 48 HOUR")
def _(spark, d):
    return table(spark, d, "events").where(f"ts is null or ts >= timestamp_ntz '{NOW}' + interval 48 hours").select("event_id")


@query("b16_d1_after_high_water_mark", "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup') - INTERVAL 1 DAY")
def _(spark, d):
    e = table(spark, d, "events")
    mark = e.where("event_type = 'signup'").agg((F.max("ts") - F.expr("interval 1 day")).alias("mark"))
    return e.join(F.broadcast(mark), F.col("ts") > F.col("mark")).select("event_id")  # one row


@query("b18_noise_and_extensions", "SELECT source_file, count(*) AS n FROM extracted_documents WHERE regexp_matches(lower(source_file), 'addendum|annex') AND lower(regexp_extract(source_file, '(\\.[^./]+)$', 1)) NOT IN ('.txt', '.doc') GROUP BY source_file")
def _(spark, d):
    f = table(spark, d, "extracted_documents").select("source_file")
    return f.where(F.lower("source_file").rlike("addendum|annex") & ~S.file_extension(F.col("source_file")).isin(".txt", ".doc")).groupBy("source_file").agg(F.count("*").alias("n"))


@query("b19_expired_deleted", "SELECT id FROM tenders_all WHERE NOT coalesce(extraction_timestamp < TIMESTAMPTZ '2023-01-01 00:00:00+00', false)")
def _(spark, d):
    return R.delete_where(_tenders(spark, d), F.col("extraction_timestamp") < F.lit("2023-01-01 00:00:00").cast("timestamp")).select("id")


@query("b20_active_ids", "SELECT DISTINCT resource_id FROM tenders_all WHERE extraction_timestamp >= TIMESTAMPTZ '2025-01-01 00:00:00+00'")
def _(spark, d):
    return _tenders(spark, d).where(F.col("extraction_timestamp") >= F.lit("2025-01-01 00:00:00").cast("timestamp")).select("resource_id").distinct()


@query("b24_h8_folder_consistency", "SELECT competition_unique_id, CASE WHEN strpos(competition_unique_id, '/') > 0 THEN substr(competition_unique_id, 1, strpos(competition_unique_id, '/') - 1) || '_' || substr(competition_unique_id, strpos(competition_unique_id, '/') + 1) ELSE competition_unique_id END AS folder, count(*) AS n FROM tenders_all WHERE competition_unique_id IS NOT NULL GROUP BY ALL HAVING folder IN (SELECT tender_folder FROM documents)")
def _(spark, d):
    folder = S.swap_first(F.col("competition_unique_id"), "/", "_")
    t = _tenders(spark, d).where("competition_unique_id is not null").groupBy("competition_unique_id").agg(F.count("*").alias("n")).withColumn("folder", folder)
    return t.join(table(spark, d, "documents").select(F.col("tender_folder").alias("folder")).distinct(), "folder", "left_semi").select("competition_unique_id", "folder", "n")


@query("b25_required_fields", "SELECT id, array_to_string(list_filter([CASE WHEN coalesce(trim(title), '') = '' THEN 'title' END, CASE WHEN coalesce(trim(status), '') = '' THEN 'status' END, CASE WHEN coalesce(trim(procuring_entity), '') = '' THEN 'procuring_entity' END], lambda x: x IS NOT NULL), ',') AS missing FROM tenders_all")
def _(spark, d):
    return _tenders(spark, d).select("id", F.array_join(R.missing_fields(["title", "status", "procuring_entity"]), ",").alias("missing"))


@query("b28_point_lookup", "SELECT id, title FROM tenders_all WHERE replace(competition_unique_id, '_', '/') = (SELECT min(replace(competition_unique_id, '_', '/')) FROM tenders_all) ORDER BY id LIMIT 1")
def _(spark, d):
    t = _tenders(spark, d).withColumn("uid", F.replace("competition_unique_id", F.lit("_"), F.lit("/")))
    least = t.agg(F.min("uid").alias("uid"))
    return t.join(F.broadcast(least), "uid").orderBy("id").limit(1).select("id", "title")  # one row


@query("b21_b29_null_rows", "SELECT id FROM award_details_all WHERE name_of_contractor IS NULL AND error IS NOT NULL")
def _(spark, d):
    return table(spark, d, "award_details_all").where("name_of_contractor is null and error is not null").select("id")


# --- joins and mutations -----------------------------------------------------------------------------------------------------
@query("j1_left_join_latest", "SELECT a.id, d.id AS detail_id, d.official_name FROM awards_all a LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY extraction_timestamp DESC, id DESC) AS n FROM award_details_all) d ON a.resource_id = d.resource_id AND d.n = 1")
def _(spark, d):
    details = table(spark, d, "award_details_all").select("resource_id", "id", "official_name", "extraction_timestamp")
    one = R.latest(details, ["resource_id"], [F.col("extraction_timestamp"), F.col("id")]).withColumnRenamed("id", "detail_id")
    return table(spark, d, "awards_all").select("id", "resource_id").join(one, "resource_id", "left").select("id", "detail_id", "official_name")


@query("j2_inner_active", "SELECT count(*) AS n, count(DISTINCT t.resource_id) AS tenders FROM tenders_all t JOIN tender_snapshots s ON t.resource_id = s.resource_id WHERE s.status = 'Open'")
def _(spark, d):
    s = table(spark, d, "tender_snapshots").where("status = 'Open'").select("resource_id")
    return _tenders(spark, d).select("resource_id").join(s, "resource_id").agg(F.count("*").alias("n"), F.countDistinct("resource_id").alias("tenders"))


@query("j3_overlay", "WITH a AS (SELECT resource_id, arg_max(title, id) AS title FROM (SELECT resource_id, id, coalesce(title, '') AS title FROM awards_all) GROUP BY 1), d AS (SELECT resource_id, arg_max(title, id) AS title FROM (SELECT resource_id, id, coalesce(title, '') AS title FROM award_details_all) GROUP BY 1) SELECT resource_id, CASE WHEN trim(d.title) <> '' THEN d.title ELSE a.title END AS title FROM a FULL JOIN d USING (resource_id)")
def _(spark, d):
    one = lambda n: table(spark, d, n).groupBy("resource_id").agg(F.max_by(F.coalesce("title", F.lit("")), "id").alias("title"))
    return R.overlay(one("awards_all"), one("award_details_all"), ["resource_id"])


@query("j4_present_key_overwrites", "WITH a AS (SELECT DISTINCT ON (resource_id) resource_id, title FROM awards_all WHERE resource_id IS NOT NULL ORDER BY resource_id, id), d AS (SELECT resource_id, title FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY id DESC) n FROM award_details_all) WHERE n = 1) SELECT a.resource_id, CASE WHEN d.resource_id IS NOT NULL THEN d.title ELSE a.title END AS title FROM a LEFT JOIN d USING (resource_id)")
def _(spark, d):
    base = R.first_per_group(table(spark, d, "awards_all").select("resource_id", "id", "title"), ["resource_id"], [F.col("id")]).drop("id")
    patch = R.first_per_group(table(spark, d, "award_details_all").select("resource_id", "id", "title"), ["resource_id"], [F.desc("id")]).drop("id")
    return R.overwrite_present(base, patch, ["resource_id"])


@query("j6_two_key_match", "SELECT DISTINCT s.resource_id, s.competition_unique_id FROM tender_snapshots s JOIN tenders_all t ON s.resource_id = t.resource_id AND s.competition_unique_id = t.competition_unique_id")
def _(spark, d):
    keys = ["resource_id", "competition_unique_id"]
    return table(spark, d, "tender_snapshots").select(*keys).distinct().join(_tenders(spark, d).select(*keys).distinct(), keys)


@query("j7_anti_both_keys", "SELECT DISTINCT t.resource_id, t.competition_unique_id FROM tenders_all t WHERE NOT EXISTS (SELECT 1 FROM tender_snapshots s WHERE s.resource_id = t.resource_id AND s.competition_unique_id = t.competition_unique_id)")
def _(spark, d):
    keys = ["resource_id", "competition_unique_id"]
    return _tenders(spark, d).select(*keys).distinct().join(table(spark, d, "tender_snapshots").select(*keys).distinct(), keys, "left_anti")


@query("j8_keep_current_guarded", "SELECT id FROM tenders_all WHERE resource_id IN (SELECT resource_id FROM tender_snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM tender_snapshots))")
def _(spark, d):
    s = table(spark, d, "tender_snapshots")
    last = s.join(F.broadcast(s.agg(F.max("snapshot_date").alias("snapshot_date"))), "snapshot_date")  # one row
    return R.keep_known(_tenders(spark, d), last, ["resource_id"]).select("id")


@query("j10_tiered_lookup", "WITH c AS (SELECT competition_unique_id AS k, min(title) AS title FROM tender_snapshots WHERE title IS NOT NULL AND competition_unique_id IS NOT NULL GROUP BY 1), r AS (SELECT resource_id AS k, min(title) AS title FROM tender_snapshots WHERE title IS NOT NULL AND resource_id IS NOT NULL GROUP BY 1), a AS (SELECT resource_id AS k, min(title) AS title FROM tenders_all WHERE title IS NOT NULL AND resource_id IS NOT NULL GROUP BY 1) SELECT t.id, coalesce(c.title, r.title, a.title) AS title, CASE WHEN c.k IS NOT NULL THEN 1 WHEN r.k IS NOT NULL THEN 2 WHEN a.k IS NOT NULL THEN 3 END AS tier FROM tenders_all t LEFT JOIN c ON t.competition_unique_id = c.k LEFT JOIN r ON t.resource_id = r.k LEFT JOIN a ON t.resource_id = a.k")
def _(spark, d):
    now, all_ = table(spark, d, "tender_snapshots").where("title is not null"), _tenders(spark, d)
    asked = all_.select("id", "competition_unique_id", "resource_id")
    tiers = [(now, "competition_unique_id", "competition_unique_id"), (now, "resource_id", "resource_id"), (all_.where("title is not null"), "resource_id", "resource_id")]
    return R.tiered_lookup(asked, tiers, ["title"]).select("id", "title", "tier")


@query("j11_manifest_changes", "WITH s AS (SELECT snapshot_date AS snap, resource_id, max(md5(coalesce(detailed_description, ''))) AS h, max(length(coalesce(title, ''))) AS s FROM tender_snapshots WHERE resource_id IS NOT NULL GROUP BY 1, 2), o AS (SELECT * FROM s WHERE snap = (SELECT min(snap) FROM s)), n AS (SELECT * FROM s WHERE snap = (SELECT max(snap) FROM s)) SELECT resource_id, CASE WHEN o.h IS NULL THEN 'new' WHEN n.h IS NULL THEN 'deleted' ELSE 'changed' END AS state FROM o FULL JOIN n USING (resource_id) WHERE o.h IS NULL OR n.h IS NULL OR o.h <> n.h OR o.s <> n.s")
def _(spark, d):
    """The first snapshot as the manifest, the last as what has landed."""
    snaps = table(spark, d, "tender_snapshots").where("resource_id is not null")
    rows = snaps.groupBy(F.col("snapshot_date").alias("at"), "resource_id").agg(
        F.max(F.md5(F.coalesce("detailed_description", F.lit("")))).alias("h"), F.max(F.length(F.coalesce("title", F.lit("")))).alias("s")
    )
    ends = snaps.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))  # one row
    both = rows.join(F.broadcast(ends), (F.col("at") == F.col("first")) | (F.col("at") == F.col("last")))
    return R.manifest_changes(both.where("at = first"), both.where("at = last"), ["resource_id"], ["h", "s"])


@query("j13_mirror_differences", "SELECT resource_id, 'left' AS side FROM (SELECT DISTINCT resource_id FROM awards_all EXCEPT SELECT DISTINCT resource_id FROM award_details_all) UNION ALL SELECT resource_id, 'right' FROM (SELECT DISTINCT resource_id FROM award_details_all EXCEPT SELECT DISTINCT resource_id FROM awards_all)")
def _(spark, d):
    return R.mirror_differences(table(spark, d, "awards_all"), table(spark, d, "award_details_all"), "resource_id")


@query("j16_event_enrichment", "SELECT e.event_id, c.c_name, n.n_name FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    e = table(spark, d, "events").select("event_id", "user_id")
    return e.join(c, F.col("user_id") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("event_id", "c_name", "n_name")


@query("j9_j17_semi_join_cascade", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(o, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber", "l_quantity")


@query("s4_upsert", "WITH t AS (SELECT resource_id, max(title) AS title FROM awards_all WHERE resource_id IS NOT NULL GROUP BY 1), n AS (SELECT resource_id, max(title) AS title FROM award_details_all WHERE resource_id IS NOT NULL AND title IS NOT NULL GROUP BY 1) SELECT * FROM t WHERE resource_id NOT IN (SELECT resource_id FROM n) UNION ALL SELECT * FROM n")
def _(spark, d):
    one = lambda n: table(spark, d, n).where("resource_id is not null").groupBy("resource_id").agg(F.max("title").alias("title"))
    return R.upsert(one("awards_all"), one("award_details_all").where("title is not null"), ["resource_id"])


@query("s5_d2_insert_new", "WITH t AS (SELECT resource_id, min(title) AS title FROM tender_snapshots WHERE snapshot_date <= '2026-01-19' GROUP BY 1), n AS (SELECT resource_id, min(title) AS title FROM tender_snapshots WHERE snapshot_date > '2026-01-19' GROUP BY 1) SELECT * FROM t UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.resource_id = n.resource_id)")
def _(spark, d):
    one = lambda w: table(spark, d, "tender_snapshots").where(w).groupBy("resource_id").agg(F.min("title").alias("title"))
    return R.insert_new(one("snapshot_date <= '2026-01-19'"), one("snapshot_date > '2026-01-19'"), ["resource_id"])


@query("s6_update_where", "SELECT id, CASE WHEN coalesce(status = 'Closed', false) THEN 'archived' ELSE status END AS status FROM tenders_all")
def _(spark, d):
    return R.update_where(_tenders(spark, d).select("id", "status"), F.col("status") == "Closed", {"status": F.lit("archived")})


@query("d9_b27_changed_fields", "WITH s AS (SELECT snapshot_date, resource_id, max(coalesce(title, '')) AS title, max(coalesce(status, '')) AS status, max(coalesce(procuring_entity, '')) AS procuring_entity FROM tender_snapshots GROUP BY ALL) SELECT n.snapshot_date, n.resource_id, array_to_string(list_filter([CASE WHEN n.title <> o.title THEN 'title' END, CASE WHEN n.status <> o.status THEN 'status' END, CASE WHEN n.procuring_entity <> o.procuring_entity THEN 'procuring_entity' END], lambda x: x IS NOT NULL), ',') AS changed FROM s n JOIN (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before FROM (SELECT DISTINCT snapshot_date FROM s WHERE snapshot_date IS NOT NULL)) d USING (snapshot_date) JOIN s o ON n.resource_id = o.resource_id AND o.snapshot_date = d.before WHERE n.title <> o.title OR n.status <> o.status OR n.procuring_entity <> o.procuring_entity")
def _(spark, d):
    fields = ["title", "status", "procuring_entity"]
    s = table(spark, d, "tender_snapshots").where("snapshot_date is not null")
    now = s.groupBy("snapshot_date", "resource_id").agg(*[F.max(F.coalesce(f, F.lit(""))).alias(f) for f in fields])
    # one row a snapshot; the window runs over that many rows only
    dates = s.select("snapshot_date").distinct().select("snapshot_date", F.lead("snapshot_date").over(Window.orderBy("snapshot_date")).alias("after"))
    before = now.join(F.broadcast(dates.where("after is not null")), "snapshot_date").drop("snapshot_date").withColumnRenamed("after", "snapshot_date")
    both = before.alias("o").join(now.alias("n"), ["snapshot_date", "resource_id"])
    return both.select("snapshot_date", "resource_id", F.array_join(R.changed_fields("o", "n", fields), ",").alias("changed")).where("changed <> ''")


# --- aggregations ---------------------------------------------------------------------------------------------------------------
@query("g1_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query("g2_completeness", "SELECT count(*) AS total, count(*) FILTER (detailed_description IS NOT NULL) AS with_details, count(*) - count(*) FILTER (detailed_description IS NOT NULL) AS without_details, count(*) FILTER (extraction_timestamp >= TIMESTAMPTZ '2026-01-01 00:00:00+00') AS recent, round(count(*) FILTER (detailed_description IS NOT NULL) * 100.0::DOUBLE / count(*), 2) AS rate FROM tenders_all")
def _(spark, d):
    return G.completeness(_tenders(spark, d), F.col("detailed_description").isNotNull(), F.col("extraction_timestamp") >= F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query("g3_facets", "SELECT dimension, value, count(*) AS n FROM (SELECT 'type' AS dimension, CASE WHEN trim(procurement_type) <> '' THEN procurement_type ELSE 'Unknown' END AS value FROM tenders_all UNION ALL SELECT 'funding', CASE WHEN trim(funding_source) <> '' THEN funding_source ELSE 'Unknown' END FROM tenders_all UNION ALL SELECT 'status', CASE WHEN trim(status) <> '' THEN status ELSE 'Unknown' END FROM tenders_all) GROUP BY ALL")
def _(spark, d):
    return G.facets(_tenders(spark, d), {"type": F.col("procurement_type"), "funding": F.col("funding_source"), "status": F.col("status")})


@query("g4_urgency_buckets", f"SELECT count(*) FILTER (days BETWEEN 0 AND 7) AS week, count(*) FILTER (days BETWEEN 0 AND 30) AS month FROM (SELECT floor((epoch_us(ts) - epoch_us(TIMESTAMP '{NOW}')) / 86400000000.0) AS days FROM events)")
def _(spark, d):
    days = S.floor_days(F.col("ts"), F.lit(NOW).cast("timestamp"))
    return table(spark, d, "events").select(days.alias("days")).agg(F.expr("count_if(days between 0 and 7)").alias("week"), F.expr("count_if(days between 0 and 30)").alias("month"))


@query("g5_coverage", "SELECT (resource_id IN (SELECT resource_id FROM award_details_all WHERE title IS NOT NULL)) AS covered, count(*) AS n FROM awards_all WHERE resource_id IS NOT NULL GROUP BY 1")
def _(spark, d):
    known = table(spark, d, "award_details_all").where("title is not null and resource_id is not null").select("resource_id").distinct().withColumn("hit", F.lit(True))
    a = table(spark, d, "awards_all").where("resource_id is not null").select("resource_id")
    return a.join(known, "resource_id", "left").groupBy(F.col("hit").isNotNull().alias("covered")).agg(F.count("*").alias("n"))


@query("g6_latest_value", "SELECT epoch_us(max(extraction_timestamp)) AS latest_micros FROM tenders_all")
def _(spark, d):
    return _tenders(spark, d).agg(F.unix_micros(F.max("extraction_timestamp")).alias("latest_micros"))


@query("g7_g10_histogram", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def _(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy("event_type")


@query("g8_first_valid", "SELECT resource_id, arg_min(title, id) FILTER (trim(title) <> '') AS title, arg_min(official_name, id) FILTER (trim(official_name) <> '') AS official_name FROM award_details_all GROUP BY 1")
def _(spark, d):
    by = table(spark, d, "award_details_all").groupBy("resource_id")
    return by.agg(G.first_valid(F.col("title"), F.col("id")).alias("title"), G.first_valid(F.col("official_name"), F.col("id")).alias("official_name"))


@query("g9_ordered_union", "SELECT resource_id, array_to_string(list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda p: list_position(l, p[1]) = p[2]), lambda p: p[1]), '|') AS words FROM (SELECT resource_id, flatten(list(string_split(title, ' ') ORDER BY id)) AS l FROM award_details_all WHERE title IS NOT NULL GROUP BY 1)")
def _(spark, d):
    a = table(spark, d, "award_details_all").where("title is not null").select("resource_id", "id", F.split("title", " ").alias("l"))
    return a.groupBy("resource_id").agg(F.array_join(G.ordered_union(F.col("l"), F.col("id")), "|").alias("words"))


@query("g12_grouped_ids", "SELECT c_nationkey, count(*) AS n, array_to_string(list_sort(list(c_custkey)), ',') AS ids FROM customer WHERE c_acctbal < 0 GROUP BY 1")
def _(spark, d):
    c = table(spark, d, "customer").where("c_acctbal < 0")
    return c.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("c_custkey")).cast("array<string>"), ",").alias("ids"))


_PACK = "SELECT tender_folder, doc_id, n_chars // 2 AS tokens FROM documents WHERE tender_folder IS NOT NULL"


@query("w2_g13_next_fit_packing", f"WITH RECURSIVE d AS (SELECT tender_folder, doc_id, coalesce(tokens, 0) AS tokens, row_number() OVER (PARTITION BY tender_folder ORDER BY doc_id) AS n FROM ({_PACK})), p AS (SELECT tender_folder, doc_id, tokens, n, 1 AS bin_no, tokens AS used FROM d WHERE n = 1 UNION ALL SELECT d.tender_folder, d.doc_id, d.tokens, d.n, CASE WHEN p.used + d.tokens > 13000 THEN p.bin_no + 1 ELSE p.bin_no END, CASE WHEN p.used + d.tokens > 13000 THEN d.tokens ELSE p.used + d.tokens END FROM p JOIN d ON d.tender_folder = p.tender_folder AND d.n = p.n + 1) SELECT tender_folder, max(bin_no) AS chunks, count(*) AS n FROM p GROUP BY 1")
def _(spark, d):
    docs = table(spark, d, "documents").where("tender_folder is not null").select("tender_folder", "doc_id", F.expr("coalesce(n_chars div 2, 0)").alias("tokens"))
    return G.next_fit(docs, ["tender_folder"], "doc_id", "tokens", 13_000).groupBy("tender_folder").agg(F.max("bin_no").alias("chunks"), F.count("*").alias("n"))


# --- order-dependent, sorting, sets ------------------------------------------------------------------------------------------------
@query("w1_first_of_each_key", "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events WHERE event_type <> 'view') WHERE n = 1")
def _(spark, d):
    e = table(spark, d, "events").where("event_type <> 'view'").select("event_id", "user_id", "event_type", "ts")
    return R.first_per_group(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type")


@query("w4_part_labels", "SELECT source_file, tender_resource_id, extension, CASE WHEN count(*) OVER w > 1 THEN '[part ' || row_number() OVER (PARTITION BY tender_resource_id ORDER BY source_file) || '/' || count(*) OVER w || ']' ELSE '' END AS label FROM (SELECT DISTINCT tender_resource_id, source_file, extension FROM extracted_documents) WINDOW w AS (PARTITION BY tender_resource_id)")
def _(spark, d):
    f = table(spark, d, "extracted_documents").select("tender_resource_id", "source_file", "extension").distinct()
    return f.withColumn("label", G.part_labels(["tender_resource_id"], "source_file"))


@query("w5_carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events")
def _(spark, d):
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return table(spark, d, "events").select("event_id", G.carry_forward(bought, ["user_id"], "event_id").alias("last_purchase"))


@query("o3_sort_nulls_last", "SELECT id, title FROM tenders_all ORDER BY lower(title) ASC NULLS LAST, id LIMIT 200")
def _(spark, d):
    return _tenders(spark, d).select("id", "title").orderBy(F.asc_nulls_last(F.lower("title")), "id").limit(200)


@query("o2_o4_page", "SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total_rows, (SELECT count(*) FROM orders) > 60 AS has_next FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.page(o, [-F.col("o_totalprice"), F.col("o_orderkey")], 3, 20)


@query("u1_u2_union_distinct", "SELECT resource_id, min(title) AS title FROM (SELECT resource_id, title FROM tenders_all UNION ALL SELECT resource_id, title FROM tender_snapshots) GROUP BY 1")
def _(spark, d):
    both = _tenders(spark, d).select("resource_id", "title").unionByName(table(spark, d, "tender_snapshots").select("resource_id", "title"))
    return both.groupBy("resource_id").agg(F.min("title").alias("title"))


@query("u3_set_difference", "SELECT DISTINCT procuring_entity FROM tenders_all EXCEPT SELECT DISTINCT procuring_entity FROM awards_all")
def _(spark, d):
    return _tenders(spark, d).select("procuring_entity").subtract(table(spark, d, "awards_all").select("procuring_entity"))


@query("u4_ordered_distinct_parts", "SELECT id, array_to_string(list_transform(list_filter(list_zip(p, range(1, len(p) + 1)), lambda z: z[1] <> '' AND list_position(p, z[1]) = z[2]), lambda z: z[1]), '|') AS parts FROM (SELECT id, list_transform(string_split(cpv_codes, ';'), lambda x: trim(x)) AS p FROM tenders_all WHERE cpv_codes IS NOT NULL)")
def _(spark, d):
    t = _tenders(spark, d).where("cpv_codes is not null")
    return t.select("id", F.array_join(S.distinct_parts(F.split("cpv_codes", ";")), "|").alias("parts"))


# --- scalar functions ---------------------------------------------------------------------------------------------------------------
@query("h1_h2_urls", "SELECT id, nullif(trim(regexp_extract(title_url, '[?&]resourceId=([^&#]*)', 1)), '') AS rid, CASE WHEN trim(title_url) = '' OR title_url IS NULL THEN NULL WHEN regexp_matches(title_url, '^https?://') THEN title_url WHEN starts_with(title_url, '/') THEN 'https://tenders.invalid' || title_url ELSE 'https://tenders.invalid/' || title_url END AS url FROM tenders_all")
def _(spark, d):
    u = F.col("title_url")
    return _tenders(spark, d).select("id", S.url_parameter(u).alias("rid"), S.absolute_url(u, "https://tenders.invalid").alias("url"))


@query("h3_h4_local_to_utc", "SELECT id, epoch_us(coalesce(try_strptime(v, '%d/%m/%Y %H:%M:%S'), try_strptime(v, '%d/%m/%Y %H:%M'))) + 18000000000 AS utc_micros FROM (SELECT id, trim(regexp_replace(publication_date, '[\\s\\x{00a0}]+', ' ', 'g')) AS v FROM tenders_all) WHERE regexp_matches(v, '^\\d{1,2}/\\d{1,2}/\\d{4} \\d{1,2}:\\d{2}(:\\d{2})?$') AND coalesce(try_strptime(v, '%d/%m/%Y %H:%M:%S'), try_strptime(v, '%d/%m/%Y %H:%M')) IS NOT NULL")
def _(spark, d):
    return _tenders(spark, d).select("id", F.unix_micros(S.local_to_utc(F.col("publication_date"))).alias("utc_micros")).where("utc_micros is not null")


@query("h5_pair_of_ints", "SELECT doc_id, nullif(regexp_extract(v, '^\\s*(\\d+)\\s*/\\s*(\\d+)\\s*$', 1), '')::INT AS first, nullif(regexp_extract(v, '^\\s*(\\d+)\\s*/\\s*(\\d+)\\s*$', 2), '')::INT AS second FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id || '/x' ELSE (doc_id % 100) || ' / ' || (doc_id % 7) END AS v FROM documents)")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("doc_id", F.lit("/x"))).otherwise(F.concat(F.col("doc_id") % 100, F.lit(" / "), F.col("doc_id") % 7)).alias("v"))
    return docs.select("doc_id", S.pair_of_ints(F.col("v")).alias("p")).select("doc_id", "p.first", "p.second")


@query("h6_h7_safe_names", "SELECT DISTINCT source_file, regexp_replace(source_file, '[^A-Za-z0-9\\-_.() ]', '_', 'g') AS file_name, regexp_replace(source_file, '[^\\p{L}\\p{N}_\\-.]+', '_', 'g') AS folder FROM extracted_documents")
def _(spark, d):
    f = table(spark, d, "extracted_documents").select("source_file").distinct()
    return f.select("source_file", S.safe_file_name(F.col("source_file")).alias("file_name"), S.safe_folder(F.col("source_file")).alias("folder"))


@query("h9_snake_keys", "SELECT DISTINCT procurement_method, regexp_replace(regexp_replace(lower(procurement_method), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS key FROM awards_all")
def _(spark, d):
    m = table(spark, d, "awards_all").select("procurement_method").distinct()
    return m.select("procurement_method", S.snake_key(F.col("procurement_method")).alias("key"))


@query("h10_plain_money", "SELECT id, TRY_CAST(regexp_replace(contract_price_amount, '[^0-9.\\-]', '', 'g') AS DECIMAL(18,2))::VARCHAR AS amount FROM award_details_all")
def _(spark, d):
    return table(spark, d, "award_details_all").select("id", S.plain_money(F.col("contract_price_amount")).cast("string").alias("amount"))


@query("h14_h15_h16_coercions", "SELECT event_id, lower(trim(v)) IN ('true', 'yes', '1', 'on') AS flag, CASE WHEN regexp_matches(trim(v), '^\\d+$') THEN TRY_CAST(trim(v) AS INT) END AS number FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN ' Yes' WHEN 1 THEN '1' WHEN 2 THEN 'no' WHEN 3 THEN '12 ' END AS v FROM events)")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", F.expr("case event_id % 5 when 0 then ' Yes' when 1 then '1' when 2 then 'no' when 3 then '12 ' end").alias("v"))
    return e.select("event_id", S.to_boolean(F.col("v")).alias("flag"), S.whole_number(F.col("v")).alias("number"))


RULES = [("addendum", "addendum"), ("clarification|question", "clarification"), ("site (visit|office)", "site"), ("award", "award")]


@query("h17_first_rule", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)addendum') THEN 'addendum' WHEN regexp_matches(text, '(?i)clarification|question') THEN 'clarification' WHEN regexp_matches(text, '(?i)site (visit|office)') THEN 'site' WHEN regexp_matches(text, '(?i)award') THEN 'award' ELSE 'other' END AS kind FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", S.first_rule(F.col("text"), RULES, "other").alias("kind"))


@query("h18_h19_ids_from_text", "SELECT doc_id, coalesce(nullif(regexp_extract(text, '[Aa]ddendum no\\. (\\d+)', 1), ''), nullif(regexp_extract(text, '[Cc]lause (\\d+\\.\\d+)', 1), '')) AS found FROM documents")
def _(spark, d):
    pick = lambda p: F.nullif(F.regexp_extract("text", p, 1), F.lit(""))
    return table(spark, d, "documents").select("doc_id", F.coalesce(pick(r"[Aa]ddendum no\. (\d+)"), pick(r"[Cc]lause (\d+\.\d+)")).alias("found"))


@query("h22_price_and_currency", "SELECT id, nullif(trim(regexp_extract(contract_price_raw, '^(.*?)\\s*Currency:\\s*(\\S+)', 1)), '') AS price, nullif(regexp_extract(contract_price_raw, '^(.*?)\\s*Currency:\\s*(\\S+)', 2), '') AS currency FROM award_details_all")
def _(spark, d):
    p = r"^(.*?)\s*Currency:\s*(\S+)"
    pick = lambda i: F.nullif(F.trim(F.regexp_extract("contract_price_raw", p, i)), F.lit(""))
    return table(spark, d, "award_details_all").select("id", pick(1).alias("price"), pick(2).alias("currency"))


@query("h23_fenced_json", "SELECT event_id, json_extract_string(props, '$.k') AS k, length(props) AS n FROM events")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "props", F.concat(F.lit("```json\n"), "props", F.lit("\n```")).alias("fenced"))
    return e.select("event_id", S.unfenced_json(F.col("fenced"), "map<string,string>")["k"].alias("k"), F.length("props").alias("n"))


@query("h24_h27_tokens_and_hash", "SELECT doc_id, coalesce(length(text) // 2, 0) AS tokens, md5(text) AS hash FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", S.estimated_tokens(F.col("text")).alias("tokens"), F.md5("text").alias("hash"))


@query("h26_extensions", "SELECT lower(regexp_extract(source_file, '(\\.[^./]+)$', 1)) AS ext, regexp_extract(pdf_path, '([^/]*)$', 1) AS base, count(*) AS n FROM extracted_documents CROSS JOIN (SELECT min(pdf_path) AS pdf_path FROM award_details_all) GROUP BY ALL")
def _(spark, d):
    least = table(spark, d, "award_details_all").agg(F.min("pdf_path").alias("pdf_path"))
    f = table(spark, d, "extracted_documents").select("source_file").join(F.broadcast(least))  # one row
    return f.groupBy(S.file_extension(F.col("source_file")).alias("ext"), S.base_name(F.col("pdf_path")).alias("base")).agg(F.count("*").alias("n"))


@query("h30_j14_first_keyword", "SELECT id, coalesce(list_filter(regexp_split_to_array(trim(title), '\\s+'), lambda w: length(w) > 4)[1], substr(title, 1, 20)) AS keyword FROM tenders_all")
def _(spark, d):
    return _tenders(spark, d).select("id", S.first_keyword(F.col("title")).alias("keyword"))


@query("h29_s2_csv_flatten", "SELECT tender_resource_id, source_file, array_to_string(list_transform(content.chunks, lambda c: c.text), ' | ') AS chunks FROM extracted_documents WHERE content.chunks IS NOT NULL")
def _(spark, d):
    f = table(spark, d, "extracted_documents").where("content.chunks is not null")
    return sinks.flat_columns(f.select("tender_resource_id", "source_file", F.col("content.chunks.text").alias("chunks")))


@query("pj2_listing_projection", "SELECT nullif(trim(regexp_extract(title_url, '[?&]resourceId=([^&#]*)', 1)), '') AS resource_id, CASE WHEN trim(title) <> '' THEN title ELSE 'Untitled' END AS title, TRY_CAST(row_no AS INT) AS row_no, coalesce(status, 'Unknown') AS status FROM tenders_all WHERE nullif(trim(regexp_extract(title_url, '[?&]resourceId=([^&#]*)', 1)), '') IS NOT NULL")
def _(spark, d):
    t = _tenders(spark, d)
    return t.select(
        S.url_parameter(F.col("title_url")).alias("resource_id"), F.when(F.trim("title") != "", F.col("title")).otherwise("Untitled").alias("title"),
        F.col("row_no").try_cast("int").alias("row_no"), F.coalesce("status", F.lit("Unknown")).alias("status"),
    ).where("resource_id is not null")


@query("pj8_header_block", "SELECT id, concat_ws(chr(10), 'Title: ' || coalesce(nullif(trim(title), ''), 'Not stated'), 'Entity: ' || coalesce(nullif(trim(procuring_entity), ''), 'Not stated'), 'Codes: ' || coalesce(nullif(trim(cpv_codes), ''), 'None')) AS header FROM tenders_all")
def _(spark, d):
    line = lambda label, c, none: F.concat(F.lit(f"{label}: "), F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(none)))
    return _tenders(spark, d).select("id", F.concat_ws("\n", line("Title", "title", "Not stated"), line("Entity", "procuring_entity", "Not stated"), line("Codes", "cpv_codes", "None")).alias("header"))


# --- further rows of the inventory ----------------------------------------------------------------------------------------------------
@query("a9_u1_paged_union", "SELECT id, 'tender' AS kind FROM tenders_all UNION ALL SELECT id, 'award' FROM awards_all")
def _(spark, d):
    return _tenders(spark, d).select("id", F.lit("tender").alias("kind")).unionByName(table(spark, d, "awards_all").select("id", F.lit("award").alias("kind")))


@query("a12_fields_to_rows", "SELECT id, unnest(['title', 'status', 'funding_source']) AS label, unnest([title, status, funding_source]) AS value FROM tenders_all")
def _(spark, d):
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in ("title", "status", "funding_source")])
    return _tenders(spark, d).select("id", F.explode(pairs).alias("p")).select("id", "p.label", "p.value")


@query("a25_manifest_defaults", "SELECT DISTINCT t.resource_id, coalesce(f.n, 0)::BIGINT AS n_files FROM tenders_all t LEFT JOIN (SELECT tender_resource_id, count(DISTINCT source_file) AS n FROM extracted_documents GROUP BY 1) f ON t.resource_id = f.tender_resource_id")
def _(spark, d):
    n = table(spark, d, "extracted_documents").groupBy(F.col("tender_resource_id").alias("resource_id")).agg(F.countDistinct("source_file").alias("n"))
    return _tenders(spark, d).select("resource_id").distinct().join(n, "resource_id", "left").select("resource_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_files"))


@query("b5_b13_chained_filters", "SELECT id FROM tenders_all WHERE lower(procurement_type) = 'works' AND (contains(lower(coalesce(title, '')), 'bridge') OR contains(lower(coalesce(detailed_description, '')), 'bridge') OR contains(lower(coalesce(funding_source, '')), 'bridge')) AND contains(competition_unique_id, '2026')")
def _(spark, d):
    has = [F.lower(F.coalesce(c, F.lit(""))).contains("bridge") for c in ("title", "detailed_description", "funding_source")]
    t = _tenders(spark, d).where(F.lower("procurement_type") == "works").where(R.any_of(*has))
    return t.where(F.col("competition_unique_id").contains("2026")).select("id")


@query("b15_past_dropped", f"SELECT event_id FROM events WHERE NOT coalesce(ts < TIMESTAMP '{NOW}', false)")
def _(spark, d):
    return R.delete_where(table(spark, d, "events"), F.expr(f"ts < timestamp_ntz '{NOW}'")).select("event_id")


@query("b17_future_or_unknown", f"SELECT o_orderkey FROM orders WHERE coalesce(o_orderdate > TIMESTAMP '1997-01-01', true)")
def _(spark, d):
    return table(spark, d, "orders").where("coalesce(o_orderdate > timestamp_ntz '1997-01-01 00:00:00', true)").select("o_orderkey")


@query("b22_stale_since", "SELECT tender_resource_id, max(epoch_us(extraction_timestamp)) AS last_micros FROM extracted_documents GROUP BY 1 HAVING max(extraction_timestamp) < TIMESTAMPTZ '2025-06-01 00:00:00+00'")
def _(spark, d):
    g = table(spark, d, "extracted_documents").groupBy("tender_resource_id").agg(F.max("extraction_timestamp").alias("m"))
    return g.where(F.col("m") < F.lit("2025-06-01 00:00:00").cast("timestamp")).select("tender_resource_id", F.unix_micros("m").alias("last_micros"))


@query("b23_pending_folders", "SELECT DISTINCT d.tender_folder FROM documents d WHERE d.tender_folder IS NOT NULL AND d.tender_folder NOT LIKE 'RFQ%' AND d.tender_folder NOT IN (SELECT replace(competition_unique_id, '/', '_') FROM tender_snapshots WHERE competition_unique_id IS NOT NULL)")
def _(spark, d):
    folders = table(spark, d, "documents").where("tender_folder is not null and tender_folder not like 'RFQ%'").select("tender_folder").distinct()
    done = table(spark, d, "tender_snapshots").where("competition_unique_id is not null").select(F.replace("competition_unique_id", F.lit("/"), F.lit("_")).alias("tender_folder")).distinct()
    return folders.join(done, "tender_folder", "left_anti")


@query("j5_restore_from_mirror", "WITH m AS (SELECT resource_id, min(competition_unique_id) AS uid FROM tender_snapshots WHERE trim(competition_unique_id) <> '' GROUP BY 1) SELECT t.id, coalesce(nullif(trim(t.competition_unique_id), ''), m.uid) AS competition_unique_id FROM tenders_all t LEFT JOIN m ON t.resource_id = m.resource_id")
def _(spark, d):
    mirror = table(spark, d, "tender_snapshots").where("trim(competition_unique_id) <> ''").groupBy("resource_id").agg(F.min("competition_unique_id").alias("uid"))
    own = _tenders(spark, d).select("id", "resource_id", F.nullif(F.trim("competition_unique_id"), F.lit("")).alias("own"))
    return own.join(mirror, "resource_id", "left").select("id", F.coalesce("own", "uid").alias("competition_unique_id"))


@query("j12_changes_by_base_name", "WITH o AS (SELECT DISTINCT source_file AS f FROM extracted_documents WHERE extraction_status = 'completed'), n AS (SELECT DISTINCT regexp_extract('docs/' || source_file, '([^/]*)$', 1) AS f FROM extracted_documents WHERE extension <> '.txt') SELECT f, CASE WHEN o.f IS NULL THEN 'new' ELSE 'deleted' END AS state FROM o FULL JOIN n USING (f) WHERE o.f IS NULL OR n.f IS NULL")
def _(spark, d):
    e = table(spark, d, "extracted_documents").select("source_file", "extension", "extraction_status")
    old = e.where("extraction_status = 'completed'").select(F.col("source_file").alias("f")).distinct().withColumn("x", F.lit(1))
    new = e.where("extension <> '.txt'").select(S.base_name(F.concat(F.lit("docs/"), "source_file")).alias("f")).distinct().withColumn("x", F.lit(1))
    return R.manifest_changes(old, new, ["f"], ["x"])


@query("pj3_renamed_patch", "SELECT resource_id, title AS name, cpv_codes AS codes, cpv_codes AS codes_raw FROM award_details_all WHERE title IS NOT NULL OR cpv_codes IS NOT NULL")
def _(spark, d):
    a = table(spark, d, "award_details_all").where("title is not null or cpv_codes is not null")
    return a.select("resource_id", F.col("title").alias("name"), F.col("cpv_codes").alias("codes"), F.col("cpv_codes").alias("codes_raw"))


@query("pj4_pj5_whitelist_defaults", "SELECT coalesce(TRY_CAST(row_no AS INT), 0) AS row_no, coalesce(title, '') AS title, coalesce(status, 'Open') AS status, false AS is_active FROM tenders_all")
def _(spark, d):
    return _tenders(spark, d).select(
        F.coalesce(F.col("row_no").try_cast("int"), F.lit(0)).alias("row_no"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("status", F.lit("Open")).alias("status"), F.lit(False).alias("is_active")
    )


@query("pj6_pj7_summary_view", "WITH d AS (SELECT resource_id, max(nullif(title, '')) AS title FROM award_details_all GROUP BY 1) SELECT a.id, coalesce(nullif(a.title, ''), d.title, 'Untitled') AS title, d.title IS NOT NULL AS has_notice FROM awards_all a LEFT JOIN d USING (resource_id)")
def _(spark, d):
    one = table(spark, d, "award_details_all").groupBy("resource_id").agg(F.max(F.nullif("title", F.lit(""))).alias("dt"))
    a = table(spark, d, "awards_all").select("id", "resource_id", "title").join(one, "resource_id", "left")
    return a.select("id", F.coalesce(F.nullif("title", F.lit("")), "dt", F.lit("Untitled")).alias("title"), F.col("dt").isNotNull().alias("has_notice"))


@query("pj9_prefixed_columns", "SELECT id AS db_id, title AS db_title, status AS db_status FROM tenders_all")
def _(spark, d):
    return _tenders(spark, d).select(*[F.col(c).alias(f"db_{c}") for c in ("id", "title", "status")])


@query("pj12_file_names", "SELECT id, concat_ws('_', resource_id, coalesce(pdf_resource_id, 'contract'), row_no) || '.pdf' AS file_name FROM awards_all")
def _(spark, d):
    return table(spark, d, "awards_all").select("id", F.concat(F.concat_ws("_", "resource_id", F.coalesce("pdf_resource_id", F.lit("contract")), "row_no"), F.lit(".pdf")).alias("file_name"))


@query("h12_h13_iso_instants", "SELECT id, epoch_us(TRY_CAST(award_date_raw AS TIMESTAMPTZ)) AS utc_micros FROM awards_all WHERE regexp_matches(award_date_raw, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(Z|[+-]\\d{2}:\\d{2})$')")
def _(spark, d):
    a = table(spark, d, "awards_all").where(F.col("award_date_raw").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$"))
    return a.select("id", F.unix_micros(F.col("award_date_raw").try_cast("timestamp")).alias("utc_micros"))


@query("h20_h21_labelled_sections", "SELECT doc_id, nullif(regexp_extract(text, 'Clause (\\d+\\.\\d+): ([^.]*)\\.', 2), '') AS duty, nullif(regexp_extract(text, 'before (\\d{1,2} [A-Z][a-z]+ \\d{4})', 1), '') AS before FROM documents")
def _(spark, d):
    pick = lambda p, i: F.nullif(F.regexp_extract("text", p, i), F.lit(""))
    return table(spark, d, "documents").select("doc_id", pick(r"Clause (\d+\.\d+): ([^.]*)\.", 2).alias("duty"), pick(r"before (\d{1,2} [A-Z][a-z]+ \d{4})", 1).alias("before"))


@query("h28_base64url", "SELECT doc_id, coalesce(source, '') || '/' || coalesce(text, '') AS back FROM documents")
def _(spark, d):
    """Whole texts, coded as a mail service codes them and read again."""
    plain = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("text", F.lit("")))
    code = F.regexp_replace(F.translate(F.regexp_replace(F.base64(F.encode(plain, "UTF-8")), "[\r\n]", ""), "+/", "-_"), "=+$", "")
    return table(spark, d, "documents").select("doc_id", S.from_base64url(code).alias("back"))


@query("o6_o7_capped_lists", "SELECT c_nationkey, array_to_string(list_sort(list(c_custkey))[1:5], ',') AS first_ids FROM customer GROUP BY 1 ORDER BY 1 LIMIT 10")
def _(spark, d):
    """Five a group, by a group limit before anything is gathered."""
    n = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    five = table(spark, d, "customer").select("c_nationkey", "c_custkey", n.alias("n")).where("n <= 5")
    c = five.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_list("c_custkey")).cast("array<string>"), ",").alias("first_ids"))
    return c.orderBy("c_nationkey").limit(10)


@query("d13_skip_done_or_failed", "SELECT tender_resource_id, source_file FROM extracted_documents GROUP BY 1, 2 HAVING count(*) FILTER (extraction_status IN ('completed', 'failed')) = 0")
def _(spark, d):
    e = table(spark, d, "extracted_documents").select("tender_resource_id", "source_file", "extraction_status")
    done = e.where(F.col("extraction_status").isin("completed", "failed")).select("tender_resource_id", "source_file").distinct()
    return e.select("tender_resource_id", "source_file").distinct().join(done, ["tender_resource_id", "source_file"], "left_anti")
