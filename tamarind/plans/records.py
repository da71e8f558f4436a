"""Queries of whole operators over records, documents and messages, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tamarind.functions import scalars as S
from tamarind.functions.notice import notice_fields
from tamarind.operators import relations as R
from tamarind.operators import search as Q
from tamarind.operators import summaries as G
from tamarind.plans.reference import query
from tamarind.session import _folder, table
from tamarind.sources import landing
from tamarind.streaming import ingest

NOW = "2026-01-20 12:00:00+00:00"
_ISO = r"'^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$'"


def _iso(c: str) -> str:
    """SQL for :func:`iso_instant`."""
    zoned = f"CASE WHEN length({c}) = 10 THEN {c} || 'T00:00:00Z' WHEN regexp_matches({c}, '(Z|[+-]\\d{{2}}:\\d{{2}})$') THEN {c} ELSE {c} || 'Z' END"
    return f"(CASE WHEN regexp_matches({c}, {_ISO}) THEN TRY_CAST({zoned} AS TIMESTAMPTZ) END)"


# --- search -----------------------------------------------------------------------------------------------------------------------
_SEARCH = """
WITH a AS (SELECT competition_unique_id AS k, min(struct_pack(contract_type := procurement_type, scope_of_work := detailed_description, contract_title := title)) AS a
  FROM tender_snapshots WHERE competition_unique_id IS NOT NULL GROUP BY 1),
t AS (SELECT id, resource_id, competition_unique_id, title, procuring_entity, procurement_type, detailed_description, funding_source, submission_deadline, a.a AS a,
  list_filter(list_transform(string_split(coalesce(cpv_codes, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS codes, @dl AS dl
  FROM tenders_all LEFT JOIN a ON competition_unique_id = a.k),
f AS (SELECT * FROM t WHERE @tests)
SELECT id, title, a IS NOT NULL AS has_analysis, (SELECT count(*) FROM f) AS total_rows, (SELECT count(*) FROM f) > @upto AS has_next
FROM f ORDER BY @order LIMIT @size OFFSET @skip"""


def _search_sql(tests: str, order: str, size: int, skip: int) -> str:
    values = {"@tests": tests, "@order": order, "@size": str(size), "@skip": str(skip), "@upto": str(size + skip), "@dl": _iso("submission_deadline")}
    out = _SEARCH
    for k, v in values.items():
        out = out.replace(k, v)
    return out


def _searched(spark, d, **given):  # noqa: ANN001, ANN003, ANN202
    t = table(spark, d, "tenders_all").select(
        "id", "resource_id", "competition_unique_id", "title", "procuring_entity", "procurement_type", "detailed_description", "funding_source",
        "submission_deadline", "publication_date", S.to_list(F.col("cpv_codes")).alias("cpv_codes"),
    )
    a = table(spark, d, "tender_snapshots").select(
        "competition_unique_id", F.col("procurement_type").alias("contract_type"), F.col("detailed_description").alias("scope_of_work"), F.col("title").alias("contract_title")
    )
    return Q.search(t, a, "competition_unique_id", NOW, **given).select("id", "title", "has_analysis", "total_rows", "has_next")


_ALL = (
    "a IS NOT NULL AND contains(lower(coalesce(a.contract_type, '')), 'works') AND contains(lower(coalesce(procurement_type, '')), 'works') "
    "AND dl IS NOT NULL AND dl >= TIMESTAMPTZ '2020-01-01 00:00:00+00' AND dl <= TIMESTAMPTZ '2027-01-01 00:00:00+00' "
    "AND contains(lower(concat_ws(' ', nullif(title, ''), nullif(procuring_entity, ''), nullif(detailed_description, ''), nullif(a.scope_of_work, ''), nullif(a.contract_title, ''))), 're')"
)


@query("search_all_filters", _search_sql(tests=_ALL, order="dl, id", size=20, skip=0))
def _(spark, d):
    return _searched(spark, d, q=" RE ", contract_type="Works", procurement_type="works", has_analysis=True, deadline_after="2020-01-01", deadline_before="2027-01-01T00:00:00Z")


@query("search_closing_and_codes", _search_sql(tests="coalesce(list_bool_or(list_transform(codes, lambda c: contains(c, '-'))), false) AND coalesce(floor((epoch_us(dl) - epoch_us(TIMESTAMPTZ '" + NOW + "')) / 86400000000) BETWEEN 0 AND 400, false)", order="dl DESC NULLS LAST, id", size=10, skip=10))
def _(spark, d):
    """Second page, latest deadline first; the bound that is no date is ignored."""
    return _searched(spark, d, cpv="-", closing_within_days=400, deadline_after="soon", sort="deadline_desc", number=2, size=10)


@query("search_without_analysis", _search_sql(tests="a IS NULL AND contains(lower(coalesce(funding_source, '')), 'gov')", order="id", size=20, skip=0))
def _(spark, d):
    """A sort that is not known sorts by key only."""
    return _searched(spark, d, has_analysis=False, funding_source="GOV", sort="by_colour")


@query("o3_sorts", f"(SELECT 'published' AS sort, id FROM tenders_all ORDER BY {_iso('publication_date')} DESC NULLS LAST, id LIMIT 50) UNION ALL (SELECT 'entity', id FROM tenders_all ORDER BY lower(coalesce(procuring_entity, '')), id LIMIT 50) UNION ALL (SELECT 'deadline', id FROM tenders_all ORDER BY {_iso('submission_deadline')} DESC NULLS LAST, id LIMIT 50)")
def _(spark, d):
    """The first fifty by each sort, each a top-k pass."""
    t = table(spark, d, "tenders_all")
    sorts = {
        "published": S.iso_instant(F.col("publication_date")).desc_nulls_last(), "entity": F.lower(F.coalesce("procuring_entity", F.lit(""))),
        "deadline": S.iso_instant(F.col("submission_deadline")).desc_nulls_last(),
    }
    tops = [t.orderBy(order, "id").limit(50).select(F.lit(name).alias("sort"), "id") for name, order in sorts.items()]
    return tops[0].unionByName(tops[1]).unionByName(tops[2])


# --- candidates -------------------------------------------------------------------------------------------------------------------
_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda w: w <> ''))"


@query("j14_j15_best_candidate", rf"""
WITH q AS (SELECT resource_id, min(title) AS title FROM award_details_all WHERE title IS NOT NULL AND resource_id IS NOT NULL GROUP BY 1),
c AS (SELECT resource_id AS rid, min(title) AS t FROM tenders_all WHERE trim(title) <> '' AND resource_id IS NOT NULL GROUP BY 1),
k AS (SELECT *, lower(coalesce(list_filter(regexp_split_to_array(trim(title), '\s+'), lambda w: length(w) > 4)[1], substr(trim(title), 1, 20))) AS kw FROM q),
m AS (SELECT k.resource_id, k.title, c.rid, c.t, row_number() OVER (PARTITION BY k.resource_id ORDER BY c.rid, c.t) AS n FROM k JOIN c ON kw <> '' AND contains(lower(c.t), kw)),
s AS (SELECT resource_id, rid, t, coalesce(len(list_intersect({_WORDS.format('title')}, {_WORDS.format('t')})) / nullif(len(list_distinct(list_concat({_WORDS.format('title')}, {_WORDS.format('t')}))), 0), 0) AS confidence FROM m WHERE n <= 20)
SELECT resource_id, rid, round(confidence, 6) AS confidence FROM s WHERE confidence >= 0.7 QUALIFY row_number() OVER (PARTITION BY resource_id ORDER BY confidence DESC, rid) = 1""")
def _(spark, d):
    """The tenders whose title holds the notice's first longer word, at most twenty; the best is taken if its score reaches 0.70."""
    q = table(spark, d, "award_details_all").where("title is not null and resource_id is not null").groupBy("resource_id").agg(F.min("title").alias("title"))
    c = table(spark, d, "tenders_all").where("trim(title) <> '' and resource_id is not null").groupBy(F.col("resource_id").alias("rid")).agg(F.min("title").alias("t"))
    found = Q.keyword_candidates(q, c, "resource_id", "title", "rid", "t").where("trim(title) <> ''")
    best = Q.best_match(found, "resource_id", lambda _: Q.word_overlap(F.col("title"), F.col("t")), "rid")
    return best.select("resource_id", "rid", F.round("confidence", 6).alias("confidence"))


# --- documents --------------------------------------------------------------------------------------------------------------------
_STRIP = r"regexp_replace({0}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"
_KEPT = "list_filter({0}, lambda y: y <> '')"
_TEXT = f"""(CASE WHEN content.markdown IS NULL AND content.raw_text IS NULL AND content.chunks IS NULL AND content.pages IS NULL AND content.slides IS NULL THEN NULL ELSE
 array_to_string(list_concat(
  list_filter(list_concat(coalesce(list_transform(content.chunks, lambda c: {_STRIP.format("coalesce(c.text, '')")}), []),
   coalesce(flatten(list_transform(content.pages, lambda p: list_concat([{_STRIP.format("coalesce(p.text, '')")}], coalesce(list_transform(p.tables, lambda t:
    array_to_string(list_filter(list_transform(t, lambda r: array_to_string(list_filter(list_transform(r, lambda x: {_STRIP.format("coalesce(x, '')")}), lambda y: y <> ''), ' | ')), lambda y: y <> ''), chr(10))), [])))), [])), lambda y: y <> ''),
  CASE WHEN content.markdown IS NOT NULL AND content.chunks IS NULL AND content.pages IS NULL THEN [content.markdown] ELSE [] END,
  coalesce(flatten(list_transform(content.slides, lambda s: list_filter(s.texts, lambda y: y IS NOT NULL))), []),
  CASE WHEN content.raw_text IS NOT NULL THEN [content.raw_text] ELSE [] END), chr(10) || chr(10)) END)"""
_ARM = "CASE WHEN content.markdown IS NOT NULL THEN 'markdown' WHEN content.raw_text IS NOT NULL THEN 'raw_text' WHEN content.chunks IS NOT NULL THEN 'chunks' WHEN content.pages IS NOT NULL THEN 'pages' WHEN content.slides IS NOT NULL THEN 'slides' ELSE 'none' END"


@query("h25_text_of_arms", f"SELECT tender_resource_id, source_file, length({_TEXT}) AS n, {_ARM} AS arm, md5({_TEXT}) AS digest FROM extracted_documents")
def _(spark, d):
    """The text of every document from whichever arms it has."""
    arm = F.lit("none")
    for a in ("slides", "pages", "chunks", "raw_text", "markdown"):
        arm = F.when(F.col(f"content.{a}").isNotNull(), a).otherwise(arm)
    t = table(spark, d, "extracted_documents").select("tender_resource_id", "source_file", S.document_text(F.col("content")).alias("t"), arm.alias("arm"))
    return t.select("tender_resource_id", "source_file", F.length("t").alias("n"), "arm", F.md5("t").alias("digest"))


@query("g11_tokens_and_files", f"SELECT tender_resource_id, sum(coalesce(length({_TEXT}) // 4, 0))::BIGINT AS tokens, count(DISTINCT regexp_replace(source_file, ' [0-9]+(\\.[^.]+)$', '\\1')) AS files FROM extracted_documents GROUP BY 1")
def _(spark, d):
    f = table(spark, d, "extracted_documents").select("tender_resource_id", "source_file", S.document_text(F.col("content")).alias("t"))
    return f.groupBy("tender_resource_id").agg(
        F.sum(S.estimated_tokens(F.col("t"), 4)).cast("bigint").alias("tokens"), F.countDistinct(F.regexp_replace("source_file", r" [0-9]+(\.[^.]+)$", "$1")).alias("files")
    )


@query("w3_split_at_limit", r"""
WITH RECURSIVE p AS (
  SELECT doc_id, 0 AS part_no, CASE WHEN length(text) <= 400 THEN text END AS part, CASE WHEN length(text) > 400 THEN text END AS rest FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, part_no + 1, CASE WHEN length(rest) > 400 THEN regexp_replace(substr(rest, 1, cut), '^\s+|\s+$', '', 'g') ELSE rest END,
    CASE WHEN length(rest) > 400 THEN nullif(regexp_replace(substr(rest, cut + 1), '^\s+|\s+$', '', 'g'), '') END
  FROM (SELECT *, CASE WHEN length(rest) <= 400 THEN length(rest) WHEN contains(substr(rest, 1, 400), chr(10) || chr(10)) THEN length(regexp_extract(substr(rest, 1, 400), '(?s)^(.*)\n\n', 1))
    WHEN contains(substr(rest, 1, 400), chr(10)) THEN length(regexp_extract(substr(rest, 1, 400), '(?s)^(.*)\n', 1)) ELSE 400 END AS cut FROM p WHERE rest IS NOT NULL))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part_no) - 1 AS part_no, regexp_replace(part, '\s+$', '') AS part FROM p WHERE part <> '' OR (part_no = 0 AND part IS NOT NULL)""")
def _(spark, d):
    """Every document in parts of at most 400 characters, cut at blank lines and line breaks where there are any."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    parts = docs.select("doc_id", F.posexplode(G.split_at_limit(F.col("text"), 400)).alias("part_no", "part"))
    return parts.select("doc_id", "part_no", F.regexp_replace("part", r"\s+$", "").alias("part"))


@query("a27_eligible_documents", "SELECT tender_resource_id, source_file FROM extracted_documents WHERE lower(extension) IN ('.pdf', '.docx', '.txt', '.md') AND NOT (contains(lower(source_file), 'sheet ') OR contains(lower(source_file), 'drawing') OR source_file = '.manifest.json')")
def _(spark, d):
    """Documents worth reading: by extension, without those whose name shows that they hold drawings, and without the manifest."""
    low = F.lower("source_file")
    e = table(spark, d, "extracted_documents").where(F.lower("extension").isin(".pdf", ".docx", ".txt", ".md"))
    return e.where(~(low.contains("sheet ") | low.contains("drawing") | (F.col("source_file") == ".manifest.json"))).select("tender_resource_id", "source_file")


@query("a21_quick_extract", f"SELECT tender_resource_id, source_file, length(substr({_TEXT}, 1, 6000)) AS n, md5(substr({_TEXT}, 1, 6000)) AS digest FROM extracted_documents")
def _(spark, d):
    """The extract of 6,000 characters that a quick assessment reads; the cut is the operator."""
    t = table(spark, d, "extracted_documents").select("tender_resource_id", "source_file", F.substring(S.document_text(F.col("content")), 1, 6000).alias("t"))
    return t.select("tender_resource_id", "source_file", F.length("t").alias("n"), F.md5("t").alias("digest"))


_PRIORITY = ["solicitation", "bidding document", "bid document", "rfp", "rfb", "itb", "terms of reference", "tor", "scope of service", "scope of work", "appendix", "addendum"]  # fixed values: what a file's name may hold, in the order of reading


@query("o5_keyword_priority", "SELECT DISTINCT source_file, CASE " + " ".join(f"WHEN contains(lower(source_file), '{k}') THEN {i}" for i, k in enumerate(_PRIORITY)) + " WHEN contains(lower(source_file), 'competition notice') OR contains(lower(source_file), 'c4t_') THEN 999 ELSE 100 END AS priority FROM extracted_documents")
def _(spark, d):
    e = table(spark, d, "extracted_documents").select("source_file").distinct()
    return e.select("source_file", S.keyword_rank(S.base_name(F.col("source_file")), _PRIORITY, ["competition notice", "c4t_"]).alias("priority"))


# --- notices, listings, messages ----------------------------------------------------------------------------------------------------
_NOTICE_FIELDS = ("official_name", "postal_address", "title", "tender_reference_number", "name_of_contractor", "contract_price_raw", "level_of_competition", "funding_source")


def _flat(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


@query("h21_notice_sections", "SELECT id, " + ", ".join(f"{_flat(c)} AS {c}" if c != "tender_reference_number" else f"nullif(regexp_extract(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '^(\\S+)', 1), '') AS {c}" for c in _NOTICE_FIELDS) + ", len(list_filter(list_transform(string_split(coalesce(cpv_codes, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '')) AS codes FROM award_details_all WHERE title IS NOT NULL")
def _(spark, d):
    """Notices written out as text under their labels, and read again."""
    a = table(spark, d, "award_details_all").where("title is not null")
    one = lambda c: F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
    parts = [
        F.lit("SECTION I\nOfficial name: "), one("official_name"), F.lit("\nPostal address: "), one("postal_address"), F.lit("\nSECTION II\nTITLE: "), one("title"),
        F.lit("\nTender Reference Number:\n"), one("tender_reference_number"), F.lit("\nSECTION III\nName of contractor (1)\n"), one("name_of_contractor"),
        F.lit("\nPPC Category Code and Titles (1)\n"), one("ppc_category_code_and_title"), F.lit("\nCPV codes (1)\n"), F.coalesce("cpv_codes", F.lit("")),
        F.lit("\nContract price (1)\n"), one("contract_price_raw"), F.lit("\nLevel of Competition\n"), one("level_of_competition"), F.lit("\nFunding Source: "), one("funding_source"),
        F.lit("\nDATE OF DISPATCH OF THIS NOTICE:\n01/01/2026"),
    ]
    fields = notice_fields(F.concat(*parts))
    first = F.when(one("tender_reference_number") != "", fields["tender_reference_number"]).alias("tender_reference_number")
    got = [first if c == "tender_reference_number" else fields[c].alias(c) for c in _NOTICE_FIELDS]
    return a.select("id", *got, F.coalesce(F.size(fields["cpv_codes"]), F.lit(0)).cast("bigint").alias("codes"))


@query("h12_award_date_or_raw", r"WITH a AS (SELECT id, nullif(trim(regexp_replace(award_date_raw, '[\s\x{a0}]+', ' ', 'g')), '') AS raw FROM awards_all), m AS (SELECT *, try_strptime(nullif(regexp_extract(raw, '(\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2})', 1), ''), '%d/%m/%Y %H:%M:%S') AS t FROM a) SELECT id, coalesce(strftime(t, '%Y-%m-%dT%H:%M:%S+00:00'), raw) AS value, raw FROM m")
def _(spark, d):
    return table(spark, d, "awards_all").select("id", S.award_instant(F.col("award_date_raw")).alias("a")).select("id", "a.value", "a.raw")


@query("h15_to_array", "SELECT id, CASE WHEN coalesce(trim(funding_source), '') = '' THEN 0 ELSE 1 END AS n, nullif(trim(funding_source), '') AS first_item FROM tenders_all")
def _(spark, d):
    return table(spark, d, "tenders_all").select("id", S.to_array(F.col("funding_source")).alias("a")).select("id", F.size("a").alias("n"), F.get("a", F.lit(0)).alias("first_item"))


# fixed values: what an address holds, and the kind of action it stands for
_ACTIONS = [("listClarification.do", "list_clarification"), ("prepareViewCfTWS.do", "prepare_view"), ("viewETenders.do", "view_etenders")]


@query("h18_action_url", r"SELECT id, u AS url, CASE " + " ".join(f"WHEN contains(u, '{p}') THEN '{k}'" for p, k in _ACTIONS) + r" END AS kind FROM (SELECT id, nullif(regexp_replace(regexp_extract('See https://tenders.invalid' || coalesce(title_url, '') || '. Thanks', '(https?://[^\s<>\x{22}\x{27})]+)', 1), '\.+$', ''), '') AS u FROM tenders_all)")
def _(spark, d):
    body = F.concat(F.lit("See https://tenders.invalid"), F.coalesce("title_url", F.lit("")), F.lit(". Thanks"))
    return table(spark, d, "tenders_all").select("id", S.action_url(body, _ACTIONS).alias("a")).select("id", "a.url", "a.kind")


@query("u6_told_items", "WITH x AS (SELECT id, unnest(string_split(coalesce(cpv_codes, ''), ',') || [coalesce(funding_source, 'None given'), upper(coalesce(funding_source, '')), 'N/A']) AS v, generate_subscripts(string_split(coalesce(cpv_codes, ''), ',') || ['', '', ''], 1) AS i FROM tenders_all), k AS (SELECT id, trim(v) AS v, i FROM x WHERE v <> '' AND NOT regexp_matches(lower(trim(v)), '^(" + "|".join(S.NOISE) + ")')), f AS (SELECT id, v, i FROM k QUALIFY row_number() OVER (PARTITION BY id, lower(v) ORDER BY i) = 1), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) AS r FROM f) SELECT t.id, coalesce(string_agg(v, ';' ORDER BY i) FILTER (r <= 40), '') AS items FROM tenders_all t LEFT JOIN n USING (id) GROUP BY 1")
def _(spark, d):
    parts = F.concat(F.split(F.coalesce("cpv_codes", F.lit("")), ","), F.array(F.coalesce("funding_source", F.lit("None given")), F.upper(F.coalesce("funding_source", F.lit(""))), F.lit("N/A")))
    return table(spark, d, "tenders_all").select("id", F.array_join(S.told_items(parts), ";").alias("items"))


@query("u5_milestones", "WITH m AS (SELECT id, 'Deadline ' AS e, submission_deadline AS v, 1 AS i FROM tenders_all UNION ALL SELECT id, 'Deadline', submission_deadline, 2 FROM tenders_all UNION ALL SELECT id, funding_source, publication_date, 3 FROM tenders_all), k AS (SELECT id, trim(e) AS e, v, min(i) AS i FROM m WHERE coalesce(trim(e), '') <> '' GROUP BY 1, 2, 3) SELECT id, count(*) AS n, string_agg(e || '=' || coalesce(v, '?'), ';' ORDER BY i) AS events FROM k GROUP BY 1")
def _(spark, d):
    t = table(spark, d, "tenders_all")
    row = lambda e, v: F.struct(e.alias("event"), F.col(v).alias("date"))
    rows = F.array(row(F.lit("Deadline "), "submission_deadline"), row(F.lit("Deadline"), "submission_deadline"), row(F.col("funding_source"), "publication_date"))
    m = t.select("id", S.milestones(rows).alias("m"))
    return m.select("id", F.size("m").cast("bigint").alias("n"), F.array_join(F.transform("m", lambda x: F.concat(x["event"], F.lit("="), F.coalesce(x["date"], F.lit("?")))), ";").alias("events"))


@query("pj11_context_block", "SELECT id, concat_ws(chr(10), 'Title: ' || nullif(title, ''), 'Procuring Entity: ' || nullif(procuring_entity, ''), '', CASE WHEN len(c) > 0 THEN chr(10) || 'CPV CODES:' || chr(10) || array_to_string(list_transform(c, lambda x, i: '  ' || i || '. ' || x), chr(10)) END) AS block FROM (SELECT id, title, procuring_entity, list_filter(list_transform(string_split(coalesce(cpv_codes, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS c FROM tenders_all)")
def _(spark, d):
    t = table(spark, d, "tenders_all").select("id", "title", "procuring_entity", S.to_list(F.col("cpv_codes")).alias("cpv_codes"))
    return t.select("id", S.context_block(["title", "procuring_entity"], ["cpv_codes"]).alias("block"))


_CELL = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x{{a0}}]+', ' ', 'g'))"


@query("a10_typed_listing", "SELECT id, " + ", ".join(f"nullif({_CELL.format(c)}, '') AS {c}" for c in ("title", "procuring_entity", "status", "procurement_type", "publication_date")) + ", resource_id FROM tenders_all WHERE resource_id IS NOT NULL")
def _(spark, d):
    """Listing pages written out as HTML tables, and read again as typed rows."""
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    link = F.concat(F.lit('<a href="/epps/view.do?resourceId='), F.col("resource_id"), F.lit('">'), safe("title"), F.lit("</a>"))
    order = [safe("row_no"), link, safe("procuring_entity"), F.lit(""), safe("submission_deadline"), safe("procurement_type"), F.lit(""), safe("status"), F.lit(""), safe("publication_date")]
    t = table(spark, d, "tenders_all").where("resource_id is not null")
    pages = t.select("id", F.concat(F.lit("<table><tr><th>No</th></tr><tr>"), *[cell(x) for x in order], F.lit("</tr></table>")).alias("html"))
    rows = landing.tender_listing(pages, "id", "html")
    return rows.select("id", "title", "procuring_entity", "status", "procurement_type", "publication_date", "resource_id")


# --- mutations ---------------------------------------------------------------------------------------------------------------------
@query("d7_patch_filled", "WITH p AS (SELECT resource_id, max(struct_pack(o := extraction_timestamp, d := submission_deadline, p := publication_date)) AS r FROM tender_snapshots WHERE resource_id IS NOT NULL GROUP BY 1) SELECT id, coalesce(p.r.d, submission_deadline) AS submission_deadline, coalesce(p.r.p, publication_date) AS publication_date FROM tenders_all LEFT JOIN p USING (resource_id)")
def _(spark, d):
    """The dates of the latest snapshot set where they are filled; nulls change nothing."""
    latest = R.latest(table(spark, d, "tender_snapshots").where("resource_id is not null").select("resource_id", "extraction_timestamp", "submission_deadline", "publication_date"), ["resource_id"], [F.col("extraction_timestamp")])
    t = table(spark, d, "tenders_all").select("id", "resource_id", "submission_deadline", "publication_date")
    return R.patch_filled(t, latest, ["resource_id"], ["submission_deadline", "publication_date"]).select("id", "submission_deadline", "publication_date")


@query("s9_orphans", "SELECT id, resource_id FROM award_details_all d WHERE NOT EXISTS (SELECT 1 FROM awards_all a WHERE a.resource_id = d.resource_id)")
def _(spark, d):
    return R.orphans(table(spark, d, "award_details_all"), table(spark, d, "awards_all"), ["resource_id"]).select("id", "resource_id")


_PLAN = "WITH o AS (SELECT tender_resource_id AS k, source_file AS f, min(extraction_timestamp) AS t FROM extracted_documents WHERE extraction_status = 'completed' GROUP BY 1, 2), n AS (SELECT tender_resource_id AS k, source_file AS f, max(extraction_timestamp) AS t, min(lower(extension)) AS e FROM extracted_documents GROUP BY 1, 2)"


@query("d11_extraction_plan", _PLAN + " SELECT n.k AS tender_resource_id, n.f AS source_file, CASE WHEN o.t IS NULL THEN 'new' ELSE 'changed' END AS state, CASE e WHEN '.pdf' THEN 'pages' WHEN '.docx' THEN 'markdown' WHEN '.pptx' THEN 'slides' WHEN '.xlsx' THEN 'sheets' WHEN '.txt' THEN 'text' END AS reader FROM n LEFT JOIN o USING (k, f) WHERE o.t IS NULL OR o.t <> n.t")
def _(spark, d):
    """Files that are new or were fetched again since the manifest's entry, each with the reader of its extension."""
    keys = ["tender_resource_id", "source_file"]
    e = table(spark, d, "extracted_documents")
    manifest = e.where("extraction_status = 'completed'").groupBy(*keys).agg(F.min("extraction_timestamp").alias("t"))
    landed = e.groupBy(*keys).agg(F.max("extraction_timestamp").alias("t"), F.min(F.lower("extension")).alias("extension"))
    return R.extraction_plan(manifest, landed, keys, ["t"], {".pdf": "pages", ".docx": "markdown", ".pptx": "slides", ".xlsx": "sheets", ".txt": "text"}, "extension")


@query("s12_manifest_after", "SELECT tender_resource_id, source_file, epoch_us(max(extraction_timestamp)) AS micros FROM extracted_documents GROUP BY 1, 2")
def _(spark, d):
    """The manifest after its plan was carried out: each file under its last extraction."""
    keys = ["tender_resource_id", "source_file"]
    e = table(spark, d, "extracted_documents")
    manifest = e.where("extraction_status = 'completed'").groupBy(*keys).agg(F.min("extraction_timestamp").alias("t"))
    landed = e.groupBy(*keys).agg(F.max("extraction_timestamp").alias("t"))
    return R.updated_manifest(manifest, landed, keys).select(*keys, F.unix_micros("t").alias("micros"))


@query("d12_job_rows", "SELECT tender_resource_id, source_file, CASE WHEN bool_or(extraction_status = 'completed') THEN 'completed' WHEN bool_or(extraction_status = 'failed') THEN 'failed' ELSE 'pending' END AS job_status, count(*) AS attempts FROM extracted_documents GROUP BY 1, 2")
def _(spark, d):
    """One job a file: completed if any attempt was, else failed if any was, else pending."""
    done, failed = (F.coalesce(F.bool_or(F.col("extraction_status") == s), F.lit(False)) for s in ("completed", "failed"))
    g = table(spark, d, "extracted_documents").groupBy("tender_resource_id", "source_file")
    return g.agg(F.when(done, "completed").when(failed, "failed").otherwise("pending").alias("job_status"), F.count("*").alias("attempts"))


# --- streams -----------------------------------------------------------------------------------------------------------------------
@query("d14_available_now", "SELECT event_id, user_id FROM events")
def _(spark, d):
    """The events as an incremental load takes them: each file and each key once, however often it is called."""
    at = f"{_folder(spark)}/stream-{uuid.uuid4().hex}"
    for _ in range(2):
        stream = ingest.new_records(spark, f"{d}/events.parquet*", "event_id bigint, ts timestamp_ntz, user_id bigint", "event_id", "at", stamp="ts")
        ingest.append_available(stream, f"{at}/rows", f"{at}/state")
    return spark.read.parquet(f"{at}/rows").select("event_id", "user_id")


@query("d15_windowed_counts", "SELECT epoch_us(date_trunc('day', ts)) AS start_micros, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    """Events by day and type as a stream that has seen all files counts them; the watermark lies behind every row."""
    at = f"{_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = spark.readStream.schema("event_id bigint, ts timestamp_ntz, event_type string").parquet(f"{d}/events.parquet*").withColumn("at", F.col("ts").cast("timestamp"))
    counts = ingest.windowed_counts(rows, "at", "1 day", "event_type", lateness="3650 days")
    return ingest.final_counts(counts, at).select(F.unix_micros("start").alias("start_micros"), "event_type", "n")


# --- values ------------------------------------------------------------------------------------------------------------------------
@query("h13_iso_or_raw", f"SELECT id, CASE WHEN {_iso('award_date_raw')} IS NULL THEN award_date_raw ELSE strftime({_iso('award_date_raw')} AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') END AS value FROM awards_all")
def _(spark, d):
    """ISO dates in UTC, those without an offset taken as UTC; all other text as it is."""
    at = S.iso_instant(F.col("award_date_raw"))
    return table(spark, d, "awards_all").select("id", F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), "award_date_raw").alias("value"))


_LOCAL = r"nullif(trim(regexp_replace(regexp_replace(submission_deadline, '[\s\x{a0}]+', ' ', 'g'), '\s*UTC-5\s*$', '')), '')"


@query("h4_listing_timestamps", f"WITH t AS (SELECT id, trim(submission_deadline) AS r, {_LOCAL} AS v FROM tenders_all) SELECT id, epoch_us(CASE WHEN regexp_matches(r, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}(:\\d{{2}}(\\.\\d{{1,6}})?)?(Z|[+-]\\d{{2}}:\\d{{2}})$') THEN TRY_CAST(r AS TIMESTAMPTZ) WHEN regexp_matches(v, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}} \\d{{1,2}}:\\d{{2}}(:\\d{{2}})?$') THEN (coalesce(try_strptime(v, '%d/%m/%Y %H:%M:%S'), try_strptime(v, '%d/%m/%Y %H:%M')) + INTERVAL 5 HOUR) AT TIME ZONE 'UTC' END) AS utc_micros FROM t")
def _(spark, d):
    return table(spark, d, "tenders_all").select("id", F.unix_micros(S.listing_instant(F.col("submission_deadline"))).alias("utc_micros"))


# fixed values: what a subject holds, in the order in which it is looked for, and the update it announces
_SUBJECTS = [
    ("clarification response", "clarification_response"), ("modifications?", "modifications"), ("request for clarifications? end", "clarification_period_end"),
    ("time limit for receipt", "time_limit"), ("extension", "deadline_extension"), ("cancell?(ation|ed|led)", "cancellation"), ("addendum", "addendum"),
    ("site visit", "site_visit"), ("bidders? conference", "site_visit"), (r"\bdocuments?\b", "new_documents"),
]
# fixed values: updates that only inform
_INFORM = ["clarification_period_end", "time_limit"]
_TYPED = "CASE " + " ".join(f"WHEN regexp_matches(lower(s), '{p}') THEN '{t}'" for p, t in _SUBJECTS) + " ELSE 'other' END"


@query("h17_pj10_update_types", f"SELECT id, {_TYPED} AS update_type, ({_TYPED}) NOT IN ('clarification_period_end', 'time_limit') AS requires_action FROM (SELECT id, concat_ws(' ', title, status, submission_deadline, detailed_description) AS s FROM tenders_all)")
def _(spark, d):
    """The kind of update that a text announces, and whether something must follow from it."""
    t = table(spark, d, "tenders_all").select("id", S.first_rule(F.concat_ws(" ", "title", "status", "submission_deadline", "detailed_description"), _SUBJECTS, "other").alias("update_type"))
    return t.select("id", "update_type", (~F.col("update_type").isin(_INFORM)).alias("requires_action"))


@query("h20_title_in_body", r"SELECT id, nullif(trim(regexp_extract('Update on the competition titled: ' || coalesce(title, '') || '. It is open.', '(?i)competition titled[:\s]+([^\n.]+)', 1)), '') AS named FROM tenders_all WHERE trim(title) <> '' AND title NOT LIKE '.%'")
def _(spark, d):
    t = table(spark, d, "tenders_all").where("trim(title) <> '' and title not like '.%'")
    body = F.concat(F.lit("Update on the competition titled: "), F.coalesce("title", F.lit("")), F.lit(". It is open."))
    return t.select("id", F.nullif(F.trim(F.regexp_extract(body, r"(?i)competition titled[:\s]+([^\n.]+)", 1)), F.lit("")).alias("named"))


# --- projections and tests -----------------------------------------------------------------------------------------------------------
@query("pj2_published_preferred", f"SELECT id, epoch_us(coalesce({_iso('publication_date')}, {_iso('submission_deadline')})) AS parsed_micros FROM tenders_all WHERE resource_id IS NOT NULL")
def _(spark, d):
    """The parsed date is that of the preferred field where it can be read, else that of the other."""
    t = table(spark, d, "tenders_all").where("resource_id is not null")
    return t.select("id", F.unix_micros(F.coalesce(S.iso_instant(F.col("publication_date")), S.iso_instant(F.col("submission_deadline")))).alias("parsed_micros"))


_PATCH = ["title", "procuring_entity", "procurement_type", "funding_source", "project_reference_number"]


@query("pj3_patch_without_nulls", "SELECT id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '{c}' END" for c in _PATCH) + ", 'cpv_codes'], lambda x: x IS NOT NULL), ',') AS patched, len(list_filter(list_transform(string_split(coalesce(cpv_codes, ''), ','), lambda x: trim(x)), lambda x: x <> '')) AS codes FROM tenders_all")
def _(spark, d):
    """The fields a patch sets: nulls are taken out, empty lists stay."""
    t = table(spark, d, "tenders_all").withColumn("cpv_codes", S.to_list(F.col("cpv_codes")))
    names = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in (*_PATCH, "cpv_codes")]))
    return t.select("id", F.array_join(names, ",").alias("patched"), F.size("cpv_codes").cast("bigint").alias("codes"))


@query("pj5_award_defaults", "SELECT id, coalesce(title, '') AS title, coalesce(procurement_method, 'Unknown') AS procurement_method, coalesce(TRY_CAST(row_no AS INT), 0) AS row_no, coalesce(contract_amount, 0.0) AS contract_amount, coalesce(pdf_resource_id, '') AS pdf_resource_id FROM awards_all")
def _(spark, d):
    a = table(spark, d, "awards_all")
    return a.select(
        "id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("procurement_method", F.lit("Unknown")).alias("procurement_method"),
        F.coalesce(F.col("row_no").try_cast("int"), F.lit(0)).alias("row_no"), F.coalesce("contract_amount", F.lit(0.0)).alias("contract_amount"),
        F.coalesce("pdf_resource_id", F.lit("")).alias("pdf_resource_id"),
    )


_LATEST = "SELECT competition_unique_id AS k, max(struct_pack(t := extraction_timestamp, title := coalesce(title, ''), entity := coalesce(procuring_entity, ''), dl := coalesce(submission_deadline, ''))) AS r FROM tender_snapshots WHERE competition_unique_id IS NOT NULL GROUP BY 1"


@query("pj6_summary_of_two", f"SELECT id, coalesce(nullif(title, ''), nullif(r.title, ''), 'Untitled') AS title, coalesce(nullif(procuring_entity, ''), nullif(r.entity, '')) AS procuring_entity, coalesce(nullif(submission_deadline, ''), nullif(r.dl, '')) AS submission_deadline, r IS NOT NULL AS has_analysis, CASE WHEN {_iso('submission_deadline')} IS NOT NULL THEN greatest(0, floor((epoch_us({_iso('submission_deadline')}) - epoch_us(TIMESTAMPTZ '{NOW}')) / 86400000000))::BIGINT END AS days_remaining FROM tenders_all LEFT JOIN ({_LATEST}) ON competition_unique_id = k")
def _(spark, d):
    """The summary of a record and its enrichment: the record's value, else the enrichment's, else a default; days are never negative."""
    s = table(spark, d, "tender_snapshots").where("competition_unique_id is not null")
    fields = [F.coalesce(c, F.lit("")).alias(n) for c, n in (("title", "rt"), ("procuring_entity", "re"), ("submission_deadline", "rd"))]
    one = s.groupBy("competition_unique_id").agg(F.max(F.struct("extraction_timestamp", *fields)).alias("r"))
    j = table(spark, d, "tenders_all").join(one, "competition_unique_id", "left")
    pick = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), F.nullif(F.col(f"r.{b}"), F.lit("")))
    days = S.floor_days(S.iso_instant(F.col("submission_deadline")), F.lit(NOW).cast("timestamp"))
    return j.select(
        "id", F.coalesce(pick("title", "rt"), F.lit("Untitled")).alias("title"), pick("procuring_entity", "re").alias("procuring_entity"),
        pick("submission_deadline", "rd").alias("submission_deadline"), F.col("r").isNotNull().alias("has_analysis"), F.when(days.isNotNull(), F.greatest(days, F.lit(0))).cast("bigint").alias("days_remaining"),
    )


@query("pj9_prefix_and_back", "SELECT id, title, status FROM tenders_all")
def _(spark, d):
    """Columns under a prefix, as one record holds another's, and out of it again."""
    t = table(spark, d, "tenders_all").select("id", "title", "status")
    there = t.select(*[F.col(c).alias(f"db_{c}") for c in t.columns], F.lit(1).alias("own"))
    return there.select(*[F.col(c).alias(c.removeprefix("db_")) for c in there.columns if c.startswith("db_")])


@query("b23_pending_five_tests", "WITH f AS (SELECT tender_folder AS folder, count(*) FILTER (text IS NOT NULL AND trim(text) <> '') AS n, max(published_on) AS last FROM documents WHERE tender_folder IS NOT NULL GROUP BY 1), a AS (SELECT DISTINCT replace(competition_unique_id, '/', '_') AS folder FROM tender_snapshots WHERE competition_unique_id IS NOT NULL), x AS (SELECT DISTINCT replace(competition_unique_id, '/', '_') AS folder FROM tenders_all WHERE lower(trim(status)) = 'cancelled'), e AS (SELECT DISTINCT replace(competition_unique_id, '/', '_') AS folder FROM tenders_all WHERE lower(trim(status)) = 'evaluation') SELECT folder, CASE WHEN last < DATE '2021-06-01' THEN n > 0 WHEN e.folder IS NOT NULL THEN false WHEN x.folder IS NOT NULL THEN false WHEN n = 0 THEN false ELSE a.folder IS NULL END AS pending FROM f LEFT JOIN a USING (folder) LEFT JOIN x USING (folder) LEFT JOIN e USING (folder)")
def _(spark, d):
    """Five tests in order: a stale folder counts if it has documents at all; else it must be neither done, nor failed, nor empty, nor known."""
    docs = table(spark, d, "documents").where("tender_folder is not null").groupBy(F.col("tender_folder").alias("folder"))
    f = docs.agg(F.count_if(F.trim("text") != "").alias("n"), F.max("published_on").alias("last"))
    named = lambda t, w, m: table(spark, d, t).where(w).select(F.replace("competition_unique_id", F.lit("/"), F.lit("_")).alias("folder"), F.lit(True).alias(m)).distinct()
    j = f.join(named("tender_snapshots", "competition_unique_id is not null", "known"), "folder", "left")
    j = j.join(named("tenders_all", "lower(trim(status)) = 'cancelled'", "failed"), "folder", "left").join(named("tenders_all", "lower(trim(status)) = 'evaluation'", "done"), "folder", "left")
    pending = F.when(F.col("last") < F.lit("2021-06-01").cast("date"), F.col("n") > 0).when(F.col("done"), False).when(F.col("failed"), False).when(F.col("n") == 0, False).otherwise(F.col("known").isNull())
    return j.select("folder", pending.alias("pending"))


_MINOR = ["submission_deadline", "publication_date"]  # fixed values: fields whose change asks for nothing
_WATCHED = ["title", "status", "submission_deadline", "publication_date"]
_DIFF = "list_filter([" + ", ".join(f"CASE WHEN n.{c} <> o.{c} THEN '{c}' END" for c in _WATCHED) + "], lambda x: x IS NOT NULL)"


@query("b27_substantive_changes", "WITH s AS (SELECT snapshot_date AS snap, resource_id, " + ", ".join(f"max(coalesce({c}, '')) AS {c}" for c in _WATCHED) + f" FROM tender_snapshots WHERE resource_id IS NOT NULL GROUP BY 1, 2), o AS (SELECT * FROM s WHERE snap = (SELECT min(snap) FROM s)), n AS (SELECT * FROM s WHERE snap = (SELECT max(snap) FROM s)) SELECT resource_id, len({_DIFF}) AS changed, len(list_filter({_DIFF}, lambda x: x NOT IN ('submission_deadline', 'publication_date'))) > 0 AS substantive FROM o JOIN n USING (resource_id) WHERE len({_DIFF}) > 0")
def _(spark, d):
    """What changed between the first and the last snapshot, and whether more than the minor fields did."""
    snaps = table(spark, d, "tender_snapshots").where("resource_id is not null")
    rows = snaps.groupBy(F.col("snapshot_date").alias("snap"), "resource_id").agg(*[F.max(F.coalesce(c, F.lit(""))).alias(c) for c in _WATCHED])
    ends = snaps.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))  # one row
    both = rows.join(F.broadcast(ends), (F.col("snap") == F.col("first")) | (F.col("snap") == F.col("last")))
    j = both.where("snap = first").alias("o").join(both.where("snap = last").alias("n"), "resource_id")
    changed = R.changed_fields("o", "n", _WATCHED)
    out = j.select("resource_id", changed.alias("c")).where(F.size("c") > 0)
    return out.select("resource_id", F.size("c").cast("bigint").alias("changed"), (F.size(F.array_except("c", F.array(*[F.lit(m) for m in _MINOR]))) > 0).alias("substantive"))


@query("b21_open_work", "SELECT tender_resource_id, source_file, CASE WHEN extraction_status IS NULL THEN 'not begun' WHEN extraction_status = 'pending' THEN 'pending' WHEN extraction_status = 'completed' AND content IS NULL THEN 'left over' WHEN extraction_status = 'failed' THEN 'failed' END AS work FROM extracted_documents WHERE extraction_status IS NULL OR extraction_status IN ('pending', 'failed') OR (extraction_status = 'completed' AND content IS NULL)")
def _(spark, d):
    """Four tests of what is still to be done: not begun, pending, completed without content, failed."""
    s = F.col("extraction_status")
    work = F.when(s.isNull(), "not begun").when(s == "pending", "pending").when((s == "completed") & F.col("content").isNull(), "left over").when(s == "failed", "failed")
    return table(spark, d, "extracted_documents").select("tender_resource_id", "source_file", work.alias("work")).where("work is not null")


def _safe(c):  # noqa: ANN001, ANN202
    return F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("a11_typed_awards", "SELECT id, " + ", ".join(f"nullif({_CELL.format(c)}, '') AS {c}" for c in ("procurement_method", "procuring_entity", "title", "contract_amount_raw", "award_date_raw")) + " FROM awards_all")
def _(spark, d):
    """Award pages written out as HTML tables, and read again as typed rows."""
    cells = [F.concat(F.lit("<td>"), _safe(c), F.lit("</td>")) for c in ("row_no", "procurement_method", "procuring_entity", "title", "contract_amount_raw", "award_date_raw")]
    pages = table(spark, d, "awards_all").select("id", F.concat(F.lit("<table><tr>"), *cells, F.lit("</tr></table>")).alias("html"))
    return landing.award_listing(pages, "id", "html").select("id", "procurement_method", "procuring_entity", "title", "contract_amount_raw", "award_date_raw")


@query("a12_field_map", "SELECT id, " + ", ".join(f"nullif({_CELL.format(c)}, '') AS {c}" for c in ("title", "procuring_entity", "funding_source")) + " FROM tenders_all")
def _(spark, d):
    """Detail pages written out as definition lists, and read again as a map of fields."""
    pairs = [F.concat(F.lit(f"<dt>{label}:</dt><dd>"), _safe(c), F.lit("</dd>")) for label, c in (("Title", "title"), ("Procuring Entity", "procuring_entity"), ("Funding source", "funding_source"))]
    pages = table(spark, d, "tenders_all").select("id", F.concat(F.lit("<dl>"), *pairs, F.lit("</dl>")).alias("html"))
    got = landing.field_map(pages, "id", "html")
    return got.select("id", *[F.get(F.col("fields")[c], F.lit(0)).alias(c) for c in ("title", "procuring_entity", "funding_source")])
