import zipfile
from io import BytesIO

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarind import plans
from tamarind.functions import scalars as S
from tamarind.operators import relations as R
from tamarind.operators import summaries as G
from tamarind.sources import landing, sinks
from tamarind.streaming import ingest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import os

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def plain(rows):
    return sorted(tuple("" if v is None else f"{float(v):.6g}" if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_against_sql(spark, duck, name):
    got = plans.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({plans.oracle_sql()[name]})").fetchall()
    assert plain(got.select(*columns).collect()) == plain(want)


def split_by_hand(text, limit):
    if len(text) <= limit:
        return [text]
    parts = []
    while len(text) > limit:
        at = next((k for k in (text.rfind("\n\n", 0, limit), text.rfind("\n", 0, limit)) if k >= 0), limit)
        parts.append(text[:at].strip())
        text = text[at:].strip()
    return [p for p in [*parts, text] if p]


TEXTS = ["aa\n\naaaaaaa\n\nbb", "aaa \n\n\nbbbbbbbbbbbbbb", "aaaa\n\nbbbb\ncccc dddd\n\n" + "e" * 25, "x" * 12, "x" * 13, "  \n\n" + "y" * 14, "", " ", "a\tb\n" * 9, "ab \n" * 8]


def test_split_at_limit(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = {r["t"]: r["p"] for r in df.select("t", G.split_at_limit(F.col("t"), 12).alias("p")).collect()}
    assert got.pop(None) is None
    assert got == {t: split_by_hand(t, 12) for t in TEXTS}


@given(st.lists(st.text("ab \n", max_size=60), min_size=1, max_size=20, unique=True), st.integers(2, 20))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_split_at_any_limit(spark, texts, limit):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["p"] for r in df.select("t", G.split_at_limit(F.col("t"), limit).alias("p")).collect()} == {t: split_by_hand(t, limit) for t in texts}


def test_next_fit(spark):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate([5, 6, 20, 1, 9, None])] + [(None, 1, 3), (None, 2, 9)], "g string, i int, s int")
    got = {(r["g"], r["i"]): r["bin_no"] for r in G.next_fit(df, ["g"], "i", "s", 10).collect()}
    assert got == {("a", 0): 1, ("a", 1): 2, ("a", 2): 3, ("a", 3): 4, ("a", 4): 4, ("a", 5): 4, (None, 1): 1, (None, 2): 2}


def test_next_fit_of_one_hot_group(spark):
    """A million rows of one group stream through one bin's state."""
    df = spark.range(1_000_000).select(F.lit("hot").alias("g"), F.col("id").alias("i"), F.lit(3).alias("s"))
    r = G.next_fit(df, ["g"], "i", "s", 10).agg(F.max("bin_no").alias("m"), F.count("*").alias("n")).first()
    assert (r["m"], r["n"]) == (333_334, 1_000_000)


def test_upsert_does_not_depend_on_order(spark):
    target = spark.createDataFrame([(1, "old"), (2, "stays")], "k int, v string")
    rows = spark.createDataFrame([(1, "a", 2), (1, "z", 1), (3, "b", 1), (3, "c", 1)], "k int, v string, at int")
    for r in (rows, rows.orderBy(F.desc("v"))):
        assert sorted(map(tuple, R.upsert(target, r, ["k"], [F.col("at")]).collect())) == [(1, "a"), (2, "stays"), (3, "c")]
        assert sorted(map(tuple, R.insert_new(target, r, ["k"], [F.col("at")]).collect())) == [(1, "old"), (2, "stays"), (3, "c")]
    patch = spark.createDataFrame([(1, None), (2, "new"), (None, "x")], "k int, v string")
    assert sorted(map(tuple, R.patch_filled(target, patch, ["k"], ["v"]).collect())) == [(1, "old"), (2, "new")]


def test_keep_known_guard(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert R.keep_known(df, df.limit(0), ["k"]).count() == 2
    assert [r["k"] for r in R.keep_known(df, df.where("k = 2"), ["k"]).collect()] == [2]


def test_scalars(spark):
    df = spark.createDataFrame([("aGk_", "```json\n{\"a\": 1}\n```")], "b string, j string")
    r = df.select(S.from_base64url(F.col("b")).alias("b"), S.unfenced_json(F.col("j"), "a int")["a"].alias("j")).first()
    assert (r["b"], r["j"]) == ("hi?", 1)
    df = spark.createDataFrame([(["A", "a", None, "b", "B"],)], "x array<string>")
    assert df.select(S.distinct_ignoring_case(F.col("x")).alias("x")).first()["x"] == ["A", "b"]


def test_sources(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a": "1"}, 5, {"a": "2"}]')
    (tmp_path / "env.json").write_text('{"records": [{"a": "3"}]}')
    assert sorted(r["a"] for r in landing.read_listing(spark, str(tmp_path / "list.json"), "a string").collect()) == ["1", "2"]
    assert [r["a"] for r in landing.read_envelope(spark, str(tmp_path / "env.json"), "a string").collect()] == ["3"]
    assert sorted(r["a"] for r in landing.read_envelope(spark, str(tmp_path / "list.json"), "a string").collect()) == ["1", "2"]
    assert landing.newest_file(spark, str(tmp_path / "none*.json")) is None
    assert landing.newest_file(spark, str(tmp_path / "list*.json")).endswith("list.json")
    page = "<table><tr><td>a<td>b<br>c</tr><tr><td>only</td></tr></table><dl><dt>Label</dt><dd>x<br>y</dd></dl>"
    pages = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert [r["cells"] for r in landing.table_rows(pages, "id", "html", 2).collect()] == [["a", "b c"]]
    assert [(r["label"], r["values"]) for r in landing.grid_fields(pages, "id", "html").collect()] == [("Label", ["x", "y"])]
    inner, outer = BytesIO(), BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("d/x.txt", "one")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("in.zip", inner.getvalue())
        z.writestr("e/x.txt", "two")
    files = spark.createDataFrame([("p", bytearray(outer.getvalue())), ("q", bytearray(b"no zip"))], "path string, content binary")
    got = landing.unzip(files).collect()
    assert sorted((r["path"], r["member"] or "", bytes(r["content"] or b"")) for r in got) == [("p", "x.txt", b"two"), ("q", "", b"")]
    mail = b"Message-ID: <1>\nSubject: Hi\nFrom: a@b\nDate: Mon, 01 Jan 2024 10:00:00 -0500\nContent-Type: text/plain\n\nbody\n"
    m = landing.messages(spark.createDataFrame([("p", bytearray(mail))], "path string, content binary")).first()
    assert (m["message_id"], m["body_plain"].strip()) == ("<1>", "body")


def test_sinks_and_stream(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    sinks.write_swap(R.delete_where(spark.read.parquet(path), F.col("id") == 1), path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 2]
    landed = str(tmp_path / "in")
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00")], "k string, t string").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(landed)
    for _ in range(2):
        stream = ingest.new_records(spark, landed, "k string, t timestamp", "k", "t")
        ingest.append_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def whole_text(c):
    """All arms of a document, one after the other; None where no arm is filled."""
    if c is None or all(v is None for v in c):
        return None
    there = lambda x: [v for v in x or [] if v is not None]
    parts = [k["text"] or "" for k in there(c["chunks"])]
    for page in there(c["pages"]):
        parts.append(page["text"] or "")
        for rows in there(page["tables"]):
            lines = [" | ".join(x.strip() for x in there(row) if x.strip()) for row in there(rows)]
            parts.append("\n".join(x for x in lines if x))
    parts = [p.strip() for p in parts if p.strip()] or there([c["markdown"]])
    return "\n\n".join(parts + [t for slide in there(c["slides"]) for t in there(slide["texts"])] + there([c["raw_text"]]))


def test_text_of_all_arms(spark, duck):
    files = spark.read.parquet(f"{DATA}/extracted_documents.parquet").select("tender_resource_id", "source_file", "content")
    mixed = ("m", " r ", [("\u00a0x ", None), None, (None, None)], [("p", [[["1 ", None, "2"], None, [" "]], None]), ("", None)], [(1, ["s", None]), (2, None)])
    made = spark.createDataFrame([("a", "f", mixed), ("b", "f", None), ("c", "f", (None,) * 5), ("d", "f", (" m ", None, [], None, None))], files.schema)
    rows = files.unionByName(made).withColumn("got", S.document_text(F.col("content"))).collect()
    assert {r["tender_resource_id"]: r["got"] for r in rows if r["source_file"] == "f"} == {"a": "x\n\np\n\n1 | 2\n\ns\n\n r ", "b": None, "c": None, "d": " m "}
    assert [r["got"] for r in rows] == [whole_text(r["content"]) for r in rows]
    assert {"chunks", "pages", "slides"} <= {a for r in files.collect() if r["content"] for a, v in r["content"].asDict().items() if v}
    want, tokens = [], {}
    for key, file, content in files.collect():
        text = whole_text(content)
        want.append((key, file, None if text is None else len(text)))
        tokens[key] = tokens.get(key, 0) + len(text or "") // 4
    got = plans.queries()["h25_text_of_arms"](spark, DATA).select("tender_resource_id", "source_file", "n").collect()
    assert plain(got) == plain(want)
    got = plans.queries()["g11_tokens_and_files"](spark, DATA)
    assert plain(got.select("tender_resource_id", "tokens").collect()) == plain(tokens.items())


def test_flattened_chunks_are_whole(spark):
    rows = spark.read.parquet(f"{DATA}/extracted_documents.parquet").where("content.chunks is not null").select("tender_resource_id", "source_file", "content.chunks").collect()
    want = [(r[0], r[1], " | ".join(c["text"] for c in r["chunks"] if c["text"] is not None)) for r in rows]
    got = plans.queries()["h29_s2_csv_flatten"](spark, DATA).select("tender_resource_id", "source_file", "chunks").collect()
    assert max(len(r["chunks"]) for r in got) > 200 and plain(got) == plain(want)


def test_changed_fields_of_every_snapshot(spark, duck):
    fields = ["title", "status", "procuring_entity"]
    by = {}
    for r in spark.read.parquet(f"{DATA}/tender_snapshots.parquet").select("snapshot_date", "resource_id", *fields).collect():
        own = by.setdefault(r[0], {}).setdefault(r[1], [""] * 3)
        by[r[0]][r[1]] = [max(a, b or "") for a, b in zip(own, r[2:])]
    want = []
    for old, new in zip(sorted(by), sorted(by)[1:]):
        for key in by[old].keys() & by[new].keys() - {None}:
            changed = ",".join(f for f, a, b in zip(fields, by[old][key], by[new][key]) if a != b)
            want += [(new, key, changed)] if changed else []
    got = plans.queries()["d9_b27_changed_fields"](spark, DATA).select("snapshot_date", "resource_id", "changed").collect()
    assert len({r["snapshot_date"] for r in got}) > 1 and plain(got) == plain(want)


def test_refused_renames_leave_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    real = sinks._place

    class Refusing:
        """A file system that refuses the nth rename."""

        def __init__(self, fs, nth):
            self.fs, self.left = fs, nth

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.left -= 1
            return False if self.left == 0 else self.fs.rename(a, b)

    for nth in (1, 2):
        shared = []

        def place(s, p, nth=nth, shared=shared):
            at, fs = real(s, p)
            shared = shared or [Refusing(fs, nth)]
            return at, shared[0]

        monkeypatch.setattr(sinks, "_place", place)
        with pytest.raises(OSError):
            sinks.write_swap(spark.range(9), path)
        assert spark.read.parquet(path).count() == 3
    monkeypatch.setattr(sinks, "_place", real)
    sinks.write_swap(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9


def test_more_sinks(spark, tmp_path):
    from datetime import datetime

    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    at = sinks.write_snapshot(rows, str(tmp_path), "snap", datetime(2026, 1, 2, 3, 4, 5))
    assert at.endswith("snap_2026-01-02_03-04-05") and spark.read.json(at).count() == 3
    path = str(tmp_path / "done")
    assert [sinks.write_missing(rows, path, ["k"]), sinks.write_missing(rows, path, ["k"])] == [2, 0]
    sinks.append_rows(rows, path)
    assert spark.read.parquet(path).count() == 5
    log = sinks.run_log(spark.createDataFrame([("completed",), ("failed",), (None,)], "s string"), "s").first()
    assert (log["total"], log["completed"], log["failed"], log["open"]) == (3, 1, 1, 1)
    flat = sinks.flat_columns(spark.createDataFrame([({"b": "2", "a": None},)], "m map<string,string>")).first()
    assert flat["m"] == "a: ; b: 2"


def archive(**members):
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/"), text)
    return bytearray(out.getvalue())


def test_office_files(spark):
    m = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = archive(**{
        "xl__workbook.xml": f'<workbook {m} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>',
        "xl___rels__workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>',
        "xl__sharedStrings.xml": f"<sst {m}><si><t>Name</t></si><si><r><t>Pi</t></r><r><t>pe</t></r></si></sst>",
        "xl__worksheets__s.xml": f'<worksheet {m}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>7</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="B2" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>',
    })
    a = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
    slide = lambda t: f"<p:sld xmlns:p='p' {a}><a:p><a:r><a:t>{t}</a:t></a:r></a:p><a:p/><a:tbl><a:tr><a:tc><a:p><a:r><a:t>c</a:t></a:r></a:p></a:tc></a:tr></a:tbl></p:sld>"
    deck = archive(**{"ppt__slides__slide2.xml": slide("two"), "ppt__slides__slide10.xml": slide("ten"), "ppt__slides__slide1.xml": slide("one")})
    files = spark.createDataFrame([("b", book), ("d", deck), ("x", bytearray(b"no"))], "path string, content binary")
    rows = landing.spreadsheets(files.where("path <> 'd'")).orderBy("path").collect()
    assert [(r["path"], r["sheet"], r["cells"], r["error"]) for r in rows] == [("b", "S", {"Name": "Pipe", "column 2": "x", "7": ""}, None), ("x", None, None, "BadZipFile")]
    got = landing.presentations(files.where("path = 'd'")).collect()
    assert [(r["slide_number"], r["texts"], r["tables"]) for r in got] == [(1, ["one"], [[["c"]]]), (2, ["two"], [[["c"]]]), (3, ["ten"], [[["c"]]])]


def test_marks_on_a_page():
    page = [
        ("q", []), ("cm", [1, 0, 0, 1, 10, 700]), ("box", [True]), ("Q", []), ("q", []), ("cm", [1, 0, 0, 1, 30, 703]), ("text", ["Works"]), ("Q", []),
        ("q", []), ("cm", [1, 0, 0, 1, 100, 696]), ("box", [False]), ("Q", []), ("q", []), ("cm", [1, 0, 0, 1, 120, 700]), ("text", ["Goods"]), ("Q", []), ("Q", []),
        ("q", []), ("cm", [1, 0, 0, 1, 10, 600]), ("box", [1]), ("cm", [1, 0, 0, 1, 20, 2]), ("text", ["Open"]), ("Q", []),
    ]
    assert landing.checked_labels(page) == ["Works", "Open"]
    # rows go by their first point, not by the gap to the last
    assert landing.anchored_rows([(0, 10, "a"), (1, 6, "b"), (2, 2, "c")]) == [["a", "b"], ["c"]]


def test_typed_pages(spark):
    page = "<table><tr><td>1<td>Open<td>Body<td>Title<td>$1,200.50<td>at 25/03/2026 12:09:10 h<td><a href='/c.do?resourceId=9%2F1'>x</a><a href='/p.do?resourceId=7'>p</a></tr></table><dl><dt>CPV Codes:</dt><dd>a<br>b</dd><dt>CPV codes</dt><dd>c</dd></dl>"
    pages = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    r = landing.award_listing(pages, "id", "html").collect()
    assert [(x["contract_amount"], x["award_date"], x["resource_id"], x["pdf_resource_id"]) for x in r] == [(1200.5, "2026-03-25T12:09:10+00:00", "9/1", "7")]
    assert [x["fields"] for x in landing.field_map(pages, "id", "html").collect()] == [{"cpv_codes": ["a", "b"]}]


def test_late_rows_and_sidecars(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text("{broken")
    assert [r["x"] for r in landing.read_sidecars(spark, str(tmp_path / "*.json"), "x int").collect()] == [1]
    landed, target, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for k, t in (("a", "2024-01-10 00:00:00"), ("b", "2024-02-10 00:00:00"), ("late", "2024-01-01 00:00:00"), ("c", "2024-02-11 00:00:00")):
        spark.createDataFrame([(k, t)], "k string, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(landed)
        ingest.append_available(ingest.new_records(spark, landed, "k string, t timestamp", "k", "t"), target, state)
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]  # behind the watermark by more than a week


def test_entry_without_the_subpackage(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tamarind", tmp_path / "tamarind", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    ask = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('p1_') for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1] == "False"
    blocked = "import sys; sys.modules['zstandard'] = None; " + ask
    out = subprocess.run([sys.executable, "-c", blocked], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1] == "False"


def test_keyword_candidates_against_brute_force(spark):
    from tamarind.operators import search as Q

    known = [(f"k{i:02d}", t) for i, t in enumerate(["Repairs of Roads", "road REPAIR", "a b c of it", "x a b c of it y", "Supply", "", None, "disrepair now", "a b"] * 3)] + [(None, "Repair")]
    asked = [("q1", "the Repair of it"), ("q2", "a b c"), ("q3", "A b"), ("q4", " "), ("q5", None), ("q6", "nothing like that"), ("q1b", "Repair"), ("q7", "100% sup.ply")]
    shape = "{0} string, {1} string"
    got = Q.keyword_candidates(spark.createDataFrame(asked, shape.format("q", "t")), spark.createDataFrame(known, shape.format("ck0", "ct0")), "q", "t", "ck0", "ct0", most=4, blank_most=3)
    want = set()
    full = sorted((k, t) for k, t in known if k and (t or "").strip())
    for q, t in asked:
        words = [w for w in (t or "").split() if len(w) > 4]
        key = (words[0] if words else (t or "").strip()[:20]).lower()
        want |= {(q, k) for k, _ in (full[:3] if not (t or "").strip() else [x for x in full if key in x[1].lower()][:4])}
    assert {(r["q"], r["ck0"]) for r in got.collect()} == want
    best = Q.best_match(got, "q", lambda _: Q.word_overlap(F.col("t"), F.col("ct0")), "ck0").collect()
    assert all(r["confidence"] >= 0.7 for r in best) and len({r["q"] for r in best}) == len(best)


def test_search_rules(spark):
    from tamarind.operators import search as Q

    rows = [(1, "u1", "Bridge", "Body", "Works", "text", None, ["45-1"], "2026-02-01T00:00:00Z", "2026-01-01"), (2, "u2", None, None, None, None, "Gov", None, "soon", None), (3, None, "bridge two", "a", "Goods", None, None, [], "2026-03-01", "2026-01-05T10:00:00+02:00")]
    t = spark.createDataFrame(rows, "id int, u string, title string, procuring_entity string, procurement_type string, detailed_description string, funding_source string, cpv_codes array<string>, submission_deadline string, publication_date string")
    a = spark.createDataFrame([("u1", "Works", "Scope", "T"), ("u1", "Z", None, None), (None, "x", None, None)], "u string, contract_type string, scope_of_work string, contract_title string")
    ask = lambda **k: [r["id"] for r in Q.search(t, a, "u", "2026-01-20T00:00:00Z", **k).collect()]
    assert ask() == [1, 3, 2] and ask(sort="deadline_desc") == [3, 1, 2] and ask(sort="?") == [1, 2, 3] and ask(sort="published_desc") == [3, 1, 2]
    assert ask(sort="entity_asc") == [2, 3, 1] and ask(number=2, size=2) == [2] and ask(number=9) == []
    assert ask(has_analysis=True) == [1] and ask(has_analysis=False) == [3, 2] and ask(contract_type="WORK") == [1]
    assert ask(q="BRIDGE") == [1, 3] and ask(q="scope") == [1] and ask(q="  ") == [1, 3, 2] and ask(cpv="45") == [1] and ask(funding_source="gov") == [2]
    assert ask(closing_within_days=12) == [1] and ask(deadline_after="2026-02-01") == [1, 3] and ask(deadline_before="2026-02-01") == [1] and ask(deadline_after="no date") == [1, 3, 2]
    r = Q.search(t, a, "u", "2026-01-20T00:00:00Z", size=2).first()
    assert (r["total_rows"], r["has_next"]) == (3, True) and Q.search(t.limit(0), a.limit(0), "u", "2026-01-20T00:00:00Z").count() == 0
