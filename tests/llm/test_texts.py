import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarind.llm import leaks, mixing, mojibake, pieces

# --- pieces -------------------------------------------------------------------------------------------------------------


@given(st.text("ab .\n#-1", max_size=400), st.integers(5, 60), st.integers(0, 4))
@settings(max_examples=300, deadline=None)
def test_split_round_trip(text, limit, overlap):
    spans = pieces.split_text(text, limit, overlap)
    assert all(b - a <= limit for a, b in spans)
    at = 0
    for i, (a, b) in enumerate(spans):
        assert a == max(0, at - (overlap if i else 0))
        at = b
    assert at == len(text) and (text or not spans)


def test_split_prefers_structure():
    text = "# One\n\n" + "a" * 30 + "\n\n# Two\n\n" + "b" * 30 + "\n\n## Sub\n\n" + "c" * 30 + "\n"
    assert [text[a:b].split("\n")[0] for a, b in pieces.split_text(text, 85, 0)] == ["# One", "# Two"]
    assert pieces.split_text("x" * 10, 4, 1) == [(0, 3), (2, 6), (5, 9), (8, 10)]


def test_split_documents(spark):
    rows = [("k", 1, "a" * 50), ("k", 2, "b" * 20), ("k", 2, "b" * 20), (None, 1, "c"), ("e", 1, ""), ("n", 1, None), ("l", 1, "word " * 40_000)]
    df = spark.createDataFrame(rows, "k0 string, v int, h string").withColumn("c", F.lit(1))  # names as the operator's own
    got = pieces.split_documents(df, ["k0"], "h", 26_000, 100).collect()
    with pytest.raises(ValueError):
        pieces.split_text("x" * 9, 5, 5)
    assert sum(r["k0"] is None for r in got) == 1 and sum(r["k0"] == "l" for r in got) == 8 and not any(r["k0"] in ("e", "n") for r in got)
    latest = pieces.split_documents(df, ["k0"], "h", 30, 0, version="v")
    assert {(r["piece_no"], r["n_pieces"]) for r in latest.where("start_at = 0").collect() if r[0] == "k"} == {(1, 1)}
    assert pieces.split_documents(df.limit(0), ["k0"], "h").count() == 0


def test_arms(spark):
    arms = "c struct<markdown:string,raw_text:string,chunks:array<struct<text:string,headings:array<string>>>,pages:array<struct<text:string,tables:array<array<array<string>>>>>,slides:array<struct<slide_number:int,texts:array<string>>>>"
    rows = [
        (1, (None, None, [(" a ", []), (None, None), ("b", None)], None, None)),
        (2, (None, None, None, [("p", [[["x", "", " y"], ["", None]]]), ("q", None)], None)),
        (3, (None, None, None, None, [(1, ["s", " "]), (2, None), (3, ["t"])])),
        (4, (" m ", None, None, None, None)), (5, (None, None, None, None, None)), (6, None),
    ]
    df = spark.createDataFrame(rows, f"id int, {arms}")
    got = {r["id"]: r["piece"] for r in pieces.split_documents(df, ["id"], "c").collect()}
    assert got == {1: "a\n\nb", 2: "p\n\nx | y\n\nq", 3: "s\n\nt", 4: "m"}


def test_sections_do_not_run_into_each_other():
    """The end of an oversized section stays by itself, whole siblings are merged."""
    text = "# A\n" + "word " * 30 + "\n# B\nshort\n# C\nshort too\n# D\n" + "other " * 30
    spans = pieces.split_text(text, 60, 0)
    assert "".join(text[a:b] for a, b in spans) == text and all(b - a <= 60 for a, b in spans)
    starts = {text.index(h) for h in ("# A", "# B", "# D")}
    assert starts <= {a for a, _ in spans}
    assert any(text[a:b] == "# B\nshort\n# C\nshort too\n" for a, b in spans)


# --- leaks --------------------------------------------------------------------------------------------------------------


def test_words():
    assert leaks.words("The <b>Quick</b>, brown-fox jum-\nped; US$1,034 &amp; — “x”") == ["the", "quick", "brownfox", "jumped", "us1034", "x"]


def brute(item, doc, least=20):
    for i in range(len(item) - least + 1):
        for n in range(least, len(item) - i + 1):
            k = n // 10
            for j in range(len(doc)):
                d = list(range(len(doc) - j + 1))
                for a in range(1, n + 1):
                    new = [a]
                    for b in range(1, len(d)):
                        new.append(min(d[b] + 1, new[-1] + 1, d[b - 1] + (item[i + a - 1] != doc[j + b - 1])))
                    d = new
                if item[i] == doc[j] and any(c <= k and item[i + n - 1] == doc[j + b - 1] for b, c in enumerate(d) if b):
                    return True
    return False


def test_alignment_against_brute_force():
    rng = np.random.default_rng(1)
    item = [f"w{i}" for i in range(26)]
    for _ in range(40):
        a, n = int(rng.integers(0, 6)), int(rng.integers(15, 24))
        part = item[a : a + n]
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(0, len(part)))
            kind = int(rng.integers(0, 3))
            part = part[:at] + ([] if kind == 0 else ["z"] if kind == 1 else ["z", part[at]]) + part[at + 1 :]
        doc = ["u", "v", *part, "x"]
        assert leaks.repeats(item, doc) == brute(item, doc), (part,)


def test_find_leaks(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    items = [(i, " ".join(word() for _ in range(60))) for i in range(5)] + [(8, None), (9, "short one")]
    docs = [(i, " ".join(word() for _ in range(80))) for i in range(30)] + [(90, None), (91, " "), (92, "x")]
    passage = items[2][1].split()[10:35]
    altered = passage[:5] + ["other"] + passage[6:15] + passage[16:]
    docs += [(100, docs[0][1] + " " + " ".join(passage).upper()), (101, "a b " + ", ".join(altered)), (101, "a b " + ", ".join(altered)), (102, " ".join(passage[:18]))]
    docs += [(103, "filler words here " * 30_000 + " ".join(passage))]
    d = spark.createDataFrame(docs, "k long, t string")
    i = spark.createDataFrame(items, "item long, t string")
    got = sorted((r["item"], r["k"]) for r in leaks.find_leaks(d, i, "k", "t", "item", "t").collect())
    assert got == [(2, 100), (2, 101), (2, 103)]
    assert leaks.find_leaks(d.limit(0), i, "k", "t", "item", "t").count() == 0
    assert leaks.find_leaks(d, i.limit(0), "k", "t", "item", "t").count() == 0


@pytest.mark.parametrize("length", [60, 300, 1000, 3000])
def test_copies_of_long_items(spark, length):
    """A copy of 25 words is found whatever the item's length, by the cosine alone as well."""
    rng = random.Random(length)
    made = lambda n: ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)]
    items = [made(length) for _ in range(10)]
    docs = []
    for i, item in enumerate(items):
        at = rng.randrange(length - 25)
        docs.append((i, " ".join(made(200) + item[at : at + 25] + made(200))))
    docs += [(100 + i, " ".join(made(400))) for i in range(20)]
    d = spark.createDataFrame(docs, "k int, t string")
    q = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item int, t string")
    for by_runs in (True, False):
        got = {(r["item"], r["k"]) for r in leaks.find_leaks(d, q, "k", "t", "item", "t", by_runs=by_runs).collect()}
        assert got == {(i, i) for i in range(10)}, (length, by_runs)


def test_singular_vectors(spark):
    """The basis spans the leading right singular vectors, as an exact decomposition gives them."""
    rng = np.random.default_rng(3)
    texts = [rng.choice(60, 20, p=np.arange(60, 0, -1) / 1830).astype(np.int32) for _ in range(400)]
    tokens = spark.createDataFrame([(i, t.tolist()) for i, t in enumerate(texts)], "k int, w array<int>")
    idf = np.ones(leaks.BUCKETS, np.float32)
    item = [texts[0]]
    basis, values = leaks.latent_basis(tokens, item, idf, 1e-9)
    a = np.zeros((400, 60))
    for i, t in enumerate(texts):
        np.add.at(a[i], t, 1)
    want = np.linalg.svd(a, compute_uv=False)
    assert basis.shape == (leaks.BUCKETS, leaks.RANK) and np.allclose(basis.T @ basis, np.eye(leaks.RANK), atol=1e-3)
    assert np.allclose(values[:20], want[:20], rtol=0.05)


def test_paraphrases(spark):
    item = "question alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima answer: mike november oscar papa quebec romeo sierra tango uniform"
    other = "alpha so bravo then charlie or delta and echo foxtrot golf hotel with india juliet kilo for lima mike november by oscar papa quebec romeo"
    docs = spark.createDataFrame([(1, other), (2, item), (3, "nothing of that sort at all " * 5), (4, None)], "k int, t string")
    items = spark.createDataFrame([(7, item)], "item int, t string")
    got = leaks.find_paraphrases(docs, items, "k", "t", "item", "t", 0.5).collect()
    assert [r["k"] for r in got] == [1] and got[0]["lcs"] >= 0.5
    assert leaks.find_paraphrases(docs.limit(0), items, "k", "t", "item", "t").count() == 0


def test_least_leaks_of_long_items(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    item = [word() for _ in range(500)]
    rows = [(-1 - i, " ".join(word() for _ in range(80))) for i in range(20)]
    for at in range(len(item) - 20 + 1):
        altered = ((6, 13), (1, 18), (5, 12))[at % 3]
        part = [word() if n in altered else w for n, w in enumerate(item[at : at + 20])]
        rows.append((at, " ".join([word() for _ in range(40 + at % 5)] + part + [word() for _ in range(40)])))
    docs, items = spark.createDataFrame(rows, "k long, t string"), spark.createDataFrame([(1, " ".join(item))], "item long, t string")
    got = sorted(r["k"] for r in leaks.find_leaks(docs, items, "k", "t", "item", "t").collect())
    assert got == list(range(len(item) - 20 + 1))


# --- mixing -------------------------------------------------------------------------------------------------------------


def test_mix(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ["a", "b", "c", "other", None][i % 5], int(rng.integers(0, 50))) for i in range(3000)]
    sized = spark.createDataFrame(rows, "doc long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.6, 2), ("b", 0.3, 1), ("c", 0.1, 3), ("absent", 0.0, 1)], "source string, target_share double, max_repeats int")
    drawn = mixing.mix(sized, targets, "doc", "source")
    report = {r["source"]: r for r in mixing.mix_report(drawn, targets, "source").collect()}
    for s, share, most in (("a", 0.6, 2), ("b", 0.3, 1), ("c", 0.1, 3)):
        assert abs(report[s]["actual_share"] - share) < 0.002 and report[s]["most_uses"] <= most
    assert report["absent"]["tokens"] == 0
    # a smaller budget's selection lies within a larger one's, and each is the most that fits
    small = {r["doc"]: r["uses"] for r in mixing.mix(sized, targets, "doc", "source", 9_000).collect()}
    large = {r["doc"]: r["uses"] for r in mixing.mix(sized, targets, "doc", "source", 12_000).collect()}
    assert all(large.get(k, 0) >= n for k, n in small.items())
    size = {k: n for k, _, n in rows}
    for s, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
        got = sum(size[k] * n for k, n in small.items() if rows[k][1] == s)
        assert 9_000 * share - 50 < got <= 9_000 * share + 1
    assert mixing.mix(sized.limit(0), targets, "doc", "source").count() == 0


def test_count_tokens(spark):
    df = spark.createDataFrame([(1, "a", "hello world"), (2, None, None), (3, "b", ""), (3, "b", "<|endoftext|>" * 3)], "k long, s string, t string")
    got = sorted((r["k"], r["n_tokens"]) for r in mixing.count_tokens(df, "k", "t", "s").collect())
    assert got[0] == (1, 2) and got[1] == (2, 0) and got[2] == (3, 0) and got[3][1] > 3


# --- mojibake -------------------------------------------------------------------------------------------------------------

HONEST = ["«Ã» is a letter; so is “â”.", "Å-scale, naïve Ãvila bay", "SEÇÃO 6: NÃO será aceita caução", "Жуков & Söhne, № 7.", "© São Pedro £5 – Â-class, “AÇÃO”.", "Ângela’s Ø90 mm valve, ±2 %.", "l’été à Paris", "合同金额为US$3。", "", "plain"]
WRONG = [("La sociedad rechazó la oferta más baja.", "cp1252", "utf-8"), ("Bidders’ questions will be answered – later.", "mac_roman", "utf-8"), ("el máximo según presupuesto", "cp437", "utf-8"), ("La comisión rechazó", "cp1251", "utf-8"), ("NÃO será aceita caução inferior", "mac_roman", "cp1252")]


def garble(text, shown, stored):
    return text.encode(stored).decode(shown, "replace" if shown == "cp1252" else "strict")


def test_restore():
    d = mojibake.Describer({"x": "\n".join(HONEST + [w[0] for w in WRONG]).encode()})
    for t in HONEST:
        assert mojibake.restore(t, d) == (t, [])
    for text, shown, stored in WRONG:
        now, chains = mojibake.restore(garble(text, shown, stored), d)
        assert (now, len(chains)) == (text, 1)
    assert mojibake.restore("caf� next", d)[1] == ["lost"]
    twice = garble(garble("el máximo según", "cp1252", "utf-8"), "cp1252", "utf-8")
    assert mojibake.restore(twice, d)[0] == "el máximo según"


def test_restore_texts(spark):
    rows = [(1, "x", "el mÃ¡ximo segÃºn el presupuesto"), (2, None, None), (3, "en", "plain"), (4, "pt", HONEST[2]), (1, "x", "el mÃ¡ximo segÃºn el presupuesto")]
    df = spark.createDataFrame(rows, "k long, lang string, restored string").withColumn("chains", F.lit(1))  # names as the operator's own
    got = [(r["k"], r["restored"]) for r in mojibake.restore_texts(df, "k", "restored", "lang").collect()]
    assert got == [(1, "el máximo según el presupuesto")] * 2
    assert mojibake.restore_texts(df.limit(0), "k", "restored", "lang").count() == 0


def test_scripts_of_no_list(spark):
    """Signs of scripts that the dictionaries lack are restored as well; honest pairs that could be one such sign stay."""
    d = mojibake.Describer({"x": "\n".join(HONEST).encode()})
    for honest in ("Оплата 😀 done", "다음 문서를 보내 주세요", "يرجى إرسال الوثائق"):
        wrong = mojibake._RUN.sub(lambda m: "".join(chr(b) if b in mojibake._CP1252_GAPS else bytes([b]).decode("cp1252") for b in m.group().encode()), honest)
        assert mojibake.restore(wrong, d)[0] == honest
    assert mojibake.restore("L’âge du contrat", d) == ("L’âge du contrat", [])


def test_dictionaries_of_all_languages(spark):
    rows = [(f"texte numéro {i} déjà signé.", "fr") for i in range(20)] + [(f"tekst nr {i} został podpisany.", "pl") for i in range(20)] + [("x", "zz"), (None, "fr"), ("y", None)]
    df = spark.createDataFrame(rows, "t string, l string")
    found = mojibake.fit_dictionaries(df, "t", "l")
    assert sorted(found) == ["fr", "pl"] and mojibake.fit_dictionaries(df.orderBy(F.rand(1)), "t", "l") == found
    assert mojibake.fit_dictionaries(df.limit(0), "t", "l") == {}
