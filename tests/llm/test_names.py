import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarind.llm.names import INDEX_EDITS, _index_keys, _probe_keys, edits, link_names, name_pairs, take_apart


def plain_edits(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@given(st.text("abc", max_size=9), st.text("abc", max_size=9), st.integers(0, 3))
@settings(max_examples=300, deadline=None)
def test_banded_distance(a, b, k):
    assert edits(a, b, k) == min(plain_edits(a, b), k + 1)


@given(st.text("abcd", min_size=4, max_size=14), st.lists(st.tuples(st.integers(0, 13), st.sampled_from("abcd-+")), max_size=INDEX_EDITS))
@settings(max_examples=300, deadline=None)
def test_pigeonhole_misses_none(name, changes):
    other = list(name)
    for at, what in changes:
        at = min(at, len(other) - 1)
        if what == "-" and len(other) > 4:
            del other[at]
        elif what == "+":
            other.insert(at, "a")
        elif what not in "+-":
            other[at] = what
    assert set(_index_keys(name)) & set(_probe_keys("".join(other)))


def test_apart():
    a = take_apart("Ministry of Land Survey & Port Logistics ", False)
    assert a == take_apart("MINISTRY OF LAND SURVEY AND PORT LOGISTICS, Jamaica", False) == take_apart("Min. of Land Survey and Port Logistics", False)
    assert take_apart("Air Conditioning Ltd, Kannurux Global", True) == take_apart("Kannurux Global Air Conditioning Limited", True)
    assert take_apart("Bel sotosk Engineering Ltd", True) == take_apart("Belsotosk-Engineering Ltd", True)
    assert take_apart("Bostanong, Eddie T.", True)[:3] == ("person", "bostanong", "edward")
    assert take_apart("Ltd", True) is None and take_apart("", True) is None


@pytest.fixture(scope="module")
def linked(spark):
    rows = [
        ("authority", n)
        for n in ("National Roads and Bridges Agency", "National Rodas and Bridges Agency", "NRBA", "Agency, National Roads and Bridges", "Hotizuth High School", "Horizuth Primary School", "H.S.", None, " ", "日本")
    ] + [
        ("contractor", n)
        for n in (
            "Semsofath Caribbean Printing Incorporated", "Semsofath Caribbean Incorporated", "M/s Semsofath\nCaribbean Printing LTD",
            "Bunfolesk Northern Dredging Ltd", "Bunfolesk Northern Roofing Ltd", "Bunfolesk Northern Ltd",
            "Anthony J. Zanmizord", "Anthony Zanmizord", "A J Zanmizord", "ZANMIZORD TONY", "Deborah K. Fasserer", "Deborah L. Fasserer", "Deborah Fasserer",
        )
    ]
    return spark.createDataFrame(rows * 3, "kind string, raw string")


def test_links(linked):
    by = {}
    for r in link_names(linked).collect():
        by.setdefault((r["kind"], r["entity"]), set()).add(r["raw"])
    groups = sorted(sorted(v) for v in by.values() if len(v) > 1)
    assert groups == [
        ["A J Zanmizord", "Anthony J. Zanmizord", "Anthony Zanmizord", "ZANMIZORD TONY"],
        ["Agency, National Roads and Bridges", "NRBA", "National Roads and Bridges Agency", "National Rodas and Bridges Agency"],
        ["M/s Semsofath\nCaribbean Printing LTD", "Semsofath Caribbean Incorporated", "Semsofath Caribbean Printing Incorporated"],
    ]


def test_pairs_and_empty(linked):
    pairs = name_pairs(link_names(linked)).collect()
    assert len(pairs) == 6 + 6 + 3 and all(r["name_a"] < r["name_b"] for r in pairs)
    assert name_pairs(link_names(linked.limit(0))).count() == 0


def test_words_of_no_list(spark):
    """Names of words that no list holds: typos, another order, abbreviations that the data explain."""
    rng = random.Random(5)
    word = lambda k: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(k))
    trades = ["wobblery", "quandling", "mizzenworks", "thrumbling", "vexillary", "plonkering"]
    short = {t: t[0] + "".join(c for c in t[1:] if c not in "aeiou")[:3] for t in trades}
    rows, entity = [], {}
    for i in range(150):
        a, b, t = word(4).title(), word(3).title(), trades[i % 6]
        typo = a[:3] + rng.choice("bdfg") + a[4:]
        forms = {f"{a} {b} {t} Ltd", f"{b} {a} {t} Limited", f"{typo} {b} {t}", f"{t}, {a} {b} Ltd", f"{a} {b} {short[t].title()}.", f"{b} {typo} {t} Ltd"}
        rows += [("contractor", x) for x in forms]
        entity.update(dict.fromkeys(forms, i))
    linked = link_names(spark.createDataFrame(rows, "kind string, raw string"))
    pairs = {(r["name_a"], r["name_b"]) for r in name_pairs(linked).collect()}
    want = {(x, y) for x in entity for y in entity if x < y and entity[x] == entity[y]}
    assert len(pairs & want) >= 0.95 * len(want) and len(pairs - want) <= 0.01 * len(want)


def test_reordered_unlisted_words(spark):
    rows = [("contractor", n) for n in ("Zorvex Quillan Beverages Ltd", "Quillan Zorvex Beverages Limited", "Zorvex Quilan Beverages Ltd", "Zorvex Mubbin Beverages Ltd")]
    by = {r["raw"]: r["entity"] for r in link_names(spark.createDataFrame(rows, "kind string, raw string")).collect()}
    assert len({by[n] for _, n in rows[:3]}) == 1 and by[rows[3][1]] != by[rows[0][1]]
