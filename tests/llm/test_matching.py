from collections import deque

import numpy as np
from pyspark.sql import functions as F

from tamarind.llm import matching as m
from tamarind.llm.plans import p7_sides

def test_titles():
    assert m.title_parts("RE: Supply of Hospital Beds to Raburift College, (Lot III) - Phase 2 FY 2023/24") == (["supply", "hospital", "beds", "raburift", "college"], "3", "2", "2023")
    assert m.title_parts("D&B Muzuzer Fire Stn Annex, LOT-3")[:2] == (["design", "build", "muzuzer", "fire", "station", "annex"], "3")
    assert m.reference_parts("Ref: CAP_2026_0561-L2") == ("CAP", "2026", "561", "2")
    assert m.reference_parts("2026/0437") == ("", "2026", "437", "")
    assert m.reference_parts("see file") == m.reference_parts(None) == ("", "", "", "")


def records(spark):
    rng = np.random.default_rng(2)
    places = ["".join(rng.choice(list("bdfgklmnprst")) + rng.choice(list("aeiou")) for _ in range(4)) for _ in range(60)]
    kinds = ["Supply of Hospital Beds to {} College", "Construction of {} Fire Station Annex", "Provision of Pest Control - {} Campus"]
    tenders, awards, want = [], [], set()
    for i, p in enumerate(places):
        title = kinds[i % 3].format(p.title())
        ref = f"CAP/2025/{i:04d}"
        tenders.append((f"2{i:03d}", title, f"{p.title()} High School", ref, 100, i % 2, "open"))
        changed = title.upper() if i % 4 == 0 else title.replace("Hospital", "Hopsital").replace("Station", "Stn") if i % 4 == 1 else title[:-1] + "." if i % 4 == 2 else title
        awards.append((f"6{i:03d}", changed, f"{p.title()} High School", ref if i % 3 else None, 160))
        want.add((f"2{i:03d}", f"6{i:03d}"))
    # another lot, another year, no counterpart, nulls
    tenders += [("2900", tenders[0][1] + ", Lot 2", tenders[0][2], None, 100, 0, None), ("2901", tenders[1][1], tenders[1][2], None, -900, 0, "open"), ("2902", None, None, None, None, None, None)]
    awards += [("6900", "Resurfacing of Zzyxyz Footpath", None, None, 160), ("6901", "", None, None, None), (None, "x", None, None, None)]
    shape = "id string, title string, entity string, reference string, day int"
    return spark.createDataFrame(tenders, shape + ", basis int, trait string"), spark.createDataFrame(awards, shape), want


def test_matches(spark):
    left, right, want = records(spark)
    got = m.match_records(left, right).collect()
    pairs = {(r["left_id"], r["right_id"]) for r in got}
    assert pairs <= want and len(pairs) >= 0.9 * len(want)
    assert all(0 <= r["confidence"] <= 1 for r in got)
    assert m.match_records(left.limit(0), right).count() == 0
    assert m.match_records(left.limit(0), right.limit(0)).count() == 0


def test_rows_do_not_depend_on_extra_columns_or_order(spark):
    left, right, _ = records(spark)
    plain = sorted((r["left_id"], r["right_id"]) for r in m.match_records(left, right).collect())
    other = m.match_records(left.withColumn("node", F.rand()).withColumn("words", F.lit("x")).orderBy(F.desc("id")), right.withColumn("key", F.lit(1))).collect()
    assert len(plain) > 40 and len(set(plain) & {(r["left_id"], r["right_id"]) for r in other}) >= 0.95 * len(plain)


def test_without_references(spark):
    """Titles and entities decide where no reference is known; ids may be numbers."""
    left, right, want = records(spark)
    none = F.lit(None).cast("string")
    got = m.match_records(left.withColumn("reference", none).withColumn("id", F.col("id").cast("long")), right.withColumn("reference", none)).collect()
    pairs = {(r["left_id"], r["right_id"]) for r in got}
    assert pairs <= want and len(pairs) >= 0.8 * len(want)


def test_a_title_shared_by_a_third(spark):
    """A title that names nothing: only reference, or entity and period, tell its records apart."""
    left, right, want = records(spark)
    same = [(f"3{i:04d}", "Consultancy Services", f"Body {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} School", f"SRV/2024/{i:04d}", 100 + i % 300, 0, "open") for i in range(1500)]
    theirs = [(f"7{i:04d}", "Consultancy Services", f"Body {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} School", f"SRV/2024/{i:04d}", 160 + i % 300) for i in range(1500)]
    left = left.unionByName(spark.createDataFrame(same, left.schema))
    right = right.unionByName(spark.createDataFrame(theirs, right.schema))
    pairs = {(r["left_id"], r["right_id"]) for r in m.match_records(left, right).collect()}
    assert sum(a.startswith("3") and b == "7" + a[1:] for a, b in pairs) >= 1350
    assert len(pairs & want) >= 0.8 * len(want)


def test_a_common_title_without_reference_or_with_another_entity(spark):
    """Records of a common title that share neither reference nor entity's spelling with their counterpart meet it all the same."""
    left, right, want = records(spark)
    rng = np.random.default_rng(5)
    names = ["".join(rng.choice(list("bdfgklmnprstvz")) + rng.choice(list("aeiou")) for _ in range(5)).title() for _ in range(800)]
    body = lambda i: f"{names[i]}ville High School"
    same = [(f"3{i:04d}", "Consultancy Services", body(i), f"SRV/2024/{i:04d}", 100 + i % 300, 0, "open") for i in range(800)]
    # every fifth has no reference, and of these one half a misspelt entity, the other no date
    theirs = [
        (f"7{i:04d}", "Consultancy Services", body(i).replace("ville", "vile") if i % 10 == 0 else body(i), f"SRV/2024/{i:04d}" if i % 5 else None, None if i % 10 == 5 else 160 + i % 300)
        for i in range(800)
    ]
    left = left.unionByName(spark.createDataFrame(same, left.schema))
    right = right.unionByName(spark.createDataFrame(theirs, right.schema))
    pairs = {(r["left_id"], r["right_id"]) for r in m.match_records(left, right).collect()}
    for k in (0, 5):
        mine = [i for i in range(800) if i % 10 == k]
        assert sum((f"3{i:04d}", f"7{i:04d}") in pairs for i in mine) >= 0.9 * len(mine), k
    assert len(pairs & want) >= 0.8 * len(want)


def test_one_reference_is_enough_to_meet(spark, monkeypatch):
    """Pairs of one reference are compared even if their dates lie outside the window that others show."""
    monkeypatch.setattr(m, "OUTSIDE", 0.02)
    left, right, _ = records(spark)
    late = [(f"3{i:03d}", f"Paving of Lokimu{chr(97 + i)}ra Road", "Lokimura Council", f"RD/2025/{i:04d}", 100, 0, "open") for i in range(3)]
    theirs = [(f"7{i:03d}", f"Paving of Lokimu{chr(97 + i)}ra Road", "Lokimura Council", f"RD/2025/{i:04d}", 900) for i in range(3)]
    many = [(f"4{i:03d}", f"Supply of Chairs to Gosu{chr(97 + i % 26)}{chr(97 + i // 26)}n Hall", "Gosun Council", f"CH/2025/{i:04d}", 100, 0, "open") for i in range(300)]
    ours = [(f"8{i:03d}", x[1], x[2], x[3], 160) for i, x in enumerate(many)]
    left = left.unionByName(spark.createDataFrame(late + many, left.schema))
    right = right.unionByName(spark.createDataFrame(theirs + ours, right.schema))
    pairs = {(r["left_id"], r["right_id"]) for r in m.match_records(left, right).collect()}
    assert {(f"3{i:03d}", f"7{i:03d}") for i in range(3)} <= pairs


def test_words_are_summed_and_compared_once():
    """Sums by word equal sums by letter group, whatever is kept; words that cannot be near are told apart without a distance."""
    rng = np.random.default_rng(1)
    table = rng.standard_normal((m.BUCKETS, m.DIMENSIONS)).astype(np.float32)
    words = ["".join(rng.choice(list("abcdeg19"), rng.integers(1, 9))) for _ in range(300)]
    titles = [" ".join(rng.choice(words, rng.integers(0, 6))) for _ in range(100)]
    plain = np.array([sum((table[g] for w in x.split() for g in m._letters(w)), np.zeros(m.DIMENSIONS)) for x in titles])
    for most in (1, 50, 1_000):
        sums = m.Sums(table, most)
        got = np.concatenate([sums([x.split() for x in titles[at : at + 20]]) for at in range(0, 100, 20)])
        assert np.abs(got - plain).max() < 1e-3

    def alike(a, b):
        if min(len(a), len(b)) >= 4 and m.edits(a, b, 1) <= 1 or min(len(a), len(b)) >= 3 and (a.startswith(b) or b.startswith(a)):
            return 1
        return 2 if min(len(a), len(b)) >= 6 and m.edits(a, b, 2) <= 2 else 0

    asked = m._near.cache_info().misses
    assert all(m._alike(a, b) == alike(a, b) for a in words for b in words)
    assert m._near.cache_info().misses - asked < len(words) ** 2 / 4


def test_titles_are_compared_in_arrays(monkeypatch):
    """Compared at once, titles tell what they tell one by one, and few of them have to be compared one by one."""
    rng = np.random.default_rng(4)
    common = ["supply", "repair", "school", "road", "beds", "a", "1", "design", "roof", "kerbs"]
    names = ["".join(rng.choice(list("bdfgklmnprst")) + rng.choice(list("aeiou")) for _ in range(4)) for _ in range(150)]
    titles = [" ".join([*rng.choice(common, rng.integers(0, 6)), *rng.choice(names, rng.integers(0, 3))]) for _ in range(400)]
    titles += [x.replace("e", "", 1) for x in titles[:50]] + [" ".join(names[:40]), " ".join(names[1:31] * 3), ""]
    known = np.zeros(m.BUCKETS, bool)
    known[[m._word(w) - m.BUCKETS for w in common]] = True
    weight = m.Weights(known)
    x, y = rng.integers(0, len(titles), 3_000), rng.integers(0, len(titles), 3_000)
    x[:4], y[:4] = [450, 451, 452, 450], [451, 450, 450, 452]
    want = np.array([m.compare_titles(titles[i].split(), titles[j].split(), weight) for i, j in zip(x, y)])
    single, plain = [], m.compare_titles
    monkeypatch.setattr(m, "compare_titles", lambda *a: single.append(1) or plain(*a))
    share, other = m.compare_all(titles, x, y, weight)
    assert (share == want[:, 0]).all() and (other == want[:, 1]).all()
    assert len(single) < 0.8 * len(x)


def test_frequencies_count_titles(spark):
    """A group or word that a title has twice counts once, and batches add up."""
    titles = ["supply supply beds", "beds of bed", "", "repair road", "road beds"] * 1_000
    groups, words = m.frequencies(spark.createDataFrame([(x,) for x in titles], "words string"))
    want = np.zeros(2 * m.BUCKETS, np.int64)
    for x in titles:
        for c in {m._word(w) for w in x.split()}.union(*map(m._letters, x.split())):
            want[c] += 1
    assert (np.concatenate([groups, words]) == want).all()


def test_release_tells_the_jvm_first(spark, monkeypatch):
    """What Python dropped is unknown to the JVM once ``release`` is done, so that its shuffle files can go."""
    from tamarind.session import release

    client, waiting = spark.sparkContext._gateway._gateway_client, deque()
    monkeypatch.setattr(client, "finalizer_deque", waiting)  # which no thread empties
    frames = [spark.range(10).withColumn("k", F.lit(i)) for i in range(20)]
    assert len(frames) == 20
    del frames
    before = {id(x) for x in waiting}
    kept = list(waiting)
    release(spark)
    assert len(kept) >= 20 and not before & {id(x) for x in waiting}


def test_learned_vectors_matter(spark):
    """Of pairs with one reference and differing titles, learned vectors bring more into one block than random ones do."""
    left, right = p7_sides(spark, "/root/testdata/sf0.1")
    side = lambda df, k: df.where("title is not null").select(F.col("id").alias("rid"), F.lit(k).alias("side"), "title", "entity", "reference", "day", F.lit(0).alias("basis"), F.lit(0).alias("trait"))
    got = side(left, 0).unionByName(side(right, 1)).mapInPandas(m._describe, m._SHAPE).withColumn("node", F.xxhash64("rid", "side")).cache()
    rows = got.where("ref_no <> ''").select("side", "words", F.concat_ws("/", "series", "ref_year", "ref_no", "lot", "fy").alias("k")).toPandas()
    one = rows[rows["side"] == 0].drop_duplicates("k", keep=False).merge(rows[rows["side"] == 1], on="k")
    one = one[(one["words_x"] != one["words_y"]) & np.array([m.compare_titles(x.split(), y.split(), m.Weights(np.zeros(m.BUCKETS, bool)))[0] > 0.5 for x, y in zip(one["words_x"], one["words_y"])])]
    groups, _ = m.frequencies(got)
    weight = np.minimum(np.log((got.count() + 1) / np.maximum(groups, 1)), m.MOST_WEIGHT).astype(np.float32)[:, None]
    met = {}
    for kind in ("learned", "random"):
        vectors = m.train_vectors(m.random_walks(got), 4) if kind == "learned" else np.random.default_rng(1).standard_normal((m.BUCKETS, m.DIMENSIONS)).astype(np.float32)
        table = m._unit(vectors[: m.BUCKETS]) * weight
        mean, turn = m.whitening(got, table)
        planes = np.random.default_rng(2).standard_normal((m.DIMENSIONS, 4, 17))
        bits = [np.einsum("nd,dtb->ntb", m._unit((m._unit(m._totals(list(one[c]), table)) - mean) @ turn), planes) > 0 for c in ("words_x", "words_y")]
        met[kind] = (bits[0] == bits[1]).all(axis=2).any(axis=1).mean()
    got.unpersist()
    print(len(one), met)
    assert len(one) > 500 and met["learned"] > met["random"] + 0.1, met
