from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tamarind.functions.instants import instant, readings
from tamarind.operators.timestamps import normalise_instants, viterbi


def micros(*parts, zone="America/Jamaica"):
    return int(datetime(*parts, tzinfo=ZoneInfo(zone)).astimezone(timezone.utc).timestamp()) * 1_000_000


CASES = [
    ("26/02/2026 11:30:00", micros(2026, 2, 26, 11, 30)),
    ("24/2/2026 10:30", micros(2026, 2, 24, 10, 30)),
    ("02/06/23 11:30", micros(2023, 6, 2, 11, 30)),
    ("25/02/2026 11:30:00 ", micros(2026, 2, 25, 11, 30)),
    ("25/02/2026 11:30:00 UTC-5", micros(2026, 2, 25, 11, 30)),
    ("25/02/2026 11:30:00 (UTC-5)", micros(2026, 2, 25, 11, 30)),
    ("12/01/2022 14:00:00 UTC-05:00", micros(2022, 1, 12, 14)),
    ("2026-02-25 11:00:00-03:30", micros(2026, 2, 25, 14, 30, zone="UTC")),
    ("2024-08-21 11:00:00.250-05:00", micros(2024, 8, 21, 16, zone="UTC") + 250_000),
    ("2026-01-30T18:15:00Z", micros(2026, 1, 30, 18, 15, zone="UTC")),
    ("20220612T211500Z", micros(2022, 6, 12, 21, 15, zone="UTC")),
    ("Sun, 30 Jul 2023 10:00:00 -0500", micros(2023, 7, 30, 15, zone="UTC")),
    ("19-Feb-2026 14:00:00", micros(2026, 2, 19, 14)),
    ("December 22, 2025", micros(2025, 12, 22)),
    ("Jul 20, 2021 2:15 p.m.", micros(2021, 7, 20, 14, 15)),
    ("19/05/2025 12:00 PM", micros(2025, 5, 19, 12)),
    ("19/05/2025 12:10 AM", micros(2025, 5, 19, 0, 10)),
    ("18/01/2025 15:00:00 GMT", micros(2025, 1, 18, 15, zone="UTC")),
    ("02/11/2023 10:10:49 EDT", micros(2023, 11, 2, 14, 10, 49, zone="UTC")),
    ("12/09/2025 00:41:56 BST", micros(2025, 9, 11, 23, 41, 56, zone="UTC")),
    ("27/02/2026 12:30:00 America/New_York", micros(2026, 2, 27, 12, 30, zone="America/New_York")),
    ("2025-08-25T19:00:00[Europe/London]", micros(2025, 8, 25, 19, zone="Europe/London")),
    ("2024-10-27T01:06:39 Europe/London", micros(2024, 10, 27, 0, 6, 39, zone="UTC")),  # occurs twice: the first
    ("1772042400", 1772042400 * 10**6),
    ("1674837000000", 1674837000000 * 10**3),
    ("46080", micros(2026, 2, 27)),
    ("2023-04-13", micros(2023, 4, 13)),
]
NONE = [None, "", "  ", "TBA", "-", "31/02/2025", "00/00/0000", "2023-13-01", "12/03/2023 02:31:00 America/New_York", "13/05/2025 13:00 PM", "25/02/2026 11:30 XYZ"]


def test_readings(spark):
    df = spark.createDataFrame(CASES + [(x, None) for x in NONE], "raw string, want long")
    for r in df.withColumn("got", instant(F.col("raw"))).collect():
        assert r["got"] == r["want"], r


def test_both_orders(spark):
    df = spark.createDataFrame([("03/04/2025 10:00",), ("23/04/2025 10:00",)], "raw string")
    got = [len(r["x"]) for r in df.select(readings(F.col("raw"), slashed="both").alias("x")).collect()]
    assert got == [2, 1]


def test_viterbi_prefers_order_and_form():
    path = [[("d", 10)], [("d", 30), ("m", 5)], [("d", 40), ("m", 20)], [("d", 50)]]
    assert viterbi(path) == [0, 0, 0, 0]
    assert viterbi([[("m", 10)], [("d", 5), ("m", 20)], [("m", 30)]]) == [0, 1, 0]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_runs_across_partitions(spark, partitions):
    """Ambiguous values between certain ones come out alike however the records are laid out."""
    rows = [("s", i, f"{d:02d}/03/2025 10:00") for i, d in enumerate([13, 1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14])]
    rows += [("t", 0, "05/06/2025 10:00"), ("t", 1, "06/06/2025 09:00"), ("u", 0, None)]
    df = spark.createDataFrame(rows, "source string, n int, raw string")
    got = normalise_instants(df, "raw", ["source"], ["n"], ["source", "n"], partitions, slashed="both").collect()
    assert len(got) == 15
    forms = {(r["source"], r["n"]): r["form"] for r in got}
    assert {f for (s, _), f in forms.items() if s == "s"} == {"d/m/y"}
    whole = sorted((r["source"], r["n"], r["utc_micros"]) for r in normalise_instants(df, "raw", ["source"], ["n"], ["source", "n"], 1, slashed="both").collect())
    assert sorted((r["source"], r["n"], r["utc_micros"]) for r in got) == whole


def test_edges(spark):
    df = spark.createDataFrame([(1, "2023-04-13", "x"), (1, "2023-04-13", "x"), (None, "2023-04-14", None)], "id long, raw string, form string")
    got = normalise_instants(df.withColumnRenamed("form", "micros"), "raw", [], ["id"], ["id", "micros"]).collect()
    assert sorted((r["id"] or 0, r["micros"] or "") for r in got) == [(0, ""), (1, "x"), (1, "x")]
    assert normalise_instants(df.limit(0), "raw", [], ["id"], ["id"]).count() == 0
