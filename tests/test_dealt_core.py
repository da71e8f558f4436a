import pytest
from pyspark.sql import functions as F

from tamarind.operators.packed import CATEGORY_CODE, CPV_CODE, unpack
from tamarind.operators.snapshots import plain, snapshot_changes
from tamarind.operators.units import aliases, parse_quantity, to_common_unit

QUANTITIES = [
    ("15,691,439.89", 15691439.89, None), ("$8,172,397.81", 8172397.81, None), ("30,621.87 (USD)", 30621.87, "usd"),
    ("9.150.508,80 JMD", 9150508.80, "jmd"), ("7 221 388.15 JMD", 7221388.15, "jmd"), ("152 418 893,74", 152418893.74, None),
    ("1'364'125.88", 1364125.88, None), ("J$4.78467E+06", 4784670.0, "j$"), ("16.722M", 16722000.0, None), ("3.1180 MM", 3118000.0, None),
    ("JMD 000s: 100,980.00", 100980000.0, "jmd"), ("1,145.00 ('000)", 1145000.0, None), ("12,763.46 (in thousands) Currency: JMD", 12763460.0, "jmd"),
    ("72,900.21K", 72900210.0, None), ("JMD 5.9552 Million (approx.)", 5955200.0, "jmd"), ("JMD 1.4312 billion", 1431200000.0, "jmd"),
    ("J$291,542.60 per month for 24 months", 6997022.40, "j$"), ("JMD 2,730,909.99 per annum for three years", 8192729.97, "jmd"),
    ("Euro 46.82 a month for thirty-six months", 1685.52, "euro"), ("US$100 per quarter x four quarters", 400.0, "us$"), ("GBP 10 monthly over 6 months", 60.0, "gbp"),
    ("100 per month for 2 years", 2400.0, None),
    ("TWO MILLION SEVEN HUNDRED AND SIXTY-SEVEN THOUSAND Trinidad and Tobago dollars", 2767000.0, "trinidadandtobagodollars"),
    ("Six hundred and sixty thousand five hundred euros", 660500.0, "euros"), ("Twenty Million Ten Thousand Jamaican dollars only", 20010000.0, "jamaicandollars"),
    ("as per schedule of rates", None, None), ("N/A", None, None), ("-", None, None), ("", None, None), (None, None, None),
]


def test_quantities(spark):
    df = spark.createDataFrame([(r, a, u) for r, a, u in QUANTITIES], "raw string, amount double, unit string")
    for r in df.withColumn("q", parse_quantity(F.col("raw"))).collect():
        if r["amount"] is None:
            assert r["q"]["amount"] is None, r
        else:
            assert r["q"]["amount"] == pytest.approx(r["amount"], rel=1e-9), r
            assert r["q"]["unit"] == r["unit"], r


def test_common_unit(spark):
    rates = spark.createDataFrame([("JMD", 1.0), ("USD", 100.0)], "code string, rate double")
    units = aliases(spark, rates, "code", "rate")
    rows = [(1, "5 USD", "JMD"), (2, "5", "US$"), (3, "5", None), (4, "5", "unheard of"), (5, "XCD 5", None), (5, "XCD 5", None), (6, None, "USD")]
    df = spark.createDataFrame(rows, "factor int, raw string, alias string")  # names as the unit table's
    got = to_common_unit(df, "raw", units, "alias", "JMD").collect()
    assert sorted((r["factor"], r["common_value"]) for r in got if r["factor"] < 5) == [(1, 500.0), (2, 500.0), (3, 5.0), (4, 5.0)]
    assert [r["common_value"] for r in got if r["factor"] >= 5] == [None, None, None]
    assert to_common_unit(df.limit(0), "raw", units, "alias", "JMD").count() == 0


PACKED = [
    ("60980170-9 and 58213460-2", CPV_CODE, ["60980170-9", "58213460-2"]),
    ('"30798720-3",37809400-2,"33842840-8"', CPV_CODE, ["30798720-3", "37809400-2", "33842840-8"]),
    ('["91606340-1", "41556350-0"]', CPV_CODE, ["91606340-1", "41556350-0"]),
    ("{33891090-7,49146050-2}", CPV_CODE, ["33891090-7", "49146050-2"]),
    ("64673960-2 - Bitumen and asphalt; 41961400-4: Electrical fittings; low voltage", CPV_CODE, ["64673960-2 - Bitumen and asphalt", "41961400-4: Electrical fittings; low voltage"]),
    (";95105440-7: School furniture; ; 95105440-7: School furniture;", CPV_CODE, ["95105440-7: School furniture", "95105440-7: School furniture"]),
    ("* 97820440-7\n* 53508090-4", CPV_CODE, ["97820440-7", "53508090-4"]),
    ("1) G78 - Solid Waste, Haulage 2) PPC52", CATEGORY_CODE, ["G78 - Solid Waste, Haulage", "PPC52"]),
    ("(1) CW89 Pipe Laying; (2) S85 - Civil Engineering (Grade 1)", CATEGORY_CODE, ["CW89 Pipe Laying", "S85 - Civil Engineering (Grade 1)"]),
    ("1. G69 Security Services (unarmed)\n2. CW03 Industrial Painting | Coating", CATEGORY_CODE, ["G69 Security Services (unarmed)", "CW03 Industrial Painting | Coating"]),
    ('["S83 - General Services", "CW18 - Roofing \\"Class A\\""]', CATEGORY_CODE, ["S83 - General Services", 'CW18 - Roofing "Class A"']),
    ('"G95 Roofing ""Class A""";"PPC82: Food/Beverages"', CATEGORY_CODE, ['G95 Roofing "Class A"', "PPC82: Food/Beverages"]),
    ("'G19: Roofing \"Class A\"', 'PPC09 - Pest Control'", CATEGORY_CODE, ['G19: Roofing "Class A"', "PPC09 - Pest Control"]),
    ('S02 - Roofing "Class A"\nS73: Electrical Works - Low Voltage', CATEGORY_CODE, ['S02 - Roofing "Class A"', "S73: Electrical Works - Low Voltage"]),
    ("CW27 Medical Goods & Supplies & PPC77", CATEGORY_CODE, ["CW27 Medical Goods & Supplies", "PPC77"]),
    ("W74", CATEGORY_CODE, ["W74"]), ("[]", CATEGORY_CODE, []), ("", CATEGORY_CODE, []), (None, CATEGORY_CODE, []),
]


def test_packed(spark):
    for code in (CPV_CODE, CATEGORY_CODE):
        mine = [(i, raw) for i, (raw, c, _) in enumerate(PACKED) if c == code]
        df = spark.createDataFrame(mine, "piece int, shape string")  # names as the operator's own
        got: dict = {}
        for r in unpack(df, "shape", ["piece"], code).collect():
            got.setdefault(r["piece"], {})[r["pos_no"]] = r["item_value"]
        for i, _ in mine:
            items = got.get(i, {})
            assert [items[k] for k in sorted(items)] == PACKED[i][2], PACKED[i]
            assert sorted(items) == list(range(1, len(items) + 1))


def test_packed_long_and_empty(spark):
    n = 3000
    df = spark.createDataFrame([(1, "; ".join(f"{i:08d}-{i % 10}" for i in range(n)))], "id int, v string")
    assert unpack(df, "v", ["id"], CPV_CODE).count() == n
    assert unpack(df.limit(0), "v", ["id"], CPV_CODE).count() == 0


def changes(df, compared=("text",)):
    got = snapshot_changes(df, "day", "k", "v", [plain(F.col(c)) for c in compared]).collect()
    return sorted((r["day"], r["k"], r["change_kind"]) for r in got)


def test_snapshots(spark):
    rows = [
        ("d1", "a", 1, "x  y"), ("d1", "b", 1, "same"), ("d1", "c", 1, "gone"), ("d1", "n", 1, None),
        ("d2", "a", 1, " x y "), ("d2", "b", 1, "old"), ("d2", "b", 2, "new"), ("d2", "b", 2, "new"), ("d2", "e", 1, "came"), ("d2", "n", 1, "  "),
        ("d3", "a", 1, "x y"), ("d3", "b", 1, "new"), ("d3", "e", 1, "came"), ("d3", "c", 1, "back"), ("d3", None, 1, "?"), ("d3", "n", 1, ""),
    ]
    df = spark.createDataFrame(rows, "day string, k string, v int, text string")
    assert changes(df) == [("d2", "b", "changed"), ("d2", "c", "removed"), ("d2", "e", "added"), ("d3", "c", "added")]
    assert changes(df.where("day = 'd1'")) == []
    assert changes(df.limit(0)) == []
    assert changes(df.withColumn("at", F.lit(1)).withColumn("d", F.rand())) == changes(df)


def test_snapshot_ties_do_not_depend_on_order(spark):
    rows = [("d1", "a", 1, "x"), ("d1", "a", 1, "y"), ("d2", "a", 1, "y"), ("d2", "a", 1, "x")]
    df = spark.createDataFrame(rows, "day string, k string, v int, text string")
    assert changes(df) == [] == changes(df.orderBy(F.desc("text")))
