"""One golden row per rule, and the letter dispatch against the plain cascade."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import attributes as A
from shelfmark.functions.size_rules import FEED_A_SIZES, FEED_B_SIZES

PRICES_A = {"269.100đ": 269100, "99.5đ": 995, "Giá Liên Hệ": None, "": None, "1.290.000đ": None, "269.100₫": None, None: None}
PRICES_B = {"269.100₫": 269100, "1.290.000₫": 1290000, "2691₫": None, "": None, "269.100đ": None, None: None}
WEIGHTS_A = {"58 g": "58", "0.12 kg": "120", "58g": None, "58.1234 g": None, None: None, "1.125 kg": "1130"}
WEIGHTS_B = {
    "58 g": "58",
    "<58g": "58",
    "60 g (thêm)": "60",
    "0.1 kg": "0.10",
    "60 g / 3,56 oz": "60",
    "< 60 g": "60",
    "101,4 g - pin": "101.40",
    "POWERPLAY 68g / Pin AA 86g": "68",
    "POWERPLAY 68 g": None,
    "abc": None,
    None: None,
}
SIZES_A = {
    "12,5 x 6.3 x 4.1 cm": ("125.00", "63.00", "41.00"),
    "Cao: 125.5 mm x Rộng: 63.2 mm x Dày: 41.7 mm": ("125.50", "41.70", "41.70"),
    "125,5 x 63.2 x 41.7 mm": ("125.00", "63.20", "41.70"),
    "125.5 x 63,2 x 41,7mm": ("125.50", "63.00", "41.70"),
    "Dài: 125.5mm | Rộng: 63.2 mm | Cao: 41.7 mm": ("125.50", "63.20", "41.70"),
    "125.5 x 63.2 x 41.7 mm (Cao x Rộng x Dày)": ("125.50", "63.20", "41.70"),
    "125.5x63.2x41.7mm": ("125.50", "63.20", "41.70"),
    "Cao 125.5 mm x Rộng 63.2 mm x Dày 41.7 mm": ("125.50", "63.20", "41.70"),
    "125.5 mm x 63.2 mm x 41.7 mm": ("125.50", "63.20", "41.70"),
    "12.5 x 6.3 x 4.1cm": ("125.00", "63.00", "41.00"),
    "125,5 x 63.2 x 41.7 mm (Dài x Rộng x Cao)": ("125.50", "63.20", "41.70"),
    "125.5mm * 63.2mm * 41.7mm": ("125.50", "63.20", "41.70"),
    "125.5mm * 63.2mm * 41.7mm;": ("125.50", "63.20", "41.70"),
    "125.5 ×63.2 ×41.7 mm": ("125.50", "63.20", "41.70"),
    "- Bàn phím: Dài 44 cm - ngang 13 cm - cao 2 cm - Chuột: Dài 12.5 cm - ngang 6.3 cm - cao 4.1 cm": (
        "125.00",
        "63.00",
        "4.10",
    ),
    "125.5 x 63.2 x41.7 mm": ("125.50", "63.20", "41.70"),
    "125.5 × 63.2 × 41.7 mm": ("125.50", "63.20", "41.70"),
    "4.1cm × 6.3cm × 12.5cm": ("125.00", "63.00", "41.00"),
    "125.5*63.2*41.7mm": ("125.50", "63.20", "41.70"),
    "125.5 x63.2 x 41.7 mm": ("125.50", "63.20", "41.70"),
    "Dài: 12.5cm Cao : 4.1 cm Rộng : 6.3cm": ("125.00", "63.00", "4.10"),
    "Dài 12.5 cm - ngang 6.3 cm - cao 4.1 cm Độ dài dây: 1.8 m": ("125.00", "63.00", "41.00"),
    "Cao 125.5 mm x Rộng 63.2 mm x Sâu 41.7 mm": ("125.50", "63.20", "41.70"),
    "4.9 x 2.5 x 1.6 in (125.5 x 63.2 x 41.7 mm)": ("125.50", "63.20", "41.70"),
    "Cao 12.5cm x Rộng 6.3cm x Dày 4.1cm": ("125.00", "63.00", "41.00"),
    "12.5x6.3x4.1cm": ("125.00", "63.00", "41.00"),
    "Chuột : Dài: 12.5cm, Cao : 4.1 cm, Rộng : 6.3cm": ("125.00", "63.00", "4.10"),
    "gồm Chuột : Dài: 12.5cm, Cao : 4.1 cm, Rộng : 6.3cm và pin": ("125.00", "63.00", "4.10"),
    "12.5 x 6.3 x 4.1 cm (4.9 x 2.5 x 1.6 in)": ("125.00", "63.00", "41.00"),
    "  12.345 x 6.3 x 4.1 cm\n": ("123.50", "63.00", "41.00"),
    "dùng pin AA": (None, None, None),
    "": (None, None, None),
    "abc": (None, None, None),
    None: (None, None, None),
}
SIZES_B = {
    "Dài 125.5 x Rộng 63.2 x Cao 41.7": ("125.50", "63.20", "41.70"),
    "125.5 x 63.2 x 41.7 mm": ("125.50", "63.20", "41.70"),
    "12.5 x 6.3 x 4.1 cm": ("125.00", "63.00", "41.00"),
    "12.345 x 6.3 x 4.125 cm": ("123.45", "63.00", "41.30"),
    "12.5x6.3x4.1cm": ("125.00", "63.00", None),
    "125.5 mm x 63.2 mm x 41.7 mm": ("125.50", "63.20", "41.70"),
    "125.5*63.2*41.7mm": ("125.50", "63.20", "41.70"),
    "12,5 x 6,3 x 4,1 cm": ("125.00", "63.00", "41.00"),
    "125,5 x 63,2 x 41,7 mm": ("125.50", "63.20", "41.70"),
    "125.5 x 63.2 x 41.7mm, 90.1 x 50.2 x 30.3mm": ("125.50", "50.20", "30.30"),
    "Chiều cao: 125,5 mm, Chiều rộng: 63,2 mm, Chiều dày: 41,7 mm, Trọng lượng: 90 g": ("125.50", "63.20", "41.70"),
    "Chiều cao: 125,5 mm, Chiều rộng: 63,2 mm, Chiều dày: 41,7 mm": ("125.50", "63.20", "41.70"),
    # the height is read from the text, not taken from a constant
    "125.5 x 63.2 x 41.7 ( mm ) ( Dài x Rộng x Cao )": ("125.50", "63.20", "41.70"),
    "125.5(L)x63.2(w)x41.7(H) mm": ("125.50", "63.20", "41.70"),
    "125.5(L) x 63.2(W) x 41.7(H) mm": ("125.50", "63.20", "41.70"),
    "‎12.5 x 6.3 x 4.1 cm": ("125.00", "63.00", "41.00"),
    "(125.5) x 63.2 x 41.7 ( mm ) ( Dài x Rộng x Cao )": ("125.50", None, None),
    "(125.5 x 63.2 x 41.7 ( mm ) ( Dài x Rộng x Cao )": ("125.50", "63.20", "41.70"),
    "125.5 x 63.2 x 41.7 (mm)": ("125.50", "63.20", "41.70"),
    "125.5 x 63.2 x 41.7 mm, 90.1 x 50.2 x 30.3 mm": ("125.50", "50.20", "30.30"),
    "125,5 mm x 63,2 mm x 41,7 mm": ("125.50", "63.20", "41.00"),
    "125.5 (dài) x 63.2 (rộng) x 41.7 mm (cao)": ("125.50", "63.20", "41.70"),
    "Length: 125.5 mm / 4.94 in, Width: 63.2 mm / 2.49 in, Height: 41.7 mm / 1.64 in": ("125.50", "63.20", "41.70"),
    "Dài: 125.5 mm / 4.94 in, Rộng: 63.2 mm / 2.49 in, Cao: 41.7 mm / 1.64 in": ("125.50", "63.20", "41.70"),
    "Chiều dài: 125,5 mm / 4,94 inch Chiều rộng: 63,2 mm / 2,49 inch Chiều cao: 41,7 mm / 1,64 inch": (
        "125.50",
        "63.00",
        "41.70",
    ),
    " 12 x 6 x 4 cm": ("120.00", "60.00", "40.00"),
    " 12x6x4mm": (None, None, "4.00"),
    "12 x 6 x 4 mm": ("12.00", "6.00", "4.00"),
    "12 x 6 x 4": ("12.00", "6.00", "4.00"),
    "abc": (None, None, None),
    None: (None, None, None),
}


def _dec(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def _frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


@pytest.mark.parametrize(
    "parser, golden",
    [
        (A.parse_price_a, PRICES_A),
        (A.parse_price_b, PRICES_B),
        (A.parse_weight_a, WEIGHTS_A),
        (A.parse_weight_b, WEIGHTS_B),
    ],
)
def test_price_and_weight(spark, parser, golden):
    rows = _frame(spark, golden).select("t", parser(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in rows} == {t: _dec(v) for t, v in golden.items()}


@pytest.mark.parametrize("adder, golden", [(A.with_size_a, SIZES_A), (A.with_size_b, SIZES_B)])
@pytest.mark.parametrize("ignore_case", [False, True])
def test_size(spark, adder, golden, ignore_case):
    rows = adder(_frame(spark, golden), "t", ignore_case).collect()
    assert {r.t: (r.length, r.width, r.height) for r in rows} == {t: tuple(map(_dec, v)) for t, v in golden.items()}


def test_ignore_case(spark):
    df = _frame(spark, ["CAO 12CM X RỘNG 6CM X DÀY 4CM"])
    assert A.with_size_a(df, "t").first().length is None
    assert A.with_size_a(df, "t", ignore_case=True).first().length == Decimal("120.00")


@pytest.mark.parametrize("rules, golden", [(FEED_A_SIZES, SIZES_A), (FEED_B_SIZES, SIZES_B)])
def test_letters_pick_the_same_rule(spark, rules, golden):
    """Texts mangled at random get the same numbers with and without the dispatch."""
    rng, texts = random.Random(7), []
    pieces = ["x", " x ", "mm", " mm", "cm", "12", "6.3", "4,1", "(", ")", ", ", " ", " ", "‎", ";", "*", "×"]
    for text in [t for t in {**SIZES_A, **SIZES_B} if t]:
        for _ in range(12):
            at, cut = rng.randrange(len(text) + 1), rng.randrange(4)
            texts.append(text[:at] + rng.choice(pieces + [""]) + text[at + cut :])
        texts += [text + " " + text, "x " + text, text + " y", text.replace(" ", ""), text.replace(".", ",")]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(3, 9))) for _ in range(500)]
    names = {"raw": "t", "trimmed": "trim(t)", "unmarked": "trim(replace(t, '‎', ''))"}
    whole = A._first_match(rules, names, False)
    short = A._match_by_letters(rules, names, "letters")
    df = _frame(spark, texts).withColumn("letters", F.translate("t", A.NOT_LETTERS, ""))
    both = df.select("t", F.expr(whole).alias("whole"), F.expr(short).alias("short"))
    assert both.filter(~F.col("whole").eqNullSafe(F.col("short"))).collect() == []
    assert both.filter(F.col("whole").isNotNull()).count() > 100
