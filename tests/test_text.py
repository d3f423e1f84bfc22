from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quantloom.functions import text


@pytest.mark.parametrize(
    ("cell", "wanted"),
    [
        (None, None), ("", None), ("-", None), ("–", None), ("1,234", 1234), ("(1,234)", -1234), ("(-)1,234", -1234), ("-1,234", -1234), ("△1,234", -1234), ("▲ 1,234", -1234),
        ("1,234 5,678", None), ("1,234 1,234", 1234), ("4,244, 863", 4244863), ("4 244 863", 4244863), ("7 23,570,750", 723570750), ("7 3,570,750", None), ("72 3,570,750", 723570750), ("7 2 3,570,750", 723570750), ("13.42", Decimal("13.42")), ("5~7", None), ("abc", None),
        ("12,345,678,901,234,567", None), ("1,234,", 1234), ("0", 0), (".5", Decimal("0.5")), ("1.2.3", None),
        ("-\n3,272,017", None), ("- \n- \n1,473,000,000", None), ("264653801==========", 264653801), ("(2,564원)", -2564), ("1,234\n-----", None), ("(1,000)\n====", -1000), ("- 5", -5), ("1,234\n1,234", 1234),
    ],
)
def test_amounts(cell, wanted):
    assert text.amount(cell) == wanted


def test_amount_units():
    assert text.amount("(2,564원)", 1000) == -2564 and text.amount("1,234", 1000) == 1234000 and text.amount("1,234원", 1000) == 1234
    assert text.rounded(Decimal("2.5")) == 3 and text.rounded(Decimal("-2.5")) == -3


def test_amount_column_agrees_with_parser(spark):
    cells = ["1,234", "(1,234)", "-5", "(-)7", "△ 8", "1 234 567", "9 원", None, "-", "x", "13.42", "(5", "1,2,3", "-\n3,272", "26465==========", "(2,564원)", "7\n7"]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cells)], "k int, c string")
    got = {r.k: (r.value, r.exact) for r in text.with_amounts(df, "c", F.lit(10)).collect()}
    for k, c in enumerate(cells):
        value = text.amount(c, 10)
        assert got[k][0] == (None if value is None else text.rounded(value)), c
    assert {r.value for r in text.with_amounts(df.where("k = 0"), "c", F.lit(None).cast("long")).collect()} == {None}


@pytest.mark.parametrize(("label", "wanted"), [("Ⅲ. 총당기순이익", "총당기순이익"), ("1. 매  출  액 (주석 5,6)", "매출액"), ("[유동자산]", "유동자산"), ("ㆍ현금", "현금"), ("(2) 자본금", "자본금"), ("이익잉여금,39>", "이익잉여금"), ("이익잉여금<주석5,39>", "이익잉여금"), ("가. 재고자산", "재고자산"), ("Net income (Note 3)", "Net income"), ("XIV. 법인세비용", "법인세비용"), ("IIII. 항목", "IIII. 항목"), ("· ① 1) 현금", "1) 현금"), ("■ Ⅱ. (1) 비유동자산", "비유동자산"), ("가. (나) 항목 <주 3 및 4>", "(나) 항목"), (None, "")])
def test_label_keys(spark, label, wanted):
    assert text.label_key_of(label) == wanted
    if label:
        assert spark.createDataFrame([(label,)], "s string").select(text.label_key("s")).first()[0] == wanted


def test_jaro_winkler():
    assert text.jaro_winkler("MARTHA", "MARHTA") == pytest.approx(0.961111, abs=1e-6)
    assert text.jaro_winkler("DIXON", "DICKSONX") == pytest.approx(0.813333, abs=1e-6)
    assert text.jaro_winkler("", "a") == 0 and text.jaro_winkler("same", "same") == 1


def test_label_mapping_stages(spark):
    aliases = spark.createDataFrame([("bs", "bs.cash", "Cash and deposits", 1), ("is", "is.revenue", "Revenue", 2), ("bs", "bs.total", "Total", 3)], "section string, code string, alias string, place int")
    labels = spark.createDataFrame([("bs", "Cash and deposits"), ("bs", "1. Cash and deposits (Note 4)"), ("bs", "Revenue"), ("bs", "Cash and deposit"), ("bs", "Nothing like it"), ("bs", "Stop"), ("bs", None), ("is", "Subtotal of it")], "section string, label string")
    got = {r.label: (r.code, r.stage) for r in text.map_labels(labels, aliases, ["Stop"]).collect()}
    assert got == {"Cash and deposits": ("bs.cash", "exact"), "1. Cash and deposits (Note 4)": ("bs.cash", "normalized"), "Revenue": ("is.revenue", "exact"), "Cash and deposit": ("bs.cash", "fuzzy"), "Nothing like it": (None, "unknown"), "Stop": (None, "blocked"), "Subtotal of it": (None, "unknown")}


def test_units(spark):
    said = [("(단위: 백만원)", 10**6), ("단위 : 천원", 1000), ("(단위:원)", 1), ("(단위: USD)", None), ("none", None), ("(단위: 억원)", 10**8)]
    df = spark.createDataFrame([(s,) for s, _ in said], "s string")
    assert [r[0] for r in df.select(text.unit_multiplier("s")).collect()] == [v for _, v in said]
