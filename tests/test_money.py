from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidebook.functions import blank, cents, signed, text_literal, whole_dollars

HALVES = ["0.50", "1.50", "2.50", "3.50", "-0.50", "-1.50", "-2.50", "2.49", "2.51", "-2.70"]


def test_halves_go_to_the_even_dollar(spark):
    frame = spark.createDataFrame([(Decimal(x),) for x in HALVES], "x decimal(18,2)")
    got = [r[0] for r in frame.select(whole_dollars(F.col("x"))).collect()]
    assert got == [0, 2, 2, 4, 0, -2, -2, 2, 3, -3]
    assert got == [round(Decimal(x)) for x in HALVES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(-10**12, 10**12, places=2), min_size=1, max_size=200))
def test_whole_dollars_equal_bankers_rounding(spark, amounts):
    frame = spark.createDataFrame([(x,) for x in amounts], "x decimal(18,2)")
    rows = frame.select("x", whole_dollars(F.col("x")), cents(F.col("x"))).collect()
    assert all(r[1] == round(r[0]) and r[2] == int(r[0] * 100) for r in rows)


def test_sign(spark):
    frame = spark.createDataFrame([("inflow",), ("outflow",)], "d string")
    got = [r[0] for r in frame.select(signed(F.lit(5), F.col("d"))).collect()]
    assert got == [5, -5]


def test_blank(spark):
    frame = spark.createDataFrame([(None,), ("",), ("  ",), (" x",)], "t string")
    assert [r[0] for r in frame.select(blank(F.col("t"))).collect()] == [True, True, True, False]


@pytest.mark.parametrize("text", ["plain", "it's", 'a "b"', "back\\slash", "\\'"])
def test_text_literal(spark, text):
    assert spark.range(1).select(F.expr(text_literal(text))).first()[0] == text
