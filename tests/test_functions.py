"""Scalar functions: STR1-STR7, CST1-CST2, MTH1-MTH2, NUL1."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from jobtrend.functions import (
    area_parts,
    contains_any,
    month_digits,
    nan_to_null,
    percent,
    ratio_change,
    remove,
    remove_all,
    round2,
    strip_ws,
    to_double,
    zfill,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_strip_removes_tabs_cr_lf_and_blanks(spark):
    got = one_col(spark, ["\t a b \r\n", "  x", "y\x0b\x0c", " \t ", None], strip_ws)
    assert got == ["a b", "x", "y", "", None]


def test_zfill_pads_but_never_cuts(spark):
    got = one_col(spark, ["7", "1234", "123456789", "", None], lambda c: zfill(c, 8))
    assert got == ["00000007", "00001234", "123456789", "00000000", None]
    assert one_col(spark, [5, 12345], lambda c: zfill(c, 3), "int") == ["005", "12345"]


def test_remove_leaves_the_space_before_a_removed_suffix(spark):
    names = ["Akron, OH Metropolitan Statistical Area", "Boston-Cambridge-Quincy, MA NECTA", "Statewide"]
    got = one_col(spark, names, lambda c: remove_all(c, (" NECTA", "Metropolitan Statistical Area")))
    assert got == ["Akron, OH ", "Boston-Cambridge-Quincy, MA", "Statewide"]
    assert one_col(spark, ["Ohio\r", None], lambda c: remove(c, "\r")) == ["Ohio", None]


def test_contains_any_treats_null_as_no_match(spark):
    got = one_col(spark, ["X Metropolitan Division", "Y NECTA Division", "Z", None],
                  lambda c: contains_any(c, ("Metropolitan Division", "NECTA Division")))
    assert got == [True, True, False, False]


def test_month_digits(spark):
    assert one_col(spark, ["M07", "M13", "MM1", None], month_digits) == ["07", "13", "1", None]


def test_to_double_turns_bad_text_into_null(spark):
    got = one_col(spark, ["12.5", " 3 ", "-", "", "1,234", "NaN", None, "1e3"], to_double)
    assert got == [12.5, 3.0, None, None, None, None, None, 1000.0]


def test_to_double_takes_plain_decimals_only(spark):
    texts = ["1d", "12f", "0x1p3", "Infinity", "-inf", "1e999", "+.5", "-7.", "2E-3"]
    assert one_col(spark, texts, to_double) == [None] * 6 + [0.5, -7.0, 0.002]


def test_nan_to_null(spark):
    assert one_col(spark, [float("nan"), 1.5, None], nan_to_null, "double") == [None, 1.5, None]


def test_round2_is_half_to_even_like_numpy(spark):
    rng = np.random.default_rng(7)
    vals = [float(v) for v in rng.normal(0, 50, 2000)] + [0.125, 0.135, -0.125, 2.675, 1.005, 0.5, 1e-9]
    got = one_col(spark, vals, round2, "double")
    want = [float(np.round(v, 2)) for v in vals]
    assert got == want
    got_pct = one_col(spark, vals, percent, "double")
    assert got_pct == [float(np.round(v * 100, 2)) for v in vals]


def test_ratio_change_null_current_and_zero_base(spark):
    df = spark.createDataFrame([(2.0, 1.0), (None, 1.0), (3.0, 0.0), (3.0, None), (0.0, 0.0)], "x double, b double")
    got = [r[0] for r in df.select(ratio_change("x", "b")).collect()]
    assert got[0] == 1.0 and got[1:] == [None, None, None, None]


def test_area_parts(spark):
    df = spark.createDataFrame([("Akron, OH",), ("Statewide",), ("Nowhere",), (None,)], "a string")
    first, second = area_parts("a", "Statewide")
    got = [tuple(r) for r in df.select(first, second).collect()]
    assert got == [("Akron", "OH"), ("Statewide", "Statewide"), ("Nowhere", None), (None, None)]


def test_round2_null_passthrough(spark):
    got = one_col(spark, [None], round2, "double")
    assert got == [None]
    assert math.isclose(one_col(spark, [1.234], round2, "double")[0], 1.23)
