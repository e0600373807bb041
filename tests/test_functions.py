import unicodedata

import pytest
from helpers import assert_rows, frame
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yearloom import fixed
from yearloom.functions import (
    as_measure,
    cleaned_year,
    compact_name,
    database_name,
    is_leap_year,
    measure_in_text,
    short_name,
    storable_name,
    title_name,
    without_sentinel,
)

SEN = fixed.SENTINEL


def applied(spark, expression, values, kind="string"):
    df = frame(spark, f"n int, x {kind}", *enumerate(values))
    rows = df.select("n", expression(F.col("x")).alias("y")).orderBy("n").collect()
    return [r.y for r in rows]


def test_sentinel_code_points():
    names = [unicodedata.name(c) for c in SEN]
    assert [hex(ord(c)) for c in SEN] == (
        "0x28 0x20 0x361 0xb0 0x20 0x35c 0x296 0x20 0x361 0xb0 0x29".split()
    )
    assert names[0] == "LEFT PARENTHESIS" and names[-1] == "RIGHT PARENTHESIS"


@pytest.mark.parametrize(
    "given_name, expected",
    [
        ("My Awesome Column", "My_Awesome_Column"),
        ("(Another) Awesome Column", "Another_Awesome_Column"),
        ("a,b;c\nd\te=f-g", "a_b_c_d_e_f_g"),
        ("{x}(y)", "xy"),
        ("plain.name_1", "plain.name_1"),
        ("", ""),
    ],
)
def test_storable_name(given_name, expected):
    assert storable_name(given_name) == expected


@given(st.text())
def test_storable_name_leaves_no_refused_character(name):
    result = storable_name(name)
    assert not set(result) & set(fixed.CHARS_TO_UNDERSCORE + fixed.CHARS_TO_DROP)
    assert storable_name(result) == result


def test_compact_name():
    assert compact_name("United Kingdom_TotalEmissions") == "UnitedKingdom_TotalEmissions"


def test_database_name():
    assert database_name("jane.doe-42@example.com") == "janedoe42"
    assert database_name("plain") == "plain"
    with pytest.raises(ValueError):
        database_name("._-@example.com")


def test_without_sentinel(spark):
    dirty = [f"{SEN}4.384{SEN}", "-", "?", "#", f"{SEN}1.53{SEN}", None, "7", f"{SEN}{SEN}", "( "]
    clean = ["4.384", "-", "?", "#", "1.53", None, "7", "", "( "]
    assert applied(spark, without_sentinel, dirty) == clean


def test_title_name(spark):
    names = ["  gErMaNy ", "   uNiTeD sTaTeS    ", None, "GUINEA-BISSAU", "\tspain", ""]
    # Only spaces are trimmed, and a hyphen starts no word.
    expected = ["Germany", "United States", None, "Guinea-bissau", "\tspain", ""]
    assert applied(spark, title_name, names) == expected


def test_short_name(spark):
    names = [
        "Afghanistan, Islamic Republic of",
        "Antarctica (the territory South of 60 deg S)",
        "Georgia",
        " Congo (Kinshasa), Republic of the\t",
        "(nameless)",
        None,
    ]
    expected = ["Afghanistan", "Antarctica", "Georgia", "Congo", "", None]
    assert applied(spark, short_name, names) == expected


MEASURES = """4.384 -1.53 +2 .5 5. 1e3 0x1p3 NaN nan Infinity -infinity inf +INF - ? # x 1.5f 1d
12abc 1,5 --1 ٣ 1e999 n N in""".split() + ["", " ", " 2 ", "1 2", "\t3\n", None]


def test_as_measure(spark):
    result = applied(spark, as_measure, ["4.384", "-", "?", "#", "1.53", None])
    assert [r is None for r in result] == [False, True, True, True, False, True]
    assert result[0] == pytest.approx(4.384) and result[4] == pytest.approx(1.53)


def test_as_measure_of_numbers(spark):
    assert applied(spark, as_measure, [1.5, None, 1e300], "double") == [1.5, None, float("inf")]


def test_measure_in_text_equals_as_measure(spark):
    guarded = [repr(v) for v in applied(spark, measure_in_text, MEASURES)]
    assert guarded == [repr(v) for v in applied(spark, as_measure, MEASURES)]
    assert "nan" in guarded and "inf" in guarded


def test_cleaned_year(spark):
    dates = ["11-30-1999", "02-29-2000", "02-30-2000", "1-1-2000", "01-01-2000\n", "junk", None]
    assert applied(spark, cleaned_year, dates) == [1999, 2000, None, None, None, None, None]
    other = lambda c: cleaned_year(c, "yyyy/MM/dd")
    assert applied(spark, other, ["2004/05/06", "05-06-2004"]) == [2004, None]


def test_is_leap_year(spark):
    import calendar

    years = [*range(1, 2801)]
    assert applied(spark, is_leap_year, years, "int") == [calendar.isleap(y) for y in years]
    assert applied(spark, is_leap_year, [None], "int") == [None]


def test_cast_counts(spark):
    from yearloom.operators import null_counts

    df = frame(spark, "t string", *[(t,) for t in (f"{SEN}4.384{SEN}", "-", "?", "#", f"{SEN}1.53{SEN}")])
    values = df.select(measure_in_text(without_sentinel(F.col("t"))).alias("v"))
    assert_rows(null_counts(values, "v"), "missing bigint, present bigint", (3, 2))
