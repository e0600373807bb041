"""Replacing flagged values, on known cases and against a plain loop."""

import calendar
import random

import pytest
from helpers import assert_rows, emission_rows, frame
from pyspark.sql import functions as F

from yearloom import fixed
from yearloom import operators as op
from yearloom.functions import is_leap_year

OUT = "Year int, Country string, TotalEmissions float"
AU, NZ = fixed.OCEANIA_TWO
NZ_IN = [(2016, NZ, 5.0), (2020, NZ, 6.0), (2022, NZ, 6.5), (2023, NZ, 7.0), (2024, NZ, 8.0)]
NZ_OUT = [(2016, NZ, None), (2020, NZ, 6.5), (2022, NZ, 6.5), (2023, NZ, 7.0), (2024, NZ, 7.0)]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize(
    "au_in, au_out",
    [
        ([(1998, AU, 2.0), (2000, AU, 3.0), (2001, AU, 4.0)], [(1998, AU, 2.0), (2000, AU, 2.0), (2001, AU, 4.0)]),
        ([(2019, AU, 2.0), (2020, AU, 3.0), (2022, AU, 4.0)], [(2019, AU, 2.0), (2020, AU, 2.0), (2022, AU, 4.0)]),
    ],
)
def test_leap_years_of_oceania(spark, au_in, au_out, unique):
    emissions = emission_rows(spark, (1997, "United States", 1.0), *au_in, *NZ_IN)
    filled = op.leap_year_fill(emissions, unique=unique)
    assert filled.schema == fixed.OUTPUT_SCHEMAS[fixed.OCEANIA_DATASET]
    assert_rows(filled, OUT, *au_out, *NZ_OUT)


@pytest.mark.parametrize("unique", [True, False])
def test_missing_values_and_keys(spark, unique):
    emissions = emission_rows(
        spark,
        (1997, "A", 1.0),
        (1998, "A", 2.0),
        (2000, "A", 9.0),
        (2004, "B", 5.0),
        (2007, "B", 6.0),
        (2008, "B", 7.0),
        (2011, "B", 8.0),
        (None, "B", 3.0),
        (2000, None, 4.0),
        (1999, None, 4.5),
    )
    # The nearest earlier value is missing, so an earlier one counts.
    emissions = emissions.withColumn(
        "TotalEmissions", F.expr("CASE WHEN Year IN (1998, 2007) THEN NULL ELSE TotalEmissions END")
    )
    flagged = emissions.select("Year", "Country", "TotalEmissions")
    filled = op.fill_flagged(flagged, is_leap_year(F.col("Year")), unique=unique)
    assert_rows(
        filled,
        OUT,
        (1997, "A", 1.0),
        (1998, "A", None),
        (2000, "A", 1.0),
        (2004, "B", None),
        (2007, "B", None),
        (2008, "B", 8.0),
        (2011, "B", 8.0),
        (None, "B", 3.0),
        (2000, None, None),
        (1999, None, 4.5),
    )


def plain_fill(rows, back, ahead):
    best = {}
    for year, country, value in rows:
        if value is not None:
            at = (country, year)
            best[at] = max(value, best.get(at, value))
    steps = [-d for d in range(1, back + 1)] + list(range(1, ahead + 1))
    result = []
    for year, country, value in rows:
        if calendar.isleap(year):
            near = [best[country, year + d] for d in steps if (country, year + d) in best]
            value = near[0] if near else None
        result.append((year, country, value))
    return result


@pytest.mark.parametrize("repeats", [1, 4])
@pytest.mark.parametrize("back, ahead", [(3, 3), (1, 5)])
def test_against_a_plain_loop(spark, repeats, back, ahead):
    rng = random.Random(repeats * 100 + back)
    rows = []
    for n in range(120):
        years = rng.sample(range(1890, 1925), rng.randint(1, 30))
        for year in years:
            for _ in range(rng.randint(1, repeats)):
                value = None if rng.random() < 0.3 else float(rng.randint(0, 999))
                rows.append((year, f"country {n}", value))
    df = frame(spark, OUT, *rows)
    flag = is_leap_year(F.col("Year"))
    expected = plain_fill(rows, back, ahead)
    general = op.fill_flagged(df, flag, back=back, ahead=ahead)
    assert_rows(general, OUT, *expected)
    if repeats == 1:
        single = op.fill_flagged(df, flag, back=back, ahead=ahead, unique=True)
        assert_rows(single, OUT, *expected)
    # Buckets shorter and longer than what a row looks at, and than all years.
    for bucket in (1, 2.5, 7, 500):
        cut = op.fill_flagged(df, flag, back=back, ahead=ahead, unique=repeats == 1, bucket=bucket)
        assert_rows(cut, OUT, *expected)


def test_buckets_of_real_and_negative_order_values(spark):
    schema = "At double, Place string, V double"
    rows = [(-2.5, "a", 1.0), (-1.5, "a", 2.0), (0.25, "a", 3.0), (1.75, "a", 4.0), (None, "a", 5.0), (0.0, None, 6.0)]
    df = frame(spark, schema, *rows)
    flag = (F.col("V") % 2 == 0) | F.col("At").isNull()
    whole = op.fill_flagged(df, flag, "Place", "At", "V", 2, 2, unique=True)
    for unique in (True, False):
        cut = op.fill_flagged(df, flag, "Place", "At", "V", 2, 2, unique=unique, bucket=1)
        assert_rows(cut, schema, *[tuple(r) for r in whole.collect()])
    with pytest.raises(ValueError, match="bucket"):
        op.fill_flagged(df, flag, "Place", "At", "V", unique=True, bucket=0)


def test_other_columns_stay(spark):
    emissions = emission_rows(spark, (1999, "A", 1.0), (2000, "A", 2.0))
    for unique in (True, False):
        filled = op.fill_flagged(emissions, F.col("Year") == 2000, unique=unique)
        assert filled.columns == emissions.columns
        assert {tuple(r)[:4] for r in filled.collect()} == {
            tuple(r)[:4]
            for r in emission_rows(spark, (1999, "A", 1.0), (2000, "A", 2.0))
            .withColumn("TotalEmissions", F.lit(1.0).cast("float"))
            .collect()
        }


def test_flag_may_be_a_python_function(spark):
    emissions = emission_rows(spark, (1999, "A", 1.0), (2000, "A", 2.0), (2001, "A", 3.0))
    rows = emissions.select("Year", "Country", "TotalEmissions")
    odd_rule = F.udf(lambda year: calendar.isleap(year), "boolean")
    for unique in (True, False):
        filled = op.fill_flagged(rows, odd_rule(F.col("Year")), unique=unique)
        assert_rows(filled, OUT, (1999, "A", 1.0), (2000, "A", 1.0), (2001, "A", 3.0))
