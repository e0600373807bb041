"""Names in other spellings, and sums that do not depend on order."""

import math
import random
import struct

import pytest
from helpers import assert_rows, emission_rows, frame
from pyspark.sql import functions as F

from yearloom import operators as op
from yearloom.functions import exact_avg, exact_sum


@pytest.mark.parametrize(
    "name, key",
    [
        ("Guinea-bissau", "guinea bissau"),
        ("  Bosnia And  Herzegovina ", "bosnia and herzegovina"),
        ("Bosnia & Herzegovina", "bosnia and herzegovina"),
        ("Côte d'Ivoire", "cote d ivoire"),
        ("CÔTE D’IVOIRE", "cote d ivoire"),
        ("Côte d'Ivoire", "cote d ivoire"),
        ("Curaçao", "curacao"),
        ("Łódź Øst", "lodz ost"),
        ("St. Lucia", "st lucia"),
        ("日本", "日本"),
        ("", ""),
        (None, None),
    ],
)
def test_match_key(spark, name, key):
    df = frame(spark, "n string", (name,))
    assert df.select(op.match_key(F.col("n"))).first()[0] == key


TEMPERATURES = "Year int, Country string, AverageTemperature float"


def test_reconciled_panel(spark):
    emissions = emission_rows(
        spark, (2000, "Côte d'Ivoire", 1.0), (2000, "Czechia", 2.0), (2000, "World Tour", 3.0), (2000, None, 4.0)
    )
    temperatures = frame(
        spark, TEMPERATURES, (2000, "Cote D'ivoire", 26.0), (2000, "Czech Republic", 8.0), (2001, "Czechia", 9.0),
        (2000, "Atlantis", 1.0), (2000, None, 2.0),
    )
    found = lambda df: {(r.Country, r.AverageTemperature) for r in df.collect()}
    assert found(op.country_panel(emissions, temperatures)) == set()
    assert found(op.reconciled_panel(emissions, temperatures)) == {("Côte d'Ivoire", 26.0)}
    aliases = {"CZECH republic": "Czechia"}
    panel = op.reconciled_panel(emissions, temperatures, aliases)
    assert panel.columns == op.country_panel(emissions, temperatures).columns
    assert found(panel) == {("Côte d'Ivoire", 26.0), ("Czechia", 8.0)}
    left = op.unmatched_names(emissions, temperatures, aliases)
    assert_rows(
        left, "side string, Country string, match_key string, rows long",
        ("emissions", "World Tour", "world tour", 1), ("temperatures", "Atlantis", "atlantis", 1),
    )
    assert op.ambiguous_names(temperatures).count() == 0
    [row] = op.ambiguous_names(temperatures, aliases).collect()
    assert row.match_key == "czechia" and list(row.names) == ["Czech Republic", "Czechia"]
    empty = temperatures.filter("Year < 0")
    assert op.reconciled_panel(emissions, empty, aliases).count() == 0
    assert op.unmatched_names(emissions, empty).count() == 3


def bits(x):
    return None if x is None else struct.pack("<d", x)


def test_exact_sums_do_not_depend_on_partitions(spark):
    rng = random.Random(1)
    rows = [(k % 3, rng.choice([1e16, -1e16, 0.1, 1e-9, 123456.789]) * rng.random()) for k in range(3000)]
    df = frame(spark, "k int, v double", *rows)
    results = set()
    for n in (1, 8, 211):
        rng.shuffle(rows)
        dealt = frame(spark, "k int, v double", *rows).repartition(n)
        sums = dealt.groupBy("k").agg(exact_sum(F.col("v")).alias("s"), exact_avg(F.col("v")).alias("a"))
        results.add(tuple(sorted((r.k, bits(r.s), bits(r.a)) for r in sums.collect())))
    assert len(results) == 1
    [found] = results
    for k, s, _ in found:
        whole = math.fsum(v for key, v in rows if key == k)
        assert struct.unpack("<d", s)[0] == pytest.approx(whole, rel=1e-12, abs=1e-6)
    assert df.count() == 3000


@pytest.mark.parametrize(
    "values, total",
    [
        ([None, None], None),
        ([], None),
        ([1.5, None, 2.5], 4.0),
        ([0.1] * 10, 1.0),
        ([1e30, 1.0], 1e30),
        ([math.inf, 1.0], math.inf),
        ([9e19, 9e19], 1.8e20),
    ],
)
def test_exact_sum_of_awkward_values(spark, values, total):
    df = frame(spark, "v double", *[(v,) for v in values])
    r = df.agg(exact_sum(F.col("v")).alias("s"), exact_avg(F.col("v")).alias("a")).first()
    assert r.s == total
    n = len([v for v in values if v is not None])
    assert r.a == (None if total is None else total / n)


def test_exact_panels_are_equal_for_all_partitionings(spark):
    emissions = emission_rows(spark, *[(2000 + k % 4, f"c{k % 7}", k * 0.1) for k in range(900)])
    temperatures = frame(spark, TEMPERATURES, *[(2000 + y, f"c{c}", y + c / 3) for y in range(4) for c in range(7)])
    seen = set()
    for n in (1, 8, 211):
        panel = op.country_panel(emissions, temperatures).repartition(n)
        averages = op.country_averages(panel, exact=True).collect()
        totals = op.yearly_total(emissions.repartition(n), exact=True).collect()
        seen.add((tuple(sorted(map(tuple, averages))), tuple(sorted(map(tuple, totals)))))
    assert len(seen) == 1


def test_exact_nan(spark):
    df = frame(spark, "v double", (math.nan,), (1.0,))
    assert math.isnan(df.agg(exact_sum(F.col("v"))).first()[0])
