"""Golden landing lines."""

import pytest
from pyspark.sql import functions as F

from brinemark import fixed_values as fv
from brinemark.operators import parse, quality

GOOD = "1 2 3 5.0 90 1.5 180 8 0 0 0 1980"
CASES = [
    ("Tuxpan.txt", GOOD, ""),
    ("Tuxpan.txt", "1 2 3 5.0 90 1.5 180 8 0 0 0 0 1980", ""),
    ("tuxpan.v2.txt", "1.0 2.0 3.0 5 90 1.5 180 8 0 0 0 1980.0", ""),
    ("tuxpan.txt", "1 2 3", fv.MSG_STRUCTURE),
    ("tuxpan.txt", "", fv.MSG_STRUCTURE),
    ("tuxpan.txt", None, fv.MSG_STRUCTURE),
    ("acapulco.txt", GOOD, fv.MSG_COAST),
    ("tuxpan.txt", "2 30 3 5 90 1.5 180 8 0 0 0 1980", fv.MSG_DATE),
    ("tuxpan.txt", "2 3 24 5 90 1.5 180 8 0 0 0 1980", fv.MSG_DATE),
    ("tuxpan.txt", "1 2 3 x 90 1.5 180 8 0 0 0 1980", fv.MSG_WIND_SPEED),
    ("tuxpan.txt", "1 2 3 5 90 NaN 180 8 0 0 0 1980", fv.MSG_HEIGHT),
    ("tuxpan.txt", "1 2 3 500 400 1.5 180 8 0 0 0 1980", fv.MSG_WIND_SPEED + fv.MSG_WIND_DIR),
    ("tuxpan.txt", "1 2 3 100 360 50 360 50 0 0 0 1980", ""),
    ("tuxpan.txt", "\t" + GOOD, ""),
]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, data, f"/landing/{name}") for i, (name, data, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "case int, data string, source_file string")


def test_each_line_lands_where_it_should(lines):
    good, bad = quality.split_quality(parse.parse_lines(lines))
    clean = {r["case"] for r in good.collect()}
    rejected = {r["case"]: r["error_reason"] for r in bad.collect()}
    expected = {i: reason for i, (_, _, reason) in enumerate(CASES)}
    assert clean == {i for i, reason in expected.items() if reason == ""}
    assert rejected == {i: reason for i, reason in expected.items() if reason}


def test_decoded_values(lines):
    good, _ = quality.split_quality(parse.parse_lines(lines))
    for r in good.where(F.col("case") < 3).collect():
        assert str(r["datetime"]) == "1980-01-02 03:00:00" and r["year"] == 1980 and r["coast_name"] == "Tuxpan"
        assert abs(r["wave_energy"] - 2830.7981) < 1e-3 and abs(r["wave_power_kW_m"] - 8.82) < 1e-5
        assert r["wind_cos_direction"] == 0 and r["wind_sin_direction"] == 1
        assert r["wave_cos_direction"] == -1 and r["wave_sin_direction"] == 0


def test_reference_trim_keeps_a_leading_tab(lines):
    tab = lines.where(F.col("case") == len(CASES) - 1)
    _, bad = quality.split_quality(parse.parse_lines(tab, reference_trim=True))
    # The empty first token shifts all others: 13 tokens, no month.
    assert bad.first()["error_reason"].startswith(fv.MSG_DATE)


def test_strict_rules(spark):
    rows = [
        ("1 2 3 26 90 1.5 180 8 0 0 0 1980", fv.MSG_WIND_SPEED),
        ("1 2 3 5 90 7.5 180 16 0 0 0 1980", fv.MSG_HEIGHT + fv.MSG_PERIOD),
        ("1 1 0 5 90 1.5 180 8 0 0 0 2019", fv.MSG_DATE),
        ("12 31 23 5 90 1.5 180 8 0 0 0 2018", ""),
        ("1 1 0 5 90 1.5 180 8 0 0 0 1979", ""),
    ]
    df = spark.createDataFrame([(i, d, "tuxpan.txt") for i, (d, _) in enumerate(rows)], "i int, data string, source_file string")
    good, bad = quality.split_quality(parse.parse_lines(df), quality.STRICT_RULES)
    assert {r["i"] for r in good.collect()} == {3, 4}
    assert {r["i"]: r["error_reason"] for r in bad.collect()} == {i: m for i, (_, m) in enumerate(rows) if m}


def test_steepness(spark):
    df = spark.createDataFrame([(GOOD, "tuxpan.txt")], "data string, source_file string")
    row = parse.parse_lines(df, steepness=True).first()
    assert abs(row["wave_steepness"] - 1.5 / 64) < 1e-4


def test_identity_is_stable_and_content_based(lines):
    ids = [r["id"] for r in parse.parse_lines(lines).orderBy("case").collect()]
    assert ids == [r["id"] for r in parse.parse_lines(lines.repartition(5)).orderBy("case").collect()]
    assert len(set(ids[:4])) == 4


def test_lines_are_split_once(lines):
    good, _ = quality.split_quality(parse.parse_lines(lines))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1


def test_year_helpers(spark):
    df = spark.range(1990, 2000).select(F.col("id").cast("int").alias("year"))
    assert sorted(r[0] for r in quality.every_n_years(df, 3).collect()) == [1992, 1995, 1998]
    assert sorted(r[0] for r in quality.year_range(df, 1995, 1993).collect()) == [1993, 1994, 1995]


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert quality.drop_nulls(df, ["a"]).count() == 2
