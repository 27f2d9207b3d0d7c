import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evidentia.functions import geo, keys, parse, similarity, text


def values(spark, column, rows):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_stable_key_agrees_with_plain_values(spark):
    row = [None, "", "a|b", "Merton Lane", "001", "é"]
    df = spark.createDataFrame([tuple(row)], ", ".join(f"c{k} string" for k in range(6)))
    key = df.select(keys.stable_sha256("n", "v1", *df.columns)).first()[0]
    assert key == keys.stable_sha256_of("n", "v1", row)
    others = [("n", "v2", row), ("m", "v1", row), ("n", "v1", row[::-1]), ("n", "v1", ["", None, *row[2:]])]
    assert len({key, *(keys.stable_sha256_of(*o) for o in others)}) == 5


def test_strict_integers(spark):
    raw = ["001", " 42 ", "1.5", "1e3", "-1", "18446744073709551616", "18446744073709551615", "", None]
    assert values(spark, lambda c: parse.strict_unsigned(c).cast("string"), raw) == ["1", "42", None, None, None, None, "18446744073709551615", None, None]
    assert values(spark, parse.strict_integer, ["-7", "7.0", "99999999999"]) == [-7, None, None]


def test_postcodes(spark):
    raw = ["S4 8GG", " sw1a 1aa ", "UNKNOWN", "", "S4 8GG\n", None]
    assert values(spark, text.postcode, raw) == ["S4 8GG", "SW1A 1AA", None, None, "S4 8GG", None]
    assert values(spark, text.postcode_sector, raw[:3]) == ["S4 8", "SW1A 1", None]
    assert values(spark, text.postcode_status, raw[:4]) == ["VALID", "VALID", "INVALID", "MISSING"]


def test_numbers_and_units(spark):
    assert values(spark, text.complete_number_designator, ["11-13", "BRIGHTHAMPTON, 55 - 57", "11/13", "11 AND 13", "11AB", "A11", "5a."]) == ["11-13", "55-57", None, None, None, None, "5A"]
    assert values(spark, text.unit_identifier, ["Flat 5A", "5a", None]) == ["5A", "5A", None]
    assert values(spark, text.first_number_token, ["Flat 5A, 11 High St", "none"]) == ["5A", None]


def test_header_names():
    assert text.snake_header(["LAD25CD", "Co_terminous", "2nd Name"]) == ["lad25cd_raw", "co_terminous_raw", "column_2nd_name_raw"]
    with pytest.raises(ValueError):
        text.snake_header(["a b", "a-b"])


def test_money(spark):
    raw = ["£100", "GBP 100 - GBP 350", "£1,000.50 - £20", "$5", "5", " ", "Â£5", "about 5", "£99999999999999999999"]
    df = spark.createDataFrame([(r,) for r in raw], "x string")
    got = [(r.low and float(r.low), r.high and float(r.high), r.status) for r in parse.with_money(df, F.col("x")).collect()]
    assert got == [
        (100, 100, "SINGLE_VALUE_PARSED"), (100, 350, "RANGE_PARSED"), (None, None, "INVALID_BOUNDS"), (None, None, "NON_GBP_CURRENCY"), (None, None, "BARE_NUMBER_UNSUPPORTED"),
        (None, None, "MISSING"), (None, None, "ENCODING_ERROR"), (None, None, "UNSUPPORTED_FORMAT"), (None, None, "NUMERIC_OVERFLOW"),
    ]


def test_bands_dates_and_small_numbers(spark):
    df = spark.createDataFrame([(92,), (91,), (20,), (None,)], "s int")
    assert [r[0] for r in df.select(parse.band(F.col("s"))).collect()] == ["A", "B", "G", None]
    assert [str(x) for x in values(spark, parse.date_of, ["2020-1-5", "2020-02-30", "2020-01-05 00:00"])] == ["2020-01-05", "None", "None"]
    assert values(spark, parse.rounded_small, ["72.5", "-72.5", "1e3", "5_0"]) == [73, -73, 1000, None]


def test_grid_to_lonlat(spark):
    df = spark.createDataFrame([(530000.0, 180000.0), (529985.0, 179952.5)], "e double, n double")
    expected = [(-0.12835394047946935, 51.50399082763378), (-0.12858742477613924, 51.503567408226914)]
    for r, e in zip(geo.with_lonlat(df, F.col("e"), F.col("n")).select("lon", "lat").collect(), expected, strict=True):
        assert abs(r[0] - e[0]) < 1e-6 and abs(r[1] - e[1]) < 1e-6


@settings(max_examples=300, deadline=None)
@given(st.text("abcde 1", max_size=12), st.text("abcde 1", max_size=12))
def test_jaro_winkler_agrees_with_duckdb(a, b):
    expected = duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
    assert abs(similarity.jaro_winkler_of(a, b) - expected) < 1e-9 or a == b == ""
