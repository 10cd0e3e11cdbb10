import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkcare.functions import (basename, collapse_ws, encode_map, format_elapsed, parse_date_time_ntz,
                                 percent_text, split_ws, strip_last, suffix_of, suffix_of_name)


@pytest.mark.parametrize("secs,text", [(5, "0:00:05"), (3600, "1:00:00"), (86400, "1 day and 0:00:00"),
                                       (356521, "4 days and 3:02:01"), (2 * 86400 + 59, "2 days and 0:00:59"),
                                       (-5, "-1 day and 23:59:55")])
def test_format_elapsed_matches_timedelta_text(spark, secs, text):
    got = spark.range(1).select(format_elapsed(F.lit(secs * 1_000_000)).alias("t")).first().t
    assert got == text
    assert got == str(dt.timedelta(seconds=secs)).replace(",", " and")


def test_format_elapsed_fraction(spark):
    got = spark.range(1).select(format_elapsed(F.lit(1_500_000)).alias("t")).first().t
    assert got == str(dt.timedelta(microseconds=1_500_000))


@pytest.mark.parametrize("name", ["copay_options_yn", "access_group_code", "financial", "_product_group",
                                  "place_of_service#", "Member_ID"])
def test_suffix_rule(spark, name):
    expected = name.lower().split("_")[-1]
    assert suffix_of_name(name) == expected
    assert spark.range(1).select(suffix_of(F.lit(name)).alias("s")).first().s == expected


def test_text_helpers(spark):
    r = spark.range(1).select(
        basename(F.lit("/proj/etl/run_claims.py")).alias("b"),
        basename(F.lit("plain")).alias("b2"),
        collapse_ws(F.lit("a   b\t c")).alias("c"),
        split_ws(F.lit("  a  b   c  ")).alias("s"),
        split_ws(F.lit("   ")).alias("e"),
        strip_last(F.lit("Aborted)")).alias("x"),
        percent_text(F.lit(0.473)).alias("p"),
        encode_map(F.lit("northeast"), {"southwest": 1, "northeast": 4}).alias("m"),
        encode_map(F.lit("central"), {"southwest": 1}).alias("m2")).first()
    assert r.b == "run_claims.py" and r.b2 == "plain"
    assert r.c == "a b c" and r.s == ["a", "b", "c"] and r.e == []
    assert r.x == "Aborted" and r.p == "47.3%"
    assert r.m == 4 and r.m2 is None


def test_parse_date_time_is_strict_and_zone_free(spark):
    df = spark.createDataFrame([("2024-01-05", "13:02:03"), ("2024-02-30", "00:00:00"), ("2024-1-5", "1:2:3"),
                                (None, "00:00:00")], "d string, t string")
    got = [r.ts for r in df.select(parse_date_time_ntz("d", "t").alias("ts")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 13, 2, 3), None, None, None]
    assert dict(df.select(parse_date_time_ntz("d", "t").alias("ts")).dtypes)["ts"] == "timestamp_ntz"
