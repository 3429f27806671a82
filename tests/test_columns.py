"""Column expressions and name handling."""

import datetime as dt

import pytest
from flowtide.functions import columns as C
from flowtide.functions import fixed_values as V
from pyspark.sql import functions as F


def one_column(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_valid_id(spark):
    ids = ["#", "0", "12", "ABC", "0.4", "1.5", "-3", " 7 ", "0012", "1e3", "", None]
    kept = one_column(spark, ids).where(C.valid_id(F.col("x"))).collect()
    assert [r.x for r in kept] == ["12", "-3", " 7 ", "0012"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("01-31-2020", dt.date(2020, 1, 31)),
        ("2020-01-31", None),
        ("1-2-2020", None),
        ("13-01-2020", None),
        ("02-30-2020", None),
        (".", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    df = one_column(spark, [text]).select(C.parse_date(F.col("x"), V.MACRO_DATE_FORMAT).alias("d"))
    assert df.first().d == expected


def test_month_keys(spark):
    df = one_column(spark, [202011, 202012, 202101], "int")
    month = F.col("x")
    got = df.select(C.month_index(month), C.month_date(month), C.month_date(month, 0)).collect()
    assert [r[0] for r in got] == [24251, 24252, 24253]
    assert [r[1] for r in got] == [dt.date(2020, 12, 1), dt.date(2021, 1, 1), dt.date(2021, 2, 1)]
    assert got[0][2] == dt.date(2020, 11, 1)


def test_map_suffix(spark):
    df = one_column(spark, ["RGAAX", "RGAGX", "RGAZZ", "AX", None])
    got = [r[0] for r in df.select(C.map_suffix(F.col("x"), V.SHARE_CLASS_SUFFIXES)).collect()]
    assert got == ["R-1", "R-6", None, "R-1", None]


def test_fund_bucket(spark):
    df = one_column(spark, ["AFTD2050", "TCGTD1", "GFA", "TD", "XAFTD", "ZZZ", None])
    bucket = C.fund_bucket(F.col("x"), V.FUND_BUCKETS, V.TARGET_DATE_BUCKET, V.TARGET_DATE_PREFIXES)
    assert [r[0] for r in df.select(bucket).collect()] == ["TD", "TD", "GFA", None, None, None, None]


def test_names_and_casts(spark):
    df = spark.createDataFrame([("1.5", ".", "x")], ["Oil Price", "GDP", "keep me"])
    got = C.cast_all(C.clean_names(df), "double", except_=["keep_me"])
    assert got.columns == ["Oil_Price", "GDP", "keep_me"]
    assert tuple(got.first()) == (1.5, None, "x")


def test_cast_all_with_awkward_names(spark):
    df = spark.createDataFrame([("1", "2")], ["a.b", "c d"])
    assert tuple(C.cast_all(df, "double").first()) == (1.0, 2.0)


def test_standard_names_ignore_case(spark):
    df = spark.createDataFrame([(1, 2)], ["MonthNumber", "SaleAmount"])
    got = C.standardize_columns(df, V.FLOW_COLUMNS)
    assert got.columns == ["month_number", "sale_amount"]


def test_mean_of_nothing_is_null(spark):
    df = one_column(spark, [None], "decimal(18,2)")
    assert df.select(C.mean(F.sum("x"), F.count("x"))).first()[0] is None
