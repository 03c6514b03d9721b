import pytest
from pyspark.sql import functions as F

from playbill.functions import decade, first_known, first_of, split_list, to_int


def values(spark, column, data, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


DIRTY = ["Reality-TV", "12.7", " 12 ", "", None, "-3", "99999999999", "12"]


def test_to_int_never_fails(spark):
    assert values(spark, to_int("v"), DIRTY) == [None, None, 12, None, None, -3, None, 12]


def test_to_int_can_cut_decimals(spark):
    got = values(spark, to_int("v", truncate=True), DIRTY + [" 7.9 ", "-1.5", "3.x", "."])
    assert got == [None, 12, 12, None, None, -3, None, 12, 7, -1, None, None]


def test_decade(spark):
    years = [1994, 2000, 1999, None, 0, -5, 2147483647, -2147483648]
    assert values(spark, decade("v"), years, "int") == [
        "1990", "2000", "1990", "unknown", "0", "-10", "2147483640", "-2147483650"]


@pytest.mark.parametrize("text,items,first", [
    ("A,B", ["A", "B"], "A"), ("A", ["A"], "A"), (None, [], None), (",B", ["", "B"], ""),
])
def test_lists(spark, text, items, first):
    assert values(spark, split_list("v"), [text]) == [items]
    assert values(spark, first_of(split_list("v")), [text]) == [first]


def test_first_known(spark):
    df = spark.createDataFrame(
        [("1990", "1980"), ("unknown", "1980"), ("unknown", "unknown"), (None, "1970"),
         (None, None)], "a string, b string")
    plain = df.select(first_known("a", "b")).collect()
    assert [r[0] for r in plain] == ["1990", "unknown", "unknown", "1970", "unknown"]
    strict = df.select(first_known("a", F.col("b"), missing="unknown")).collect()
    assert [r[0] for r in strict] == ["1990", "1980", "unknown", "1970", "unknown"]
