"""Parser cases: literal input -> expected output, one DataFrame per parser."""

import math

import pytest
from pyspark.sql import functions as F

from simcat.functions import parsers as P
from simcat.functions import vectors as V

NAN = float("nan")

CASES = {
    "price": (P.parse_price, [
        ("200.00", 200.0), ("1,299.00", 1299.0), ("$14.99 - $19.99", 17.49), (None, None),
        ("", None), ("nan", None), ("abc", None), ("-5", 5.0), ("Rs, 5", 5.0), ("0", None)]),
    "weight": (P.parse_weight, [
        ("999999999", None), ("240 g", 240.0), ("1.5 kg", 1500.0), ("3.2 ounces", 90.7184),
        ("500", None), ("1.2.3 kg", None), ("10 x 20 cm 240 g", None), ("2 gms", 2.0)]),
    "rating": (P.parse_rating, [
        ("4.5", 4.5), ("4.5 out of 5 stars", 4.5), ("11.0", None), ("4.5d", None), (None, None)]),
    "percentage": (P.parse_percentage, [
        ("54", 54.0), ("54%", 54.0), ("150", None), ("1.2.3", None), ("-20", 20.0)]),
    "category_key": (P.category_key, [
        ("{'WomensKurtasKurtis': '#1793'}", "WomensKurtasKurtis"), ("not a dict", None),
        ("{'Top': '#19,259', 'Par1': '#12'}", "Par1"), ("[1]", None), (None, None)]),
    "category_rank": (P.category_rank, [
        ("{'ClothingAccessories': '#19,259'}", 19259.0), ("{'A': 'none'}", None),
        ("{'Top': '#19,259', 'Par1': '#12'}", 12.0)]),
    "clean_text": (P.clean_text, [
        ("Hello, World! https://x.y/z  ok", "hello world ok"), (None, ""), ("NaN", "")]),
    "yn": (P.yn_flag, [(" y ", 1.0), ("N", 0.0), (None, 0.0)]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_parser_table(spark, name):
    fn, rows = CASES[name]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "i int, x string")
    got = {r["i"]: r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    for i, (x, want) in enumerate(rows):
        if isinstance(want, float):
            assert got[i] is not None and math.isclose(got[i], want, rel_tol=1e-9), (x, got[i], want)
        else:
            assert got[i] == want, (x, got[i], want)


def test_split_multi_is_set_like(spark):
    df = spark.createDataFrame([("black|white",), ("white|Black ",), (None,)], "x string")
    out = [r[0] for r in df.select(P.split_multi("x")).collect()]
    assert set(out[0]) == set(out[1]) == {"black", "white"}
    assert out[2] == []


def test_cosine_bounds(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0]), ([1.0, 0.0], [0.0, 1.0]),
                                ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(V.cosine("a", "b")).collect()]
    assert math.isclose(got[0], 1.0) and got[1] == 0.0 and got[2] == 0.0


def test_stop_words_parameter(spark):
    from simcat.functions import text as TX
    df = spark.createDataFrame([("the slim fit shirt",)], "x string")
    assert df.select(TX.tokens("x")).first()[0] == ["slim", "fit", "shirt"]
    assert df.select(TX.tokens("x", ["shirt"])).first()[0] == ["the", "slim", "fit"]


def test_stop_words_equal_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    from simcat.functions.text import STOP_WORDS
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
