from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from granary.functions import cleaning
from granary.operators import filters, shaping


@pytest.mark.parametrize(
    "text, how, expected",
    [
        ("25,3", {}, 253.0),
        ("-4.5", {}, -4.5),
        ("-", {}, None),
        ("", {}, None),
        ("   ", {}, None),
        ("1.2.3", {}, None),
        (" 26.1 C", {}, 26.1),
        (None, {}, None),
        ("12,5", {"decimal": ",", "signed": False}, 12.5),
        ("12.5", {"decimal": ",", "signed": False}, 12.5),
        ("-12,5", {"decimal": ",", "signed": False}, 12.5),
        ("1.234,5", {"decimal": ",", "signed": False}, None),
        ("1.234,5", {"decimal": ",", "group": "."}, 1234.5),
        ("1,234.5", {"group": ","}, 1234.5),
        ("10213705.17", {"decimal": ","}, 10213705.17),
    ],
)
def test_parse_number(spark, text, how, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cleaning.parse_number("t", **how)).first()[0] == expected


def test_large_numbers_survive_whether_text_or_typed(spark):
    text = spark.createDataFrame([("53980993.19",)], "v string")
    typed = spark.createDataFrame([(53980993.19,)], "v double")
    for df in (text, typed):
        assert shaping.clean_numbers(df, ["v", "absent"], decimal=",").first().v == 53980993.19


@pytest.mark.parametrize(
    "text, expected",
    [("28/02/2023", datetime.date(2023, 2, 28)), ("31/02/2023", None), ("1/2/2023", None), ("", None), (None, None)],
)
def test_parse_day(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cleaning.parse_day("t")).first()[0] == expected


def test_codes_and_names(spark):
    df = spark.createDataFrame([("babel",), ("xyz",), (None,)], "c string")
    got = [r[0] for r in df.select(cleaning.code_to_name("c", {"babel": "BANGKA"})).collect()]
    assert got == ["BANGKA", "XYZ", None]
    df = spark.createDataFrame([("  Kep. Riau ",), ("aceh",)], "n string")
    got = [r[0] for r in df.select(cleaning.standard_name("n", {"KEP. RIAU": "KEPULAUAN RIAU"})).collect()]
    assert got == ["KEPULAUAN RIAU", "ACEH"]


@pytest.mark.parametrize("entries", [0, 3, 200])
def test_lookup_whatever_the_size_of_the_mapping(spark, entries):
    mapping = {f"k{i}": i for i in range(entries)}
    df = spark.createDataFrame([("k0",), ("k2",), ("k199",), ("z",), (None,)], "k string")
    got = [r[0] for r in df.select(cleaning.lookup("k", mapping, -1)).collect()]
    assert got == [mapping.get(k, -1) for k in ("k0", "k2", "k199", "z", None)]


def test_union_is_by_name_and_tolerates_missing_columns(spark, rows):
    a = spark.createDataFrame([("x", 1, 2.0)], "k string, target int, area double")
    b = spark.createDataFrame([(5.0, "y")], "area double, k string")
    assert rows(shaping.unite([a, b])) == [("x", 1, 2.0), ("y", None, 5.0)]


def test_dedupe_keeps_the_smallest_row_of_a_hot_key(spark, rows):
    copies = spark.range(30_000).select(F.lit(7).alias("k"), (F.col("id") + 5).alias("v"), F.lit("z").alias("w"))
    others = spark.range(100).select((F.col("id") + 100).cast("int").alias("k"), F.col("id").alias("v"), F.lit("a").alias("w"))
    out = shaping.dedupe(copies.unionByName(others), ["k"], ["v"])
    assert out.count() == 101
    assert rows(out.where("k = 7")) == [(7, 5, "z")]
    assert out.columns == ["k", "v", "w"]


def test_filters(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, 3.0, None), (3, None, -1.0)], "i int, a double, b double")
    assert [r[0] for r in rows(filters.drop_all_null(df, ["a", "b", "gone"]))] == [2, 3]
    assert filters.drop_all_null(df, ["gone"]).count() == 3
    assert [r[0] for r in rows(filters.positive_or_null(df, "b"))] == [1, 2]
    assert [r[0] for r in rows(filters.at_extreme(df, "i"))] == [1]


def test_required_projection(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out, absent = shaping.project_required(df, ["b", "c", "a"])
    assert out.columns == ["b", "a"] and absent == ["c"]
    with pytest.raises(ValueError):
        shaping.project_required(df, ["x"])
    assert shaping.add_literals(df, {"a": 9, "c": 3}, only_missing=True).first().asDict() == {"a": 1, "b": 2, "c": 3}
