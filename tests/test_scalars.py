"""Scalar functions on the examples that pin their meaning."""

import pytest
from pyspark.sql import functions as F

from placeforge.functions import scalars as S


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize("given, key", [("Exit A", "A"), ("EXIT B", "B"), ("1", "1"), ("  a  ", "A"), ("Exit", ""), ("", "")])
def test_exit_key(spark, given, key):
    assert one(spark, S.exit_key(F.col("s")), s=given) == key


@pytest.mark.parametrize("given, label", [("A", "Exit A"), ("exitb", "Exit b"), ("EXIT", "Exit "), ("Exit 2", "Exit 2")])
def test_exit_label(spark, given, label):
    assert one(spark, S.exit_label(F.col("s")), s=given) == label


def test_exit_order(spark):
    df = spark.createDataFrame([("10",), ("B",), ("2",), ("A",)], "c string")
    assert [r[0] for r in df.orderBy(S.exit_order(F.col("c"))).collect()] == ["A", "B", "2", "10"]


@pytest.mark.parametrize("codes, yes", [(["DT1", "BP1"], True), (["NE16", "STC"], True), (["NS13", "NS14"], False), (["BP2", "BP3"], False)])
def test_interchange(spark, codes, yes):
    assert spark.createDataFrame([(codes,)], "c array<string>").select(S.is_interchange(F.col("c"))).first()[0] is yes


def test_codes(spark):
    assert one(spark, S.codes_strict(F.col("s")), s="X MRT STATION (NS13 / A1)") == ["NS13"]
    assert one(spark, S.codes_loose(F.col("s")), s="north east line NE, ns1") == ["NE", "NS1"]
    assert spark.createDataFrame([(["NE16", "STC"],)], "c array<string>").select(S.detect_lines(F.col("c"))).first()[0] == ["NEL", "SKL"]


def test_names(spark):
    assert one(spark, S.py_title(F.col("s")), s="one-north KING'S 2a") == "One-North King'S 2A"
    assert one(spark, S.percent_quote(F.col("s")), s="A b/c&d") == "A%20b/c%26d"
    assert one(spark, S.clean_building(F.col("s")), s="YISHUN MRT STATION EXIT A (NS13)") == "YISHUN MRT STATION"
    assert one(spark, S.url_candidates(F.col("s"), "u"), s="Gardens By The Bay")[1] == "u/Gardens_by_the_Bay_MRT_Station"
    assert one(spark, S.url_candidates(F.col("s"), "u"), s="One-North")[-1] == "u/One-north_MRT_Station"


@pytest.mark.parametrize("lat, lng, yes", [(1.3521, 103.8198, True), (1.0, 105.0, True), (0.0, 103.0, False), (1.35, 150.0, False)])
def test_bounds(spark, lat, lng, yes):
    assert one(spark, S.in_bounds(F.col("a"), F.col("b")), a=lat, b=lng) is yes


def test_reduction(spark):
    assert one(spark, S.reduction_percent(F.col("a"), F.col("b")), a=10000, b=5000) == 50.0
    assert one(spark, S.reduction_percent(F.col("a"), F.col("b")), a=0, b=4) == 0.0
    assert one(spark, S.reduction_ratio(F.col("a"), F.col("b")), a=10000, b=5000) == 2.0
