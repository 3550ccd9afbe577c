"""Cleaning and parsing semantics (including the decided quirks)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratum.contracts import snake_case
from stratum.functions import clean as C
from stratum.functions.keys import natural_key


def _one(spark, value, fn, ddl="string"):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    out = fn(F.col("v"))
    if isinstance(out, tuple):
        row = df.select(out[0].alias("value"), out[1].alias("invalid")).first()
        return row["value"], row["invalid"]
    return df.select(out.alias("value")).first()["value"]


@pytest.mark.parametrize("raw,expected", [
    ("  Maria   da\tSilva ", "Maria da Silva"),
    ("a  b", "a b"),        # NBSP and EM SPACE are whitespace
    ("x\x1cy", "x y"),                # Python treats \x1c-\x1f as whitespace
    ("-", None), ("N/A", None), ("null", None), ("NaN", None), ("  ", None), ("", None),
    (None, None),
])
def test_clean_text(spark, raw, expected):
    assert _one(spark, raw, C.clean_text) == expected


@pytest.mark.parametrize("raw,value,invalid", [
    ("12", 12, False), (" -7 ", -7, False), ("+12", None, True), ("12x", None, True),
    ("1e3", None, True), ("-", None, False), ("99999999999", None, True),
])
def test_parse_integer(spark, raw, value, invalid):
    assert _one(spark, raw, C.parse_integer) == (value, invalid)


@pytest.mark.parametrize("raw,value,invalid", [
    ("1.234,56", Decimal("1234.56"), False),
    ("1234.56", Decimal("123456"), False),      # dots are always thousands separators
    ("1.2.3,4", Decimal("123.4"), False),
    (",5", None, True), ("5,", None, True), ("#########", None, True), ("#DIV/0!", None, True),
    ("1e3", None, True), ("-10,25", Decimal("-10.25"), False), ("0,12345678901", None, True),
])
def test_parse_decimal(spark, raw, value, invalid):
    got, bad = _one(spark, raw, C.parse_decimal)
    assert bad is invalid
    assert (got is None and value is None) or got == value


@pytest.mark.parametrize("raw,value,invalid", [
    ("16/08/2026", dt.date(2026, 8, 16), False), ("1/2/2024", dt.date(2024, 2, 1), False),
    ("31/02/2024", None, True), ("32/01/2024", None, True), ("01/02/24", None, True),
    ("01/02/20245", None, True), ("", None, False),
])
def test_parse_date(spark, raw, value, invalid):
    assert _one(spark, raw, C.parse_date) == (value, invalid)


@pytest.mark.parametrize("raw,value,invalid", [
    ("13:21", "13:21:00", False), ("9:5", "09:05:00", False), ("13:21:07", "13:21:07", False),
    ("25:00", None, True), ("12:60", None, True), ("null", None, False),
])
def test_parse_time(spark, raw, value, invalid):
    assert _one(spark, raw, C.parse_time) == (value, invalid)


def test_combine_datetime_is_null_safe(spark):
    df = spark.createDataFrame([(dt.date(2026, 8, 16), "13:21:00"), (None, "13:21:00")], "d date, t string")
    got = [r[0] for r in df.select(C.combine_datetime("d", "t")).collect()]
    assert got == [dt.datetime(2026, 8, 16, 13, 21), None]


def test_upper_follows_unicode_rules(spark):
    assert _one(spark, " ção ß ", C.clean_category) == "ÇÃO SS"


def test_names():
    names = {"Valor Pago (R$)": "valor_pago_r", " ÓRGÃO--nº 2 ": "orgao_no_2", "a–b": "a_b", "?!": "coluna", "": "coluna"}
    assert {n: snake_case(n) for n in names} == names


def test_natural_key_trims_and_empties_nulls(spark):
    df = spark.createDataFrame([(2024, "ESTADUAL", "SP ", None, None)], "y int, l string, uf string, ue string, c string")
    assert df.select(natural_key("y", "l", "uf", "ue", "c", trim_first=(2,))).first()[0] == "2024|ESTADUAL|SP||"


def test_rate(spark):
    df = spark.createDataFrame([(1, 3), (2, 0)], "n long, rows long")
    assert [r[0] for r in df.select(C.rate("n", "rows")).collect()] == [0.333333, 1.0]


def test_cells_are_collapsed_by_one_expensive_replacement_at_most(spark):
    """Texts of visible ASCII skip the replacement; all others are collapsed as before, white space of any kind included."""
    texts = ["ab", " a  b ", "a  b", "　", "", "\x1c", "é", "é\tü", "a~!", None, "n/a", " N/A "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.select("i", C.collapse_whitespace("t").alias("c")).orderBy("i").collect()]
    assert got == [t if t is None else " ".join(t.split()) for t in texts]


def test_duplicate_issues_shuffle_only_what_they_tell(spark):
    from stratum.operators import quality as Q

    rows = spark.createDataFrame([("m", 1, "x" * 9), ("m", 1, "y"), ("n", 1, "z")], "member string, no long, wide string")
    issues = Q.duplicate_issues(rows, ["member", "no"], ["no"], F.col("member"), F.col("no"), "duplicate", None, "twice")
    assert [(r.artifact, r.record_no) for r in issues.collect()] == [("m", 1)]
    assert "wide" not in issues._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0].split("LogicalRDD")[0]


def test_tables_are_written_with_methods_that_the_jvm_compiles(spark):
    from stratum.session import METHOD_LIMIT, written_once

    before = spark.conf.get(METHOD_LIMIT)
    seen = []

    class Frame:
        sparkSession, schema = spark, spark.range(1).schema

        class write:
            @staticmethod
            def parquet(path):
                seen.append(int(spark.conf.get(METHOD_LIMIT)))
                spark.range(1).write.parquet(path)

    assert written_once(Frame, "limit").count() == 1
    assert seen == [8000] and spark.conf.get(METHOD_LIMIT) == before
