"""Generic record validations (ported cases)."""

from __future__ import annotations

import pytest

from stratum.operators import validate as V


def test_missing_fields_are_reported(spark):
    df = spark.createDataFrame([(1, "A"), (2, "")], "id int, name string")
    rep = V.validate_records(df, required=["id", "name"]).collect()[0]
    assert rep["valid"] is False and "name" in rep["missing_fields"].split(",")


def test_empty_allowed_when_requested(spark):
    df = spark.createDataFrame([], "id int")
    rep = V.validate_records(df, allow_empty=True).collect()[0]
    assert rep["valid"] is True and rep["record_count"] == 0


def test_empty_refused_by_default(spark):
    with pytest.raises(V.ValidationError):
        V.ensure_not_empty(spark.createDataFrame([], "id int"))


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "id int, pos int")
    dups = V.find_duplicate_rows(df, ["id"], ["pos"]).collect()
    assert [r.asDict() for r in dups] == [{"id": 1, "pos": 2}]


@pytest.mark.parametrize("value,ddl", [("0", "int"), ("-1", "int"), (None, "int"), ("'1'", "string"),
                                       ("true", "boolean")])
def test_positive_fields_reject(spark, value, ddl):
    expr = f"CAST({value if value is not None else 'NULL'} AS {ddl})"
    df = spark.sql(f"SELECT 1 AS id, {expr} AS row_count")
    assert V.positive_field_violations(df, ["row_count"], ["id"]).count() == 1


def test_positive_fields_accept(spark):
    df = spark.createDataFrame([(1, 10, 9)], "id int, source_row_count int, row_count int")
    assert V.positive_field_violations(df, ["source_row_count", "row_count"], ["id"]).count() == 0
