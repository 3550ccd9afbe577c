"""Lake I/O helpers: CSV export / text read-back, append sink, names, last writer."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stratum.functions import clean as C
from stratum.operators import dims as D
from stratum.sources import lake as L


def test_prefix_layout():
    assert L.prefix("s3a://lake", "silver", "fundo_eleitoral", {"ano_eleicao": 2024}, "tratado") == \
        "s3a://lake/silver/fundo_eleitoral/ano_eleicao=2024/tratado/"
    with pytest.raises(ValueError):
        L.prefix("/x", "platinum", "s")


def test_csv_export_and_text_read_back(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="stratum-csv-"), "silver")
    df = spark.createDataFrame([(1, "PDT", None), (2, "PSB", "1234.56")], "n int, sigla string, valor string")
    L.export_csv(df, path)
    back = L.read_text_csv(spark, path, ["n", "sigla", "valor"])
    assert dict(back.dtypes) == {"n": "string", "sigla": "string", "valor": "string"}
    assert sorted((r["n"], r["sigla"], r["valor"]) for r in back.collect()) == [
        ("1", "PDT", None), ("2", "PSB", "1234.56")]
    with pytest.raises(Exception):
        L.read_text_csv(spark, path, ["n", "sigla", "other"]).collect()


def test_save_table_append_and_error(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="stratum-tbl-"), "t")
    df = spark.createDataFrame([(1,)], "a int")
    L.save_table(df, path, mode="append")
    L.save_table(df, path, mode="append")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception):
        L.save_table(df, path, mode="error")


def test_base_name(spark):
    df = spark.createDataFrame([("dir/sub/fefc_genero_2024.csv",)], "p string")
    assert df.select(C.base_name("p")).first()[0] == "fefc_genero_2024.csv"


def test_resolve_last_writer(spark):
    df = spark.createDataFrame([(2024, 12, "PDT", 2), (2024, 12, "PDTX", 5), (2024, 13, "PSB", 1)],
                               "yr int, n int, sigla string, rec int")
    got = {(r["yr"], r["n"]): r["sigla"] for r in D.resolve_last_writer(df, ["yr", "n"], "sigla", "rec").collect()}
    assert got == {(2024, 12): "PDTX", (2024, 13): "PSB"}
