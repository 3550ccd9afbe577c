"""Duplicates with ties and hot keys, frequent keys, CSV that other readers understand, imports without the subpackage."""

from __future__ import annotations

import csv
import glob
import os
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from stratum.operators import quality as Q
from stratum.operators import skew as K
from stratum.sources import lake as L

ROOT = Path(__file__).resolve().parent.parent


def test_rows_that_tie_on_the_order_leave_exactly_one_first(spark):
    rows = spark.createDataFrame(
        [("m", 1, "a"), ("m", 1, "b"), ("m", 1, "c"), ("m", 2, "x"), ("m", 2, "x"), ("n", 1, None), ("n", 1, "a"),
         (None, None, "p"), (None, None, "q"), ("z", 9, "alone")], "member string, no int, v string")
    issues = Q.duplicate_issues(rows, ["member", "no"], ["no"], F.col("member"), F.col("no"), "duplicate_source_row",
                                "no", "repeated")
    assert Counter(r["artifact"] for r in issues.collect()) == {"m": 3, "n": 1, None: 1}
    left = Counter(r["v"] for r in Q.duplicates_after_first(rows, ["member", "no"], ["no"]).collect())
    assert left == {"b": 1, "c": 1, "x": 1, "a": 1, "q": 1}  # nulls come first, else the smallest row is kept


def test_only_hot_keys_are_copied_to_salts(spark):
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        hot = K.hot_hashes(rows, ["k"], share=0.1).first()["hot"]
        assert len(hot) == 1
        per_key = rows.groupBy("k").agg(F.count("*").alias("n"))
        joined = K.salted_join(rows, per_key, ["k"], K.is_hot(rows, ["k"], 0.1))
        assert joined.columns == ["k", "v", "n"] and joined.count() == 4000
        assert joined.where("k = 0 AND n <> 1334").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "1")


def test_frequent_keys_misses_none_at_the_share_and_counts_exactly(spark):
    rows = spark.range(10_000).selectExpr("if(id < 100, 'edge', if(id % 2 = 0, 'half', string(id))) AS k")
    found = {r["k"]: r["n"] for r in K.frequent_keys(rows, ["k"], share=0.01).collect()}
    assert found == {"edge": 100, "half": 4950}
    assert K.frequent_keys(rows.where("k = 'none'"), ["k"]).count() == 0


VALUES = ['A "B" C;d', '"', 'back\\slash', 'ends with \\', 'two\nlines', "carriage\r\nreturn", " blanks ", "a;b", "'x'", None]


def test_exported_csv_is_read_alike_by_python_and_by_spark(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame(list(enumerate(VALUES)), "n int, v string").coalesce(1)
    L.export_csv(rows, path)
    (part,) = glob.glob(f"{path}/*.csv")
    with open(part, encoding="utf-8", newline="") as handle:
        header, *records = csv.reader(handle, delimiter=";")
    assert header == ["n", "v"] and [r[1] for r in records] == [v or "" for v in VALUES]
    back = L.read_text_csv(spark, path, ["n", "v"])
    assert [r["v"] for r in back.orderBy(F.col("n").cast("int")).collect()] == VALUES


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for name in ("stratum", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "stratum" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    ran = [subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)]
    os.remove(tmp_path / "corpus_pipeline.py")
    ran.append(subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True))
    for done in ran:
        assert done.returncode == 0, done.stderr
        assert done.stdout.split()[1:] == ["False", "False"] and int(done.stdout.split()[0]) > 60
