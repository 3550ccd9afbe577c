"""Uniqueness checks deal keys over tasks by the bytes read."""

from stratum.operators import dims as D
from stratum.session import dealt, file_bytes


def test_keys_are_dealt_by_the_bytes_read(spark, tmp_path):
    spark.range(200_000).selectExpr("id % 150000 AS k", "id AS v").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    size = file_bytes(table)
    assert size > 0 and file_bytes(spark.createDataFrame([(1,)], "k int")) == 0
    assert dealt(table, ["k"], -(-size // 5)).rdd.getNumPartitions() == 5
    plan = D.duplicate_keys(table, ["k"])
    assert {r.k for r in plan.collect()} == set(range(50_000))


def test_large_tables_get_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dealt, "__defaults__", (1024,))
    spark.range(50_000).selectExpr("id % 40000 AS k").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    found = D.duplicate_keys(table, ["k"])
    assert "RepartitionByExpression" in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 10_000
