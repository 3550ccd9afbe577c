"""Plan guards: pushed filters, pruned scans, single reads, and no bound on the years."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from stratum import session as S
from stratum.plans import gold_fixture as GF
from tests.conftest import SMALL_SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_is_pushed_to_the_orders_scan(spark):
    plan = _plan(queries()["total_one_year"](spark, SMALL_SF))
    orders_scan = [line for line in plan.split("\n") if "FileScan parquet" in line and "orders.parquet" in line]
    assert orders_scan, plan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in orders_scan[0]


def test_the_flagship_reads_lineitem_once_and_four_columns_of_it(spark):
    schemas = re.findall(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", _plan(GF.party_segment_totals(spark, SMALL_SF)))
    assert [{c.split(":")[0] for c in s.split(",")} for s in schemas] == [
        {"l_orderkey", "l_suppkey", "l_returnflag", "l_extendedprice"}]
    for name in ("total_by_year_party_gender", "view_location_child", "gated_backfill"):
        assert "lineitem.parquet" not in _plan(queries()[name](spark, SMALL_SF))


def test_orders_of_any_year_keep_their_rows(spark, tmp_path):
    for name in os.listdir(SMALL_SF):
        if name != "orders.parquet":
            os.symlink(f"{SMALL_SF}/{name}", tmp_path / name)
    orders = spark.read.parquet(f"{SMALL_SF}/orders.parquet")
    later = F.when(F.year("o_orderdate") == 1998, F.add_months("o_orderdate", 480).cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))
    orders.withColumn("o_orderdate", later.cast(orders.schema["o_orderdate"].dataType)).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("total_by_year_party_gender", "view_parent"):
        before, after = queries()[name](spark, SMALL_SF), queries()[name](spark, str(tmp_path))
        assert after.count() == before.count()
        assert {r["yr"] for r in after.select("yr").distinct().collect()} >= {2038}


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_dir(Session())
