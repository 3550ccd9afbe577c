"""Slice replacement on disk, and the log of versions, each written in one step by one run only."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from stratum.operators import publish as P


def test_only_named_slices_are_replaced(spark, tmp_path):
    path = str(tmp_path / "fact")
    ddl = "yr int, member string, v int"
    P.write_slices(spark.createDataFrame([(2020, "a", 1), (2020, "a", 2), (2022, "b", 3)], ddl), path, ["yr", "member"])
    P.write_slices(spark.createDataFrame([(2020, "a", 9)], ddl), path, ["yr", "member"])
    assert sorted((r["yr"], r["v"]) for r in spark.read.parquet(path).collect()) == [(2020, 9), (2022, 3)]


def test_the_pointer_moves_and_carries_its_facts(spark, tmp_path):
    base = str(tmp_path)
    assert P.pointer(spark, base) is None and P.current_run(spark, base) is None
    for name in ("one", "two"):
        P.publish(spark, base, name, {"facts": {"t": {"2020/a": name}}})
        assert P.pointer(spark, base) == {"run": name, "facts": {"t": {"2020/a": name}}}
    assert P.current_run(spark, base) == "two"


def test_a_crash_before_the_rename_leaves_the_old_pointer(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    P.publish(spark, base, "one")

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(P, "_place", lost)
    with pytest.raises(OSError):
        P.publish(spark, base, "two")
    assert P.current_run(spark, base) == "one"


def test_one_of_two_runs_gets_a_version_and_the_other_goes_on_top(spark, tmp_path):
    base = str(tmp_path)

    def add(name: str):
        return P.commit(spark, base, lambda now: {"run": name, "all": sorted([*(now or {"all": []})["all"], name])}, start=0,
                        touched={"t": [name]})

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(add, [f"r{i}" for i in range(8)]))
    assert sorted(versions) == list(range(1, 9))
    assert P.pointer(spark, base)["all"] == [f"r{i}" for i in range(8)]
    names = sorted(p.name for p in (tmp_path / P.POINTER).iterdir() if not p.name.startswith("."))
    assert names == [f"{i:012d}.json" for i in range(1, 9)]


def test_a_slice_that_another_run_published_meanwhile_is_refused(spark, tmp_path):
    base = str(tmp_path)
    start, _ = P.head(spark, base)
    P.commit(spark, base, lambda _: {"run": "a"}, start, {"t": ["2020/x"], "u": ["2020/x"]})
    P.commit(spark, base, lambda _: {"run": "b"}, start, {"t": ["2022/x"]})  # another slice: both stay
    with pytest.raises(P.Conflict, match="2020/x"):
        P.commit(spark, base, lambda _: {"run": "c"}, start, {"u": ["2020/x", "2024/x"]})
    assert P.head(spark, base) == (2, {"run": "b"})
    P.commit(spark, base, lambda _: {"run": "c"}, 2, {"u": ["2020/x"]})  # begun after it: no conflict
    assert P.current_run(spark, base) == "c"
    assert json.loads((tmp_path / P.POINTER / f"{3:012d}.json").read_text())["touched"] == {"u": ["2020/x"]}
