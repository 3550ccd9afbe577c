"""The whole daily run, then a manual backfill."""

from __future__ import annotations

import pytest

from stratum.contracts import EXPECTED_DATASETS
from stratum.operators import quality as Q
from stratum.plans import pipeline as PL
from tests.conftest import archive, lake_of


def counts(run):
    return {(r["yr"], r["dataset"]): (r["staged"], r["deleted"], r["inserted"]) for r in run.collect()}


def test_a_run_and_backfills_of_one_and_of_all_years(spark):
    lake = lake_of((2022, archive(2022)), (2024, archive(2024)))
    summary = PL.run(spark, lake)
    assert [r["valid"] for r in summary["report"].collect()] == [True, True]
    assert counts(summary["load"]) == {(y, d): (1, 0, 1) for y in (2022, 2024) for d in EXPECTED_DATASETS}
    one = PL.backfill(spark, lake, [2024])
    assert counts(one.results) == {(2024, d): (1, 1, 1) for d in EXPECTED_DATASETS}
    assert {(a["yr"], a["deleted_rows"]) for a in one.audit.collect()} == {(2022, 0), (2024, 1)}
    assert len(counts(PL.backfill(spark, lake).results)) == 8
    with pytest.raises(Q.GateClosed, match="2020"):
        PL.backfill(spark, lake, [2020])


def test_two_loads_at_once(spark, monkeypatch):
    """A load of another year published meanwhile stays beside ours, its parties too; one of the same year refuses ours."""
    from tests.conftest import line

    lake = lake_of((2022, archive(2022)), (2024, archive(2024, {d: [line(d, 2024, sigla_partido="sol", numero_partido="88")]
                                                                for d in EXPECTED_DATASETS})))
    PL.run(spark, lake)
    commit = PL.P.commit

    def meanwhile(year):
        def first_another(*args, **kwargs):
            monkeypatch.setattr(PL.P, "commit", commit)
            PL.backfill(spark, lake, [year])
            return commit(*args, **kwargs)
        monkeypatch.setattr(PL.P, "commit", first_another)

    gold = next(p for p in (f"{lake}/gold/{PL.SOURCE_NAME}",))
    meanwhile(2024)
    PL.backfill(spark, lake, [2022])
    version, state = PL.P.head(spark, gold)
    assert version == 3
    for dataset in EXPECTED_DATASETS:
        folders = {k.split("/")[0]: v for k, v in state["facts"][dataset].items()}
        assert folders.keys() == {"2022", "2024"} and folders["2022"] != folders["2024"]
    assert {r["sigla_partido"] for r in PL.gold_view(spark, gold, "fp_genero").collect()} == {"LUA NOVA", "SOL"}
    assert {(r["yr"], r["deleted_rows"]) for r in spark.read.parquet(f"{state['run']}/carga_arquivo").collect()} == {(2022, 1), (2024, 1)}
    meanwhile(2022)
    with pytest.raises(PL.P.Conflict, match="2022"):
        PL.backfill(spark, lake, [2022])
    assert PL.P.head(spark, gold)[0] == 4


def test_reports_merge_from_the_years_that_were_loaded(spark):
    """A year loaded again replaces its own partials; the report over all years reads no record and no other year's silver."""
    lake = lake_of((2022, archive(2022)), (2024, archive(2024)))
    first = PL.run(spark, lake)
    base = f"{lake}/silver/{PL.SOURCE_NAME}"
    before = PL.P.pointer(spark, base)["partials"]
    assert before.keys() == {"2022", "2024"} and len(set(before.values())) == 1
    second = PL.run(spark, lake, years=[2024])
    after = PL.P.pointer(spark, base)["partials"]
    assert after["2022"] == before["2022"] and after["2024"] == f"{second['silver_run']}/quality"
    report = PL.published_report(spark, lake)
    assert [r.asDict() for r in report.collect()] == [
        {"valid": True, "artifacts": 8, "rows": 8, "errors": 0, "warnings": 0}]
    assert {r["year"]: r["rows"] for r in PL.published_report(spark, lake, ["year"]).collect()} == {2022: 4, 2024: 4}
    read = "".join(f for d in PL.published_quality(spark, lake) for f in d.inputFiles())
    assert f"{first['silver_run']}/quality" in read and "/silver/fefc" not in read and "year=2024" in read


def test_silver_is_exported_a_file_a_member(spark):
    import csv

    lake = lake_of((2024, archive(2024)))
    silver = PL.build_silver(spark, f"{lake}/bronze/{PL.SOURCE_NAME}", f"{lake}/run")
    done = PL.export_silver(spark, silver, lake).collect()
    assert {r["member"] for r in done} == {f"{d}_2024.csv" for d in EXPECTED_DATASETS}
    for r in done:
        assert r["path"].endswith(f"/ano_eleicao=2024/tratado/{r['member'].removesuffix('.csv')}_tratado.csv")
        with open(r["path"], encoding="utf-8", newline="") as handle:
            header, *records = csv.reader(handle, delimiter=";")
        assert len(records) == r["records"] == 1 and len(header) == len(records[0])
        assert dict(zip(header, records[0]))["sigla_partido"] == "LUA NOVA"
