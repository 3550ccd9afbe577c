"""Quality reports, the gate and the gold load, through the real pipeline."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from stratum.contracts import EXPECTED_DATASETS, SOURCE_NAME
from stratum.operators import dims as D
from stratum.operators import facts as FA
from stratum.operators import publish as P
from stratum.operators import quality as Q
from stratum.plans import pipeline as PL
from tests.conftest import archive, lake_of, lake_with, line
from tests.test_silver_pipeline import silver_of


def judged(spark, lake, write=False):
    silver = silver_of(spark, lake)
    return silver, PL.run_quality(spark, silver, write=write)


def rules_of(quality):
    return {(r["year"], r["artifact"], r["rule"], r["severity"]): r["n"] for r in
            quality.rollup.groupBy("year", "artifact", "rule", "severity").agg(F.sum("n").alias("n")).collect()}


@pytest.fixture(scope="module")
def good(spark):
    lake = lake_with()
    return (lake, *judged(spark, lake))


def test_good_files_give_a_valid_report(good):
    report, = good[2].report.collect()
    assert report.asDict() == {"year": 2024, "valid": True, "artifacts": 4, "rows": 4, "errors": 0, "warnings": 0}
    assert rules_of(good[2]) == {}


def test_issues_of_two_years_stay_apart_and_coverage_has_its_rate(spark):
    parents = {y: [line("fp_genero", y, numero_partido=str(n)) for n in range(70, 70 + k)] for y, k in ((2020, 4), (2024, 6))}
    children = {y: [line("fp_cor_raca", y, numero_partido="70")] for y in parents}
    children[2024].append(line("fp_cor_raca", 2024, numero_partido="99"))
    lake = lake_of(*((y, archive(y, {"fp_genero": parents[y], "fp_cor_raca": children[y]})) for y in parents))
    _, quality = judged(spark, lake, write=True)
    found = {r["year"]: r for r in quality.rollup.where("rule = 'cross_dataset_integrity'").collect()}
    assert (found[2020]["n"], found[2020]["rate"]) == (3, 0.75)
    assert (found[2024]["n"], found[2024]["rate"]) == (6, 1.0)
    assert "without child=5, orphans=1" in found[2024]["message"]
    assert [r["errors"] for r in quality.report.orderBy("year").collect()] == [3, 6]
    total, = quality.overall.collect()
    assert (total["valid"], total["errors"], total["rows"]) == (False, 9, 17)


def test_the_written_report_has_totals_profiles_and_samples(spark):
    twice = [line("fefc_genero", 2024)] * 3
    silver, _ = judged(spark, lake_with(fefc_genero=twice), write=True)
    path, = glob.glob(f"{silver.run_dir}/quality/report/year=2024/*.json")
    with open(path) as text:
        report = json.load(text)
    issue, = [i for i in report["issues"] if i["rule"] == "duplicate_grain"]
    assert (issue["n"], issue["sample_rows"]) == (2, [3, 4]) and report["errors"] == 2
    profile, = [p for p in report["artifact_profiles"] if p["dataset"] == "fefc_genero"]
    assert (profile["duplicates"], profile["rows"]) == (2, 3)
    assert glob.glob(f"{silver.run_dir}/quality/report_overall/*.json")


def test_nulls_are_counted_for_each_artifact(good, spark):
    found = {r["dataset"]: r["null_counts"] for r in judged(spark, lake_with(2022))[1].profiles.collect()}
    assert found["fp_genero"] == {"sigla_ue": 1, "municipio": 1} and found["fefc_genero"] is None


def test_a_null_key_breaks_required_geography_and_coverage_rules(spark):
    _, quality = judged(spark, lake_with(fp_genero=[line("fp_genero", 2024, sigla_partido="", municipio="")]))
    member = "fp_genero_2024.csv"
    assert {k[1:3] for k in rules_of(quality)} >= {
        (member, "required_not_null"), (member, "geographic_integrity"), ("fp", "cross_dataset_integrity")}


def test_rows_lost_after_the_manifest_are_noticed(spark):
    lake = lake_with(fefc_genero=[line("fefc_genero", 2024), line("fefc_genero", 2024, numero_partido="78")])
    silver = silver_of(spark, lake)
    kept = silver.read(spark, "fefc_genero").where("numero_partido = 77")
    silver.tables["fefc_genero"] += "-cut"
    kept.write.partitionBy("_pyear", "source_member").parquet(silver.tables["fefc_genero"])
    assert (2024, "fefc_genero_2024.csv", "row_count_integrity", "error") in rules_of(PL.run_quality(spark, silver, write=False))
    with pytest.raises(FA.LoadError, match="manifest"):
        PL.load_gold(spark, silver, f"{lake}/gold")
    assert P.pointer(spark, f"{lake}/gold") is None


def test_odd_numbers_are_warnings(spark):
    lake = lake_with(
        fp_genero=[line("fp_genero", 2024, percentual_valor_fp_genero="#N/A")],
        fefc_genero=[line("fefc_genero", 2024, percentual_valor_fefc_genero="140,00", valor_total_recebido_fefc="-3,10")])
    _, quality = judged(spark, lake)
    assert rules_of(quality) == {
        (2024, "fp_genero_2024.csv", "source_numeric_null", "warning"): 1,
        (2024, "fefc_genero_2024.csv", "percentage_outlier", "warning"): 1,
        (2024, "fefc_genero_2024.csv", "negative_financial_value", "warning"): 1}
    assert quality.report.first()["valid"]


def test_the_manifest_s_header_must_be_the_contract_s(good, spark):
    _, silver, _ = good
    other = PL.SilverRun(silver.run_dir, silver.tables,
                         silver.artifacts.withColumn("columns", F.reverse("columns")), silver.members, silver.schemas)
    assert {k[2] for k in rules_of(PL.run_quality(spark, other, write=False))} == {"schema_integrity"}
    with pytest.raises(FA.LoadError, match="header"):
        PL.load_gold(spark, other, f"{good[0]}/gold-other")


def test_a_declared_year_without_files_lacks_all_of_them(spark):
    arts = spark.createDataFrame([(2020, "a"), (2020, "a"), (2020, "z")], "yr int, dataset string")
    got = {r["yr"]: r.asDict() for r in Q.completeness(arts, {2020: ["a", "b"], 2022: ["a", "b"]}).collect()}
    assert got[2022]["missing"] == "a,b" and got[2022]["n_issues"] == 2
    assert (got[2020]["missing"], got[2020]["duplicated"], got[2020]["extra"]) == ("b", "a", "z")


def test_the_gate_names_every_invalid_year(spark):
    report = spark.createDataFrame([(y, y % 2 == 0) for y in range(1900, 1960)], "year int, valid boolean")
    with pytest.raises(Q.GateClosed, match="1901.*1959"):
        Q.gate(report, ["year"])


# -- gold --------------------------------------------------------------------


def test_loading_again_replaces_the_slices(good, spark):
    lake, silver, _ = good
    root = f"{lake}/gold/{SOURCE_NAME}"
    for deleted in (0, 1):
        run = PL.load_gold(spark, silver, root)
        assert {(r["staged"], r["deleted"], r["inserted"]) for r in run.results.collect()} == {(1, deleted, 1)}
    view, = PL.gold_view(spark, root, "fp_cor_raca").collect()
    assert (view["sigla_partido"], view["genero"], view["cor_raca"], view["municipio"], str(view["valor_total_recebido_fp"])) == (
        "LUA NOVA", "MASCULINO", "NEGRA", "NITERÓI", "9876.50")
    audit = {a["dataset"]: a for a in run.audit.collect()}
    assert audit.keys() == set(EXPECTED_DATASETS)
    one = audit["fp_genero"]
    assert (one["source_member"], one["source_rows"], one["deleted_rows"]) == ("fp_genero_2024.csv", 1, 1)
    assert one["output_key"].endswith("/ano_eleicao=2024/source_member=fp_genero_2024.csv") and one["loaded_at"]


@pytest.mark.parametrize("moment", ["P.commit", "FA.audit_upsert", "D.insert_absent"])
def test_a_load_that_fails_leaves_the_published_state(spark, monkeypatch, moment):
    lake = lake_with()
    root = f"{lake}/gold"
    PL.load_gold(spark, silver_of(spark, lake), root)
    before = P.pointer(spark, root)
    other = silver_of(spark, lake_with(fefc_genero=[line("fefc_genero", 2024, numero_partido=n) for n in ("77", "78")]))

    def fails(*_, **__):
        raise OSError("lost")

    holder, name = moment.split(".")
    monkeypatch.setattr({"P": P, "FA": FA, "D": D}[holder], name, fails)
    with pytest.raises(OSError, match="lost"):
        PL.load_gold(spark, other, root)
    assert P.pointer(spark, root) == before
    assert PL.gold_view(spark, root, "fefc_genero").count() == 1


def test_slices_of_other_years_stay_when_one_is_loaded(spark):
    lake = lake_of((2020, archive(2020)), (2024, archive(2024)))
    root = f"{lake}/gold"
    PL.load_gold(spark, silver_of(spark, lake), root)
    PL.load_gold(spark, silver_of(spark, lake, years=[2024]), root)
    assert sorted(r["ano_eleicao"] for r in PL.gold_view(spark, root, "fp_genero").collect()) == [2020, 2024]


@pytest.mark.parametrize("cells,says", [
    ({"numero_partido": "0"}, "ck_dim_partido_numero"), ({"quantidade_candidatos": "-1"}, "ck_quantidade"),
    ({"status_renuncia": "7"}, "ck_status")])
def test_constraints_hold_at_load(spark, cells, says):
    lake = lake_with(fefc_genero=[line("fefc_genero", 2024, **cells)])
    with pytest.raises(FA.LoadError, match=says):
        PL.load_gold(spark, silver_of(spark, lake), f"{lake}/gold")
    assert P.pointer(spark, f"{lake}/gold") is None


def test_geography_constraint_holds_at_load(spark):
    lake = lake_with(fp_genero=[line("fp_genero", 2024, sigla_ue="")])
    with pytest.raises(FA.LoadError, match="ck_dim_localidade_geografia"):
        PL.load_gold(spark, silver_of(spark, lake), f"{lake}/gold")


def test_a_party_renamed_in_another_file_is_an_update_and_in_one_file_a_conflict(spark):
    lake = lake_with(fp_genero=[line("fp_genero", 2024, sigla_partido="Sol")])
    PL.load_gold(spark, silver_of(spark, lake), f"{lake}/gold")
    assert {r["sigla_partido"] for r in PL.gold_view(spark, f"{lake}/gold", "fefc_genero").collect()} == {"SOL"}
    lake = lake_with(fp_genero=[line("fp_genero", 2024), line("fp_genero", 2024, sigla_partido="Sol")])
    with pytest.raises(D.DimensionConflict):
        PL.load_gold(spark, silver_of(spark, lake), f"{lake}/gold")


def test_places_that_differ_in_which_part_is_null_have_their_own_ids(spark):
    key = ["y", "l", "uf", "ue", "c"]
    places = spark.createDataFrame([(2024, "M", None, "X", "C"), (2024, "M", "X", None, "C"), (2024, "M", None, None, None)],
                                   "y int, l string, uf string, ue string, c string")
    found = D.check_surrogate_keys(D.with_surrogate(places, "id", key), "id", key).first()
    assert (found["n_keys"], found["n_ids"], found["collision_free"]) == (3, 3, True)
    same = places.withColumn("id", F.lit(1))
    assert not D.check_surrogate_keys(same, "id", key).first()["collision_free"]


def test_an_upsert_keeps_ids_and_refuses_two_values(spark):
    old = spark.createDataFrame([(1, "a", 100), (2, "b", 200)], "k int, v string, id long")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c")], "k int, v string")
    got = {r["k"]: (r["v"], r["id"]) for r in D.upsert(old, new, ["k"], ["v"], id_col="id").collect()}
    assert got[1] == ("a", 100) and got[2] == ("B", 200) and got[3][0] == "c"
    with pytest.raises(D.DimensionConflict):
        D.upsert(old, new.unionByName(spark.createDataFrame([(3, "d")], "k int, v string")), ["k"], ["v"])


def test_a_key_with_a_third_of_the_rows_is_dealt_to_several_tasks(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS at", "id % 7 AS v")
    rows = rows.unionByName(rows.where("k = 0 AND at < 30")).repartition(3)
    plan = Q.duplicates_after_first(rows, ["k"], ["at"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    got = sorted(r["at"] for r in Q.duplicates_after_first(rows, ["k"], ["at"]).collect())
    assert got == sorted([i for i in range(3000) if i % 3 == 0 and i] + [i for i in range(0, 30, 3)])
