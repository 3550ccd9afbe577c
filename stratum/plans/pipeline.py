"""End-to-end run: bronze archives -> silver -> quality -> gate -> gold.

``run(spark, lake_root)`` is the whole daily job as one function.  Each step
is a Spark job over DataFrames; the driver only sees metadata (archive and
member lists, headers, per-artifact counts -- all bounded by the number of
files, never by rows).

Durability: parsed records are written once to the run folder (a durable cut
of lineage); every later step reads written tables.  The manifest's row counts
come from the parsed records, the quality step counts the silver tables, so the
two are taken independently.
Publishing: everything a run produces, facts included, goes to its own
``run=<id>/`` folder.  After all checks pass one version is appended to the log; it
names the run's dimensions and audit, and for every fact slice the run folder
that holds it.  A failing run publishes nothing.  Of two loads at once that share a
slice the later one is refused; else it builds its (small) dimensions again on what the first one
published, and both stay.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.contracts import (
    ELECTORAL_CONTRACTS,
    ELECTORAL_PAIRS,
    ELECTORAL_TREATMENTS,
    SOURCE_NAME,
    VALID_GENDERS,
    Contract,
    Treatment,
)
from stratum.functions import clean as C
from stratum.functions.keys import null_safe_condition
from stratum.operators import dims as D
from stratum.operators import facts as FA
from stratum.operators import partials as PA
from stratum.operators import publish as P
from stratum.operators import quality as Q
from stratum.operators import silver as S
from stratum.sources import archives as A
from stratum.sources import lake as L
from stratum.sources import member_files as MF
from stratum.session import maybe_broadcast

YEAR = "ano_eleicao"


class PipelineError(ValueError):
    """The input breaks the contract; the run publishes nothing."""


def _kind_map(treatments: Mapping[int, Treatment]) -> Column:
    return F.create_map(*[x for t in treatments.values() for x in (F.lit(t.year), F.lit(t.kind))])


# ----------------------------------------------------------------------- silver


@dataclass
class SilverRun:
    run_dir: str
    tables: dict[str, str]
    artifacts: DataFrame
    members: DataFrame | None = None
    schemas: dict = field(default_factory=dict)
    years: tuple[int, ...] | None = None

    def read(self, spark: SparkSession, dataset: str) -> DataFrame:
        df = spark.read.schema(self.schemas[dataset]).parquet(self.tables[dataset])
        if self.years is not None:  # a partition filter: only these year folders are listed/read
            df = df.where(F.col("_pyear").isin(*self.years))
        return df


def _refuse(found: DataFrame, says: str) -> None:
    """Refuse the input if a check found something; ``says`` is filled from the first row."""
    row = found.first()
    if row:
        raise PipelineError(says.format(**row.asDict()))


def _check_archives(archives: DataFrame, treatments: Mapping[int, Treatment]) -> None:
    _refuse(D.duplicate_keys(archives, ["year"]), "election year {year} comes in {n} archives")
    _refuse(archives.where(~F.col("year").isin(*treatments)), "election year {year} has no declared treatment")


def _check_members(members: DataFrame, archives: DataFrame, treatments: Mapping[int, Treatment]) -> None:
    _refuse(members.where("status <> 'ok'"), "{member} in the archive of {year}: {status}")
    years = [r["year"] for r in archives.select("year").collect()]  # one per archive
    due = {y: treatments[y].expected_datasets for y in years}
    _refuse(Q.completeness(members, due, "year").where("n_issues > 0 or extra <> ''"),
            "archive of {year}: missing datasets [{missing}], duplicated [{duplicated}], extra [{extra}]")


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_silver(
    spark: SparkSession,
    bronze_root: str,
    run_dir: str,
    *,
    years: Sequence[int] | None = None,
    contracts: Mapping[str, Contract] = ELECTORAL_CONTRACTS,
    treatments: Mapping[int, Treatment] = ELECTORAL_TREATMENTS,
    source_name: str = SOURCE_NAME,
) -> SilverRun:
    archives = A.scan_archives(spark, bronze_root)
    if years is not None:
        archives = archives.where(F.col("year").isin(*years))
    if archives.isEmpty():
        raise PipelineError(f"no archives below {bronze_root}")
    _check_archives(archives, treatments)
    paths = [r["archive"] for r in archives.select("archive").collect()]  # one per archive
    members = _stage(S.classify_members(A.list_members(spark, paths), "member", "year"), f"{run_dir}/_staging/members")
    _check_members(members, archives, treatments)

    widths = spark.createDataFrame([(n, list(c.source_columns)) for n, c in contracts.items()], "dataset string, expected array<string>")
    meta = members.join(maybe_broadcast(widths), "dataset").select(
        "archive", "member", "dataset", F.element_at(_kind_map(treatments), F.col("year")).alias("kind"), "expected")
    # decompress once, parse once, a folder for each dataset: every later step reads this durable table
    chunks = _stage(A.read_chunks(spark, paths), f"{run_dir}/_staging/chunks")
    staged_path = f"{run_dir}/_staging/records"
    A.read_records(chunks).join(maybe_broadcast(meta), ["archive", "member"]) \
        .write.mode("overwrite").partitionBy("dataset").parquet(staged_path)
    P.remove(spark, f"{run_dir}/_staging/chunks")
    records = spark.read.parquet(staged_path)
    first = records.where("record_no = 1 and fields <> expected").first()
    if first:
        S.check_header(list(first["fields"]), contracts[first["dataset"]], first["member"])
    _refuse(records.where(F.size("fields") != F.size("expected")).select(
        "member", "record_no", F.size("fields").alias("n"), F.size("expected").alias("width")),
        "record {record_no} of {member} has {n} fields; expected {width}")
    data = A.data_records(records)

    tables: dict[str, str] = {}
    schemas: dict = {}
    sources: list[DataFrame] = []
    for name, contract in contracts.items():
        part = data.where(F.col("dataset") == name)
        raw = part.select(
            F.col("archive").alias("_archive"), F.col("member").alias("_member"),
            F.col("record_no").alias("_record_no"), F.col("year").alias("_year"), F.col("kind").alias("_kind"),
            *[F.get("fields", i).alias(c) for i, c in enumerate(contract.source_columns)],
        )
        sources.append(raw.groupBy(F.col("_archive").alias("archive"), F.col("_member").alias("member")).agg(
            F.count(F.lit(1)).alias("source_row_count"),
            F.count_if(S.not_blank_record(contract)).alias("row_count")))
        silver = S.to_silver(raw, contract, source_name).withColumn("_pyear", F.col("_partition_year"))
        path = f"{run_dir}/silver/{name}"
        # the row count is observed during the write itself (no second pass)
        observed, obs = FA.observed_write(silver, f"silver_{name}")
        observed.write.mode("overwrite").partitionBy("_pyear", "source_member").parquet(path)
        if obs.get["rows"] == 0:
            raise PipelineError(f"dataset {name} has no records in any member")
        tables[name] = path
        schemas[name] = silver.schema
        # explicit schema: an all-blank dataset writes no files but still reads
        written = spark.read.schema(silver.schema).parquet(path)
        _refuse(S.year_mismatches(written, contract.year_column, "_pyear").select(
            "source_member", "source_row_number", F.col(contract.year_column).alias("found")),
            "record {source_row_number} of {source_member} has year {found}")

    counted = _artifacts(spark, records, _union(sources), members, tables, schemas, contracts, treatments)
    L.write_json(L.manifests(counted), f"{run_dir}/silver_manifest", partition_by=("year",))
    artifacts = manifest_artifacts(spark, run_dir)
    _refuse(artifacts.where("row_count = 0"), "{member} of {year} has no records")
    return SilverRun(run_dir, tables, artifacts, members, schemas)


def manifest_artifacts(spark: SparkSession, run_dir: str, years: Sequence[int] | None = None) -> DataFrame:
    """The artifacts a run's manifests declare, one row per member."""
    manifest = L.read_json(spark, f"{run_dir}/silver_manifest", L.MANIFEST_SCHEMA, years)
    return manifest.select("year", "kind", "archive", F.explode("artifacts").alias("a")).select(
        "year", "kind", "archive", "a.*")


def _artifacts(spark, records, src, members, tables, schemas, contracts, treatments) -> DataFrame:
    parts = []
    for name, path in tables.items():
        c = contracts[name]
        silver = spark.read.schema(schemas[name]).parquet(path)
        typed = [c.canonical(s) for s in c.source_columns if c.kind(c.canonical(s)) != "text"]
        counts = silver.groupBy("source_archive", "source_member").agg(
            *[F.count_if(S.invalid_flag(t)).alias(t) for t in typed],
        )
        entries = F.array(*[F.struct(F.lit(t).alias("k"), F.col(t).cast("long").alias("v")) for t in typed])
        parts.append(counts.select(
            F.col("source_archive").alias("archive"), F.col("source_member").alias("base"),
            F.map_from_entries(F.filter(entries, lambda e: e["v"] > 0)).alias("invalid_value_counts"),
            F.array(*[F.lit(x) for x in S.silver_columns(c)]).alias("columns"),
        ))
    silver_counts = parts[0]
    for p in parts[1:]:
        silver_counts = silver_counts.unionByName(p)
    meta = members.select(
        "archive", "member", "year", F.element_at(_kind_map(treatments), F.col("year")).alias("kind"), "dataset", "fund", "dimension",
        F.regexp_extract("member", r"([^/]+)$", 1).alias("base"))
    enc = A.headers(records).select("archive", "member", "encoding")
    out = (
        meta.join(enc, ["archive", "member"], "left")
        .join(src, ["archive", "member"], "left")
        .join(silver_counts, ["archive", "base"], "left")
    )
    return out.select(
        "year", "kind", "archive", "dataset", "fund", "dimension", F.col("base").alias("member"), "encoding",
        F.coalesce("source_row_count", F.lit(0)).cast("long").alias("source_row_count"),
        F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
        "invalid_value_counts", "columns",
    )


def export_silver(spark: SparkSession, silver: SilverRun, lake_root: str, source: str = SOURCE_NAME,
                  contracts: Mapping[str, Contract] = ELECTORAL_CONTRACTS) -> DataFrame:
    """A treated CSV file for each member, ``{stem}_tratado.csv`` below its year's prefix; the manifest's counts must hold."""
    done = []
    for name in silver.tables:
        df, columns = silver.read(spark, name), S.silver_columns(contracts[name])
        types = dict(df.dtypes)
        mine = silver.artifacts.where(F.col("dataset") == name)
        for year in sorted(r["year"] for r in mine.select("year").distinct().collect()):  # one per archive
            rows = df.where(F.col("_pyear") == year).select(
                F.col("source_member").alias("_member"), F.col("source_row_number").alias("_no"),
                *[C.as_text(c, types[c]).alias(c) for c in columns])
            declared = mine.where(F.col("year") == year).select("member", F.col("row_count").alias("rows"))
            folder = L.prefix(lake_root, "silver", source, {YEAR: year}, "tratado")
            done.append(MF.export_members(rows, folder, "_member", "_no", columns, declared))
    return _union(done)


# ---------------------------------------------------------------------- quality


@dataclass
class QualityRun:
    issues: DataFrame
    rollup: DataFrame
    samples: DataFrame
    profiles: DataFrame
    report: DataFrame
    overall: DataFrame


def run_quality(
    spark: SparkSession,
    silver: SilverRun,
    *,
    contracts: Mapping[str, Contract] = ELECTORAL_CONTRACTS,
    treatments: Mapping[int, Treatment] = ELECTORAL_TREATMENTS,
    source_name: str = SOURCE_NAME,
    write: bool = True,
) -> QualityRun:
    """All rules over the written silver tables.

    The issues are written once; rollup, samples, profiles and the reports by
    year and over all years read that table.
    """
    arts = silver.artifacts.select(
        F.col("member").alias("artifact"), "year", "dataset", F.col("row_count").alias("expected_rows"), "columns")
    found: list[DataFrame] = []
    observed: list[DataFrame] = []
    nulls: list[DataFrame] = []
    frames: dict[str, DataFrame] = {}
    for name in silver.tables:
        c = contracts[name]
        df = silver.read(spark, name)
        df = df.drop(*[x for x in df.columns if x.startswith("_invalid_")])
        frames[name] = df
        expected = {
            c.year_column: F.col("_pyear").cast("string"),
            "tipo_eleicao": F.element_at(_kind_map(treatments), F.col("_pyear")),
            "tipo_fundo": F.lit(c.fund),
            "dimensao_agregacao": F.lit(c.dimension),
            "silver_layer": F.lit("silver"),
            "source_name": F.lit(source_name),
        }
        rec = F.col("source_row_number")
        of_member = [
            Q.row_violations(df, Q.row_rules(df, c, expected=expected), F.col("source_member"), rec),
            Q.duplicate_issues(df, ["source_member", *c.grain], ["source_row_number"], F.col("source_member"), rec,
                               "duplicate_grain", None, "record duplicated in the analytical grain"),
            Q.duplicate_issues(df, ["source_member", "source_row_number"], ["source_row_number"],
                               F.col("source_member"), rec, "duplicate_source_row", "source_row_number",
                               "source row number repeated in the file"),
        ]
        # table rules: the manifest's header in its order, columns that are stored, columns that are required
        mine = arts.where(F.col("dataset") == name)
        of_member.append(Q.schema_issues(mine, S.silver_columns(c), [x for x in df.columns if not x.startswith("_")]))
        of_member.append(Q.missing_columns(df, c, mine.select("artifact")))
        by_year = mine.select("artifact", "year").distinct()
        found.append(_union(of_member).join(maybe_broadcast(by_year), "artifact"))
        key = [F.col("_pyear").cast("int").alias("year"), F.col("source_member").alias("artifact")]
        observed.append(df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")))
        nulls.append(Q.null_counts(df.select(*key, *S.silver_columns(c)).drop("source_member"),
                                   [x for x in S.silver_columns(c) if x != "source_member"], by=["year", "artifact"]))
    rows = _union(observed)
    counts = Q.row_count_issues(rows.select("artifact", "rows"), arts.select("artifact", "expected_rows"))
    found.append(counts.join(maybe_broadcast(arts.select("artifact", "year")), "artifact"))

    # rules between files: dataset completeness per year, parent/child coverage
    due = {y: t.expected_datasets for y, t in treatments.items()}
    here = [r["year"] for r in arts.select("year").distinct().collect()]  # one per archive
    comp = Q.completeness(arts, {y: due[y] for y in here if y in due}, "year").where(F.col("n_issues") > 0)
    message = F.format_string("missing datasets=[%s]; duplicated=[%s]", "missing", "duplicated")
    found.append(comp.select(*Q.table_issue(F.lit("_year_partition"), "artifact_integrity", message, F.col("n_issues")), "year"))
    for fund, parent, child in ELECTORAL_PAIRS:
        if parent not in frames or child not in frames:
            continue
        key = [k for k in contracts[parent].parent_key if k != contracts[parent].year_column]
        p, ch = (frames[n].withColumn("year", F.col("_pyear").cast("int")) for n in (parent, child))
        pair_issues, parents = Q.coverage_issues(p, ch, key, fund, "year")
        found.append(pair_issues)
        rows = rows.unionByName(parents)
    base = f"{silver.run_dir}/quality" if write else f"{silver.run_dir}/quality-trial-{uuid.uuid4().hex}"
    issue_schema = Q.ISSUE_SCHEMA + ", year int"
    _union([f.select(*Q.ISSUE_COLUMNS, F.col("year").cast("int").alias("year")) for f in found]) \
        .write.parquet(f"{base}/issues")
    issues = spark.read.schema(issue_schema).parquet(f"{base}/issues")

    counted = arts.drop("columns").join(_union(observed), ["year", "artifact"], "left").fillna(0, ["rows"])
    rollup = Q.rollup(issues, rows, by=["year"])
    samples = Q.samples(issues, by=["year"])
    profiles = Q.profiles(issues, counted, by=["year"], nulls=_union(nulls))
    report = Q.report(issues, counted, ["year"])
    overall = Q.report(issues.withColumn("_all", F.lit(1)), counted.withColumn("_all", F.lit(1)), ["_all"]).drop("_all")
    out = QualityRun(issues, rollup, samples, profiles, report, overall)
    if write:
        # what reports over any years merge from; a year loaded again has its own anew, others stay as they are
        PA.store(PA.findings(issues, "year"), f"{base}/{FINDINGS}", "year")
        PA.store(counted.select("artifact", "rows", "expected_rows", "year"), f"{base}/{ARTIFACTS}", "year")
        L.write_json(nested_report(out), f"{base}/report", partition_by=("year",))
        L.write_json(overall.withColumn("generated_at", F.current_timestamp()), f"{base}/report_overall", partition_by=())
    return out


FINDINGS, ARTIFACTS = "findings", "artifacts"


def published_quality(spark: SparkSession, lake_root: str, source: str = SOURCE_NAME) -> tuple[DataFrame, DataFrame]:
    """Stored partials (findings, artifacts) of every published year, each from the run that loaded it last."""
    state = P.pointer(spark, L.prefix(lake_root, "silver", source)) or {"partials": {}}
    parts: dict[str, list[DataFrame]] = {FINDINGS: [], ARTIFACTS: []}
    for folder in sorted(set(state["partials"].values())):
        years = [int(y) for y, f in state["partials"].items() if f == folder]
        for name, schema in ((FINDINGS, PA.FINDINGS_SCHEMA), (ARTIFACTS, PA.ARTIFACTS_SCHEMA)):
            parts[name].append(PA.stored(spark, f"{folder}/{name}", schema, "year", years))
    if not parts[FINDINGS]:
        raise PipelineError("no published silver run")
    return _union(parts[FINDINGS]), _union(parts[ARTIFACTS])


def published_report(spark: SparkSession, lake_root: str, by: Sequence[str] = (), source: str = SOURCE_NAME) -> DataFrame:
    """The quality report over all published years, or for each value of ``by``; no record is read for it."""
    return PA.report(*published_quality(spark, lake_root, source), by)


def nested_report(quality: QualityRun) -> DataFrame:
    """One document per year: totals, the artifacts' profiles, and the issues with their first records."""
    key = ["year", "artifact", "rule"]
    records = quality.samples.groupBy(*key, "column").agg(
        F.sort_array(F.collect_list("record_no")).alias("sample_rows")).alias("s")
    issues = quality.rollup.alias("i").join(records, null_safe_condition("i", "s", (*key, "column")), "left")
    entry = F.struct(*[F.col(f"i.{c}") for c in ("artifact", "rule", "severity", "column", "n", "rate", "message")],
                     F.col("s.sample_rows"))
    listed = issues.groupBy(F.col("i.year").alias("year")).agg(F.sort_array(F.collect_list(entry)).alias("issues"))
    profile = F.struct("artifact", "dataset", "expected_rows", "rows", "duplicates", "errors", "warnings",
                       F.to_json("null_counts").alias("null_counts"))
    profiles = quality.profiles.groupBy("year").agg(F.sort_array(F.collect_list(profile)).alias("artifact_profiles"))
    return (quality.report.join(listed, "year", "left").join(profiles, "year", "left")
            .withColumn("generated_at", F.current_timestamp()))


# ------------------------------------------------------------------------- gold

MONEY, PERCENT = "decimal(20,2)", "decimal(12,6)"
SEED_RACES = ("NEGRA", "NÃO NEGRA")


def _gold_types(contract: Contract) -> dict[str, str]:
    out = {YEAR: "smallint", "numero_partido": "int", "quantidade_candidatos": "int",
           "status_renuncia": "smallint", "source_row_number": "int"}
    for c in contract.decimal_columns:
        out[c] = PERCENT if c.startswith("percentual_") else MONEY
    return out


LOCATION = (YEAR, "esfera_partidaria", "sigla_uf", "sigla_ue", "municipio")


@dataclass
class GoldRun:
    results: DataFrame
    audit: DataFrame


#: CHECK constraints of the model, by table; fixed values.
PARTY_CHECKS = {"ck_dim_partido_numero": "numero_partido > 0"}
LOCATION_CHECKS = {
    "ck_dim_localidade_esfera": "esfera_partidaria IN ('NACIONAL', 'ESTADUAL', 'MUNICIPAL')",
    "ck_dim_localidade_geografia":
        "(esfera_partidaria = 'NACIONAL' AND sigla_uf IS NULL AND sigla_ue IS NULL AND municipio IS NULL) OR "
        "(esfera_partidaria = 'ESTADUAL' AND sigla_uf IS NOT NULL AND sigla_ue IS NULL AND municipio IS NULL) OR "
        "(esfera_partidaria = 'MUNICIPAL' AND sigla_uf IS NOT NULL AND sigla_ue IS NOT NULL AND municipio IS NOT NULL)",
}
FACT_CHECKS = {"ck_quantidade": "quantidade_candidatos >= 0"}
STATUS_CHECKS = {"ck_status": "status_renuncia IN (0, 1)"}
AUDIT_CHECKS = {"ck_carga_arquivo_linhas": "source_rows > 0 AND deleted_rows >= 0 AND inserted_rows > 0"}

SLICE = [YEAR, "source_member"]


def _hold(table: str, df: DataFrame, checks: Mapping[str, str], unique: Sequence[Sequence[str]]) -> None:
    """Refuse a written table that breaks a CHECK or repeats a unique key (nulls equal)."""
    if checks:
        broken = FA.check_violations(df, {n: F.expr(e) for n, e in checks.items()}, list(unique[0])).first()
        if broken:
            raise FA.LoadError(f"{table} breaks a constraint: {broken.asDict()}")
    for key in unique:
        twice = D.duplicate_keys(df, key).first()
        if twice:
            raise FA.LoadError(f"{table} repeats a key: {twice.asDict()}")


def _parties(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One name per year and party: two names in one artifact are a conflict, a later artifact's replaces
    an earlier one's."""
    named = _union([st.select(F.lit(n).alias("dataset"), "source_member", YEAR, "numero_partido", "sigla_partido")
                    for n, st in stages.items()]).distinct()
    twice = D.duplicate_keys(named, ["dataset", "source_member", YEAR, "numero_partido"]).first()
    if twice:
        raise D.DimensionConflict(f"a party has {twice['n']} names in one artifact: {twice.asDict()}")
    order = named.withColumn("_order", F.struct("dataset", "source_member"))
    return D.resolve_last_writer(order, [YEAR, "numero_partido"], "sigla_partido", "_order")


def _previous(spark: SparkSession, run: str | None, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{run}/{name}") if run else spark.createDataFrame([], schema)


def _keep(spark: SparkSession, folder: str, name: str, df: DataFrame, checks: Mapping[str, str], *unique: Sequence[str]) -> DataFrame:
    """Write a table of a run and hold it to its constraints."""
    df.write.parquet(f"{folder}/{name}")
    written = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    _hold(name, written, checks, unique)
    return written


def _dimensions(spark: SparkSession, stages: Mapping[str, DataFrame], run: str | None, folder: str) -> dict[str, DataFrame]:
    """The dimensions of a published ``run`` with what the stages add, written to ``folder``.

    Ids derive from natural keys, so building them on another run's dimensions gives the same ids.
    """
    dims: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, checks: Mapping[str, str], *unique: Sequence[str]) -> None:
        dims[name] = _keep(spark, folder, name, df, checks, *unique)

    def previous(name: str, schema: str) -> DataFrame:
        return _previous(spark, run, name, schema)

    year_t = f"{YEAR} smallint"
    years = [(t.year, t.kind) for t in ELECTORAL_TREATMENTS.values()]
    keep("dim_eleicao", spark.createDataFrame(years, f"{YEAR} int, tipo_eleicao string").withColumn(
        YEAR, F.col(YEAR).cast("smallint")), {}, [YEAR])
    keep("dim_partido", D.upsert(
        previous("dim_partido", f"{year_t}, numero_partido int, sigla_partido string, partido_id bigint"),
        _parties(stages), [YEAR, "numero_partido"], ["sigla_partido"], id_col="partido_id", fail_on_conflict=False),
        PARTY_CHECKS, [YEAR, "numero_partido"], ["partido_id"])
    for name, column, id_col, seeds in (("dim_genero", "genero", "genero_id", VALID_GENDERS),
                                        ("dim_cor_raca", "cor_raca", "cor_raca_id", SEED_RACES)):
        seed = spark.createDataFrame([(x,) for x in seeds], f"{column} string")
        old = previous(name, f"{column} string, {id_col} bigint").select(column).unionByName(seed).distinct()
        new = _union([s.select(column) for s in stages.values() if column in s.columns])
        keep(name, D.with_surrogate(D.insert_absent(old, new, [column]), id_col, [column]), {}, [column], [id_col])
    old = previous("dim_localidade", f"{year_t}, esfera_partidaria string, sigla_uf string, sigla_ue string, "
                                     "municipio string, localidade_id bigint").select(*LOCATION)
    places = _union([s.select(*LOCATION) for s in stages.values() if "municipio" in s.columns])
    keep("dim_localidade", D.with_surrogate(D.insert_absent(old, places, list(LOCATION)), "localidade_id", list(LOCATION)),
         LOCATION_CHECKS, LOCATION, ["localidade_id"])
    return dims


def load_gold(spark: SparkSession, silver: SilverRun, gold_root: str, *,
              contracts: Mapping[str, Contract] = ELECTORAL_CONTRACTS) -> GoldRun:
    """Dimension upserts, fact slices, constraints, reconciliation and audit, published in one step."""
    version, published = P.head(spark, gold_root)
    published = published or {"run": None, "facts": {}}
    for name in silver.tables:
        header = F.array(*[F.lit(x) for x in S.silver_columns(contracts[name])])
        other = silver.artifacts.where((F.col("dataset") == name) & (F.col("columns") != header)).first()
        if other:
            raise FA.LoadError(f"the manifest's header of {other['member']} isn't the contract's: {other['columns']}")
    stages = {n: silver.read(spark, n).withColumn(YEAR, F.col("_pyear").cast("smallint")) for n in silver.tables}

    run_dir = P.new_run(gold_root)
    dims = _dimensions(spark, stages, published["run"], run_dir)

    results = []
    for name, st in stages.items():
        c = contracts[name]
        lookups = [FA.Lookup(dims["dim_partido"], (YEAR, "numero_partido"), "partido_id"),
                   FA.Lookup(dims["dim_genero"], ("genero",), "genero_id")]
        if "cor_raca" in st.columns:
            lookups.append(FA.Lookup(dims["dim_cor_raca"], ("cor_raca",), "cor_raca_id"))
        if "municipio" in st.columns:
            lookups.append(FA.Lookup(dims["dim_localidade"], LOCATION, "localidade_id", null_safe=True))
        staged, staged_rows = FA.observed_write(st, f"staged_{name}")
        resolved = FA.resolve(staged, lookups)
        cols = [YEAR, *[lk.id_col for lk in lookups],
                *[x for x in c.data_columns if x not in ("sigla_partido", "numero_partido", "genero", "cor_raca",
                                                         "esfera_partidaria", "sigla_uf", "sigla_ue", "municipio",
                                                         "data_geracao", "hora_geracao")],
                "data_hora_geracao", "source_archive", "source_member", "source_row_number"]
        fact, loaded_rows = FA.observed_write(FA.typed_projection(resolved.select(*cols), _gold_types(c)), f"loaded_{name}")
        path = f"{run_dir}/facts/{name}"
        P.write_partitioned(fact, path, SLICE)
        # equal counts and no repeated source row: nothing was lost or fanned out
        if staged_rows.get["rows"] != loaded_rows.get["rows"]:
            raise FA.LoadError(f"incomplete load of {name}: {staged_rows.get['rows']} staged, {loaded_rows.get['rows']} loaded")
        written = spark.read.schema(fact.schema).parquet(path)
        checks = FACT_CHECKS | (STATUS_CHECKS if "status_renuncia" in written.columns else {})
        _hold(name, written, checks, [[YEAR, "source_member", "source_row_number"]])
        missing = FA.orphans(written, dims["dim_eleicao"], [YEAR]).first()
        if missing:
            raise FA.LoadError(f"{name} has a year without an election: {missing[YEAR]}")
        live = read_facts(spark, published["facts"].get(name, {}), fact.schema)
        deleted = live.groupBy(*SLICE).agg(F.count(F.lit(1)).alias("deleted"))
        new = written.groupBy(*SLICE).agg(F.count(F.lit(1)).alias("inserted"))
        results.append(new.join(deleted, SLICE, "left").select(
            F.col(YEAR).alias("yr"), F.lit(name).alias("dataset"), "source_member",
            F.concat_ws("/", F.lit(path), F.concat(F.lit(f"{YEAR}="), F.col(YEAR).cast("string")),
                        F.concat(F.lit("source_member="), F.col("source_member"))).alias("output_key"),
            F.col("inserted").alias("staged"), F.coalesce("deleted", F.lit(0)).alias("deleted"), "inserted"))
    # one row per artifact: counted now, while the run they replace is the published one
    loaded = _union(results)
    results_df = spark.createDataFrame(loaded.collect(), loaded.schema)
    declared = silver.artifacts.select("dataset", F.col("member").alias("source_member"), F.col("row_count").alias("expected"))
    differs = results_df.join(declared, ["dataset", "source_member"], "full_outer").where(
        ~F.col("staged").eqNullSafe(F.col("expected"))).first()
    if differs:
        raise FA.LoadError(f"count differs from the manifest: {differs.asDict()}")
    audit_schema = ("yr smallint, dataset string, source_member string, output_key string, source_rows bigint, "
                    "deleted_rows bigint, inserted_rows bigint, loaded_at timestamp")
    stamped = results_df.withColumn("loaded_at", F.current_timestamp())
    loaded_now = spark.createDataFrame(stamped.collect(), stamped.schema)
    mine = {n: {f"{r['yr']}/{r['source_member']}": f"{run_dir}/facts/{n}" for r in results_df.collect() if r["dataset"] == n}
            for n in stages}
    audits: list[DataFrame] = []

    def state(current: dict | None) -> dict:
        current = current or {"run": None, "facts": {}}
        folder = run_dir
        if audits or current["run"] != published["run"]:  # someone else was first: on top of theirs
            folder = f"{run_dir}/on-{uuid.uuid4().hex}"
            _dimensions(spark, stages, current["run"], folder)
        audit = FA.audit_upsert(_previous(spark, current["run"], "carga_arquivo", audit_schema), FA.audit_rows(loaded_now))
        audits.append(_keep(spark, folder, "carga_arquivo", audit, AUDIT_CHECKS, ["yr", "dataset"]))
        facts = {n: current["facts"].get(n, {}) | mine.get(n, {}) for n in {*current["facts"], *mine}}
        return {"run": folder, "facts": facts}

    P.commit(spark, gold_root, state, start=version, touched=mine)
    return GoldRun(results_df, audits[-1])


def read_facts(spark: SparkSession, slices: Mapping[str, str], schema=None) -> DataFrame:
    """A fact table from its slices, each in the run folder that the pointer names."""
    if not slices:
        return spark.createDataFrame([], schema)
    parts = []
    for folder in sorted(set(slices.values())):
        found = spark.read.schema(schema).parquet(folder) if schema is not None else spark.read.parquet(folder)
        named = [s.split("/", 1) for s, f in slices.items() if f == folder]
        wanted = F.struct(F.col(YEAR).cast("int"), F.col("source_member")).isin(
            *[F.struct(F.lit(int(y)), F.lit(m)) for y, m in named])
        parts.append(found.where(F.col(YEAR).isin(*sorted({int(y) for y, _ in named})) & wanted))
    return _union(parts)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def gold_view(spark: SparkSession, gold_root: str, dataset: str) -> DataFrame:
    """The denormalised view of one fact: ids resolved to names."""
    published = P.pointer(spark, gold_root)
    run_dir, fact = published["run"], read_facts(spark, published["facts"][dataset])
    party = spark.read.parquet(f"{run_dir}/dim_partido")
    gender = spark.read.parquet(f"{run_dir}/dim_genero")
    election = spark.read.parquet(f"{run_dir}/dim_eleicao")
    view = fact.withColumn(YEAR, F.col(YEAR).cast("smallint")).join(maybe_broadcast(election), YEAR) \
        .join(party, ["partido_id", YEAR]).join(maybe_broadcast(gender), "genero_id")
    if "cor_raca_id" in fact.columns:
        view = view.join(maybe_broadcast(spark.read.parquet(f"{run_dir}/dim_cor_raca")), "cor_raca_id")
    if "localidade_id" in fact.columns:
        view = view.join(spark.read.parquet(f"{run_dir}/dim_localidade"), ["localidade_id", YEAR])
    return view.drop("partido_id", "genero_id", "cor_raca_id", "localidade_id")


# -------------------------------------------------------------------------- run


def run(spark: SparkSession, lake_root: str, years: Sequence[int] | None = None,
        source: str = SOURCE_NAME) -> dict:
    """The daily job.  Raises (publishing nothing) on contract or gate failure."""
    bronze, base, gold_root = (L.prefix(lake_root, layer, source).rstrip("/") for layer in ("bronze", "silver", "gold"))
    run_dir = P.new_run(base)
    silver = build_silver(spark, bronze, run_dir, years=years)
    quality = run_quality(spark, silver)
    Q.gate(quality.report, ["year"])
    gold = load_gold(spark, silver, gold_root)
    loaded = {str(r["year"]): f"{run_dir}/quality" for r in quality.report.select("year").collect()}  # one per archive
    P.commit(spark, base, lambda now: {"run": run_dir, "partials": {**((now or {}).get("partials", {})), **loaded}})
    return {"silver_run": run_dir, "report": quality.report, "load": gold.results, "audit": gold.audit}


def backfill(spark: SparkSession, lake_root: str, years: Sequence[int] | None = None, source: str = SOURCE_NAME,
             contracts: Mapping[str, Contract] = ELECTORAL_CONTRACTS) -> GoldRun:
    """Manual load of the published silver run for ``years``, by default all it has.

    Per year the quality report must exist and be valid (otherwise nothing is
    loaded); the artifacts come from the silver manifests; only the silver
    partitions of those years are read (partition pruning on the year).
    """
    run_dir = P.current_run(spark, f"{lake_root}/silver/{source}")
    if run_dir is None:
        raise PipelineError("no published silver run")
    if years is None:
        years = sorted(r["year"] for r in manifest_artifacts(spark, run_dir).select("year").distinct().collect())
    years = tuple(int(y) for y in years)
    report = L.read_json(spark, f"{run_dir}/quality/report", "year int, valid boolean", years)
    status = {r["year"]: r["valid"] for r in report.collect()}  # one row per requested year
    missing = sorted(set(years) - set(status))
    invalid = sorted(y for y, ok in status.items() if not ok)
    if missing or invalid:
        raise Q.GateClosed(f"quality report missing for {missing} or invalid for {invalid}")
    tables = {n: f"{run_dir}/silver/{n}" for n in contracts}
    schemas = {n: spark.read.parquet(p).schema for n, p in tables.items()}
    silver = SilverRun(run_dir, tables, manifest_artifacts(spark, run_dir, years), None, schemas, years)
    return load_gold(spark, silver, f"{lake_root}/gold/{source}", contracts=contracts)
