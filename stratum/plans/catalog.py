"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the test tables whole (through :mod:`stratum.plans.tables`)
and runs the library operators on them.  Names of computed columns equal the
aliases of the matching SQL in :mod:`stratum.plans.oracle`.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import written_once

from stratum.functions.keys import surrogate_key
from stratum.operators import marts as M
from stratum.plans import gold_fixture as GF
from stratum.plans import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --------------------------------------------------------------- batch 1: marts


@query
def total_by_year_party_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: total amount by year, party name and segment over the star.

    The detail rows are read once and added up to the grain of the fact's
    keys; fact and dimensions come from that reduced stage, and the result is
    re-aggregated on the attributes.
    """
    stage = written_once(GF.party_segment_totals(spark, sf_dir), "flagship-stage")
    party = GF.dim_party(stage)
    gender = GF.dim_value(stage, "seg", "gender_id")
    election = GF.dim_election(stage)
    fact = stage.select(
        "yr",
        surrogate_key("yr", "party_no").alias("party_id"),
        surrogate_key("seg").alias("gender_id"),
        "amount",
    )
    out = M.aggregate_through_star(
        fact,
        fact_keys=["yr", "party_id", "gender_id"],
        measures={"amount": F.sum("amount")},
        dims=[
            M.DimJoin(election.select("yr"), ("yr",), small=True),
            M.DimJoin(party.select("party_id", "yr", "party_name"), ("party_id", "yr")),
            M.DimJoin(gender, ("gender_id",)),
        ],
        group_by=["yr", "party_name", "seg"],
        final={"total_amount": F.sum("amount").cast("decimal(38,2)")},
    )
    return out.orderBy("yr", "party_name", "seg")


@query
def total_one_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = T.v_parent(spark, sf_dir, years=[1998])
    return M.total_by(parent.where(F.col("yr") == 1998), ["yr"], "amount", "total")


@query
def rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rows_per_partition(T.v_parent(spark, sf_dir), "yr")


def _view(spark: SparkSession, sf_dir: str, child: bool, location: bool) -> DataFrame:
    fact, joins, cols = GF.star(spark, sf_dir, child=child, location=location)
    return M.star_view(fact, joins, cols)


@query
def view_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, child=False, location=False)


@query
def view_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, child=True, location=False)


@query
def view_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, child=False, location=True)


@query
def view_location_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, child=True, location=True)


@query
def parameterised_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named parameters bound by Spark, never spliced into the text."""
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders} "
        "WHERE year(o_orderdate) = :year AND o_orderstatus = :status",
        args={"year": 1998, "status": "F"},
        orders=T.table(spark, sf_dir, "orders"),
    )


# ------------------------------------------------------------ batch 2: cleaning

from stratum.functions import clean as C  # noqa: E402
from stratum.operators import silver as S  # noqa: E402

RAW_TEXT = ("YR", "INT_TXT", "MONEY_TXT", "DATE_TXT", "TIME_TXT", "STATUS_TXT")
SOURCE = "fixture"


@query
def clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned value, its upper-case category and null flag of every raw text cell (long form)."""
    raw = T.v_raw(spark, sf_dir)
    long = raw.unpivot(["k"], list(RAW_TEXT), "column", "raw")
    cleaned = C.clean_text("raw")
    return long.select("k", "column", cleaned.alias("cleaned"), C.clean_category("raw").alias("category"),
                       cleaned.isNull().alias("is_null"))


@query
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents cleaned: length of the cleaned text and null flag."""
    docs = T.table(spark, sf_dir, "documents")
    cleaned = C.clean_text("text")
    return docs.select(
        "doc_id",
        F.length(cleaned).cast("bigint").alias("clean_len"),
        cleaned.isNull().alias("is_null"),
    )


def _parsed(spark: SparkSession, sf_dir: str, column: str, parser) -> DataFrame:
    raw = T.v_raw(spark, sf_dir)
    value, invalid = parser(column)
    return raw.select("k", value.alias("value"), invalid.alias("invalid"))


@query
def parse_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "INT_TXT", C.parse_integer)


@query
def parse_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "MONEY_TXT", C.parse_decimal)


@query
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "DATE_TXT", C.parse_date)


@query
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "TIME_TXT", C.parse_time)


@query
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.v_raw(spark, sf_dir)
    d, _ = C.parse_date("DATE_TXT")
    t, _ = C.parse_time("TIME_TXT")
    return raw.select("k", d.alias("date_val"), t.alias("time_val"),
                      C.combine_datetime(d, t).alias("ts_val"))


@query
def normalize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy source names (accents, spaces, symbols, a duplicate) normalised."""
    part = T.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Código Peça"),
        F.col("p_name").alias("Nome Completo"),
        F.col("p_brand").alias(" Marca "),
        F.col("p_type").alias("Tipo-Produto"),
        F.col("p_size").alias("Tamanho (cm)"),
        F.col("p_retailprice").alias("Preço Varejo"),
        F.lit("-").alias("Campo vazio"),
        F.upper("p_type").alias("TIPO produto"),
    )
    return S.normalize_table(part)


@query
def blank_record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record numbers kept after dropping records whose every cell is blank."""
    raw = T.raw_orders(spark, sf_dir, blanks=True)
    return raw.where(S.not_blank_record(T.RAW_CONTRACT)).select(F.col("_record_no").alias("k"))


@query
def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full silver output of the raw records: lineage, typed, ordered."""
    silver = S.to_silver(T.raw_orders(spark, sf_dir), T.RAW_CONTRACT, SOURCE, keep_invalid=False)
    return silver.select(*S.silver_columns(T.RAW_CONTRACT))


@query
def invalid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = S.to_silver(T.raw_orders(spark, sf_dir), T.RAW_CONTRACT, SOURCE)
    return S.invalid_counts(silver, T.RAW_CONTRACT)


@query
def silver_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.raw_orders(spark, sf_dir, blanks=True)
    silver = S.to_silver(raw, T.RAW_CONTRACT, SOURCE)
    return S.totals(raw, silver)


@query
def partition_year_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose parsed date's year differs from the partition year."""
    silver = S.to_silver(T.raw_orders(spark, sf_dir), T.RAW_CONTRACT, SOURCE)
    with_year = silver.withColumn("date_year", F.year("date_val"))
    return S.year_mismatches(with_year, "date_year").select(
        F.col("source_row_number").alias("k"), F.col("_partition_year").alias("part_yr"), "date_val"
    )


@query
def member_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = T.v_member(spark, sf_dir)
    return S.classify_members(members, "name", "part_yr").select(
        "k", "name", "dataset", "fund", "dimension", "member_year", "status"
    )


# ----------------------------------------------------------- batch 3: row rules

from stratum.operators import partials as PA  # noqa: E402
from stratum.operators import quality as Q  # noqa: E402
from stratum.operators import skew as SK  # noqa: E402
from stratum.operators import validate as V  # noqa: E402
from stratum.plans import quality_fixture as QF  # noqa: E402


def _row_rule_query(spark: SparkSession, sf_dir: str, rules: set[str]) -> DataFrame:
    issues = QF.row_issues(QF.q_raw(spark, sf_dir), rules)
    return issues.select("artifact", "record_no", "rule", "severity", "column")


@query
def quality_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_rule_query(spark, sf_dir, {"required_not_null", "source_numeric_null"})


@query
def quality_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_rule_query(spark, sf_dir, {"accepted_values", "metadata_integrity"})


@query
def quality_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_rule_query(spark, sf_dir, {"negative_value", "percentage_outlier", "negative_financial_value"})


@query
def quality_numeric_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_rule_query(spark, sf_dir, {"invalid_integer", "invalid_decimal"})


@query
def quality_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_rule_query(spark, sf_dir, {"datetime_integrity"})


@query
def quality_conditional_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = T.v_geo_bad(spark, sf_dir)
    rules = Q.conditional_rules(geo, T.GEO_RULES)
    issues = Q.row_violations(geo, rules, F.col("yr").cast("string"), F.col("l_orderkey"))
    return issues.select(F.col("record_no").alias("l_orderkey"), "column", "message")


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = T.v_geo_bad(spark, sf_dir)
    return Q.null_counts(geo, ["lvl", "uf", "ue", "city"], by=["yr"])


@query
def positive_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = T.table(spark, sf_dir, "customer")
    return V.positive_field_violations(customer, ["c_acctbal"], ["c_custkey"])


# ----------------------------------------------------------- batch 4: set rules


@query
def duplicate_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows repeating (l_orderkey, l_linenumber), after the first in
    a total order over all columns."""
    li = T.table(spark, sf_dir, "lineitem")
    return Q.duplicates_after_first(li, ["l_orderkey", "l_linenumber"], li.columns)


@query
def duplicate_source_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen again on the same day (day = artifact, user = record number)."""
    ev = T.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    dups = Q.duplicates_after_first(ev, ["day", "user_id"], ["ts", "event_id"])
    return dups.select("event_id", "day", "user_id")


@query
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole event rows repeating (user, type, day), after the first by event id."""
    ev = T.table(spark, sf_dir, "events")
    return V.find_duplicate_rows(ev.withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"],
                                 ["event_id"]).drop("day")


@query
def duplicate_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows after the first of an order and line, where the order column ties on all of them: whole rows decide."""
    li = T.table(spark, sf_dir, "lineitem")
    return Q.duplicates_after_first(li, ["l_orderkey", "l_linenumber"], ["l_linenumber"])


@query
def frequent_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with a fiftieth of the detail rows or more, named by a sketch and counted exactly."""
    return SK.frequent_keys(T.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], share=0.02)


@query
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = T.v_parent(spark, sf_dir)
    child = T.v_child_bad(spark, sf_dir)
    return Q.coverage(parent, child, ["party_no", "party_name", "seg"], group=["yr"])


@query
def dataset_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = T.v_artifact(spark, sf_dir)
    return Q.completeness(arts, ("child", "parent"))


@query
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns absent from the child file, one issue per artifact year."""
    child = T.v_child(spark, sf_dir)
    contract = T.CHILD_CONTRACT
    arts = child.select(F.concat(F.lit("child_"), F.col("yr").cast("string")).alias("artifact"))
    return Q.missing_columns(child, contract, arts).select("artifact", "rule", "column")


@query
def schema_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files whose declared columns aren't the contract's: reversed in some years, one short or none declared in others."""
    columns = S.silver_columns(T.RAW_CONTRACT)
    due, year = F.array(*map(F.lit, columns)), F.col("yr")
    files = T.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    declared = (F.when(year % 4 == 0, F.reverse(due)).when(year % 4 == 1, F.slice(due, 1, len(columns) - 1))
                .when(year % 4 == 2, due))
    files = files.select(F.format_string("orders_%d.csv", "yr").alias("artifact"), declared.alias("columns"))
    return Q.schema_issues(files, columns, columns).select("artifact", "rule", "severity", "message", "n")


@query
def scope_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate"))
    return V.out_of_scope(orders, "yr", T.SCOPE_YEARS)


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.operators import dims as D

    li = T.table(spark, sf_dir, "lineitem")
    return D.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


@query
def validate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = T.table(spark, sf_dir, "lineitem")
    return V.validate_records(li, required=["l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"],
                              unique=["l_orderkey", "l_linenumber"], order=li.columns)


# ------------------------------------------------------------- batch 5: rollups


@query
def issue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues, arts = QF.all_issues(spark, sf_dir)
    return Q.rollup(issues, arts.select("artifact", "rows"))


@query
def issue_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues, _ = QF.all_issues(spark, sf_dir)
    return Q.samples(issues)


@query
def artifact_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues, arts = QF.all_issues(spark, sf_dir)
    return Q.profiles(issues, arts)


@query
def quality_report_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues, arts = QF.all_issues(spark, sf_dir)
    year = F.regexp_extract("artifact", r"_([0-9]{4})\.csv$", 1).cast("int")
    return Q.report(issues.withColumn("yr", year), arts, ["yr"])


@query
def issue_rollup_multi_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of several years that share an artifact's name: coverage of parent
    and child files and counts that differ from the manifest, each year's apart."""
    parent, child = family = T.parent_and_child(spark, sf_dir)
    bad_child = T.with_holes(child)
    issues, rows = Q.coverage_issues(parent, bad_child, ["party_no", "party_name", "seg"], "files", "yr")
    arts = T.v_artifact(spark, sf_dir, family).distinct()
    message = F.format_string("observed count %d differs from manifest %d", "observed", "expected")
    counts = arts.where("observed <> expected").select(
        *Q.table_issue(F.col("dataset"), "row_count_integrity", message, F.lit(1)), "yr")
    rows = rows.unionByName(arts.select("yr", F.col("dataset").alias("artifact"), F.col("observed").alias("rows")))
    return Q.rollup(issues.unionByName(counts), rows, by=["yr"])


def _partials_by_year(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Stored partials of the fixture's years, of which one year was then loaded anew (with its declared row count put right)."""
    issues, arts = QF.all_issues(spark, sf_dir)
    year = F.regexp_extract("artifact", r"_([0-9]{4})\.csv$", 1).cast("int")
    issues = issues.withColumn("yr", year)
    base = _lake_path(spark, "quality", "orders")
    paths = f"{base}findings", f"{base}artifacts"
    for name, frame in zip(paths, (PA.findings(issues, "yr"), arts)):
        PA.store(frame, name, "yr")
    reloaded = issues.where((F.col("yr") == 1997) & (F.col("rule") != "row_count_integrity"))
    PA.store(PA.findings(reloaded, "yr"), paths[0], "yr")
    PA.store(arts.where("yr = 1997").withColumn("expected_rows", F.col("rows")), paths[1], "yr")
    return paths


@query
def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, artifacts, rows, errors and warnings over all years, merged from stored partials after one year's reload."""
    found, arts = _partials_by_year(spark, sf_dir)
    return PA.report(PA.stored(spark, found, PA.FINDINGS_SCHEMA, "yr"), PA.stored(spark, arts, PA.ARTIFACTS_SCHEMA, "yr"), ["yr"])


@query
def incremental_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with rate, first message and first records, merged from stored partials after one year's reload."""
    found, arts = _partials_by_year(spark, sf_dir)
    out = PA.rollup(PA.stored(spark, found, PA.FINDINGS_SCHEMA, "yr"), PA.stored(spark, arts, PA.ARTIFACTS_SCHEMA, "yr"), ["yr"])
    return out.withColumn("records", F.array_join("records", ","))


# ---------------------------------------------------------------- batch 6: gold

from stratum.functions.keys import natural_key  # noqa: E402
from stratum.operators import dims as D  # noqa: E402
from stratum.operators import facts as FA  # noqa: E402

PLACE = ["yr", "lvl", "uf", "ue", "city"]


@query
def dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.distinct_keys(T.v_line(spark, sf_dir), ["yr", "party_no", "party_name"])


@query
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party names of years up to 1998 as the dimension; later years rename
    (lower-case) and add parties; type-1 upsert keyed by party number."""
    line = T.v_line(spark, sf_dir)
    parties = written_once(line.groupBy("yr", "party_no", "party_name").agg(F.count(F.lit(1)).alias("n")), "parties")
    existing = parties.where(F.col("yr") <= 1998).select(
        "party_no", "party_name", (-F.col("party_no")).alias("party_id")).distinct()
    incoming = parties.where(F.col("yr") >= 1998).select("party_no", F.lower("party_name").alias("party_name"))
    out = D.upsert(existing, incoming, ["party_no"], ["party_name"], id_col="party_id")
    return out.select("party_no", "party_name", (F.col("party_id") == -F.col("party_no")).alias("id_kept"))


@query
def dim_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = T.v_parent(spark, sf_dir)
    renamed = F.when((F.col("party_no") % 10 == 3) & (F.col("seg") == "A"),
                     F.concat("party_name", F.lit("*"))).otherwise(F.col("party_name"))
    stage = parent.withColumn("party_name", renamed)
    return D.conflicts(stage, ["yr", "party_no"], "party_name")


@query
def dim_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment dimension seeded with two values; the stage adds the rest."""
    seed = spark.createDataFrame([("A",), ("N",)], "seg string")
    incoming = D.distinct_keys(T.v_line(spark, sf_dir), ["seg"])
    return D.insert_absent(seed, incoming, ["seg"])


@query
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of years up to 1997 as the dimension; all places inserted if absent."""
    geo = T.v_geo(spark, sf_dir)
    existing = D.distinct_keys(geo.where(F.col("yr") <= 1997), PLACE)
    return D.insert_absent(existing, D.distinct_keys(geo, PLACE), PLACE)


@query
def location_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = D.distinct_keys(T.v_geo(spark, sf_dir), PLACE)
    return places.select(natural_key("yr", "lvl", "uf", "ue", "city", trim_first=(2,)).alias("location_key"))


def _swapped(geo: DataFrame) -> DataFrame:
    """The same rows with state and unit exchanged, so that places differ only in which part is null."""
    return geo.withColumns({"uf": F.col("ue"), "ue": F.col("uf")})


@query
def location_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows joined to the location dimension null-safely, per level."""
    geo = T.v_geo(spark, sf_dir)
    geo = geo.unionByName(_swapped(geo))
    places = D.with_surrogate(D.distinct_keys(geo, PLACE), "location_id", PLACE)
    joined = FA.resolve(geo, [FA.Lookup(places, tuple(PLACE), "location_id", null_safe=True)])
    return joined.groupBy("lvl").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(38,2)").alias("total"),
        F.count_distinct("location_id").alias("places"),
    )


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = T.v_geo(spark, sf_dir).select(*PLACE)
    places = D.with_surrogate(D.distinct_keys(geo.unionByName(_swapped(geo)), PLACE), "location_id", PLACE)
    return D.check_surrogate_keys(places, "location_id", PLACE)


@query
def dim_last_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of each user's last event of the table: by day, then by event id (many events tie on the day)."""
    ev = T.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return D.resolve_last_writer(ev, ["user_id"], "event_type", ["day", "event_id"])


@query
def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties numbered without gaps: those of years up to 1998 have ids already, all others follow in order."""
    parties = written_once(T.v_line(spark, sf_dir).groupBy("yr", "party_no").agg(F.count(F.lit(1)).alias("n")), "parties")
    key = ["yr", "party_no"]
    none = spark.createDataFrame([], "yr smallint, party_no bigint, party_id bigint")
    first = D.with_dense_ids(none, parties.where(F.col("yr") <= 1998), key, "party_id")
    return D.with_dense_ids(first, parties, key, "party_id")


@query
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, order, line) must be unique in the detail rows (nulls equal)."""
    return D.duplicate_keys(T.v_geo(spark, sf_dir), ["yr", "l_orderkey", "l_linenumber"])


@query
def constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = T.v_geo_bad(spark, sf_dir)
    lvl, uf, ue, city = (F.col(c) for c in ("lvl", "uf", "ue", "city"))
    checks = {
        "ck_level": lvl.isin("NATIONAL", "STATE", "CITY"),
        "ck_geography": (
            ((lvl == "NATIONAL") & uf.isNull() & ue.isNull() & city.isNull())
            | ((lvl == "STATE") & uf.isNotNull() & ue.isNull() & city.isNull())
            | ((lvl == "CITY") & uf.isNotNull() & ue.isNotNull() & city.isNotNull())
        ),
        "ck_amount": F.col("amount") >= 0,
    }
    return FA.check_violations(geo, checks, ["l_orderkey", "l_linenumber"])


@query
def foreign_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan rows per foreign key (left anti joins against the parents)."""
    orders = T.table(spark, sf_dir, "orders")
    fks = [
        ("orders_customer", FA.orphans(orders, T.table(spark, sf_dir, "customer"), ["o_custkey"], ["c_custkey"])),
        ("lineitem_orders", FA.orphans(T.table(spark, sf_dir, "lineitem"), orders, ["l_orderkey"], ["o_orderkey"])),
        ("labels_documents", FA.orphans(T.table(spark, sf_dir, "labels"), T.table(spark, sf_dir, "documents"),
                                        ["doc_id"], ["doc_id"])),
    ]
    out = None
    for name, orphan_rows in fks:
        part = orphan_rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("fk"), "violations")
        out = part if out is None else out.unionByName(part)
    return out


def _child_stage_and_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    line = T.v_line(spark, sf_dir)
    party = GF.dim_party(line)
    stage = T.v_child_bad(spark, sf_dir)
    loaded = FA.resolve(stage, [FA.Lookup(party, ("yr", "party_no"), "party_id")])
    return stage, loaded


@query
def stage_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = T.v_child_bad(spark, sf_dir)
    return stage.agg(F.count(F.lit(1)).alias("staged"))


@query
def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, loaded = _child_stage_and_load(spark, sf_dir)
    return FA.reconcile(stage, loaded, ["yr", "party_no", "party_name", "seg", "subseg"])


@query
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child stage with places, resolved through the party, segment, sub-segment
    and location dimensions, typed from text by casts that fail on bad values;
    ids are resolved back to natural keys for comparison."""
    fact, joins, _ = GF.star(spark, sf_dir, child=True, location=True)
    text = fact.select(*[F.col(c).cast("string") for c in fact.columns])
    typed = FA.typed_projection(text, dict(fact.dtypes))
    return M.star_view(typed, joins, ["yr", "party_no", "lvl", "uf", "ue", "city", "seg", "subseg", "qty", "amount"])


@query
def slice_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year 1998 replaced by its segment-A rows with doubled amounts."""
    parent = T.v_parent(spark, sf_dir)
    incoming = parent.where((F.col("yr") == 1998) & (F.col("seg") == "A")) \
        .withColumn("amount", (F.col("amount") * 2).cast("decimal(38,2)"))
    table = FA.replace_slices(parent, incoming, ["yr"])
    return table.groupBy("yr").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(38,2)").alias("total")
    )


def _audit(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Audit after a first load of every artifact and a second load of 1998."""
    arts = T.v_artifact(spark, sf_dir).groupBy("yr", "dataset").agg(F.max("observed").alias("n"))
    first = arts.select("yr", "dataset", F.col("n").alias("staged"), F.lit(0).cast("bigint").alias("deleted"),
                        F.col("n").alias("inserted"))
    second = arts.where(F.col("yr") == 1998).select(
        "yr", "dataset", F.col("n").alias("staged"), F.col("n").alias("deleted"), F.col("n").alias("inserted"))
    audit = FA.audit_upsert(FA.audit_rows(first), FA.audit_rows(second))
    return audit, second


@query
def audit_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit, _ = _audit(spark, sf_dir)
    return audit


@query
def audit_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit, _ = _audit(spark, sf_dir)
    return audit.orderBy("yr", "dataset")


@query
def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the second load (1998 artifacts)."""
    _, second = _audit(spark, sf_dir)
    return second.agg(
        F.count(F.lit(1)).alias("artifacts"),
        F.sum("staged").cast("bigint").alias("staged"),
        F.sum("deleted").cast("bigint").alias("deleted"),
        F.sum("inserted").cast("bigint").alias("inserted"),
    )


@query
def gated_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent rows of the years whose artifact report is valid."""
    family = T.parent_and_child(spark, sf_dir)
    arts = T.v_artifact(spark, sf_dir, family).withColumn(
        "artifact", F.concat_ws("_", "dataset", F.col("yr").cast("string")))
    rc = Q.row_count_issues(arts.select("artifact", F.col("observed").alias("rows")),
                            arts.select("artifact", F.col("expected").alias("expected_rows")).distinct())
    rc = rc.withColumn("yr", F.regexp_extract("artifact", r"_([0-9]{4})$", 1).cast("smallint"))
    comp = Q.completeness(arts, ("child", "parent")).where(F.col("n_issues") > 0).select(
        "yr", F.lit("error").alias("severity"), F.col("n_issues").alias("n"))
    issues = rc.select("yr", "severity", "n").unionByName(comp)
    report = Q.report(issues, arts.select("yr", F.col("observed").alias("rows")), ["yr"])
    valid = report.where("valid").select("yr")
    return family[0].join(valid, "yr", "left_semi")


# ------------------------------------------------------------ batch 7: lake I/O

from stratum.session import checkpoint_dir  # noqa: E402
from stratum.sources import archives as A  # noqa: E402
from stratum.sources import lake as L  # noqa: E402
from stratum.sources import member_files as MF  # noqa: E402


def _lake_path(spark: SparkSession, layer: str, name: str) -> str:
    root = f"{checkpoint_dir(spark)}/lake-{uuid.uuid4().hex}"
    return L.prefix(root, layer, "fixture", sub=name)


@query
def silver_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table exported as CSV below its layer's prefix and read back as text.

    ``note`` holds what quoting is for: quotes, the separator, a backslash before a quote, line breaks, blanks.
    """
    silver = S.to_silver(T.raw_orders(spark, sf_dir), T.RAW_CONTRACT, SOURCE, keep_invalid=False)
    silver = silver.withColumn("note", F.format_string(' %s "%s"; \\"\n\\', "source_row_number", "time_val"))
    types = dict(silver.dtypes)
    columns = ["source_row_number", "yr", "int_val", "date_val", "time_val", "status", "note"]
    path = _lake_path(spark, "silver", "orders")
    L.export_csv(silver.select(*[C.as_text(c, types[c]).alias(c) for c in columns]), path)
    return L.read_text_csv(spark, path, columns)


def _noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a yearly member's records: number, status, and a note that needs quoting."""
    orders = T.table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        F.format_string("orders_%d.csv", F.year("o_orderdate")).alias("member"), F.col("o_orderkey").alias("k"),
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('said "'), "o_orderpriority", F.lit('";\nthen\r\n\\'), day))
        .when(F.col("o_orderkey") % 3 == 1, day).alias("note"))


@query
def member_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly members written as one named CSV file each, then read back file by file."""
    path = _lake_path(spark, "silver", "members")
    MF.export_members(_noted(spark, sf_dir), path, "member", "k", ["key", "status", "note"], part_records=20_000)
    back = L.read_text_csv(spark, path, ["key", "status", "note"])
    return back.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file"), "key", "status", "note")


@query
def member_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly members packed into archives, then listed, decompressed and parsed by many tasks: records keep their numbers."""
    path = _lake_path(spark, "bronze", "members")
    MF.export_members(_noted(spark, sf_dir), f"{path}files", "member", "k", ["key", "status", "note"], suffix="", part_records=20_000)
    packed = A.pack_members(spark, f"{path}files", f"{path}raw")
    chunks = written_once(A.read_chunks(spark, packed, splitBytes=1 << 16, chunkBytes=1 << 14), "chunks")
    records = A.data_records(A.read_records(chunks))
    return records.select("member", "encoding", "record_no", *[F.get("fields", i).alias(c) for i, c in enumerate(("key", "status", "note"))],
                          F.size("fields").alias("width"))


@query
def appended_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent files appended year by year's parity to one partitioned table, read back and counted."""
    parent, _ = T.parent_and_child(spark, sf_dir)
    path = _lake_path(spark, "gold", "parents")
    for odd in (0, 1):
        L.save_table(parent.where(F.col("yr") % 2 == odd), path, partition_by=("yr",))
    back = spark.read.parquet(path)
    return back.groupBy(F.col("yr").cast("int").alias("yr")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(38,2)").alias("total"))


# -------------------------------------------------------------------- manifests


@query
def json_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON manifest document per year from the artifact table, decoded again."""
    arts = T.v_artifact(spark, sf_dir)
    per_year = arts.groupBy("yr").agg(
        F.sum("observed").cast("bigint").alias("row_count"),
        F.sort_array(F.collect_list(F.struct("dataset", "observed", "expected"))).alias("artifacts"),
    )
    encoded = per_year.select(F.to_json(F.struct("yr", "row_count", "artifacts")).alias("manifest"))
    schema = ("yr smallint, row_count bigint, "
              "artifacts array<struct<dataset:string,observed:bigint,expected:bigint>>")
    decoded = encoded.select(F.from_json("manifest", schema).alias("m"))
    return decoded.select("m.yr", "m.row_count", F.explode("m.artifacts").alias("a")).select("yr", "row_count", "a.*")
