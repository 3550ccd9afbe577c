"""Adapters that shape the driver's test tables into the workload's roles.

The operators take any DataFrame plus a contract; these views give them
realistic input built from the TPC-H-like tables (detail rows, a parent and a
child file, geography, raw text with defects, member names, ...).  Modulo
expressions below only *inject defects* into rows; no view drops rows to make
a check cheaper, and every view reads its tables whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.contracts import Conditional, Contract
from stratum.session import maybe_broadcast, written_once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_range(col: str, years) -> Column:
    """``col`` inside any of the calendar years, as plain range predicates.

    ``year(col) = y`` is a function of the column and cannot be pushed to
    the parquet reader; ``col >= 'y-01-01' AND col < 'y+1-01-01'`` can
    (it shows up under ``PushedFilters`` and prunes row groups by min/max).
    """
    cond = None
    for y in sorted(set(int(v) for v in years)):
        term = (F.col(col) >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & (
            F.col(col) < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
        cond = term if cond is None else cond | term
    return cond


def v_line(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """Detail rows: lineitem with its order, supplier, customer, nation, region.

    ``years`` restricts the orders scan with pushed range predicates.

    nation and region are fixed-size (25 / 5 rows) and broadcast explicitly;
    supplier and customer grow with the data, so Catalyst decides from their
    size statistics (and AQE re-plans at runtime) whether they are broadcast.
    """
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_extendedprice",
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if years is not None:
        o = o.where(year_range("o_orderdate", years))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey")
    return (
        l.join(o, l.l_orderkey == o.o_orderkey)
        .join(s, l.l_suppkey == s.s_suppkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(maybe_broadcast(n), c.c_nationkey == n.n_nationkey)
        .join(maybe_broadcast(r), n.n_regionkey == r.r_regionkey)
        .select(
            F.year("o_orderdate").cast("smallint").alias("yr"),
            F.col("l_suppkey").alias("party_no"),
            F.col("s_name").alias("party_name"),
            F.col("l_returnflag").alias("seg"),
            F.col("l_linestatus").alias("subseg"),
            F.col("l_extendedprice").cast("decimal(20,2)").alias("amount"),
            "l_orderkey", "l_linenumber", "c_mktsegment", "n_name", "r_regionkey",
        )
    )


def v_parent(spark: SparkSession, sf_dir: str, line: DataFrame | None = None, years=None) -> DataFrame:
    """Parent file: one row per (year, party, segment)."""
    line = line if line is not None else v_line(spark, sf_dir, years=years)
    return line.groupBy("yr", "party_no", "party_name", "seg").agg(
        F.count(F.lit(1)).alias("qty"),
        F.sum("amount").cast("decimal(38,2)").alias("amount"),
    )


def v_child(spark: SparkSession, sf_dir: str, line: DataFrame | None = None) -> DataFrame:
    """Child file: the parent grain plus the sub-segment."""
    line = line if line is not None else v_line(spark, sf_dir)
    return line.groupBy("yr", "party_no", "party_name", "seg", "subseg").agg(
        F.count(F.lit(1)).alias("qty"),
        F.sum("amount").cast("decimal(38,2)").alias("amount"),
    )


def v_child_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child with holes (some parent keys lack children) and orphans."""
    return with_holes(v_child(spark, sf_dir))


def with_holes(child: DataFrame) -> DataFrame:
    """A child file without the children of some parents and with orphans."""
    holes = child.where(~((F.col("party_no") % 7 == 0) & (F.col("seg") == "A")))
    orphans = child.where(F.col("party_no") == 1).withColumn("party_no", F.lit(-1).cast("bigint"))
    return holes.unionByName(orphans)


LEVEL_NATIONAL, LEVEL_STATE, LEVEL_CITY = "NATIONAL", "STATE", "CITY"


def v_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows with a party level and level-dependent geography."""
    line = v_line(spark, sf_dir)
    lvl = (
        F.when(F.col("r_regionkey") % 3 == 0, LEVEL_NATIONAL)
        .when(F.col("r_regionkey") % 3 == 1, LEVEL_STATE)
        .otherwise(LEVEL_CITY)
    )
    return line.select(
        "l_orderkey", "l_linenumber", "yr", "party_no", "party_name", "seg", "subseg", "amount",
        lvl.alias("lvl"),
        F.when(lvl != LEVEL_NATIONAL, F.col("n_name")).alias("uf"),
        F.when(lvl == LEVEL_CITY, F.substring("c_mktsegment", 1, 3)).alias("ue"),
        F.when(lvl == LEVEL_CITY, F.col("c_mktsegment")).alias("city"),
    )


def v_geo_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geography with blanked states, filled cities and unknown levels."""
    geo = v_geo(spark, sf_dir)
    k = F.col("l_orderkey")
    return geo.select(
        "l_orderkey", "l_linenumber", "yr", "party_no", "seg", "subseg", "amount",
        F.when(k % 37 == 0, F.lit("OTHER")).otherwise(F.col("lvl")).alias("lvl"),
        F.when(k % 29 == 0, F.lit("")).otherwise(F.col("uf")).alias("uf"),
        "ue",
        F.when(k % 31 == 0, F.lit("FILLED")).otherwise(F.col("city")).alias("city"),
    )


GEO_RULES = Conditional(
    level_column="lvl",
    rules={
        LEVEL_CITY: (("uf", "ue", "city"), ()),
        LEVEL_STATE: (("uf",), ("ue", "city")),
        LEVEL_NATIONAL: ((), ("uf", "ue", "city")),
    },
)


def v_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text columns with defects, one record per order (record no = key).

    The narrow order columns are dealt by record first, as the archive reader deals records:
    making and parsing text is the work, and a table may come as one row group.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    o = o.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    k = F.col("o_orderkey")
    int_txt = (
        F.when(k % 13 == 0, F.lit("-"))
        .when(k % 13 == 1, F.lit("12x"))
        .when(k % 13 == 2, F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .when(k % 13 == 3, F.lit("+7"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    money_txt = (
        F.when(k % 17 == 0, F.lit("#########"))
        .when(k % 17 == 1, F.lit("N/A"))
        .when(k % 17 == 2, F.lit("1.2,3,4"))
        .when(k % 17 == 3, F.lit("-5,25"))
        .otherwise(F.translate(F.format_number("o_totalprice", 2), ",.", ".,"))
    )
    date_txt = (
        F.when(k % 19 == 0, F.lit("31/02/2024"))
        .when(k % 19 == 1, F.lit(""))
        .when(k % 19 == 2, F.lit("1/2/2024"))
        .when(k % 19 == 3, F.lit("01/02/24"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    time_txt = (
        F.when(k % 5 == 0, F.lit("9:5"))
        .when(k % 5 == 1, F.lit("13:21"))
        .when(k % 5 == 2, F.lit("13:21:07"))
        .when(k % 5 == 3, F.lit("25:00"))
        .otherwise(F.lit("null"))
    )
    return o.select(
        k.alias("k"),
        F.year("o_orderdate").alias("part_yr"),
        F.year("o_orderdate").cast("string").alias("YR"),
        int_txt.alias("INT_TXT"),
        money_txt.alias("MONEY_TXT"),
        date_txt.alias("DATE_TXT"),
        time_txt.alias("TIME_TXT"),
        F.when(k % 3 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("STATUS_TXT"),
    )


RAW_CONTRACT = Contract(
    name="raw_orders",
    source_columns=("YR", "INT_TXT", "MONEY_TXT", "DATE_TXT", "TIME_TXT", "STATUS_TXT"),
    aliases={
        "YR": "yr", "INT_TXT": "int_val", "MONEY_TXT": "money_val",
        "DATE_TXT": "date_val", "TIME_TXT": "time_val", "STATUS_TXT": "status",
    },
    integer_columns=frozenset({"yr", "int_val"}),
    decimal_columns=frozenset({"money_val"}),
    date_columns=frozenset({"date_val"}),
    time_columns=frozenset({"time_val"}),
    upper_columns=frozenset({"status"}),
    datetime_column=("date_val", "time_val", "ts_val"),
    year_column="yr",
    fund="raw",
    dimension="orders",
)




def treatment_kind(year: Column) -> Column:
    """Kind of a partition year: a rule that holds for every year."""
    return F.when(year % 2 == 0, F.lit("even")).when(year.isNotNull(), F.lit("odd"))


def raw_orders(spark: SparkSession, sf_dir: str, blanks: bool = False) -> DataFrame:
    """v_raw as a raw record frame; ``blanks`` empties every cell where k % 41 = 0."""
    raw = v_raw(spark, sf_dir)
    if blanks:
        blank = F.col("k") % 41 == 0
        fill = {"YR": "N/A", "INT_TXT": " ", "MONEY_TXT": "-", "DATE_TXT": "", "TIME_TXT": "null", "STATUS_TXT": "  "}
        raw = raw.withColumns({c: F.when(blank, F.lit(v)).otherwise(F.col(c)) for c, v in fill.items()})
    from stratum.operators.silver import raw_from_table

    return raw_from_table(
        raw,
        RAW_CONTRACT,
        archive=F.lit("orders.parquet"),
        member=F.concat(F.lit("raw/raw_orders_"), F.col("part_yr").cast("string"), F.lit(".csv")),
        record_no=F.col("k"),
        year=F.col("part_yr"),
        kind=treatment_kind(F.col("part_yr")),
    )


def v_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive member names, one per order, with naming defects."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    year = F.year("o_orderdate")
    dataset = (
        F.when(k % 4 == 0, "fefc_genero").when(k % 4 == 1, "fefc_cor_raca")
        .when(k % 4 == 2, "fp_genero").otherwise("fp_cor_raca")
    )
    name = F.concat(F.lit("dir/"), dataset, F.lit("_"),
                    F.when(k % 11 == 2, F.lit(1900)).otherwise(year).cast("string"), F.lit(".csv"))
    name = (
        F.when(k % 11 == 0, F.upper(name))
        .when(k % 11 == 1, F.translate(name, "_", "-"))
        .otherwise(name)
    )
    return o.select(k.alias("k"), year.alias("part_yr"), name.alias("name"))


def parent_and_child(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parent and child file from one read of the detail rows: the child is
    written once to the shared folder, the parent adds it up."""
    child = written_once(v_child(spark, sf_dir), "child")
    parent = child.groupBy("yr", "party_no", "party_name", "seg").agg(
        F.sum("qty").alias("qty"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
    return parent, child


def v_artifact(spark: SparkSession, sf_dir: str, family: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Artifact table: per year a parent and a child file with their rows.

    The child of 2001 is missing, the parent of 2000 is listed twice and the
    1997 manifest declares one row more than observed.
    """
    parent, child = family or parent_and_child(spark, sf_dir)
    parent = parent.groupBy("yr").agg(F.count(F.lit(1)).alias("observed")).withColumn("dataset", F.lit("parent"))
    child = child.groupBy("yr").agg(F.count(F.lit(1)).alias("observed")).withColumn("dataset", F.lit("child"))
    arts = parent.unionByName(parent.where(F.col("yr") == 2000)).unionByName(child.where(F.col("yr") != 2001))
    return arts.select(
        "yr", "dataset", F.col("observed").cast("bigint").alias("observed"),
        (F.col("observed") + F.when(F.col("yr") == 1997, 1).otherwise(0)).cast("bigint").alias("expected"),
    )


CHILD_CONTRACT = Contract(
    name="child",
    source_columns=(),
    required=("yr", "party_no", "party_name", "seg", "subseg", "qty", "amount", "source_member"),
)
SCOPE_YEARS = (1996, 1998, 2000)
