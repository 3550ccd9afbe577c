"""A star schema built with the gold operators from the fixture views.

Parent / child facts and location facts, with party, segment ("gender"),
sub-segment ("race"), election and location dimensions.  Surrogate ids are
hashes of the natural keys; they never leave Spark (views resolve them back).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import dims as D
from stratum.operators.facts import Lookup, resolve
from stratum.operators.marts import DimJoin
from stratum.plans import tables as T
from stratum.session import written_once


def dim_election(stage: DataFrame) -> DataFrame:
    """Election dimension: the years that the stage has, whichever they are, and their kind."""
    return stage.select("yr").distinct().withColumn("kind", T.treatment_kind(F.col("yr")))


def dim_party(line: DataFrame) -> DataFrame:
    parties = D.distinct_keys(line, ["yr", "party_no", "party_name"])
    return D.with_surrogate(parties, "party_id", ["yr", "party_no"])


def dim_value(df: DataFrame, column: str, id_col: str) -> DataFrame:
    return D.with_surrogate(D.distinct_keys(df, [column]), id_col, [column])


def dim_location(geo: DataFrame) -> DataFrame:
    places = D.distinct_keys(geo, ["yr", "lvl", "uf", "ue", "city"])
    return D.with_surrogate(places, "location_id", ["yr", "lvl", "uf", "ue", "city"])




def party_segment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail rows added up by year, party and segment: one read of each table."""
    return T.v_line(spark, sf_dir).groupBy("yr", "party_no", "party_name", "seg").agg(
        F.sum("amount").cast("decimal(38,2)").alias("amount"))


def star(spark: SparkSession, sf_dir: str, child: bool = False, location: bool = False) -> tuple[DataFrame, list[DimJoin], list[str]]:
    """Fact + dimension joins + view columns for the four analytical views.

    The detail rows are aggregated to the fact grain and written once to the
    shared folder; fact and dimensions all read that reduced stage, so the
    large join behind the detail rows runs a single time.
    """
    base = T.v_geo(spark, sf_dir) if location else T.v_line(spark, sf_dir)
    grain = ["yr", "party_no"] + (["lvl", "uf", "ue", "city"] if location else []) + ["seg"] \
        + (["subseg"] if child else [])
    stage = written_once(base.groupBy(*grain, "party_name").agg(
        F.count(F.lit(1)).alias("qty"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    ), "star-stage")
    party = dim_party(stage)
    gender = dim_value(stage, "seg", "gender_id")
    election = dim_election(stage)
    lookups = [
        Lookup(party, ("yr", "party_no"), "party_id"),
        Lookup(gender, ("seg",), "gender_id"),
    ]
    if child:
        race = dim_value(stage, "subseg", "race_id")
        lookups.append(Lookup(race, ("subseg",), "race_id"))
    if location:
        location_dim = dim_location(stage)
        lookups.append(Lookup(location_dim, ("yr", "lvl", "uf", "ue", "city"), "location_id", null_safe=True))
    fact = resolve(stage.drop("party_name"), lookups).select(
        "yr", "party_id", "gender_id",
        *(["race_id"] if child else []),
        *(["location_id"] if location else []),
        "qty", "amount",
    )
    joins = [
        DimJoin(election, ("yr",)),
        DimJoin(party.select("party_id", "yr", "party_no", "party_name"), ("party_id", "yr")),
        DimJoin(gender, ("gender_id",)),
    ]
    cols = ["yr", "kind", "party_no", "party_name"]
    if location:
        joins.append(DimJoin(location_dim.select("location_id", "yr", "lvl", "uf", "ue", "city"), ("location_id", "yr")))
        cols += ["lvl", "uf", "ue", "city"]
    cols.append("seg")
    if child:
        joins.append(DimJoin(race, ("race_id",)))
        cols.append("subseg")
    cols += ["qty", "amount"]
    return fact, joins, cols


__all__ = ["star", "party_segment_totals", "dim_party", "dim_value", "dim_location", "dim_election"]
