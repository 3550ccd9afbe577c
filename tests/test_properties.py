"""Properties: words are joined by one space, empty tokens are null, cleaning twice changes nothing.

Examples are generated with hypothesis and checked in ONE Spark job (a
DataFrame of all examples), so the property costs one job, not one per case.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.contracts import EMPTY_TOKENS
from stratum.functions import clean as C

ALPHABET = st.sampled_from(list("ab-/Nn aA1,.") + ["\t", "\n", "\x0b", "\x1c", "\x85", "\xa0",
                                                  " ", "　", "​", "é", "ß"])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=12)), min_size=50, max_size=200))
def test_cleaning_joins_words_by_one_space_and_is_idempotent(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    once = C.clean_text("v")
    rows = df.select("i", once.alias("c1"), C.clean_text(once).alias("c2")).orderBy("i").collect()
    for r, v in zip(rows, values):
        words = None if v is None else " ".join(v.split())
        assert r["c1"] == (words if words and words.lower() not in EMPTY_TOKENS else None), repr(v)
        assert r["c2"] == r["c1"]


def test_is_blank_matches_python_strip(spark):
    values = ["", " ", "\xa0　", "\x1c", "a", " a ", "​"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(C.is_blank("v")).collect()]
    assert got == [v.strip() == "" for v in values]
