"""A CSV file for each member, read by Python's csv; nothing is shown unless all is right."""

from __future__ import annotations

import csv
import os

import pytest

from stratum.sources import member_files as M

ROWS = [("dir/a b_2024.csv", n, f'v{n} "q";\\', None if n % 3 else "line\nbreak") for n in range(2, 60)]
ROWS += [("other=x.CSV", n, "", "é") for n in range(5)]


def read(path):
    with open(path, encoding="utf-8", newline="") as handle:
        return list(csv.reader(handle, delimiter=";"))


def test_every_member_has_its_file(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "m string, n int, v string, w string").repartition(5)
    expected = spark.createDataFrame([("dir/a b_2024.csv", 58), ("other=x.CSV", 5), ("none.csv", 0)], "member string, rows long")
    folder = str(tmp_path / "tratado")
    done = {r["member"]: r for r in M.export_members(df, folder, "m", "n", ["n", "v", "w"], expected, part_records=7).collect()}
    assert sorted(os.listdir(folder)) == sorted(["a b_2024_tratado.csv", "none_tratado.csv", "other=x_tratado.csv"])
    for member, n in (("dir/a b_2024.csv", 58), ("other=x.CSV", 5), ("none.csv", 0)):
        path = done[member]["path"]
        assert read(path) == [["n", "v", "w"]] + [[str(k), v, w or ""] for m, k, v, w in ROWS if m == member]
        assert (done[member]["records"], done[member]["bytes"]) == (n, os.path.getsize(path))
    again = df.where("m = 'other=x.CSV' AND n < 2")
    M.export_members(again, folder, "m", "n", ["n"])  # a file that is there is replaced, others stay
    assert read(f"{folder}/other=x_tratado.csv") == [["n"], ["0"], ["1"]] and len(os.listdir(folder)) == 3


@pytest.mark.parametrize("expected", [[("dir/a b_2024.csv", 58), ("other=x.CSV", 6)], [("dir/a b_2024.csv", 58)]])
def test_a_wrong_count_shows_no_file(spark, tmp_path, expected):
    df = spark.createDataFrame(ROWS, "m string, n int, v string, w string")
    with pytest.raises(M.MemberFileError):
        M.export_members(df, str(tmp_path), "m", "n", ["n"], spark.createDataFrame(expected, "member string, rows long"))
    assert not [p for p in os.listdir(tmp_path) if not p.startswith(".")]


def test_two_members_of_one_name_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("a/x.csv", 1), ("b/x.csv", 1)], "m string, n int")
    with pytest.raises(M.MemberFileError, match="2 members"):
        M.export_members(df, str(tmp_path), "m", "n", ["n"])
