"""Members of archives as a data source, and their records parsed in parallel, against Python's csv."""

from __future__ import annotations

import csv
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from stratum.sources import archives as A
from stratum.sources import csv_split as CS
from stratum.sources import zip_source as Z

PIECES = ["a", "bb", ";", '"', '""', "\n", "\r\n", "\r", '"x;y"', '"line\nbreak"', "é", "", '"', "\n\n", ';"', '";', "long " * 7]


def plain(data: bytes) -> list[list[str]]:
    try:
        text = data.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    return list(csv.reader(io.StringIO(text, newline=""), delimiter=";"))


def random_file(rng: random.Random, n: int) -> bytes:
    return "".join(rng.choices(PIECES, k=n)).encode()


def archive_of(path, members: dict[str, bytes]) -> str:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as target:
        for name, data in members.items():
            target.writestr(name, data)
    return str(path)


def test_chunks_are_whole_lines():
    rng = random.Random(3)
    for size in (1, 7, 64):
        data = random_file(rng, 300)
        chunks = list(Z.line_chunks(io.BytesIO(data), size))
        assert b"".join(chunks) == data
        for one, two in zip(chunks, chunks[1:]):
            assert one[-1:] in b"\r\n" and not (one[-1:] == b"\r" and two[:1] == b"\n")


def test_a_chunk_walked_from_either_state():
    assert CS.walk('a;"b\nc;"\n', False, ";") == (False, 1, 0)
    assert CS.walk('a;"b\n', False, ";") == (True, 1, 0)
    assert CS.walk('c;"\nd\n', True, ";") == (False, 1, 4)
    assert CS.walk("c\nd\n", True, ";") == (True, 0, 4)
    assert CS.walk('x";"y\nz\n', True, ";") == (True, 0, 8)
    assert CS.walk('say "hi\n', False, ";") == (False, 1, 0)  # a quote inside a field is a letter


def test_records_of_members_in_many_chunks(spark, tmp_path):
    rng = random.Random(11)
    files = {f"dir/m{i}.csv": random_file(rng, rng.choice([0, 1, 40, 400])) for i in range(12)}
    files["dir/latin.CSV"] = "name;city\nJosé;São Paulo\n\"Ni\nterói\";x\n".encode("latin-1") * 9
    files["dir/bom.csv"] = b"\xef\xbb\xbf" + '"one;two";3\n"quo\n""ted""";é\n'.encode() * 20
    files["dir/open.csv"] = b'a;b\nc;"never closed\nd\ne;f\n' + b"g;h\n" * 50
    files["dir/other.txt"] = b"not read"
    path = archive_of(tmp_path / "ano_eleicao=2024.zip", files)
    chunks = A.read_chunks(spark, [path], splitBytes=100, chunkBytes=48)
    chunks.write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    assert chunks.groupBy("member").count().agg(F.max("count")).first()[0] > 20
    got: dict[str, dict[int, list[str]]] = {}
    for r in A.read_records(chunks).collect():
        assert r["year"] == 2024 and r["record_no"] not in got.setdefault(r["member"], {})
        got[r["member"]][r["record_no"]] = r["fields"]
        assert r["encoding"] == ("latin-1" if "latin" in r["member"] else "utf-8-sig")
    for name, data in files.items():
        if name.lower().endswith(".csv"):
            assert [got.get(name, {})[k] for k in sorted(got.get(name, {}))] == plain(data), name
            assert sorted(got.get(name, {})) == list(range(1, len(plain(data)) + 1))


def test_members_are_listed_by_tasks_with_pushed_conditions(spark, tmp_path, monkeypatch):
    for year in (2020, 2024):
        folder = tmp_path / f"ano_eleicao={year}"
        os.makedirs(folder)
        archive_of(folder / "a.zip", {f"t{i}_{year}.csv": b"x;y\n" * i for i in range(30)} | {"sub/": b"", "note.txt": b"z"})
    Z.register(spark)
    listed = spark.read.format("zip_members").schema(Z.MEMBER_SCHEMA).option("path", str(tmp_path)).option("splitBytes", 300).load()
    assert listed.count() == 60 and listed.rdd.getNumPartitions() > 10
    one = listed.where("member = 't7_2024.csv' AND year = 2024")
    assert [(r["member"], r["member_size"]) for r in one.collect()] == [("t7_2024.csv", 28)]
    assert one.rdd.getNumPartitions() < listed.rdd.getNumPartitions()  # the other year's archive isn't opened
    reader = Z.ZipReader({"path": str(tmp_path)}, ["member"])
    left = list(reader.pushFilters([Z.In(("member",), ("t1_2020.csv",)), Z.EqualTo(("member_size",), 4)]))
    assert [type(f).__name__ for f in left] == ["EqualTo"] and reader.conditions == [("member", "in", ("t1_2020.csv",))]
    assert sum(batch.num_rows for split in reader.partitions() for batch in reader.read(split)) == 1
    with pytest.raises(Exception, match="no such columns"):
        spark.read.format("zip_members").schema("member string, other int").option("path", str(tmp_path)).load().count()


def test_listing_decompresses_nothing(tmp_path, monkeypatch):
    path = archive_of(tmp_path / "a.zip", {"a.csv": b"x"})
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda *a, **k: pytest.fail("a member was opened"))
    reader = Z.ZipReader({"path": path}, ["member", "member_size"])
    assert [b.to_pylist() for s in reader.partitions() for b in reader.read(s)] == [[{"member": "a.csv", "member_size": 1}]]
