"""Decontamination, BPE, secrets and licenses against plain versions."""

import base64
import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from stratum.llm import bpe, decontaminate, licenses, queries, secrets

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOC)


# -- decontamination -------------------------------------------------------

def plain_hits(text, items):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        w = WORD.findall(lower(body))
        n = min(10, len(w))
        wanted = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in wanted:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination_over_the_small_tables(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    bench = [(r.item_id, r.text) for r in items.collect()]
    expected = {r.doc_id: plain_hits(r.text, bench) for r in docs.collect()}
    got = {r["doc_id"]: r for r in rows(queries.op1_decontaminate(spark, SMALL))}
    assert len(got) == len(expected)
    for doc, (n, hits, ids) in expected.items():
        r = got[doc]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hits, len(ids), hits > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_decontamination_of_odd_texts_in_any_number_of_blocks(spark):
    rng = random.Random(5)
    word = ["a", "b", "É", "é", "x1", "0"]
    items = [(i, " ".join(rng.choices(word, k=rng.choice([0, 1, 2, 9, 10, 11, 14])))) for i in range(12)]
    items += [(3, items[3][1]), (50, items[3][1]), (51, None), (52, ""), (53, "...")]
    texts = [" ,".join(rng.choices(word, k=rng.randrange(0, 60))) for _ in range(60)]
    texts += [None, "", "!!", items[0][1], "A" * 70_000, texts[0], texts[0]]
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 30):
        got = {r["doc_id"]: r for r in rows(decontaminate.search(docs, bench, block_bytes=size))}
        for i, text in enumerate(texts):
            n, hits, ids = plain_hits(text, items)
            assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (n, hits, ids), text
    kept = {r["doc_id"] for r in rows(decontaminate.remove(docs, bench, block_bytes=30))}
    assert kept == {i for i, t in enumerate(texts) if not plain_hits(t, items)[1]}


def test_longest_matches_and_their_places(spark):
    docs = docs_of(spark, ["x y one two three four five z"])
    bench = spark.createDataFrame([(7, "Zero one, two three FOUR five six")], "item_id long, text string")
    match, = rows(decontaminate.search(docs, bench, window=3))[0]["matches"]
    assert match == {"item_id": "7", "item_start": 1, "doc_start": 2, "n_words": 5}


def test_decontamination_without_items_or_documents(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    got = rows(decontaminate.search(docs_of(spark, ["a b", None]), empty))
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [
        (2, 0, []), (0, 0, [])]
    assert decontaminate.remove(docs_of(spark, []), empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b")], "item_id long, text string")
    assert [(r["n_hit"], r["items"]) for r in rows(decontaminate.search(docs_of(spark, ["a b"]), nameless))] == [(2, [])]


# -- byte-level BPE --------------------------------------------------------

def reference_codec():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    letters = ["ab", "a", "abcdefghij ", "éüñaeiou", "aá日本語中文的", " \n\t", "!?=-'s", "01234 ", "thenginrst", "\x85\xa0 a"]
    texts = ["".join(rng.choices(rng.choice(letters), k=rng.choice([1, 3, 60, 200, 900]))) for _ in range(400)]
    return [*texts, None, "", "🙂" * 300, "the" * 5000, "a" * 20_001, " " * 3000, "it's I'll 'tis ''s", texts[0], texts[0]]


def test_bpe_is_the_library_s_and_comes_back(spark):
    ranks, library = reference_codec()
    texts = odd_texts()
    got = {r["doc_id"]: r for r in rows(bpe.encode(docs_of(spark, texts), ranks, PATTERN))}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    tokens = bpe.encode(docs_of(spark, texts), ranks, PATTERN)
    assert {r["doc_id"]: bytes(r["data"]) for r in rows(bpe.decode(tokens, ranks))} == {
        i: (t or "").encode() for i, t in enumerate(texts)}


def test_bpe_stretches_break_where_the_pattern_does(monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 7)
    ranks, library = reference_codec()
    codec = bpe.Codec(ranks, PATTERN)
    texts = odd_texts()[:200]
    codes: dict[int, bytes] = {}
    for i, part in codec.encoder().coded(texts):
        codes[i] = codes.get(i, b"") + part
    for i, text in enumerate(texts):
        assert np.frombuffer(codes[i], "<u4").tolist() == library.encode_ordinary(text or "")


def test_bpe_of_no_rows(spark):
    ranks, _ = reference_codec()
    assert bpe.digests(docs_of(spark, []), ranks, PATTERN).count() == 0


# -- secrets ---------------------------------------------------------------

SECRETS = [
    'x PassWord: "abc123" y', "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff end", "api-key=1234567", "api_key 'x'",
    "apikey:abcde secret=abcdefg", "AKIA" + "A" * 16 + " AKIAAAAA", "é token='日本' SECRET=\"//////\"", None, "",
    "paſſword=abcdefgh toKen=abcdefgh", "f" * 24 + "g" + "0" * 23, "eyJabcdefgh12.abcdefgh12.abcdefgh12",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18,
]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def test_secrets_against_the_plain_patterns(spark, tmp_path):
    small = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts = [*SECRETS, *small, SECRETS[0], SECRETS[0], "x" * 100_000 + " secret=abcdef"]
    docs_of(spark, texts).withColumn("blob", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in rows(queries.op8_secrets(spark, str(tmp_path)))}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = plain_spans(text)
        kinds = [s.split(":")[0] for s in base]
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i]["spans"].split(","))
    assert "pem:0:31" in got[12]["spans"] and "jwt:0:" in got[11]["spans"] and "prefixed:0:40" in got[13]["spans"]


def test_a_ledger_scans_a_blob_once_for_each_rule_version(spark, tmp_path):
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    first = docs_of(spark, [SECRETS[0], SECRETS[0], None, "clean"])
    ledger.scan(first)
    assert ledger.rows().count() == 3
    before = {p.name for p in (tmp_path / "ledger").rglob("*.parquet")}
    ledger.scan(docs_of(spark, [SECRETS[0], SECRETS[1]]))
    assert ledger.rows().count() == 4
    assert before <= {p.name for p in (tmp_path / "ledger").rglob("*.parquet")}
    ledger.scan(first, rule_version="2")
    assert ledger.rows("2").count() == 3 and ledger.rows().count() == 4
    assert [len(r["spans"]) for r in rows(ledger.findings(first, ["doc_id"]).orderBy("doc_id"))] == [1, 1, 0, 0]


def test_redaction_masks_spans_and_leaves_clean_rows_alone(spark, tmp_path):
    docs = docs_of(spark, [SECRETS[0], "clean", None, "a token=abcdefgh token=24be64439e3e49cf46b2d7c90f3602a3d0b907ff é"])
    got = rows(secrets.redact(docs, secrets.Ledger(spark, str(tmp_path / "l"))).orderBy("doc_id"))
    assert [r["text"] for r in got] == ['x [secret]" y', "clean", None, "a [secret] [secret] é"]
    assert [r["n_chars"] for r in got] == [13, 5, 0, 21]
    assert secrets.redact(docs_of(spark, []), secrets.Ledger(spark, str(tmp_path / "m"))).count() == 0


def test_a_private_key_is_masked_with_its_body(spark, tmp_path):
    lines = [base64.b64encode(bytes((i * 7 + k * 13) % 256 for k in range(48))).decode() for i in range(6)] + ["q83vAQ=="]
    begin, end = "-----BEGIN {}PRIVATE KEY-----", "-----END {}PRIVATE KEY-----"
    joints = ["\n", "\r\n", "\\n", "\n    ", " ", '\\n" +\n  "', "\n> ", '",\n"']
    bodies = [joint + joint.join(lines) + joint for joint in joints]
    bodies.append("\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n" + "\n".join(lines) + "\n")
    whole = ["a " + begin.format(k) + body + end.format(k) + " b" for k in ("", "RSA ", "ENCRYPTED ") for body in bodies]
    twice = f"{whole[0]} and {whole[1]}"
    cut = ["a " + begin.format("EC ") + body.rstrip('\\n" +>,\r') for body in bodies]
    more = ["a " + begin.format("") + "\n" + "\n".join(lines) + "\nThe text goes on, as it was.",
            "a " + begin.format("") + " starts a key.", "a " + begin.format("") + "\n" + lines[0][:7]]
    docs = docs_of(spark, [*whole, twice, *cut, *more])
    got = [r["text"] for r in rows(secrets.redact(docs, secrets.Ledger(spark, str(tmp_path / "l"))).orderBy("doc_id"))]
    assert got[:len(whole)] == ["a [secret] b"] * len(whole)
    assert got[len(whole)] == "a [secret] b and a [secret] b"
    for text in got:
        assert not any(line in text for line in lines), text
    assert all(text.startswith("a [secret]") for text in got)
    assert got[-3:] == ["a [secret]\nThe text goes on, as it was.", "a [secret] starts a key.", "a [secret]"]


# -- licenses --------------------------------------------------------------

def test_license_phrases_against_a_plain_search(spark, tmp_path):
    texts = ["The MIT License, mit-license and the Apache   license", "mit licenses submit license", None, "", "!!",
             "GNU General Public License mit license mit license", "général public license", "mit license",
             "mit license", "w " * 50_000 + "apache license"]
    docs_of(spark, texts).withColumn("labels", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in rows(queries.op10_licenses(spark, str(tmp_path)))}
    for i, text in enumerate(texts):
        words, places, labels = WORD.findall(lower(text)), [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [j for j in range(len(words)) if words[j:j + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def test_license_notices_are_found_with_errors_and_only_within_bounds(spark):
    notice = "Licensed under the Apache License, Version 2.0"
    texts = ["x " + notice, "We are licenced undr the apache licens version 2.0 now", "licensed to drive under a bridge",
             "Premission is hereby granted, free of charge, to any person obtaning a copy", None]
    got = [r["spans"] for r in rows(licenses.scan(docs_of(spark, texts)).orderBy("doc_id"))]
    assert [[s["label"] for s in spans] for spans in got] == [["apache"], ["apache"], [], ["mit"], []]
    assert got[0][0] == {"label": "apache", "first_word": 1, "last_word": 8, "edits": 0, "score": 1.0}
    assert (got[1][0]["first_word"], got[1][0]["last_word"], got[1][0]["edits"]) == (2, 9, 3)


def test_every_notice_within_its_bound_is_found():
    scanner, rng = licenses.Scanner(), random.Random(8)
    for notice, label in licenses.NOTICES:
        k = len(notice) // licenses.CHARS_PER_EDIT
        for _ in range(40):
            chars = list(notice)
            for _ in range(k):
                i = rng.randrange(len(chars))
                chars[i:i + 1] = rng.choice([[], ["q"], [chars[i], "z"]])
            assert label in {s["label"] for s in scanner.spans(" aa " + "".join(chars) + " bb ")}


def test_a_notice_with_edits_beside_a_better_one_is_found():
    scanner = licenses.Scanner([("hello world", "x")])
    for text, edits in (("hellx world hello world", [1, 0]), ("hello world hello wrld", [0, 1]), ("hello worl hello world helo world", [1, 0, 1])):
        assert [(s["first_word"], s["edits"]) for s in scanner.spans(text)] == [(2 * i, e) for i, e in enumerate(edits)]
    notice = "released under the mit license"
    text = " ".join(notice.replace("under", u) for u in ("undr", "under", "undxx", "unde", "under"))
    assert [(s["first_word"], s["edits"]) for s in licenses.Scanner().spans(text) if s["label"] == "mit"] == [
        (0, 1), (5, 0), (10, 2), (15, 1), (20, 0)]


@pytest.mark.parametrize("text,starts", [
    ("eyJ" * 200_000, []), ("eyJabcdefgh." * 60_000, [0]), ("xeyJabcdefgh.abcdefgh.abcdefgh", [1]), ("eyJa.eyJabcdefgh.abcdefgh.abcdefgh-", [5]),
    ("eyJeyJabcdefg.abcdefgh.abcdefgh eyJabcdefgh.abcdefg.abcdefgh", [0]), ("..eyJabcdefgh.eyJabcdefgh.eyJabcdefgh.x", [2])])
def test_tokens_in_runs_are_found_in_linear_time(text, starts):
    before = time.perf_counter()
    found = [s["start"] for s in secrets.spans_of(text) if s["kind"] == "jwt"]
    assert found[:1] == starts and time.perf_counter() - before < 5


def test_a_blob_appended_twice_counts_once(spark, tmp_path):
    docs = docs_of(spark, ["password=abcdefgh", "clean"])
    ledger = secrets.Ledger(spark, f"{tmp_path}/ledger")
    ledger.scan(docs)
    table = spark.read.parquet(ledger.path)
    table.write.mode("append").partitionBy("rule_version").parquet(ledger.path)  # another scan at the same time
    assert spark.read.parquet(ledger.path).count() == 4
    assert sorted(len(r["spans"]) for r in rows(ledger.findings(docs, ["doc_id"]))) == [0, 1]


def test_decontamination_shards_bound_a_workers_memory():
    """All words of the texts are the benchmark's, so every position is sorted; a few MB of texts must not take ten times as much."""
    words = [f"w{i}" for i in range(500)]
    suffixes = decontaminate.TestSuffixes([("a", " ".join(words).encode())], 10)
    text = " ".join(words[i * 7 % 500] for i in range(3000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 300)], ["text"])
    tracemalloc.start()
    try:
        n = sum(len(decontaminate._searched(suffixes, texts)[0]) for _, texts in decontaminate._shards([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 300
    assert peak < 40 << 20
