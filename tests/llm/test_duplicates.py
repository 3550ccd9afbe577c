"""Substring removal, the Jaccard join and components, and the whole pipeline, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from stratum.llm import bpe, components, jaccard, queries, substrings
from tests.llm.test_scans import DOC, SMALL, docs_of, plain_hits, plain_spans, rows
from tests.llm.test_tables import plain_kept

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def plain_removal(found):
    first = {}
    for doc, text in sorted((r for r in found if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i:i + 50], doc)
    out = []
    for doc, text in found:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49 if doc is not None else 0):
            if first[data[i:i + 50]] < doc:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(data)))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def removed(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(df.drop("kept")))


def test_removal_over_the_small_table(spark):
    found = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert removed(queries.op3_substrings(spark, SMALL)) == plain_removal(found)


@pytest.mark.parametrize("bucket", [200_000, 40])
def test_removal_in_odd_texts(spark, monkeypatch, bucket):
    monkeypatch.setattr(substrings, "BUCKET_ANCHORS", bucket)
    rng = random.Random(4)
    base = ["".join(rng.choices("ab", k=400)), "".join(rng.choices("abcdefgh ", k=900)), "x" * 300, "é" * 100]
    found = [(None, base[0]), (5, base[0]), (5, base[0][20:]), (1, None), (2, ""), (9, "x" * 49), (10, "x" * 50), (3, base[2])]
    for doc in rng.sample(range(20, 90), 60):
        parts = [b[(k := rng.randrange(len(b))):k + rng.randrange(30, 130)] for b in rng.choices(base, k=rng.randrange(0, 6))]
        found.append((doc, rng.choice(["", "-", "%d " % doc]).join(parts)))
    found.append(found[-1])
    docs = spark.createDataFrame([(d, t, "x") for d, t in found], "doc_id long, text string, data string")
    assert removed(substrings.removal(docs.repartition(5))) == plain_removal(found)


def test_removal_over_several_blocks_and_no_rows(spark, monkeypatch):
    from stratum.llm import blocks
    monkeypatch.setattr(blocks.blocks, "__defaults__", (3000,))
    found = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()][:80]
    found += [(1000 + i, found[i % 7][1][-400:] + str(i)) for i in range(40)]
    assert removed(substrings.removal(spark.createDataFrame(found, "doc_id long, text string"))) == plain_removal(found)
    assert substrings.removal(docs_of(spark, [])).count() == 0


def test_suffixes_are_sorted_and_equals_grouped():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 1500)
    order, tied = substrings.multikey_groups(np.append(text, np.zeros(8, np.uint8)), starts, 13, np.zeros(1500, dtype=np.int64))
    found = [text[s:s + 13].tobytes() for s in starts[order]]
    assert found == sorted(found)
    assert all((a == b) == (i == j) for a, b, i, j in zip(found, found[1:], tied.tolist(), tied[1:].tolist()))


# -- Jaccard join ----------------------------------------------------------

def plain_components(found, words, share):
    sets = []
    for _, text in found:
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().translate(LOWER)) if x]
        sets.append(frozenset(zip(*[w[j:] for j in range(words)])) if len(w) >= words else frozenset([tuple(w)] if w else []))
    holders, up = defaultdict(list), list(range(len(found)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x]).items():
            if 100 * n >= share * (len(s) + len(sets[j]) - n):
                up[top(i)] = top(j)
        for x in s:
            holders[x].append(i)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(found):
        if doc is not None:
            least[top(i)].append(doc)
    return Counter((doc, len(sets[i]), min(least[top(i)], default=None)) for i, (doc, _) in enumerate(found))


def linked(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(df))


def test_components_of_the_small_table(spark):
    found = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert linked(queries.op5_jaccard(spark, SMALL)) == plain_components(found, 3, 90)


def near_copies(rng, n):
    """Texts that share boilerplate, in groups of copies with a few to many changes, and chains of copies of copies."""
    vocabulary = [f"w{i}" for i in range(300)]
    boiler = rng.choices(vocabulary, k=12)
    texts = []
    while len(texts) < n:
        text = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 9, 15, 30, 120]))
        if rng.random() < 0.5:
            text = boiler + text
        for _ in range(rng.choice([1, 2, 5, 25])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "\x0b "]).join(copy))
            if rng.random() < 0.4:
                text = copy
    return texts[:n]


@pytest.mark.parametrize("words,share,frequent,chunk", [(3, 90, 64, 512), (3, 90, 3, 4), (5, 80, 2, 3), (2, 60, 4, 50)])
def test_components_of_near_copies(spark, monkeypatch, words, share, frequent, chunk):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    texts = near_copies(random.Random(words * share + frequent), 260)
    found = [*enumerate(texts), (900, None), (901, ""), (902, " \t"), (903, texts[0]), (903, texts[0]), (904, texts[3].upper()),
             (None, texts[5]), (None, "alone and nameless"), (7, "one id two texts"), (905, "q " * 9000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in found], "doc_id long, text string, cls long").repartition(6)
    assert linked(jaccard.link(docs, words=words, share=share)) == plain_components(found, words, share)


def test_join_of_no_rows_and_of_texts_without_words(spark):
    assert jaccard.link(docs_of(spark, [])).count() == 0
    assert linked(jaccard.link(docs_of(spark, [None, "", " "]))) == Counter([(i, 0, i) for i in range(3)])
    assert [r["doc_id"] for r in rows(jaccard.keep_one(docs_of(spark, ["a b c", None, "A b\nc", "d"])).orderBy("doc_id"))] == [0, 1, 3]


@pytest.mark.parametrize("n_sets", [0, 10**12])
def test_linked_sets_keep_a_key_in_common(n_sets):
    rng = np.random.default_rng(2)
    for share in (60, 80, 90):
        rule = jaccard.Rule(share, 100)
        starts = rule.bands(700)
        plan = jaccard.Plan(rule, starts, dict.fromkeys(range(len(starts)), n_sets))
        for _ in range(300):
            n = int(rng.integers(1, 600))
            one = rng.integers(0, 1 << 62, n).astype(np.uint64)
            # as many changes as a link allows: some shingles go, some come
            lost = int(rng.integers(0, n + 1))
            come = int(rng.integers(0, n + 1))
            while 100 * (n - lost) < share * (n + come):
                lost, come = lost * 9 // 10, come * 9 // 10
            other = np.concatenate([one[lost:], rng.integers(0, 1 << 62, come).astype(np.uint64)])
            band = min(plan.bands_of(n)[-1], plan.bands_of(len(other))[-1])
            assert band in plan.bands_of(n) and band in plan.bands_of(len(other))
            allocation = plan.allocations[band]
            differ = len(np.setxor1d(one, other))
            assert differ <= min(allocation.differ(len(one)), allocation.differ(len(other)))
            if differ:
                # how often a key occurs, as any function of the key; a key that both have isn't rare at random
                both, odds = [], int(rng.integers(1, 4))
                for s in (one, other):
                    keys, segment = allocation.keys(band, s)
                    often = (keys >> np.uint64(20)).astype(np.int64) % (4 * odds)
                    kept = allocation.kept(len(s), keys, segment, often, 5)
                    assert allocation.deletions or len(kept) <= allocation.needed(len(s)) + 1
                    both.append(keys[kept])
                assert len(np.intersect1d(*both))
            assert np.bitwise_count(allocation.odd_sketch(one) ^ allocation.odd_sketch(other)).sum() <= differ


def test_deletions_find_what_segments_alone_would_not():
    rule = jaccard.Rule(90, 100)
    allocation = jaccard.Allocation.cheapest(rule, 9, 17, 10_000_000)
    assert allocation.deletions
    one = np.arange(16, dtype=np.uint64)
    assert len(np.intersect1d(allocation.keys(3, one)[0], allocation.keys(3, one[1:])[0])) > 0


def test_a_set_with_too_few_segments_meets_others_like_it():
    allocation = jaccard.Allocation(jaccard.Rule(80, 100), 625, 40, False, 64)
    rng = np.random.default_rng(5)
    one, other = (allocation.keys(2, rng.integers(0, 1 << 62, 600).astype(np.uint64)) for _ in range(2))
    assert (one[1] < 0).sum() == (other[1] < 0).sum() == 1 and one[0][one[1] < 0] == other[0][other[1] < 0]
    often = np.full(len(one[0]), 9)
    assert one[1][allocation.kept(600, *one, often, 5)].min() == -1


def test_unrelated_texts_share_no_frequent_key(spark, monkeypatch):
    """Texts of uneven lengths at a share of 0.8: none of their kept keys is frequent, so no cluster forms."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(4000)], k=rng.choice([40, 120, 300, 700, 900]))) for _ in range(300)]
    seen = []
    plain = jaccard._clusters
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    monkeypatch.setattr(jaccard, "_clusters", lambda *args: seen.append(1) or plain(*args))
    assert linked(jaccard.link(docs_of(spark, texts))) == plain_components(list(enumerate(texts)), 5, 80)
    assert not seen


def test_a_group_of_near_copies_closes_at_its_hub(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in rng.choices(range(4000), k=200)]
    texts = []
    for _ in range(400):
        copy = list(base)
        copy[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    clusters = []
    monkeypatch.setattr(jaccard, "_clusters", lambda *args: clusters.append(args))
    assert {r["component_id"] for r in rows(jaccard.link(docs_of(spark, texts)))} == {0}
    assert not clusters


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["component"] for r in rows(components.components(spark.createDataFrame(links, "a long, b long")))}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- the pipeline ----------------------------------------------------------

def test_pipeline_against_plain_stages(spark):
    found = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in rows(kept)}
    verdicts = plain_kept([(r.doc_id, r.text, r.lang, r.source) for r in found.values()])
    assert left == {d: found[d].text for d, stays in verdicts.items() if stays}
    least = plain_components(list(left.items()), 5, 80)
    left = {d: left[d] for d, _, c in least if d == c}
    left = {d: t for d, t in left.items() if not plain_hits(t, bench)[1]}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    got = {r["doc_id"]: r for r in rows(corpus_pipeline.run(spark, SMALL))}
    assert got.keys() == left.keys()
    for doc, text in left.items():
        if plain_spans(text):
            assert not plain_spans(library.decode(got[doc]["ids"]))
        else:
            assert got[doc]["ids"] == library.encode_ordinary(text)
        assert got[doc]["n_tokens"] == len(got[doc]["ids"])


def test_each_stage_takes_odd_rows_and_no_rows(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", None, "s", 0, "x"), (1, "", None, "s", 0, "x"),
         (2, "token=abcdefgh " * 20_000, "en", None, 0, "x"), (3, "a b c d e f g h i j k l m", "en", "s", 0, "x")],
        DOC + ", spans string")
    for docs, n in ((odd, 5), (odd.where("false"), 0)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, SMALL)
            found = rows(out)
            assert len(found) <= n, name
            if name != "byte_bpe":
                assert out.columns == docs.columns
            if name != "near_duplicates":
                assert len(found) == n, name
        assert {r["doc_id"] for r in rows(corpus_pipeline.quality_rules(spark, docs, SMALL))} == ({3} if n else set())
    masked = {r["doc_id"]: r for r in rows(corpus_pipeline.secret_scan(spark, odd, SMALL))}
    assert masked[2]["text"] == "[secret] " * 20_000 and masked[2]["n_chars"] == 180_000 and masked[3]["n_chars"] == 0


def test_all_are_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_against_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = queries.QUERIES[name](spark, SMALL)
    expected = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(found.columns)
    assert Counter(tuple(r[c] for c in columns) for r in rows(found)) == Counter(expected.fetchall())
