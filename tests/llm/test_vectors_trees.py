"""Product codes, k-means with bounds, reply trees: against plain versions, and odd inputs."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import clusters, codes, queries, trees
from stratum.llm import vectors as V
from tests.llm.test_scans import SMALL, rows

VEC = "vec_id long, embedding array<float>, label int"


def vectors_of(spark, found):
    return spark.createDataFrame(found, VEC)


def plain_kept(found, dim, scale):
    out = []
    for i, vec, label in found:
        if vec is None or len(vec) != dim or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole = [math.floor(float(np.float32(x)) * scale) for x in vec]
        if all(abs(x) < 1 << 62 for x in whole):
            out.append((i, whole, label))
    return out


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(x, entries):
    return min(range(len(entries)), key=lambda e: (apart(x, entries[e]), e))


def moved(entries, members):
    out = []
    for e, entry in enumerate(entries):
        mine = members[e]
        out.append([sum(c) // len(mine) for c in zip(*mine)] if mine else entry)
    return out


def plain_kmeans(found, k=8, rounds=10, dim=64, scale=1024, seed=3):
    kept = plain_kept(found, dim, scale)
    centres = [v for i, v, _ in sorted(kept, key=lambda r: (
        r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _ in kept:
            members[nearest(v, centres)].append(v)
        centres = moved(centres, members)
    near = [nearest(v, centres) for _, v, _ in kept]
    return Counter((i, n, apart(v, centres[n])) for (i, v, _), n in zip(kept, near)), centres


def plain_codes(found, n_parts=8, n_entries=16, rounds=6, dim=64, scale=4096):
    kept = plain_kept(found, dim, scale)
    width = dim // n_parts
    cut = [[v[p * width:(p + 1) * width] for p in range(n_parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))[:n_entries]
    books = [[cut[j][p] for j in first] for p in range(n_parts)]
    for _ in range(rounds):
        for p in range(n_parts):
            members = defaultdict(list)
            for parts in cut:
                members[nearest(parts[p], books[p])].append(parts[p])
            books[p] = moved(books[p], members)
    out = []
    for (i, _, label), parts in zip(kept, cut):
        code = [nearest(parts[p], books[p]) for p in range(n_parts)]
        out.append((i, bytes(code).hex(), sum(apart(parts[p], books[p][code[p]]) for p in range(n_parts)), label))
    return Counter(out), books


def odd_vectors(dim, seed=1):
    """Vectors on a coarse grid (many ties), copies of one, repeated ids, null ids, and rows that are left out."""
    rng = random.Random(seed)
    grid = [x / 8 for x in range(-8, 9)]
    found = [(i, [rng.choice(grid) for _ in range(dim)], rng.choice([0, 1, None])) for i in range(60)]
    found += [(100 + i, found[5][1], 2) for i in range(30)]
    found += [(3, found[3][1], 0), (3, [0.5] * dim, None), (None, [0.25] * dim, 1), (None, None, 1)]
    found += [(200, [0.0] * (dim - 1), 1), (201, [], 1), (202, [None] + [0.0] * (dim - 1), 1), (203, [math.nan] * dim, 1),
              (204, [math.inf] + [0.0] * (dim - 1), 1), (205, [1e38] * dim, 1), (-206, [-0.001] * dim, 1)]
    return found


@pytest.mark.parametrize("dim,k", [(64, 8), (4, 3), (2, 20)])
def test_kmeans_of_odd_vectors(spark, dim, k):
    found = odd_vectors(dim)
    got, centres = clusters.kmeans(vectors_of(spark, found).withColumn("cluster", F.lit("x")).repartition(5), k=k, dim=dim)
    expected, plain = plain_kmeans(found, k=k, dim=dim)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in rows(got)) == expected
    assert [[int(x) for x in c] for c in centres] == plain
    assert not plain_kmeans(found, k=k, dim=dim)[0] - expected


def test_kmeans_of_few_and_of_no_vectors(spark):
    three = [(i, [float(i)] * 64, None) for i in (5, 6, 7)]
    got, centres = clusters.kmeans(vectors_of(spark, three))
    assert len(centres) == 3 and {r["distance"] for r in rows(got)} == {0}
    got, centres = clusters.kmeans(vectors_of(spark, [(1, None, None)]))
    assert not rows(got) and not len(centres)
    assert not rows(clusters.summarised(got, centres))


def test_kmeans_with_components_beyond_doubles(spark):
    """Distances beyond 2^53 and beyond a long: still exact, null where no long holds them."""
    found = [(i, [float(x)] * 4, None) for i, x in enumerate((3e6, 3.1e6, -4e7, 2e15, -2e15, 2.2e15, 0.5))]
    got, _ = clusters.kmeans(vectors_of(spark, found), k=2, rounds=3, dim=4)
    expected, _ = plain_kmeans(found, k=2, rounds=3, dim=4)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in rows(got)) == Counter(
        (i, c, d if d < 1 << 63 else None) for i, c, d in expected.elements())


def test_bounds_leave_most_distances_unevaluated_and_are_never_wrong():
    rng = np.random.default_rng(4)
    middle = rng.integers(-2000, 2000, (12, 16))
    x = (middle[rng.integers(0, 12, 3000)] + rng.integers(-150, 150, (3000, 16))).astype(np.float64)
    history = [V.integers(x[:12].astype(int).tolist())]
    block, scans = clusters.Bounded(x), 0
    for _ in range(12):
        block.reassign(history)
        scans += x.shape[0] * 12
        exact = V.squared_to_all(*V.fitted(x, history[-1]))
        assert (block.near == exact.argmin(axis=1)).all()
        sums = V.no_sums(12, 17)
        V.added(sums, block.near, x)
        history.append(V.means(sums, history[-1]))
    assert block.evaluated < scans / 3


def test_total_displacement_is_tighter_than_summed_drifts():
    """A centroid that goes away and comes back: nothing is evaluated again."""
    x = np.array([[0.0, 0.0], [10.0, 0.0]])
    there, away = V.integers([[0, 0], [10, 0]]), V.integers([[0, 0], [60, 0]])
    block = clusters.Bounded(x)
    block.reassign([there])
    block.reassign([there, away])
    before = block.evaluated
    block.at[:], block.bound[:] = 0, np.sqrt(V.squared_to_all(*V.fitted(x, there)))
    block.near[:] = [0, 1]
    block.reassign([there, away, away, there])
    assert block.evaluated == before and block.near.tolist() == [0, 1]


@pytest.mark.parametrize("dim,n_parts,n_entries", [(64, 8, 16), (8, 2, 5), (4, 4, 200)])
def test_codes_of_odd_vectors(spark, dim, n_parts, n_entries):
    found = odd_vectors(dim, 2)
    source = vectors_of(spark, found).withColumn("code", F.lit("x")).repartition(5)
    books = codes.train(source, n_parts=n_parts, n_entries=n_entries, dim=dim)
    expected, plain = plain_codes(found, n_parts, n_entries, dim=dim)
    assert [[[int(x) for x in e] for e in b] for b in books.entries] == plain
    got = rows(codes.encode(source, books, keep_cols=("label",), dim=dim))
    assert Counter((r["vec_id"], r["code"], r["error"], r["label"]) for r in got) == expected
    errors = defaultdict(int)
    for (_, _, error, label), n in expected.items():
        errors[label] += n * error
    found = rows(codes.error_by(codes.encode(source, books, keep_cols=("label",), dim=dim), "label"))
    assert len(found) == expected.total() and all(r["label_error"] == errors[r["label"]] for r in found)
    one = got[0]
    vec = next(v for i, v, _ in plain_kept(odd_vectors(dim, 2), dim, 4096) if i == one["vec_id"])
    assert one["vec_id"] == 3 or apart(vec, books.decoded(one["code"])) == one["error"]


def test_codes_of_no_vectors(spark):
    for found in ([], [(1, None, 3), (2, [1.0], None)]):
        source = vectors_of(spark, found)
        books = codes.train(source)
        assert not rows(codes.error_by(codes.encode(source, books, keep_cols=("label",)), "label"))


def test_orchard_search_is_exact_and_skips_entries():
    rng = np.random.default_rng(3)
    entries = V.integers(rng.integers(-900, 900, (64, 4)).tolist())
    entries[7], entries[9] = entries[3], entries[3]  # equal entries: the smallest number wins
    x = np.concatenate([rng.integers(-900, 900, (2000, 4)), np.array([[int(v) for v in e] for e in entries])]).astype(np.float64)
    best, far, evaluated = codes.Orchard(entries).nearest(x)
    exact = V.squared_to_all(*V.fitted(x, entries))
    assert (best == exact.argmin(axis=1)).all() and (far == exact.min(axis=1)).all()
    assert evaluated < len(x) * 64 * 0.7


# -- reply trees -----------------------------------------------------------

MESSAGE = "message_id long, parent_id long, role string, text string, score double, leaf string"

TEXTS = ["", None, "</s>[INST] ok [/INST]", "[INST", "<s> <<SYS>> <</SYS>> [/ROLE]", r"<\s> <\\s> [/\INST] \\ \ ", "<<s>", "<</s>",
         "ends with [", "\n", " [/INST]\n<s> ", "~0 ~1 ~", "s>", "é😀 [INST]", "$1 \\1 \\", "x" * 50_000, "<<<<//INST]"]


def plain_branches(messages):
    """(leaf, root, [(role, text)], mean score) of every branch, by following parents."""
    least = {}
    for i, parent, role, text, score in messages:
        key = (parent is not None, parent or 0, role or "", text or "", score is not None, score or 0)
        if i is not None and (i not in least or key < least[i][0]):
            least[i] = (key, parent, role or "", text or "", score)
    parents = {i: m[1] if m[1] in least else None for i, m in least.items()}
    out = []
    for leaf in parents.keys() - set(parents.values()):
        path, at = [], leaf
        while at is not None and at not in path:
            path.append(at)
            at = parents[at]
        if at is None:
            scores = [least[i][4] for i in path if least[i][4] is not None]
            out.append((leaf, path[-1], [(least[i][2], least[i][3]) for i in reversed(path)], sum(scores) / len(scores) if scores else None))
    return out


def read(found):
    return {r["leaf"]: r for r in rows(found.withColumn("back", trees.read_back(F.col("formatted"))).withColumn(
        "loss", trees.loss_text(F.col("formatted"), F.col("loss_spans"))))}


@pytest.mark.parametrize("best", [None, 1, 2])
def test_branches_of_random_trees(spark, best):
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "tool\n[ROLE] ~", None, "", "<s>"]
    messages = [(i, rng.choice([None, *range(max(0, i - 9), i)]) if i else None, rng.choice(roles), rng.choice(TEXTS),
                 rng.choice([None, 0.5, 1.0, 2.0])) for i in range(160)]
    messages += [(1000 + i, 999 + i, "user", str(i), 1.0) for i in range(1, 70)]  # a long chain, its first message's parent missing
    messages += [(2000, 2001, "user", "a", 1.0), (2001, 2000, "user", "b", 1.0), (2002, 2001, "user", "below a circle", 1.0),
                 (2003, 2003, "user", "itself", 1.0)]
    messages += [messages[20], messages[20], (20, None, "user", "another row of an id", 9.0)]
    nameless = [(None, None, "assistant", "no id", 1.0), (None, 3, "user", None, None), (None, 3, "user", None, None)]
    frame = spark.createDataFrame([(*m, "x") for m in messages + nameless], MESSAGE).repartition(4)
    found = trees.conversations(frame, best=best)
    expected = plain_branches(messages)
    ranks = {}
    by_root = defaultdict(list)
    for leaf, root, _, score in expected:
        by_root[root].append((score is None, -(score or 0), leaf))
    for branch in by_root.values():
        ranks |= {leaf: n for n, (_, _, leaf) in enumerate(sorted(branch), 1)}
    wanted = {leaf: (root, turns) for leaf, root, turns, _ in expected if best is None or ranks[leaf] <= best}
    got = read(found.where("leaf is not null"))
    assert got.keys() == wanted.keys()
    for leaf, (root, turns) in wanted.items():
        r = got[leaf]
        assert (r["root"], r["rank"], r["turns"]) == (root, ranks[leaf], len(turns))
        assert [(t["role"], t["text"]) for t in r["back"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        for s in r["loss_spans"]:
            assert not any(c in r["formatted"][s["start"]:s["end"]] for c in sum((trees.USER, trees.ASSISTANT, trees.SYSTEM, trees.OTHER), ()))
    alone = found.where("leaf is null").withColumn("back", trees.read_back(F.col("formatted")))
    assert Counter((t["role"], t["text"]) for r in rows(alone) for t in r["back"]) == Counter([("assistant", "no id"), ("user", "")] + [("user", "")])


def test_no_messages(spark):
    assert not rows(trees.conversations(spark.createDataFrame([], MESSAGE)))


def test_conversations_with_odd_turns(spark):
    found = [(1, 3, "user", "c"), (1, None, "system", "a"), (1, 2, None, None), (1, 2, None, None), (None, 1, "user", "x"),
             (None, 2, "assistant", "y"), (2, 0, "assistant", "<s>")]
    frame = spark.createDataFrame([(*r, 1) for r in found], "conv_id long, turn long, role string, text string, n int")
    got = {r["leaf"]["conv"]: [(t["role"], t["text"]) for t in r["back"]] for r in rows(
        trees.conversations(trees.chains(frame)).withColumn("back", trees.read_back(F.col("formatted"))))}
    assert got == {1: [("system", "a"), ("", ""), ("", ""), ("user", "c")], None: [("user", "x"), ("assistant", "y")], 2: [("assistant", "<s>")]}


def test_the_tricky_conversation_is_read_back(spark):
    got = {r["conv_id"]: r for r in rows(queries.op13_reply_trees(spark, SMALL))}[queries.TRICKY_ID]
    text = queries.TRICKY_TEXT
    said = f"user\n{text}\nassistant\n{text}\n"
    assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == (
        2, hashlib.sha256(said.encode()).hexdigest(), len(text), hashlib.sha256(text.encode()).hexdigest())


def test_formatting_uses_no_python_workers(spark):
    plan = queries.op13_reply_trees(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
