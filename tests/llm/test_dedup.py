"""Near-duplicate documents and embeddings against brute force; connected components."""

import math
import random
import re

import numpy as np
import pytest

from tessera.llm import embedding_dup, near_dup
from tessera.llm.components import components, shuffled_joins


def closure(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def test_components_on_random_links(spark):
    rnd = random.Random(2)
    for n, m in ((30, 20), (60, 60), (40, 0)):
        links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(100 + i, 101 + i) for i in range(20) if m]
        frame = spark.createDataFrame(links + [(None, 3), (5, 5)], "a long, b long")
        got = {r.id: r.component for r in components(frame).collect()}
        ids = {x for p in links if p[0] != p[1] for x in p}
        want = closure(ids, [p for p in links if p[0] != p[1]])
        assert got == want


@pytest.fixture(scope="module")
def family():
    """Near copies at every distance, copies, short and odd texts."""
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rnd.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rnd.randint(0, 10)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append(" ".join(words))
    for _ in range(60):
        rows.append(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))))
    rows += [rows[0].upper(), rows[3], rows[3], "a b", "A\tb", "a b c d e", "", "   ", None, "x" * 100_000, "é É", "é é"]
    return list(enumerate(rows, start=10))


def test_near_duplicates_equal_brute_force(spark, family):
    docs = spark.createDataFrame(family, "doc_id long, text string").withColumnRenamed("doc_id", "id").selectExpr(
        "id", "text", "'clash' AS k", "1 AS digest")
    got = {r.id: r for r in near_dup.near_duplicates(docs, id_col="id").collect()}
    sets = {i: shingles(t) for i, t in family}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = closure(sets, links)
    assert len(set(want.values())) > 20 and len(links) > 500
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), want[i], want[i] == i), i
    kept = near_dup.keep_one(docs, id_col="id")
    assert sorted(r.id for r in kept.collect()) == sorted(i for i in sets if want[i] == i)
    assert kept.columns == docs.columns


def test_near_duplicates_defined_cases(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "p q r s t u"), (2, "a b c d e f"),
                                  (None, "a b c d e f"), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True),
                          (3, 0, 3, True)], key=str)
    assert near_dup.near_duplicates(docs.where("false")).count() == 0


def test_large_nodes_are_compared_in_every_tree(spark):
    """One pair of equal sets in a large node of each tree, every class a component of its own."""
    rng = np.random.default_rng(9)
    size, nodes, marks, sets = near_dup.SMALL + 8, [], [], []
    for tree in range(near_dup.TREES):
        for i in range(size):
            k = 1000 * tree + i
            own = np.unique(rng.integers(0, 1 << 63, 80, dtype=np.uint64))
            if i == 1:
                own, mark = np.frombuffer(sets[-1][1], np.uint64), marks[-1][1]
            else:
                mark = rng.integers(0, 256, near_dup.TOKENS, dtype=np.uint8).tobytes()
            nodes.append(((tree + 1) * 4096 + tree, k, size, 1000 * tree))
            marks.append((k, mark))
            sets.append((k, own.tobytes()))
    nodes = spark.createDataFrame(nodes, "path long, k long, n long, centre long")
    marks = spark.createDataFrame(marks, "k long, mark binary")
    sets = spark.createDataFrame(sets, "k long, shingles binary")
    none = spark.createDataFrame([], "id long, component long")
    want = {(1000 * tree, 1000 * tree + 1) for tree in range(near_dup.TREES)}
    assert {(r.a, r.b) for r in near_dup.cross_pairs(nodes, none, marks, sets).collect()} == want
    assert {(r.a, r.b) for r in near_dup.attach(nodes, none, marks).collect()} == want


def test_chance_to_miss_a_pair_at_the_last_level():
    """All trees draw on the same tokens, m of which agree with the chance of a binomial law."""
    def apart(same):
        miss = 0.0
        for _ in range(near_dup.DEPTH):
            one = 1 - same + same * miss
            miss = (1 - near_dup.SECOND) * one + near_dup.SECOND * one * one
        return miss

    n = near_dup.TOKENS
    miss = sum(math.comb(n, m) * 0.75 ** m * 0.25 ** (n - m) * apart(m / n) ** near_dup.TREES for m in range(n + 1))
    assert miss < 1e-4 and near_dup.TREES <= near_dup.TREE_BITS + 1


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    vectors = [c + rng.normal(size=16) * s for c in centres for s in rng.uniform(0, 0.3, 12)]
    rows = [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)]
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [None] + [1.0] * 15, 0), (2003, [float("nan")] * 16, 0),
             (2004, rows[0][1], None), (2005, [], 0), (2006, [1.0] * 8, 0), (2007, [2.0] * 8, 0), (2008, [math.inf] * 16, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS k", "2 AS size")
    got = {r.vec_id: r for r in embedding_dup.near_duplicates(frame).collect()}
    good = [(i, np.array(v), y) for i, v, y in rows if v and y is not None
            and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = []
    for p, (i, v, y) in enumerate(good):
        for j, w, z in good[p + 1:]:
            if y == z and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98:
                links.append((i, j))
    want = closure([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    wrong = [i for i in degree if (got[i].n_links, got[i].component_id) != (degree[i], want[i])]
    assert not wrong and len(links) > 500
    assert embedding_dup.near_duplicates(frame.where("false")).count() == 0


def test_embeddings_of_few_directions_and_bad_rounding(spark):
    """Links whose whole offset cuts across the cells, and codes that round all components down."""
    angles = np.random.default_rng(3).uniform(0, 2 * math.pi, 300)
    rows = [(i, [math.cos(a), math.sin(a)] + [0.0] * 62, 0) for i, a in enumerate(angles.tolist())]
    down = [15.49 / 127] * 32
    rest = [math.sqrt((1 - sum(x * x for x in down)) / 32)] * 32
    rows += [(1000, down + rest, 1), (1001, [down[0] - 1e-4] + down[1:] + rest, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dup.near_duplicates(frame).collect()}
    near = np.cos(angles[:, None] - angles[None, :]) >= 0.98
    want = {i: int(n) - 1 for i, n in enumerate(near.sum(axis=1))} | {1000: 1, 1001: 1}
    wrong = {i for i in want if got[i] != want[i]}
    assert not wrong and sum(want.values()) > 2000


def test_sets_are_confirmed_inside_groups():
    import random

    import numpy as np
    from tessera.llm import near_dup
    rnd = random.Random(2)
    for _ in range(500):
        x = set(rnd.sample(range(40), rnd.randint(0, 20)))
        y = set(rnd.sample(range(40), rnd.randint(0, 20))) if rnd.random() < .5 else x | set(rnd.sample(range(40), rnd.randint(0, 6)))
        want = len(x & y) > 0 and 100 * len(x & y) >= 75 * len(x | y)
        assert near_dup.alike(np.array(sorted(x), np.uint64), np.array(sorted(y), np.uint64), 75) == want


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_steps_of_near_dup_hash_no_table_on_the_driver(spark, monkeypatch):
    """Joins of the steps stay shuffled at run time, and the session's setting is as before afterwards."""
    key, plain = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    before, seen, calls = spark.conf.get(plain), [], []
    for n in ("written", "components"):
        real = getattr(near_dup, n)
        monkeypatch.setattr(near_dup, n, lambda *a, real=real, n=n: (seen.append(spark.conf.get(key, None)), calls.append(n), real(*a))[2])
    docs = spark.createDataFrame(list(enumerate(["a b c d e f", "a b c d e f", "x y z", "a b c d e f g h i j k"])), "doc_id long, text string")
    spark.conf.set(key, "5m")
    try:
        assert sorted(r.doc_id for r in near_dup.keep_one(docs).collect()) == [0, 2, 3]
        assert seen and set(seen) == {"-1"} and spark.conf.get(key) == "5m"
        # nothing new was linked in the later steps: the components are those of the first
        assert calls.count("components") == 1
    finally:
        spark.conf.unset(key)
    spark.conf.set(plain, "-1")  # as for tables of unknown size: a sort-merge join is planned
    try:
        join = lambda: spark.range(50).join(spark.range(20), "id")
        spark.conf.set(key, "5m")
        assert "BroadcastHashJoin" in executed(join())
        with shuffled_joins(spark):
            assert "BroadcastHashJoin" not in executed(join())
        assert spark.conf.get(key) == "5m"
        spark.conf.unset(key)
        with pytest.raises(ValueError), shuffled_joins(spark):
            raise ValueError
        assert spark.conf.get(key, None) is None
    finally:
        spark.conf.unset(key)
        spark.conf.set(plain, before)
