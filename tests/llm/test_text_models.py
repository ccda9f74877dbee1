"""Language ID, toxicity, quality: held-out accuracy, and the defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id, quality, registry, toxicity
from tessera.llm.blocks import fold

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "123 !!"), (4, "the and of"), (4, "the and of"), (None, "der und die"), (6, "x" * 300_000)]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", F.lit("clash"))


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = registry.op10_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_defined_cases(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, learn=fold("doc_id", 4) != 2)
    got = [(r.doc_id, r.language.lang) for r in language_id.identify(odd, model).collect()]
    assert [k for i, k in got if i in (1, 2, 3)] == ["und"] * 3
    assert len({k for i, k in got if i == 4}) == 1 and len(got) == len(ODD)
    empty = docs.where("false")
    nothing = language_id.fit(empty, learn=F.lit(True))
    assert {r.language.lang for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_language_sample_is_cut_before_the_driver(spark, monkeypatch):
    """At most per_language rows of a language are collected, of however many and whatever their ids."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('the word ', id) AS text", "'en' AS lang")
    docs = docs.unionByName(spark.range(30).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('das Wort ', id) AS text", "'de' AS lang"))
    taken, collect = [], type(docs).toArrow

    def counted(frame):
        taken.append(collect(frame))
        return taken[-1]

    monkeypatch.setattr(type(docs), "toArrow", counted)
    model = language_id.fit(docs, learn=F.lit(True), per_language=20)
    assert model["langs"] == ["de", "en"]
    langs = taken[0].column("lang").to_pylist()
    assert (langs.count("en"), langs.count("de"), len(taken)) == (20, 20, 1)


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = registry.op4_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.toxic for r in rows]), np.array([r.predicted for r in rows])
    assert p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.01


def words_and_stems(text):
    words = toxicity.plain_words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    return set(toxicity.pieces(words)[0].tolist())


def test_toxicity_lexicon_of_a_fold_has_not_seen_it(spark):
    """Each lexicon equals one counted in plain Python without its fold."""
    rng = np.random.default_rng(3)
    only = ["aspen", "birch", "cedar"]  # toxic rows of one fold alone say it
    rows = []
    for i in range(160):
        y = int(i % 4 == 0)
        own = [f"w{k}" for k in rng.integers(0, 30, 12)] + [f"bad{k}" for k in rng.integers(0, 6, 3 * y)]
        rows.append((" ".join(own + ([only[i % 3]] if y else [])), float(y), i, i % 3))
    frame = spark.createDataFrame(rows, "text string, y double, h long, part long").repartition(4)
    got = toxicity.learn_lexicons(frame, 3, min_docs=2, max_entries=9)
    for left_out in range(4):
        used = [(words_and_stems(t), y) for t, y, _, part in rows if part != left_out]
        n1 = sum(y for _, y in used)
        n0 = len(used) - n1
        best = []
        for h in set().union(*[s for s, _ in used]):
            n, pos = sum(h in s for s, _ in used), sum(y for s, y in used if h in s)
            odds = np.log((pos + 0.5) / (n1 + 1)) - np.log((n - pos + 0.5) / (n0 + 1))
            if pos >= 2 and odds > 2.5:
                best.append((-odds * np.log1p(pos), int(np.uint64(h).view(np.int64)), h))
        assert got[left_out].tolist() == sorted(h for _, _, h in sorted(best)[:9]) and best
    whole = toxicity.learn_lexicons(frame, 3, min_docs=2, max_entries=1000)
    assert [bool(set(x.tolist()) & words_and_stems("birch")) for x in whole] == [True, False, True, True]
    one_class = toxicity.learn_lexicons(frame.where("y = 0"), 3, 2, 9)
    assert [len(x) for x in one_class] == [0] * 4


def test_toxicity_defined_cases(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.unionByName(labels.limit(1).withColumn("toxic", F.lit(None).cast("int"))))
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert toxicity.score(odd.where("false"), model).count() == 0
    few = labels.where("doc_id is not null").orderBy("doc_id").limit(3).withColumn("toxic", F.col("doc_id").cast("int") % 2)
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, toxicity.fit(docs, few)).collect())
    bare = toxicity.fit(docs, labels.where("false"))
    assert {r.score for r in toxicity.score(odd, bare).collect()} == {0.5}


def test_isotonic_is_nearest_monotone_curve():
    rng = np.random.default_rng(0)
    score, y = rng.integers(0, 12, 80).astype(float), rng.integers(0, 2, 80)
    knots, values = toxicity.isotonic(score, y)
    assert (np.diff(knots) > 0).all() and (np.diff(values) > -1e-9).all()
    # every block's value is the mean of its members
    at = np.searchsorted(knots, score, side="right") - 1
    for k in range(len(knots)):
        mean = y[at == k].mean()
        assert abs(values[k] - mean) < 1e-9 or mean in (0.0, 1.0)


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = registry.op8_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.predicted for r in rows])
    assert p[y == 1].mean() > 0.97 and p[y == 0].mean() < 0.08


def test_quality_defined_cases(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    bare = quality.fit(docs, labels.where("false"))
    assert {round(r.score, 6) for r in quality.score(odd, bare).collect()} == {0.5}
