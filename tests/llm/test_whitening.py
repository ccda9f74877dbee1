"""Whitening against numpy's dense eigenvectors."""
import numpy as np
import pytest

from conftest import SF_SMALL
from tessera.llm import registry, whitening


def dense(vectors, k):
    u = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, total = len(u), u.sum(axis=0)
    x = (n * u - total) / n
    values, turn = np.linalg.eigh(x.T @ x / n)
    values, turn = values[::-1], turn[:, ::-1]
    return ((n * u - total) ** 2).sum(axis=1), x @ turn[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def compare(rows, vectors, k, tolerance):
    deviation, white, share = dense(list(vectors.values()), k)
    got = {(r.vec_id, r.component): r for r in rows}
    assert set(got) == {(i, c + 1) for i in vectors for c in range(k)}
    w = np.array([[got[i, c + 1].whitened for c in range(k)] for i in vectors])
    assert np.abs(w * np.sign((w * white).sum(axis=0)) - white).max() < tolerance
    for j, i in enumerate(vectors):
        for c in range(k):
            r = got[i, c + 1]
            assert r.deviation == deviation[j] and r.n == len(vectors)
            assert abs(r.explained / share[c] - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_equals_dense_eigenvectors(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    rows = registry.op13_whitening(spark, SF_SMALL).collect()
    compare(rows, vectors, 32, 1e-9)


def test_odd_rows_are_left_out(spark):
    rng = np.random.default_rng(3)
    good = {i: [float(v) for v in np.round(rng.standard_normal(6) * [9, 5, 3, 2, 1, .5], 3)] for i in range(60)}
    good[60] = good[0]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [float("nan")] * 6), (104, [float("inf")] * 6), (105, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", -1.0) for i, v in [*good.items(), *odd]],
                               "vec_id long, embedding array<double>, whitening string, component double").repartition(3)
    model = whitening.fit(df, components=4, guard=1)
    compare(whitening.components_of(df, model).collect(), good, 4, 1e-8)
    kept = whitening.whiten(df, model)
    assert kept.columns == df.columns and kept.count() == len(good)  # the column of that name is replaced
    ids = df.selectExpr("CAST(NULL AS STRING) AS vec_id", "embedding")
    assert whitening.components_of(ids, model).where("vec_id IS NULL").count() == 4 * len(good)


def test_filter_damps_a_flat_spectrum(spark):
    """A block much thinner than the vectors, values close together: many filtered cycles."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    x = (rng.standard_normal((900, 120)) * np.linspace(12, 8, 120)) @ turn
    vectors = {i: [float(v) for v in row] for i, row in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(4)
    model = whitening.fit(df, components=5, guard=8)
    assert len(model["values"]) == 5
    compare(whitening.components_of(df, model).collect(), vectors, 5, 1e-7)


def test_more_tasks_than_reducers(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 1)
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 40)
    rng = np.random.default_rng(8)
    vectors = {i: [float(v) for v in rng.standard_normal(8) * 50] for i in range(400)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(24)
    compare(whitening.components_of(df, whitening.fit(df, components=3, guard=2)).collect(), vectors, 3, 1e-8)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_no_variance_no_component(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(df)
    assert len(model["values"]) == 0 and model["identity_error"] == 0
    out = whitening.components_of(df, model)
    assert out.count() == 0
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_rank_below_the_components(spark):
    rng = np.random.default_rng(9)
    a = rng.integers(-40, 40, (50, 2)).astype(float)
    df = spark.createDataFrame([(i, [x, y, x + y, x - y]) for i, (x, y) in enumerate(a.tolist())], "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    assert len(model["values"]) == 2 and model["identity_error"] < 1e-9
    assert abs(sum(model["values"]) / model["trace"] - 1) < 1e-12


def test_large_entries_stay_exact(spark):
    n, far = 3, 2.0 ** 50
    vectors = [[far, 1.0], [-far, 3.0], [0.0, 5.5]]
    u = [[int(64 * v) for v in row] for row in vectors]
    total = [sum(c) for c in zip(*u)]
    want = [sum((n * v - t) ** 2 for v, t in zip(row, total)) for row in u]
    assert whitening.deviations(np.array(u), n, total) == want
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    assert model["total"] == total
    assert sorted(int(r[0]) for r in whitening.whiten(df, model).select("whitening.deviation").collect()) == sorted(want)
    with pytest.raises(Exception, match="too large"):
        whitening.fit(spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<double>"))
