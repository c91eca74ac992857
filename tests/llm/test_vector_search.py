import numpy as np
import pytest

from arcash.llm import vector_search as V


def brute(rows, ok, k=20):
    ids = sorted(i for i in ok)
    x = np.array([rows[i] for i in ids], np.float32).astype(float)
    out = {}
    for a, i in enumerate(ids):
        if i % 20 == 0:
            s = (x * x[a]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if j != a][:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_small_table_is_exact_with_ties_and_bad_rows(spark, tables):
    rng = np.random.default_rng(2)
    v = {i: [float(x) for x in rng.integers(-2, 3, 4)] for i in range(100)}
    rows = [(i, x, 0) for i, x in v.items()] + [
        (200, None, 0), (220, [0.0] * 4, 0), (240, [1.0, None, 0.0, 0.0], 0), (260, [float("nan")] * 4, 0),
        (280, [float("inf"), 0.0, 0.0, 0.0], 0), (300, [1.0, 2.0], 0), (None, [1.0] * 4, 0), (40, v[40], 5)]
    got = results(V.op9_vector_search(spark, tables(embeddings=rows)))
    assert got == brute(v, [i for i in v if any(v[i])])
    few = tables(embeddings=[(0, [1.0, 0.0], 1), (20, [1.0, 1.0], 1), (3, [0.5, 0.0], 1)])
    assert results(V.op9_vector_search(spark, few)) == {0: [(20, 1.0), (3, 0.5)], 20: [(0, 1.0), (3, 0.5)]}
    assert V.op9_vector_search(spark, tables(embeddings=[])).collect() == []
    assert V.op9_vector_search(spark, tables(embeddings=[(0, [1.0], 1)])).collect() == []


@pytest.mark.parametrize("hot", [False, True])
def test_recall_against_brute_force(spark, tables, hot):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((10, 32))
    x = (centre[rng.integers(0, 10, 3000)] + rng.standard_normal((3000, 32))).astype(np.float32)
    if hot:
        x[::3] = x[0]                     # a third of all rows are copies
    v = {i: [float(t) for t in x[i]] for i in range(3000)}
    d = tables(embeddings=[(i, t, 0) for i, t in v.items()])
    got = results(V.search(spark.read.parquet(f"{d}/embeddings.parquet"), "vec_id % 20 = 0",
                           max_parts=8, cell_rows=200, cell_queries=30))
    want = brute(v, v)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    share = np.mean([len({a for a, _ in got[i]} & {a for a, _ in want[i]}) / 20 for i in want])
    assert share >= 0.9
    assert all(s == dict(want[i]).get(a, s) for i in want for a, s in got[i])


def test_parts_are_balanced_and_probes_fewer_than_parts():
    rng = np.random.default_rng(1)
    x = np.repeat(rng.standard_normal((16, 24)), 128, axis=0) * 2 + rng.standard_normal((2048, 24))
    label = V.balanced_parts(V.neighbours(x, 10), 8)
    assert np.bincount(label).tolist() == [256] * 8
    index = V.Index(x.tolist(), 8, 0.96, 20)
    assert index.parts == 8 and index.probes < 8
