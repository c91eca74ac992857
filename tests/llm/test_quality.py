import random
import zlib

import numpy as np
import pytest

from arcash.llm import quality as Q
from arcash.llm.common import Scratch
from tests.llm.helpers import doc


def corpus(n=500, seed=4):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgklm" for b in ("a", "ero", "inth", "ought", "ell")]
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randrange(30, 90))]
        poor = i % 5 == 0 if i % 2 else i % 7 == 0
        if poor:
            w = [x + rnd.choice(["###", "$$$"]) for x in w]
        rows.append(doc(i, " ".join(w), source=rnd.choice(["a", "b"]) if not poor else rnd.choice("cab")))
        if i < n // 2:
            labels.append((i, int(not poor), 0))
    return rows, labels, lambda i: i % 5 == 0 if i % 2 else i % 7 == 0


def test_held_out_accuracy_and_edges(spark, tables):
    rows, labels, poor = corpus()
    extra = [doc(9001, None), doc(9002, ""), doc(9003, "bero " * 40000), (9004, "kell gero", None, None, None),
             doc(None, "x"), doc(4, rows[4][1])]
    got = Q.op1_quality(spark, tables(documents=rows + extra, labels=labels + [(3, None, 0), (None, 1, 0)])).toPandas()
    assert len(got) == len(rows) + 6 and got[["content_score", "metadata_score", "score"]].notna().all().all()
    assert got.score.between(0, 1).all() and (got.keep == (got.score >= 0.5)).all()
    held = got[got.held_out.astype(bool) & (got.doc_id < 500)]
    assert [zlib.crc32(str(int(i)).encode()) % 5 for i in held.doc_id] == [0] * len(held)
    assert (held.keep == [not poor(int(i)) for i in held.doc_id]).mean() >= 0.95


def test_no_labels_and_empty(spark, tables):
    got = Q.op1_quality(spark, tables(documents=[doc(1, "a b"), doc(2, None)], labels=[])).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert Q.op1_quality(spark, tables(documents=[], labels=[(1, 1, 0)])).collect() == []
    one_class = tables(documents=[doc(i, f"t{i}") for i in range(30)], labels=[(i, 1, 0) for i in range(30)])
    assert all(r.keep for r in Q.op1_quality(spark, one_class).collect())


def view_rows(y, rng):
    """Each view alone sees the class through its own coordinates."""
    return [(np.array([int(c * 10 + rng.integers(0, 10))]), np.array([100 + int(c * 10 + rng.integers(0, 10))])) for c in y]


def feature_table(spark, rows, ids=None):
    ids = range(len(rows)) if ids is None else ids
    return spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in zip(ids, rows)],
                                 "doc_id long, content array<int>, metadata array<int>").repartition(3)


def label_table(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int")


@pytest.fixture(params=["true", "false"])
def arrow(spark, request):
    """Sessions with and without Arrow in toPandas."""
    name = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


def test_views_exchange_pseudo_labels(spark, arrow):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 600).astype(float)
    rows = view_rows(y, rng)
    m = Q.fit(feature_table(spark, rows[:400]), label_table(spark, [(i, int(c)) for i, c in enumerate(y[:40])]),
              Scratch(spark, "test"), bits=8, rounds=4, share=0.2, sure=0.6)
    assert sum(n for pair in m.exchanged for n in pair) > 50
    right = [(m.scores(*rows[i])[2] >= 0.5) == y[i] for i in range(400, 600)]
    assert np.mean(right) >= 0.95 and (m.line[:2] >= 0).all()


def own_ids(n, start=0):
    return [i for i in range(start, start + 3 * n) if zlib.crc32(str(i).encode()) % 5][:n]


def test_confident_documents_outside_the_labelled_sample_teach_the_other_view(spark):
    """A word that no labelled document holds gets its weight from the metadata's verdicts, in all
    documents that hold it; the labelled sample is one of 60 rows."""
    rng = np.random.default_rng(5)
    ids = own_ids(900)
    y = rng.integers(0, 2, 900)
    rows = view_rows(y, rng)
    for i in range(200, 900):                        # 50 and 51: words of unlabelled documents alone
        rows[i] = (np.append(rows[i][0], 50 + y[i]), rows[i][1])
    labels = label_table(spark, [(ids[i], int(y[i])) for i in range(200)])
    m = Q.fit(feature_table(spark, rows, ids), labels, Scratch(spark, "test"), bits=8, max_rows=60, rounds=3,
              share=0.3, sure=0.6, chunk=300)
    assert m.views[0].weight[51] > 0 > m.views[0].weight[50]
    # and what is handed over grows with the documents, not with the sample
    assert m.exchanged[-1][0] > 400


def test_all_rows_labelled_and_no_pool(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 50)
    ids = own_ids(50)
    table, labels = feature_table(spark, view_rows(y, rng), ids), label_table(spark, [(i, int(c)) for i, c in zip(ids, y)])
    assert Q.fit(table, labels, Scratch(spark, "test"), bits=8).exchanged == []
    # labelled documents beyond the sample count as unlabelled
    assert Q.fit(table, labels, Scratch(spark, "test"), bits=8, max_rows=30, sure=0.55, share=0.5).exchanged != []


def test_thresholds_against_sorting():
    rnd = random.Random(2)
    for _ in range(200):
        hist = {k: rnd.randrange(1, 30) for k in rnd.sample(range(-400, 400), 60)}
        wanted, poor, sure = rnd.uniform(1, 500), rnd.random(), rnd.uniform(0.55, 0.95)
        edge = np.log(sure / (1 - sure))
        for cut, keep, rows_wanted, order in zip(Q.thresholds(hist, wanted, poor, sure), (lambda k: (k + 1) / Q.BINS <= -edge, lambda k: k / Q.BINS >= edge),
                                                 (wanted * poor, wanted * (1 - poor)), (1, -1)):
            sure_bins = sorted((k for k in hist if keep(k)), key=lambda k: order * k)
            if not sure_bins:
                assert cut is None
                continue
            taken = sum(hist[k] for k in sure_bins if order * k < order * cut.k) + cut.part * hist[cut.k]
            assert cut.k in sure_bins and abs(taken - min(rows_wanted, sum(hist[k] for k in sure_bins))) < 1e-6


def test_learning_on_equals_a_written_out_ftrl():
    """The update of each coordinate, written out one by one."""
    rng = np.random.default_rng(8)
    rows = [np.unique(rng.integers(0, 16, 5)).astype(np.int32) for _ in range(60)]
    y = rng.integers(0, 2, 60).astype(float)
    base = Q.learn_base(rows[:20], y[:20], 4, 1)
    m = Q.learn_more(base, rows[20:], y[20:], 4, 1)
    z, n, b, n0 = base.z.tolist(), base.n.tolist(), base.intercept, base.n0
    alpha, beta, l1, l2 = m.alpha, m.beta, m.l1, m.l2

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)
    for k in np.random.default_rng(7).permutation(40):
        at, target = rows[20 + k].tolist(), 1.0 - y[20 + k]
        w = {i: weight(i) for i in at}
        g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - target
        for i in at:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
            n[i] += g * g
        n0 += g * g
        b -= alpha / (beta + n0 ** 0.5) * g
    assert np.allclose(m.z, z) and np.allclose(m.n, n) and np.isclose(m.intercept, b)
    assert np.allclose(m.weights(slice(None)), [weight(i) for i in range(16)])


def test_repeated_ids_train_once(spark):
    a, b, c = own_ids(3)
    rows = [(np.array([1, k + 5]), np.array([2])) for k in range(90)]
    table = feature_table(spark, rows, [a] * 30 + [b] * 30 + [c] * 30)
    scored = table.withColumn("raw", Q.F.array(Q.F.lit(3.0), Q.F.lit(-3.0)))
    cuts = [(None, Q.Cut(100, 1.0)), (Q.Cut(-100, 1.0), None)]
    got = {(r.view, r.doc_id): (r.label, min(r.at)) for r in Q.handed_over(scored, cuts).collect()}
    assert got == {(v, i): (float(v), 1 + v) for v in (0, 1) for i in (a, b, c)}
    assert Q.histograms(scored) == [{192: 90}, {-192: 90}]


def test_clashing_extra_columns_ties_and_long_texts(spark, tables):
    rows, labels, _ = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .selectExpr("*", "'x' AS score", "1 AS raw", "'y' AS content", "2 AS label")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scratch = Scratch(spark, "test")
    m = Q.fit(scratch.cut(Q.featured(docs), "f"), labelled, scratch)
    got = Q.score(docs, m)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["content_score", "metadata_score", "score"]
    again = Q.score(docs.union(docs), m).groupBy("doc_id").agg(Q.F.countDistinct("score").alias("n")).where("n > 1")
    assert got.count() == 120 and again.count() == 0
