import random
import zlib

import numpy as np

from arcash.llm import toxicity as X
from tests.llm.helpers import doc


def corpus(n=400, seed=2):
    rnd = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                w[rnd.randrange(60)] = rnd.choice(["vile", "nasty", "rotten"])
        rows.append(doc(i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_contract(spark, tables):
    rows, labels = corpus()
    extra = [doc(9001, None), doc(9002, ""), doc(9003, "vile " * 30000), doc(5, rows[5][1]), doc(None, "x")]
    got = X.op3_toxicity(spark, tables(documents=rows + extra, labels=labels + [(7, 1, None), (None, 0, 1)])).toPandas()
    assert len(got) == len(rows) + 5
    one = got[got.doc_id.notna()]
    assert [bool(h) for h in one.held_out] == [zlib.crc32(str(int(i)).encode()) % 5 == 0 for i in one.doc_id]
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = one[one.held_out & (one.doc_id < 400)]
    assert (held.predicted == (held.doc_id % 4 == 0)).mean() >= 0.97
    assert int(one[one.doc_id == 9003].predicted.iloc[0]) == 1
    assert int(one[one.doc_id == 9001].predicted.iloc[0]) == 0


def test_held_out_labels_are_never_seen(spark, tables):
    rows, labels = corpus(120)
    a = X.op3_toxicity(spark, tables(documents=rows, labels=labels)).toPandas()
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    b = X.op3_toxicity(spark, tables(documents=rows, labels=flipped)).toPandas()
    assert np.allclose(a.sort_values("doc_id").score, b.sort_values("doc_id").score)


def test_no_labels_and_empty_tables(spark, tables):
    got = X.op3_toxicity(spark, tables(documents=[doc(1, "a b")], labels=[])).collect()
    assert [(r.doc_id, r.score, r.predicted) for r in got] == [(1, 0.5, 1)]
    assert X.op3_toxicity(spark, tables(documents=[], labels=[])).collect() == []


def test_ftrl_is_sparse_and_follows_the_update_rule():
    m = X.Ftrl(4, alpha=0.5, l1=0.1)
    for _ in range(50):
        m.learn(np.array([0, 1]), 1.0)
        m.learn(np.array([0, 2]), 0.0)
    w = m.weights(slice(None))
    assert w[1] > 0 > w[2] and not w[3:].any()


def test_sample_has_one_row_an_id(spark, tables):
    d = tables(documents=[doc(1, f"text {i}") for i in range(50)] + [doc(2, None), doc(2, "b")],
               labels=[(1, 1, 1), (2, 1, 0)])
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = X.training_sample(docs, labels, "toxic", 2).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.label) for r in got] == [(1, "text 0", 1.0), (2, "b", 0.0)]
