import random

import corpus_pipeline as C
from tests.llm.helpers import doc

PASSAGE = "this recurring notice of fifty words and more is printed under every page of the gazette " * 4
ITEM = "which of the following rivers flows through the largest number of countries before it meets the sea"


def corpus(seed=6):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "ero", "inth", "ought", "ell", "umb", "ist")]
    line = lambda n=40: " ".join(rnd.choice(words) for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        t = "\n".join(line() for _ in range(rnd.randrange(1, 6)))
        if i % 6 == 0:
            t += " vile rotten " + line(5) + " nasty"
        rows.append(doc(i, t))
        labels.append((i, 1, int(i % 6 == 0)))
    for i in range(300, 306):                      # a passage that recurs across documents
        rows.append(doc(i, line() + "\n" + PASSAGE.strip() + "\n" + line()))
    base = [rnd.choice(words) for _ in range(300)]
    for i in range(310, 314):                      # near copies in one line, exact copy at the end
        v = list(base)
        v[rnd.randrange(300)] = f"edit{i}"
        rows.append(doc(i, " ".join(v[:200]) + f" pad{i} " * (i - 309) + " ".join(v[200:])))
    rows.append(doc(315, rows[-1][1]))
    for i in range(320, 323):
        rows.append(doc(i, line(60) + " " + ITEM.upper() + "? " + line(20)))
    rows += [doc(330, None), doc(331, ""), doc(332, "one"), doc(333, line(30000)), (None, line(), None, None, None)]
    return rows, labels


def test_every_stage_takes_effect_and_clean_documents_stay(spark, tables):
    rows, labels = corpus()
    d = tables(documents=rows, labels=labels, benchmark=[(1, ITEM), (2, None)])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, d)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{d}/stage-{name}")
        docs = spark.read.parquet(f"{d}/stage-{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    toxic = {i for i in range(300) if i % 6 == 0}
    clean = set(range(300)) - toxic
    assert len(toxic - set(seen["toxicity"])) >= 0.95 * len(toxic)
    assert len(clean & set(seen["toxicity"])) >= 0.98 * len(clean)
    text = {r[0]: r[1] for r in rows}
    lines = seen["line_dedup"]
    assert all(lines[i].text == text[i] for i in clean & set(lines))
    assert [i for i in range(300, 306) if PASSAGE.strip() in lines[i].text] == [300]
    assert lines[303].n_chars == len(lines[303].text) < len(text[303]) and lines[330].text is None
    assert 315 not in lines                                     # nothing of its own was left
    near = set(seen["near_dedup"])
    assert near & {310, 311, 312, 313, 315} == {310} and clean & set(lines) <= near
    left = seen["decontamination"]
    assert not {320, 321, 322} & set(left) and near - set(left) == {320, 321, 322}
    assert None in left and {330, 331, 332, 333} <= set(left)
    assert set(seen["packing"]) == set(left)
    ran = C.run(spark, d)
    assert ran.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0
    assert {r.doc_id for r in ran.collect()} == set(left)


def test_clashing_extra_columns_pass_through(spark, tables):
    rows, labels = corpus(8)
    d = tables(documents=rows, labels=labels, benchmark=[(1, ITEM)])
    extra = {c: f"concat('x', doc_id) as {c}" for c in (
        "score", "toxic", "row", "_row", "_gone", "_id", "_th", "line", "line_no", "leaf", "lhash", "n_lines", "n_dropped",
        "component_id", "kept", "n", "f", "g", "sig", "id", "family", "text_", "item_id", "edits", "label", "at")}
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("*", *extra.values())
    for i, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, d)
        if name != "packing":
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(f"{d}/clash-{i}")
        docs = spark.read.parquet(f"{d}/clash-{i}")
        if name != "packing":
            assert docs.where(" or ".join(f"{c} <> concat('x', doc_id)" for c in extra)).count() == 0, name
    assert docs.count() > 200


def test_empty_tables(spark, tables):
    d = tables(documents=[], labels=[], benchmark=[])
    assert C.run(spark, d).collect() == []
