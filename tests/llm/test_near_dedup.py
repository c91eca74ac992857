import random
import re

import numpy as np
import pytest

from arcash.llm import near_dedup as N
from arcash.llm.common import Scratch, components
from tests.llm.helpers import doc


def brute(rows):
    """Components by direct comparison of all pairs of string sets."""
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                p, q = find(ids[x]), find(ids[y])
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for base in range(25):
        w = [rnd.choice(words) for _ in range(rnd.choice([3, 5, 12, 60, 200]))]
        for copy in range(rnd.choice([1, 2, 6])):
            v = list(w)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                v[rnd.randrange(len(v))] = "x" + str(rnd.random())
            rows.append((i, " ".join(v).title() if copy % 2 else "  ".join(v)))
            i += 1
    w = [rnd.choice(words) for _ in range(120)]           # one large group, links of all kinds
    for _ in range(60):
        v = list(w)
        for _ in range(rnd.choice([1, 1, 2, 3, 5])):
            v[rnd.randrange(len(v))] = "y" + str(rnd.random())
        rows.append((i, " ".join(v)))
        i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, "One"), (i + 4, "one"),
             (i + 5, "a b c"), (i + 6, "Ä b"), (i + 7, "ä b")]
    return rows


def test_matches_all_pairs(spark, tables):
    rows = corpus()
    d = tables(documents=[doc(*r) for r in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in N.op2_near_dedup(spark, d).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}


def test_blocks_and_classes_lose_no_link(spark, tables):
    rows = corpus(5)
    d = tables(documents=[doc(*r) for r in rows])
    out = N.near_duplicates(spark.read.parquet(f"{d}/documents.parquet"), block_rows=8,
                            block_shingles=900)
    assert {r.doc_id: r.component_id for r in out.collect()} == \
        {i: c for i, (_, c) in brute(rows).items()}


def test_repeated_null_ids_empty_table_and_extra_columns(spark, tables):
    t = "one two three four five six seven"
    d = tables(documents=[doc(4, t), doc(4, t), doc(None, t), doc(2, t), doc(4, "other text " + t * 3)])
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("*", "1 as n", "2 as family", "3 as sig")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept)
                 for r in N.near_duplicates(docs).collect())
    assert got == [(-1, -1, False), (2, 2, True), (4, 2, False), (4, 2, False), (4, 2, False)]
    assert N.op2_near_dedup(spark, tables(documents=[])).collect() == []


def test_signature_pigeonhole():
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 2 ** 63, 4000, dtype=np.uint64))
    a = N.signature(s, 10).view(np.uint8)
    b = a.copy()
    b[rng.choice(80, 19, replace=False)] ^= 1
    differs = (a != b).reshape(10, 8).sum(axis=1)
    assert differs.min() <= 1
    assert len(N.signature(np.zeros(0, np.uint64), 10)) == 10


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    s = Scratch(spark, "test")
    got = {r.id: r.component for r in components(s, spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    s.drop()


@pytest.mark.parametrize("family", [100, 320])
def test_repeated_ids_of_unlike_texts(spark, tables, family):
    """A doc_id whose rows lie in different families joins them, whatever their size."""
    rnd = random.Random(family)

    def copies(prefix, n, size, first):
        base = [f"{prefix}{i}" for i in range(size)]
        out = []
        for i in range(n):
            v = list(base)
            v[rnd.randrange(size)] = f"{prefix}new{i}"
            out.append((first + i, " ".join(v)))
        return out
    rows = copies("a", family, 150, 1000) + copies("b", 12, 400, 5000) + copies("c", 5, 200, 7000)
    (near_a,), (near_b,) = copies("a", 1, 150, 5), copies("b", 1, 400, 5)
    rows += [near_a, near_b, (5, "quite another text of nine words in a row"), (5, None)] + [near_a] * 3
    got = N.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string"),
                            block_rows=64).collect()
    assert len(got) == len(rows)
    found = {}
    for r in got:
        found.setdefault(r.doc_id, set()).add(r.component_id)
    assert all(found[i] == {5} for i in found if i < 7000), {i: c for i, c in found.items() if i < 7000 and c != {5}}
    assert all(found[i] == {7000} for i in found if i >= 7000)
    assert sum(r.kept for r in got if r.doc_id != 5) == 1
