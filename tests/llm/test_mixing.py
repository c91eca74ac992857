import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from arcash.llm import mixing as M
from tests.llm.helpers import doc


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare by weight until no target is above its cap, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        want = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if want[s] > cap * sizes[s]}
        if not over:
            return want | {s: cap * sizes[s] for s in capped}
        capped |= over


def corpus(seed, n=1500):
    rnd = random.Random(seed)
    sources = ["hot"] * 6 + ["Z", "a", "\u00e9", "\U0001f600", "b", "c", None, "tiny"]
    rows = []
    for i in range(n):
        s = rnd.choice(sources)
        if s == "tiny" and rnd.random() < .95:
            s = "hot"
        k = rnd.choice([0, 1, 2, 5, 40, 300])
        rows.append((i, " \t\n".join("\u00a0w" for _ in range(k)), s))
    rows += [(None, "x y", "hot")] * 3 + [(5, "same same", "a")] * 50 + [(n, None, "b"), (n + 1, "", "empty"), (n + 2, "one", "single")]
    return rows


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, s, "n", 1) for i, t, s in rows],
                                 "doc_id long, text string, source string, size string, target int")
    return M.mix_sources(docs, **kw)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_bounds_and_words(spark):
    rows = corpus(1)
    got = mixed(spark, rows, fold=8).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, size(t)) for i, t, s in rows)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        times = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert math.floor(times + 1e-9) <= r.copies <= math.ceil(times - 1e-9) <= 2 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, s
    assert any(0 < want[s] < sizes[s] for s in sizes) and any(want[s] == 2 * sizes[s] > 0 for s in sizes)


def test_more_than_one_copy_and_a_fraction(spark):
    rows = [(i, "w " * (i % 50), "ab"[i % 10 == 0]) for i in range(900)]
    got = mixed(spark, rows, weights=(9, 1), share=1.3, fold=8).collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert 1 < mine[0].target / mine[0].source_size < 2 or s == "b"
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 25


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = corpus(2, 400)
    runs = []
    for k in (1, 7):
        docs = spark.createDataFrame(random.Random(k).sample([(i, t, s) for i, t, s in rows], len(rows)),
                                     "doc_id long, text string, source string").repartition(k)
        runs.append(sorted(map(repr, M.mix_sources(docs, fold=4, broadcast_sources=10 ** 6 * (k > 1)).collect())))
    assert runs[0] == runs[1]


def test_rounding_is_unbiased(spark):
    # 150 sources of the same sizes: each document is taken one and a half times on average
    rows = [(20 * k + i, "w " * (1 + i % 13), f"s{k}") for k in range(150) for i in range(20)]
    times = Counter()
    for r in mixed(spark, rows, weights=(1,), fold=4).collect():
        times[r.doc_id % 20] += r.copies
    assert all(abs(times[i] / 150 - 1.5) < 0.17 for i in range(20))


def test_many_equal_rows_are_spread(spark):
    rows = [(1, "a b c", "s")] * 500 + [(2, "d", "t"), (3, "e f", "u")]
    got = mixed(spark, rows).collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    scratch_rows = M.sized_rows(docs).where("doc_id = 1").selectExpr(
        "source", "0L place", "0L source_size", "0D target", "doc_id", "size", "m", "1L base", "7L ones")
    spread = M.one_row_each(scratch_rows, ["source", "place", "source_size", "target"], wide=64).collect()
    assert Counter(r.copies for r in spread) == {2: 7, 1: 493}
    hot = [r for r in got if r.doc_id == 1]
    assert len(hot) == 500 and abs(sum(r.taken for r in hot) - hot[0].target) <= 1.5


def test_empty_tables_and_blank_texts(spark, tables):
    empty = tables(documents=[])
    assert M.op12_mixing(spark, empty).count() == 0
    blank = tables(documents=[doc(1, None), doc(2, " \n", source=None)])
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in M.op12_mixing(spark, blank).collect()}
    assert got == {1: (0, 0, 0.0, 0), 2: (0, 0, 0.0, 0)}
    assert M.op12_mixing(spark, blank).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_no_python_in_the_plan(spark, tables):
    plan = M.op12_mixing(spark, tables(documents=[doc(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
