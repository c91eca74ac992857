import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from arcash.llm import decontamination as D
from tests.llm.helpers import doc


def least_edits(item: str, text: str) -> int:
    """Least edit distance of the item and any substring of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        old, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (a != b)))
    return min(row)


def plain(t):
    return re.sub(r"[\W_]+", " ", (t or "").lower()).strip()


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        at = rnd.randrange(len(s))
        kind = rnd.randrange(3)
        if kind == 0:
            s[at] = rnd.choice("abcdefgh")
        elif kind == 1:
            del s[at]
        else:
            s.insert(at, rnd.choice("abcdefgh"))
    return "".join(s)


def corpus(seed=1):
    rnd = random.Random(seed)
    words = ["alpha", "of", "the", "beta", "gamma", "in", "delta", "river", "stone", "and"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([4, 12, 30])))) for i in range(8)]
    docs = []
    for i in range(60):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 90)))
        if i % 2:
            _, item = rnd.choice(items)
            hit = edited(rnd, item, rnd.randrange(0, max(1, len(item) // 6)))
            cut = rnd.randrange(len(t) + 1)
            t = t[:cut] + rnd.choice([" ", "! "]) + (hit.upper() if i % 4 == 1 else hit) + ". " + t[cut:]
        docs.append((i, t))
    return docs, items


def expected(docs, items, q=8):
    out = {}
    for d, t in docs:
        for i, x in items:
            m = len(plain(x))
            if m >= q:
                e = least_edits(plain(x), plain(t))
                if e <= min(int(m * 0.1), m // q - 1):
                    out[d, i] = e
    return out


def test_matches_full_alignment(spark, tables):
    docs, items = corpus()
    docs += [(100, None), (101, ""), (102, "x"), (103, items[2][1] * 3 + " " + "filler words " * 30000 + items[3][1])]
    want = expected([d for d in docs if d[0] != 103], items)
    got = {(r.doc_id, r.item_id): r.edits for r in D.op6_decontamination(
        spark, tables(documents=[doc(*d) for d in docs], benchmark=items + [(50, None), (51, ""), (52, "ab")])).collect()}
    assert {k: v for k, v in got.items() if k[0] != 103} == want and len(want) > 15
    assert got[103, 2] == 0 and got[103, 3] == 0


def test_blocks_null_ids_and_clean(spark, tables):
    docs, items = corpus(2)
    d = tables(documents=[doc(*x) for x in docs] + [doc(None, items[5][1])], benchmark=items)
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    want = expected(docs, items)
    got = D.contaminated(read("documents").selectExpr("*", "1 as item_id", "2 as edits"), read("benchmark"), block_chars=100).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in got if r.doc_id is not None} == want
    left = D.clean(read("documents"), read("benchmark"), block_chars=100).collect()
    assert {r.doc_id for r in left} == {x for x, _ in docs} - {x for x, _ in want}
    e = tables(documents=[], benchmark=[])
    assert D.op6_decontamination(spark, e).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", min_size=1, max_size=12), st.text("ab ", max_size=24), st.integers(0, 4))
def test_banded_alignment_over_all_diagonals(item, text, k):
    code = lambda s: np.array([ord(c) for c in s], np.uint32)
    got, end = D.aligned(code(item), code(text), -len(item), len(text), k)
    want = least_edits(item, text)
    assert got == want if want <= k else got == k + 1
    if want <= k:
        assert 0 <= end


def test_repetitive_texts_equal_the_full_table():
    items = [(0, "0 " * 50), (1, "0 " * 30 + "1 " * 30), (2, "ab" * 60), (3, "0 0 1 " * 20), (4, "z" * 90)]
    texts = ["0 " * 400, "0 " * 20 + "1 " * 400 + "x", "0 " * 200 + "1 " * 200, "ab" * 300 + " " + "0 0 1 " * 19 + "0 0 2",
             "b" * 50 + "ab" * 57, "z" * 500, "z" * 85, "z" * 70 + "y", "0 1 " * 300, "q"]
    for room in (1, 3_000, 1_000_000):
        index = D.Items(items, 0.1, 8, room)
        for t in texts:
            got = {i: e for i, e, _, _ in index.matches(t)}
            assert got == {i: e for (_, i), e in expected([(0, t)], items).items()}, (room, t[:30])


def test_a_small_room_changes_no_result():
    docs, items = corpus(3)
    whole, parts, single = (D.Items(items, 0.1, 8, room) for room in (1_000_000, 60, 0))
    for _, t in docs:
        want = whole.matches(t)
        assert parts.matches(t) == want and single.matches(t) == want


def test_long_repetitive_texts_end_soon():
    index = D.Items([(i, "0 " * 50 + str(i)) for i in range(10)] + [(99, "=" * 10 + "w" * 200)], 0.1, 8)
    begin = time.perf_counter()
    got = {i: e for i, e, _, _ in index.matches("0 " * 100_000)}
    assert got == {i: 1 for i in range(1, 10)} | {0: 0} and time.perf_counter() - begin < 30
    assert index.matches("w" * 300_000) == [(10, 0, 0, 200)]
