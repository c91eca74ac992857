import random
import re
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from arcash.llm import spelling as S
from tests.llm.helpers import doc

KEPT = ["word", "form", "root", "n", "n_near", "form_n"]


def brute(rows, drop=199):
    """The contract by comparison of all pairs of words."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    around = {w: [v for v in n if v != w and near(w, v)] for w in n}
    form = {}
    for w, vs in around.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(around[w]), form[w] and n[form[w]]) for w in n)


def corpus(seed=5):
    rnd = random.Random(seed)
    letters = "abe\u00e9\u00d7"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.choice([5, 6, 7, 9]))) for _ in range(12)]
    base += ["aaaaaaa", "ababababab", "baaaaab"]          # repeated bigrams tie in rank
    words = []
    for w in base:
        words += [w] * rnd.choice([5, 30, 160])
        for _ in range(6):
            i = rnd.randrange(len(w))
            v = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i:],
                            w[:i] + rnd.choice(letters) + w[i + 1:]])
            words += [v] * rnd.choice([1, 5, 6, 31])
    rnd.shuffle(words)
    rows, i = [], 0
    while words:
        k = rnd.choice([0, 1, 7, 60])
        rows.append((i, rnd.choice([" ", "_", "1\n"]).join(w.upper() if rnd.random() < .3 else w for w in words[:k])))
        words, i = words[k:], i + 1
    return rows + [(None, "abcdefg " * 3), (7, "abcdefg  abcdefg"), (7, "abcdefg  abcdefg"), (i, None), (i + 1, ""), (i + 2, " 12 ")]


def test_matches_all_pairs_and_sql(spark, tables):
    rows = corpus()
    d = tables(documents=[doc(i, t) for i, t in rows])
    got = sorted(map(tuple, S.op11_spelling(spark, d).select(*KEPT).collect()), key=lambda r: r[0])
    want = brute(rows)
    assert got == want and len(want) > 60 and sum(r[1] is not None for r in want) > 10
    with duckdb.connect() as con:
        con.execute(f"create view documents as select * from read_parquet('{d}/documents.parquet/*.parquet')")
        sql = con.execute(f"select {', '.join(KEPT)} from ({S.oracle_sql()}) order by word").fetchall()
    # a null doc_id is written None by Python and left out by SQL: three occurrences too few to count
    assert [r for r in sql if r[0] != "abcdefg"] == [r for r in want if r[0] != "abcdefg"]


def test_pivots_are_the_cheapest_disjoint_pair():
    rnd = random.Random(1)
    for _ in range(2000):
        word = "".join(rnd.choice("abc") for _ in range(rnd.choice([4, 5, 8, 14])))
        grams = [word[i:i + 2] for i in range(len(word) - 1)]
        rank = {g: i for i, g in enumerate(rnd.sample(sorted(set(grams)), len(set(grams))))}
        prefix, (i, j) = S.pivots(grams, rank)
        third = sorted(rank[g] for g in grams)[2]
        assert prefix == [k for k, g in enumerate(grams) if rank[g] <= third]
        assert abs(i - j) >= 2 and {i, j} <= set(prefix)
        assert rank[grams[i]] + rank[grams[j]] == min(
            rank[grams[a]] + rank[grams[b]] for a in prefix for b in prefix if b - a >= 2)


def test_long_text_clashing_columns_and_empty_table(spark, monkeypatch):
    long = "lengthy" * 200_000 + " " + "wordsworth " * 300_000 + "x" * (3 << 20)
    assert S.document_words(1, long, 6, 0) == {"lengthy" * 200_000: 1, "wordsworth": 300_000, "x" * (3 << 20): 1}
    docs = spark.createDataFrame([(1, "repeats " * 5, 3, "w")], "doc_id int, text string, n int, word string")
    got = S.spelling_groups(docs).collect()
    assert [(r.word, r.n, r.n_near, r.form, r.root) for r in got] == [("repeats", 5, 0, None, "repeats")]
    assert S.spelling_groups(docs.where(F.lit(False))).count() == 0


def test_small_tables_of_counts_add_up(spark):
    docs = spark.createDataFrame([(i, f"common{chr(97 + i % 7)} other{chr(97 + i % 5)}") for i in range(200)],
                                 "doc_id long, text string").repartition(3)
    got = dict(map(tuple, S.word_counts(docs, 6, 0, table=2).collect()))
    want = Counter(w for i in range(200) for w in (f"common{chr(97 + i % 7)}", f"other{chr(97 + i % 5)}"))
    assert got == want


def test_chain_of_forms(spark):
    counts = {"abcdefgh": 700, "abcdefghi": 130, "abcdefghij": 26, "abcdefghijk": 5}
    docs = spark.createDataFrame([(1, " ".join(f"{w} " * n for w, n in counts.items()))], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in S.spelling_groups(docs).collect()}
    assert got == {"abcdefgh": (None, "abcdefgh"), "abcdefghi": ("abcdefgh", "abcdefgh"),
                   "abcdefghij": ("abcdefghi", "abcdefgh"), "abcdefghijk": ("abcdefghij", "abcdefgh")}
