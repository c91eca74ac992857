import random

import duckdb
import pytest

from arcash.llm import line_dedup as L
from tests.llm.helpers import doc

LONG = "the committee of the parish met on the green to hear what the miller had said of the new road"


def got_texts(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in df.collect()}


def test_variable_fields_and_rounds(spark, tables):
    swap = LONG.replace("miller", "baker")
    swap2 = LONG.replace("green", "hill")
    alone = LONG.replace("the committee", "the council")
    rows = [doc(1, f"own line one of the first document\n{LONG}"), doc(2, f"{swap}\nanother own line that is kept here"),
            doc(3, f"x\n{swap2}\nx"), doc(4, alone), doc(5, "order 17 was sent on 3/4/2020 to the depot by rail"),
            doc(6, "order 918 was sent on 1/2/1999 to the depot by rail\nshort"),
            doc(7, "1 2 3 4 5 6 7 8 9"), doc(8, "1 2 3 4 5 6 7 8 0"), doc(9, None), doc(10, ""), doc(None, LONG)]
    got = got_texts(L.op8_line_dedup(spark, tables(documents=rows)))
    assert got[1] == (rows[0][1], 2, 0)
    assert got[2] == ("another own line that is kept here", 2, 1)
    assert got[3] == ("x\nx", 3, 1)
    assert got[4][2] == 0 and got[5][2] == 0 and got[6] == ("short", 2, 1)
    assert got[7][2] == got[8][2] == 0 and got[9] == (None, 0, 0) and got[10] == ("", 1, 0)
    assert got[None] == (LONG, 1, 0)
    assert L.op8_line_dedup(spark, tables(documents=[])).collect() == []


def test_two_templates_in_one_leaf(spark, tables):
    a = "one two three " + " ".join(f"a{chr(97 + i)}" for i in range(12))
    b = "one two three " + " ".join(f"b{chr(97 + i)}" for i in range(12))
    rows = [doc(i, a.replace("ab", "odd" + "x" * i)) for i in range(5)] + \
        [doc(i, b.replace("bc", "odd" + "y" * i)) for i in range(5, 9)]
    got = got_texts(L.op8_line_dedup(spark, tables(documents=rows)))
    assert sorted(i for i in got if got[i][2] == 0) == [0, 5]


def templates_of(n, docs, rnd):
    """Lines of ``n`` templates of one leaf, each with up to two words changed; the first is as it is."""
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    out = []
    for _ in range(n):
        base = [word() for _ in range(12)]
        for k in range(docs):
            w = list(base)
            for at in rnd.sample(range(12), min(k, 2)):
                w[at] = word()
            out.append("one two three " + " ".join(w))
    return out


@pytest.mark.parametrize("n, alone", [(20, 0), (1, 500)])
def test_every_template_of_a_full_leaf(spark, tables, n, alone):
    rnd = random.Random(n)
    common = [f"of{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(6)]
    lines = templates_of(n, 10, rnd)
    rows = [doc(i, t) for i, t in enumerate(lines)]
    rows += [doc(1000 + i, "one two three " + " ".join(rnd.choice(common) for _ in range(12))) for i in range(alone)]
    got = got_texts(L.op8_line_dedup(spark, tables(documents=rows)))
    assert [i for i in range(len(lines)) if got[i][2] == 0] == list(range(0, len(lines), 10))


def test_large_groups_are_split(spark):
    from arcash.llm.common import Scratch
    rnd = random.Random(8)
    lines = [(7, i, t.split()) for i, t in enumerate(templates_of(12, 3, rnd))]
    rest = spark.createDataFrame(lines, "leaf long, lhash long, toks array<string>")
    got = L.similar_lines(Scratch(spark, "test"), rest, 3, 80, heads=2, large=4).collect()
    tid = dict((r.lhash, r.tid) for r in got)
    assert len(got) == len(tid)
    left = [x for x in lines if x[1] not in tid]
    assert not [1 for a in left for b in left if a[1] < b[1] and 5 * sum(p == q for p, q in zip(a[2], b[2])) >= 4 * 15]
    # a line with one word changed agrees with its base line
    assert all(3 * t in tid and 3 * t + 1 in tid for t in range(12))


def test_long_lines_of_fields_or_without_spaces(spark, tables):
    prices = " ".join(f"item {i}.50 {i}" for i in range(1, 21))
    han = "\u6211\u4eec\u5728\u8fd9\u91cc" * 8
    mixed = f"a  b\t{prices}"
    rows = [doc(1, f"{prices}\n{han}"), doc(2, f"x\n{prices}\n{han}\ny"), doc(3, prices.replace("7.50", "7.60")),
            doc(4, mixed), doc(5, f"z\n{mixed} "), doc(6, "1 2 3 4 5 6 7 8 9"), doc(7, "1 2 3 4 5 6 7 8 9"),
            doc(8, han[:-1])]
    got = got_texts(L.op8_line_dedup(spark, tables(documents=rows)))
    assert got[2] == ("x\ny", 4, 2) and got[5] == ("z", 2, 1)
    assert all(got[i][2] == 0 for i in (1, 3, 4, 6, 7, 8))


def test_repeated_ids_columns_and_own_repeats(spark, tables):
    rows = [doc(1, f"{LONG}\n{LONG}"), doc(1, f"first\n{LONG}"), doc(2, f"a\n{LONG}\nb"), doc(2, f"{LONG}\nc")]
    d = tables(documents=rows)
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("*", "7 as leaf", "8 as n_lines", "9 as toks")
    out = L.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "leaf", "toks", "n_lines", "n_dropped"]
    assert sorted(r.text for r in out.collect()) == sorted([f"{LONG}\n{LONG}", f"first\n{LONG}", "a\nb", "c"])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_same_as_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    cols = ["doc_id", "n_lines", "n_dropped", "text"]
    want = sorted(tuple(r) for r in con.sql(L.oracle_sql()).df()[cols].itertuples(index=False))
    got = sorted(tuple(r) for r in L.op8_line_dedup(spark, d).select(cols).collect())
    assert got == want and sum(r[2] for r in got) > 0


def test_no_python_in_the_plan(spark, tables):
    out = L.op8_line_dedup(spark, tables(documents=[doc(1, LONG), doc(2, LONG)]))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
