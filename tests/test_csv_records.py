"""CSV scans with line breaks in quoted cells, over several splits, against Python's CSV reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from arcash.schemas import RAW_COLUMNS
from arcash.sources import SEQ, read_raw_csv
from arcash.sources.records import ends_inside

COLS = RAW_COLUMNS["DimCategory"]


@pytest.fixture(params=[60, 1 << 27])
def split_bytes(spark, request):
    """Splits of a given size, down to one shorter than a record."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], str(request.param))
    spark.conf.set(keys[1], "0")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def expected(text):
    """Rows as Python's reader gives them, empty cells null, columns by name."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r and not (len(r) == 1 and not r[0].strip())]
    at = [rows[0].index(c) for c in COLS]
    return [tuple((r[i] or None) if i < len(r) else None for i in at) for r in rows[1:]]


def scanned(spark, path):
    df = read_raw_csv(spark, str(path), "DimCategory")
    return [tuple(c or None for c in r[:len(COLS)]) for r in df.orderBy(SEQ).collect()]


def cell(rnd):
    kind = rnd.randrange(8)
    word = "".join(rnd.choice("abc é") for _ in range(rnd.randrange(1, 12))).strip() or "w"
    if kind == 0:
        return '"' + word + "\n" * rnd.randrange(1, 4) + 'x,""y"", ' + word + '"'
    if kind == 1:
        return f'"{word}\nid,category,""\n""{word}"'
    if kind == 2:
        return f'{word}"s {word}'                     # a stray quote opens nothing
    if kind == 3:
        return f'"{word}, ""{word}"""'
    return '""' if kind == 4 else word


def test_broken_records_over_splits(spark, tmp_path, split_bytes):
    rnd = random.Random(1)
    text = "category,note,category_id,revenue_group\n" + "".join(
        ",".join(cell(rnd) for _ in range(4)) + ("\n\n" if rnd.random() < 0.1 else "\n") for _ in range(30))
    (tmp_path / "a.csv").write_text(text, newline="")
    want = expected(text)
    assert scanned(spark, tmp_path / "a.csv") == want and len(want) == 30
    assert any("\n" in (c or "") for r in want for c in r)


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path, split_bytes):
    texts = {"a b.csv": "category_id,category,revenue_group\n1,x,y\n2,\"p\nq\",z\n",
             "b.csv": "revenue_group,category,category_id\ng,c,3\nh,d,4\n",
             "c.csv": "category_id,category,revenue_group\r\n5,\"two\r\nlines\",k\r\n6,m,n",
             "d.csv": "\"a\nheader\",category,category_id,revenue_group\n0,c,7,r\n",
             "e.csv": "", "f.csv": "category_id,category,revenue_group\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    assert scanned(spark, tmp_path) == [
        ("1", "x", "y"), ("2", "p\nq", "z"), ("3", "c", "g"), ("4", "d", "h"), ("5", "two\nlines", "k"),
        ("6", "m", "n"), ("7", "c", "r")]


def test_an_open_quote_and_an_empty_folder_are_errors(spark, tmp_path):
    (tmp_path / "open.csv").write_text('category_id,category,revenue_group\n1,"x,y\n2,p,q\n')
    with pytest.raises(ValueError, match="never closed"):
        read_raw_csv(spark, str(tmp_path / "open.csv"), "DimCategory")
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError, match="missing column"):
        read_raw_csv(spark, str(tmp_path / "none.csv"), "DimCategory")


def test_files_without_broken_records_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text('category_id,category,revenue_group\n1,"x, ""y""",z\n2,a"b,c\n')
    df = read_raw_csv(spark, str(tmp_path / "a.csv"), "DimCategory")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan csv" in plan
    assert [tuple(r)[:3] for r in df.orderBy(SEQ).collect()] == [("1", 'x, "y"', "z"), ("2", 'a"b', "c")]


def test_lines_as_functions(spark):
    cases = {'a,b': (False, True), '"a': (True, False), 'a"': (False, False), '"a","b"': (False, False),
             'x","': (True, True), '""': (False, True), '"a""': (True, False), 'a"b,"c': (True, True),
             '': (False, True), '"""': (True, False), ',"': (True, False)}
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    got = df.select("v", ends_inside(F.col("v"), False).alias("o"), ends_inside(F.col("v"), True).alias("i")).collect()
    assert {r.v: (r.o, r.i) for r in got} == cases
