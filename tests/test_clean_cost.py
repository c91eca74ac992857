"""The invoice clean computes each cell once, compiled, and without failing parses."""

from pyspark.sql import functions as F

from arcash import config as C
from arcash.functions.dates import parse_date_sql, plain_date_sql, staged
from arcash.functions.text import SPACE, strip


def test_plain_dates_agree_with_the_patterns(spark):
    days, years = ("0", "1", "02", "9", "12", "13", "29", "30", "31", "32"), ("2026", "2024", "1900", "0000", "26")
    cells = [f"{a}{s}{b}{s}{y}" for a in days for b in days for y in years for s in "/-."]
    cells += [f"{y}{s}{a}{s}{b}" for a in days for b in days for y in years for s in "/-"]
    cells += [f"{a}-{m}-{y}" for a in days for m in ("Jan", "FEB", "sEp", "Foo", "Sept") for y in years]
    cells += ["2026-01/02", "1/2-2026", "12/03/20261", "+2026-1-2", "2026-01", "", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    # the same order of patterns, without the plain shapes in front
    patterns = parse_date_sql("c", C.DATE_PATTERNS[:-1], C.DATE_PATTERNS[-1:] + C.DATE_FALLBACK_PATTERNS)
    rows = df.select("c", parse_date_sql("c").alias("new"), patterns.alias("old"))
    assert rows.where("not (new <=> old)").collect() == []
    plain = df.where("c in ('31/12/2026', '12/31/2026', '31-12-2026', '2026/12/31', '2026-12-31', '9-sEp-2026')") \
        .select(F.expr(plain_date_sql("`c`")).alias("d"))
    assert plain.where("d is null").count() == 0 and plain.count() == 6


def test_strip_takes_the_same_characters(spark):
    cells = [w for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000 for w in (chr(i) + "a b" + chr(i), chr(i))]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    old = F.regexp_replace("c", rf"^{SPACE}+|{SPACE}+$", "")
    assert df.where(~strip("c").eqNullSafe(old)).collect() == []


def test_staged_columns_are_computed_by_a_projection(spark):
    df = staged(spark.createDataFrame([("a",)], "c string"), n=F.upper("c")).where("n = 'A'").select("n", F.col("n").alias("m"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "Generate" in line and "upper" not in line]
    assert plan.count("upper") == 1 and [r.asDict() for r in df.collect()] == [{"n": "A", "m": "A"}]


def _tables(spark, path):
    spark.range(60).selectExpr("id o_orderkey", "id % 7 o_custkey", "if(id % 3 = 0, 'O', 'F') o_orderstatus",
                               "cast(100 + id as decimal(12,2)) o_totalprice").write.parquet(f"{path}/orders.parquet")
    spark.range(7).selectExpr("id c_custkey", "concat('Customer ', id) c_name", "cast(id % 4 as int) c_nationkey",
                              "'MACHINERY' c_mktsegment").write.parquet(f"{path}/customer.parquet")
    return str(path)


def test_a_plain_session_gets_the_limit_and_a_set_one_keeps_its_own(spark, tmp_path):
    from arcash.sources.derived import load_inputs
    key, sf = "spark.sql.codegen.hugeMethodLimit", _tables(spark, tmp_path)
    before = spark.conf.get(key)
    try:
        for given, then in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(key, given)
            load_inputs(spark, sf).fact
            assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)
