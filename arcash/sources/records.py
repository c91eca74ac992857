"""CSV records whose quoted cells hold line breaks, cut out of splittable text scans.

A line is taken as a function on one bit, "inside a quoted cell": where it leads from outside and
where from inside (a quote opens a cell only at the cell's start, as CSV readers have it, so a
stray quote inside an unquoted cell opens nothing). Such functions compose, which gives the
state at every line by two prefix passes: over the lines of a split, and over the splits of a
file (one small row a split). Lines outside any quoted cell begin a record; only the lines of
broken records are then brought together.

A quoted line break is given as one line feed, whatever form it has in the file. A quote that
is never closed is an error: the rest of the file would be one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arcash.session import RunFolder

# states of the walk over a line, split at its quotes
START, CELL, QUOTED, CLOSED, BEFORE = 0, 1, 2, 3, 4


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, f, b, r): each line with its file, its split's start and its place in the scan."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r"))


def ends_inside(value: Column, inside: bool) -> Column:
    """Whether the line ends inside a quoted cell, if it begins inside (or outside) one."""
    def step(state, text):
        at = (F.when(state == START, QUOTED).when(state == CELL, CELL).when(state == QUOTED, CLOSED)
              .when(state == CLOSED, QUOTED).otherwise(START))
        return (F.when((at == QUOTED) | (text == ""), at)
                .when(F.endswith(text, F.lit(",")), START).otherwise(CELL))
    # the first step also takes a quote: the state before it is chosen so that it leads to the start
    walked = F.aggregate(F.split(value, '"'), F.lit(CLOSED if inside else BEFORE), step) == QUOTED
    return F.when(F.contains(value, F.lit('"')), walked).otherwise(F.lit(inside))


def file_heads(spark: SparkSession, path: str) -> list:
    """(f, head, broken) of every file with text: its first line that is not blank, and whether
    any line could leave a quoted cell open. One narrow scan, one row a file (the driver's own file
    listing is as long)."""
    lines = text_lines(spark, path)
    place = F.when(F.trim("value") != "", F.struct("b", "r"))
    return (lines.groupBy("f").agg(F.min_by("value", place).alias("head"),
                                   F.max(ends_inside(F.col("value"), False)).alias("broken"))
            .where(F.col("head").isNotNull()).orderBy("f").collect())


def state_before(df: DataFrame, by: list, order: str, start: Column, name: str) -> DataFrame:
    """``df`` with the state before each row: its rows are functions (``out``, ``stay``: the
    state after the row from outside and from inside), composed in order from ``start``."""
    rows = Window.partitionBy(*by).orderBy(order)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.col("out") & ~F.col("stay")
    odd = lambda c: F.pmod(c, F.lit(2)) == 1
    # a constant function sets the state; it is kept less the flips so far, which are added again
    df = df.withColumn("_flips", F.sum(flips.cast("long")).over(rows.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("_set", F.when(F.col("out") == F.col("stay"), F.col("out") != odd(F.col("_flips"))))
    last = F.coalesce(F.last("_set", ignorenulls=True).over(before), start)
    return df.withColumn(name, last != odd(F.col("_flips") - flips.cast("long")))


def broken_records(spark: SparkSession, path: str, files: list[str], folder: RunFolder) -> DataFrame:
    """(f, b, r, record) of every record that is not blank in ``files``: the place is its first line's."""
    lines = text_lines(spark, path).where(F.col("f").isin(files))
    lines = folder.cut(lines.withColumn("out", ends_inside(F.col("value"), False))
                       .withColumn("stay", ends_inside(F.col("value"), True)), "csv_lines")
    # a split as a function: its last line's state from either start
    split = []
    for name, start in (("out", False), ("stay", True)):
        s = state_before(lines, ["f", "b"], "r", F.lit(start), "_s")
        split.append(s.groupBy("f", "b").agg(
            F.max_by(F.when(F.col("_s"), F.col("stay")).otherwise(F.col("out")), "r").alias(name)))
    splits = state_before(split[0].join(split[1], ["f", "b"]), ["f"], "b", F.lit(False), "begins_inside")
    splits = folder.cut(splits.select("f", "b", "begins_inside", "out", "stay"), "csv_splits")
    after = F.when(F.col("begins_inside"), F.col("stay")).otherwise(F.col("out"))
    open_end = splits.groupBy("f").agg(F.max_by(after, "b").alias("open")).where("open").select("f").first()
    if open_end:
        raise ValueError(f"{open_end['f']}: a quote is never closed")

    lines = state_before(lines.join(splits.select("f", "b", "begins_inside"), ["f", "b"]),
                         ["f", "b"], "r", F.col("begins_inside"), "inside")
    lines = folder.cut(lines.select("f", "b", "r", "value", "out", "inside"), "csv_states")
    whole = lines.where("not inside and not out")
    part = lines.where("inside or out")
    # a part belongs to the last first line before it, in its split or an earlier one
    first = F.when(~F.col("inside"), F.struct("b", "r"))
    splits = part.groupBy("f", "b").agg(F.max(first).alias("_last"))
    earlier = F.last("_last", ignorenulls=True).over(
        Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("f", "b", earlier.alias("_earlier"))
    here = F.last(first, ignorenulls=True).over(
        Window.partitionBy("f", "b").orderBy("r").rowsBetween(Window.unboundedPreceding, 0))
    part = part.withColumn("_here", here).join(splits, ["f", "b"])
    joined = (part.groupBy("f", F.coalesce("_here", "_earlier").alias("at"))
              .agg(F.array_sort(F.collect_list(F.struct("b", "r", "value"))).alias("lines"))
              .select("f", "at.b", "at.r", F.array_join("lines.value", "\n").alias("record")))
    return (whole.where(F.trim("value") != "").select("f", "b", "r", F.col("value").alias("record"))
            .union(joined))
