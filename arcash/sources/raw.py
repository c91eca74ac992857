"""Raw text scans: CSV exports with an explicit ingest order, plus the null scrub."""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from arcash.functions.text import scrub_cell
from arcash.schemas import RAW_COLUMNS
from arcash.session import RunFolder
from arcash.sources.records import broken_records, file_heads

SEQ = "_seq"


# Cells as CSV writers quote them: a quote inside a quoted cell is doubled.
CSV_FORM = {"escape": '"', "mode": "PERMISSIVE"}


def read_raw_csv(spark: SparkSession, path: str, table: str, folder: RunFolder = None) -> DataFrame:
    """Scan one raw CSV export (or a folder of them) as all-text columns.

    Columns are selected by name, file by file (files may differ in their column order).
    ``_seq`` records the ingest order, which first-wins de-duplication needs because a
    DataFrame has no row order: (file path, split start, position inside the split). The split
    start matters because Spark packs splits into partitions by size, not by file name.

    One scan at the start reads every file's header and looks for line breaks in quoted cells.
    Files without any are read by the splittable CSV reader; records of the others are put
    together first (``records``), in tables of ``folder``.
    A missing path raises ``FileNotFoundError``; a missing column raises ``ValueError``, as does
    a quote that is never closed.
    """
    try:
        heads = file_heads(spark, path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"Missing required input: {path}") from exc
        raise
    parts = []
    plain = {}
    for h in heads:
        if not h.broken:
            plain.setdefault(h.head, []).append(h.f)
    for head, files in plain.items():
        names = header_names(head)
        df = (spark.read.schema(positions(names)).options(**CSV_FORM).option("header", True)
              .option("multiLine", False).csv(path)
              .withColumn(SEQ, sequence(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                        F.monotonically_increasing_id())))
        if len(files) < len(heads):
            df = df.where(F.col(f"{SEQ}.f").isin(files))
        parts.append(by_name(df, names, path, table))
    broken = [h.f for h in heads if h.broken]
    if broken:
        records = broken_records(spark, path, broken, folder or RunFolder(spark, "csv"))
        first = records.groupBy("f").agg(F.min(F.struct("b", "r", "record")).alias("h")).select("f", "h.*")
        heads_of = {}
        for r in first.orderBy("f").collect():       # one row a file
            heads_of.setdefault(r.record, []).append(r)
        for head, rows in heads_of.items():
            names = header_names(head)
            skip = [(r.f, r.b, r.r) for r in rows]
            skip = spark.createDataFrame(skip, "f string, b long, r long")
            mine = records.where(F.col("f").isin([r.f for r in rows])).join(skip, ["f", "b", "r"], "left_anti")
            df = mine.select(F.from_csv("record", positions(names), CSV_FORM).alias("c"),
                             sequence(F.col("f"), F.col("b"), F.col("r")).alias(SEQ)).select("c.*", SEQ)
            parts.append(by_name(df, names, path, table))
    if not parts:
        raise ValueError(f"{path}: missing column(s) {list(RAW_COLUMNS[table])}")
    return reduce(DataFrame.union, parts)


def header_names(head: str) -> list[str]:
    """Column names of a header record."""
    return next(csv.reader(io.StringIO(head)))


def positions(names: list[str]) -> str:
    """A schema of text columns, named by their place (names may repeat)."""
    return ", ".join(f"c{i} string" for i in range(len(names)))


def sequence(file: Column, block: Column, row: Column) -> Column:
    return F.struct(file.alias("f"), block.alias("b"), row.alias("r"))


def by_name(df: DataFrame, names: list[str], path: str, table: str) -> DataFrame:
    """The table's columns, picked by the header's names (the first of equal names)."""
    want = RAW_COLUMNS[table]
    missing = [c for c in want if c not in names]
    if missing:
        raise ValueError(f"{path}: missing column(s) {missing}")
    return df.select(*[F.col(f"c{names.index(c)}").alias(c) for c in want], SEQ)


def scrub_nulls(df: DataFrame, columns=None, csv_tokens: bool = True) -> DataFrame:
    """Replace missing-value placeholders with real nulls in every (given) text column."""
    columns = [c for c in (columns or df.columns) if c != SEQ]
    return df.select(*[scrub_cell(c, csv_tokens).alias(c) if c in columns else F.col(c)
                       for c in df.columns])
