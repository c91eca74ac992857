"""Sinks: star export, all-or-nothing publish and run comparison.

Publish without a table format: every table of a run is written under
``<base>/run_id=<id>/<table>``; only when all writes succeeded is the run committed, as the next
version of the log in ``<base>/_log`` (``arcash.plans.commits``). Readers see the previous complete
run or the new complete run, never a mix and never none; of publishers that race one is committed.
A base without a log is read by its one-line pointer ``_CURRENT``, as older runs left it.
"""

from __future__ import annotations

import json
import uuid
from decimal import Decimal
from typing import Dict, Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arcash import config as C
from arcash.plans import commits
from arcash.plans.commits import PublishConflict, file_system, hadoop_path, read_text

POINTER = "_CURRENT"
FORM = "_form.json"      # the tables' format and schemas, beside them
METRICS = "_metrics.json"    # row counts and key totals, taken while the tables were written


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file: write a new file, then rename it over the old one."""
    fs, tmp = file_system(spark, path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    p = fs.makeQualified(hadoop_path(spark, path))
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), p, overwrite)


def export_tables(tables: Dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> Dict[str, tuple]:
    """Write each table (parents first) with its declared columns. CSV renders dates as ISO
    text, as the source did; the schemas are kept beside the tables, so either form reads back.

    Returns the run's metrics, name -> (kind, value): they are observed while writing and kept
    beside the tables too, so that a later run is compared without reading any table."""
    written, metrics = {}, {}
    for name in (n for n in C.LOAD_ORDER if n in tables):
        df = tables[name]
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        wanted = table_metrics(name)
        w = df.observe(seen, *[c.alias(m) for m, (_, c) in wanted.items()]).write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(f"{out_dir}/{name}")
        else:
            w.parquet(f"{out_dir}/{name}")
        written[name] = json.loads(df.schema.json())
        metrics |= {m: (kind, seen.get[m]) for m, (kind, _) in wanted.items()}
    for df in list(tables.values())[:1]:
        write_text(df.sparkSession, f"{out_dir}/{FORM}", json.dumps({"format": fmt, "schemas": written}))
        write_text(df.sparkSession, f"{out_dir}/{METRICS}", json.dumps(metrics, indent=2, default=str))
    return metrics


def write_review(review: Dict[str, DataFrame], out_dir: str) -> None:
    """Write every review set, also when it is empty: the schema is kept."""
    for name, df in review.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def publish(spark: SparkSession, tables: Dict[str, DataFrame], base: str, run_id: str,
            review: Dict[str, DataFrame] = None, report: dict = None, fmt: str = "parquet",
            based_on: int = None) -> str:
    """Write a complete run, then commit it. Returns the run directory.

    A report that holds ``compare_with_previous`` gets the comparison of the metrics just taken
    with those stored by the run before. based_on: the version (``current_version``) that the run's
    work started from, the present one if not given. If another run was committed since, this one's
    folder is deleted and ``PublishConflict`` raised; the other run stays the current one.
    """
    if based_on is None:
        based_on = current_version(spark, base)
    previous = stored_metrics(spark, base, commits.commit_of(spark, base, based_on).run_id if based_on else None)
    folder = commits.claim_folder(spark, base, run_id)
    run_dir = f"{base}/{folder}"
    metrics = export_tables(tables, run_dir, fmt)
    write_review(review or {}, f"{run_dir}/_review")
    if report is not None:
        if "compare_with_previous" in report:
            report["compare_with_previous"] = [] if previous is None else [
                r.asDict() for r in compare_runs(previous, metric_rows(spark, metrics)).orderBy("metric").collect()]
        write_text(spark, f"{run_dir}/_validation_report.json", json.dumps(report, indent=2, default=str))
    try:
        commits.append(spark, base, based_on, run_id, folder)
    except PublishConflict:
        commits.delete_folder(spark, run_dir)
        raise
    return run_dir


def current_version(spark: SparkSession, base: str) -> int:
    """The number of the last committed version; 0 before the first."""
    return max(commits.versions(spark, base), default=0)


def current_run(spark: SparkSession, base: str) -> Optional[str]:
    last = commits.latest(spark, base)
    if last:
        return last.run_id
    rid = read_text(spark, f"{base}/{POINTER}")
    return rid.strip() if rid else None


def run_folder(spark: SparkSession, base: str, run_id: str) -> str:
    """Where a run's tables are: as committed, or under its id in a base without a log."""
    commit = commits.find_run(spark, base, run_id)
    return f"{base}/{commit.folder if commit else f'run_id={run_id}'}"


def read_published(spark: SparkSession, base: str, run_id: str = None) -> Dict[str, DataFrame]:
    """The tables of a published run that are there, in the form they were written."""
    rid = run_id or current_run(spark, base)
    if rid is None:
        return {}
    run_dir = run_folder(spark, base, rid)
    form = json.loads(read_text(spark, f"{run_dir}/{FORM}") or '{"format": "parquet", "schemas": {}}')
    out = {}
    for n in C.LOAD_ORDER:
        fs, p = file_system(spark, f"{run_dir}/{n}")
        if not fs.exists(p):
            continue
        reader = spark.read
        if n in form["schemas"]:
            reader = reader.schema(StructType.fromJson(form["schemas"][n]))
        out[n] = reader.option("header", True).csv(f"{run_dir}/{n}") if form["format"] == "csv" \
            else reader.parquet(f"{run_dir}/{n}")
    return out


# ---- run comparison -------------------------------------------------------------------

TOTALS = (("FactInvoice", "amount_incl_gst", "total_invoiced"),
          ("forecast_by_invoice", "amount_incl_gst", "forecast_total_by_invoice"),
          ("forecast_weekly", "amount", "forecast_total_weekly"))


def table_metrics(name: str) -> Dict[str, tuple]:
    """The metrics of one table: name -> (kind, aggregate)."""
    out = {f"rows.{name}": ("count", F.count(F.lit(1)).cast("decimal(20,2)"))}
    for table, col, label in TOTALS:
        if table == name:
            out[label] = ("total", F.coalesce(F.sum(col), F.lit(0)).cast("decimal(24,2)"))
    return out


def run_metrics(tables: Dict[str, DataFrame]) -> DataFrame:
    """Long form (metric, kind, value): row counts of the tables that are there, and key totals;
    one pass a table."""
    parts = []
    for name in (n for n in C.LOAD_ORDER if n in tables):
        wanted = table_metrics(name)
        row = tables[name].agg(*[c.cast("decimal(24,2)").alias(m) for m, (_, c) in wanted.items()])
        parts.append(row.select(F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.lit(kind).alias("kind"), F.col(f"`{m}`").alias("value"))
            for m, (kind, _) in wanted.items()]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_rows(spark: SparkSession, metrics: Dict[str, tuple]) -> DataFrame:
    """Stored metrics in the form of ``run_metrics``."""
    return spark.createDataFrame([(m, kind, Decimal(str(v))) for m, (kind, v) in metrics.items()],
                                 "metric string, kind string, value decimal(24,2)")


def stored_metrics(spark: SparkSession, base: str, run_id: str = None) -> Optional[DataFrame]:
    """The metrics of a published run (the current one), from its small file; those of a run that
    was published without the file are computed from its tables. None without a run."""
    rid = run_id or current_run(spark, base)
    if rid is None:
        return None
    text = read_text(spark, f"{run_folder(spark, base, rid)}/{METRICS}")
    if text is not None:
        return metric_rows(spark, json.loads(text))
    tables = read_published(spark, base, rid)
    return run_metrics(tables) if tables else None


def compare_published(spark: SparkSession, base: str, previous: str, current: str = None) -> DataFrame:
    """``compare_runs`` of two published runs, without reading their tables."""
    sides = {rid: stored_metrics(spark, base, rid) for rid in (previous, current or current_run(spark, base))}
    for rid, metrics in sides.items():
        if metrics is None:
            raise ValueError(f"{base} holds no run {rid}")
    return compare_runs(*(sides[rid] for rid in (previous, current or current_run(spark, base))))


def compare_runs(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Previous vs current metrics; ``changed`` when counts differ or totals move >= 0.01. A
    table that one run lacks has a null there and counts as changed."""
    p = previous.select("metric", "kind", F.col("value").alias("previous"))
    c = current.select("metric", F.col("kind").alias("_k"), F.col("value").alias("current"))
    j = p.join(c, on="metric", how="full_outer")
    kind = F.coalesce("kind", "_k")
    delta = F.col("current") - F.col("previous")
    changed = F.when(F.col("previous").isNull() | F.col("current").isNull(), F.lit(True)) \
        .when(kind == "count", delta != 0).otherwise(F.abs(delta) >= F.lit("0.01").cast("decimal(4,2)"))
    return j.select("metric", kind.alias("kind"), "previous", "current", delta.alias("delta"),
                    changed.alias("changed"))
