"""Corpus pipeline: toxicity, line de-duplication, near-duplicates, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), with the columns
of ``documents``, and returns the documents that go on with the same columns (the last one
the packed pieces). ``run`` writes each stage's result under ``spark.checkpoint.dir`` and
reads it again, so no stage repeats an earlier one's work.

Rows with null ids or texts go through every stage by its operator's rules; rows that repeat
a doc_id are filtered together. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read
from arcash.llm.decontamination import clean
from arcash.llm.line_dedup import dedup_lines
from arcash.llm.near_dedup import near_duplicates
from arcash.llm.packing import pack_documents
from arcash.llm.toxicity import trained_scores


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return trained_scores(spark, rows, sf_dir, "toxic").where("toxic < 0.5").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from all but one document; documents left without words go."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    changed, n_chars = F.col("n_dropped") > 0, docs.schema["n_chars"].dataType
    out = dedup_lines(rows).where(~changed | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    new = {"text": F.col("text"), "n_chars": F.when(changed, F.char_length("text").cast(n_chars))
           .otherwise(F.col("row.n_chars"))}
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (Jaccard 0.8 on five-word shingles) the least doc_id stays."""
    # 16 chunks: a pair at 0.8 is missed with probability 1e-5
    found = near_duplicates(docs, percent=80, chunks=16)
    gone = found.where("component_id is not null and not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents, packed into sequences of 2048 tokens."""
    # the executor's memory is shared with what earlier stages left in the JVM's heap
    return pack_documents(docs, cached=400_000)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: A classifier and a packing heuristic are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
