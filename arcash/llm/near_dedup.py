"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures (operator 2).

1. Every whole text becomes its set of 5-word shingles. Texts with equal sets are one class;
   only the least doc_id of a class goes on, so a class of any size costs one aggregate.
2. A signature has ``chunks * 8`` positions of 8 bits; a chunk is one 64-bit word. By
   pigeonhole two signatures that differ in at most ``2 * chunks - 1`` positions have a
   chunk that differs in one position at most. Each chunk is indexed under its eight words
   with one position blanked (all allowed errors), so every such pair shares a key. A pair
   at Jaccard 0.85 is missed only if all chunks have two errors or more: 2e-5 with 10.
3. Under each key every signature is tied to the key's least id; the components of these
   ties are families. A pair that shares a key is in one family. Small families share
   cells; a large family is dealt into blocks by size class and hash, and each cell
   holds two blocks of bounded size, so no group ever meets whole in one task.
4. In its cell each pair is verified on the full sets, and only a spanning forest of the
   verified links leaves the cell: no pair list grows with the square of a group.
5. The components of the links, spread over classes, are the result.

Defined results: a null or blank text has an empty set, is linked with nothing and is its
own component; a doc_id that repeats is one document with the sets of all its rows: each row
keeps its own n_shingles, each set is linked on its own, and the rows share a component (doc_ids
are below 2 ** 62); texts of any length are hashed whole, and ties go to the least doc_id; other
columns than doc_id and text are not read; a null doc_id has no
component and is not kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, components, mix64, read, ship, shingle_set

ship(__name__)

SEEDS = np.random.default_rng(20).integers(1, 2 ** 63, (2, 512), dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)


def signature(shingles: np.ndarray, chunks: int) -> np.ndarray:
    """``chunks`` words of eight 8-bit positions, each the low byte of one minimum hash."""
    k = 8 * chunks
    low = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            part = shingles[None, at:at + 2048]
            h = (part ^ SEEDS[0, :k, None]) * SEEDS[1, :k, None]
            low = np.minimum(low, h.min(axis=1))
        low = mix64(low) & np.uint64(255)
    return low.astype(np.uint8).view("<u8").view("<i8")


def sign(docs: DataFrame, chunks: int, width: int, text: str = "text") -> DataFrame:
    """doc_id, a hash of the text, the set's size and two fingerprints, and the signature's words."""
    @F.pandas_udf("n long, f long, g long, sig array<long>")
    def signed(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            s = shingle_set(t, width)
            with np.errstate(over="ignore"):
                f, g = s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s)) if len(s) else 0
            out.append((len(s), np.uint64(f).astype(np.int64), np.uint64(g).astype(np.int64),
                        signature(s, chunks)))
        return pd.DataFrame(out, columns=["n", "f", "g", "sig"])

    return docs.select("doc_id", F.xxhash64(text).alias("t"), signed(F.col(text)).alias("_s")) \
        .select("doc_id", "t", "_s.*")


def set_classes(full: DataFrame) -> DataFrame:
    """(f, g, n, id, doc_id, t, sig): one row per distinct set, with the least row that has it.

    ``id`` names the class: its least doc_id; where a doc_id is the least of several classes (it
    repeats with unlike texts), one of them has it and the others an id above 2 ** 62, taken
    from the set's fingerprints, so the least id of a component is always a doc_id.
    """
    classes = full.groupBy("f", "g", "n").agg(F.min(F.struct("doc_id", "t", "sig")).alias("r")) \
        .select("f", "g", "n", "r.*")
    name = F.struct("f", "g", "n")
    shared = classes.groupBy("doc_id").agg(F.min(name).alias("first"), F.count(F.lit(1)).alias("c")) \
        .where("c > 1").select("doc_id", "first")
    other = F.shiftrightunsigned(F.xxhash64("f", "g", "n"), 2).bitwiseOR(F.lit(1 << 62))
    return classes.join(shared, "doc_id", "left").select(
        "f", "g", "n", F.when(F.col("first") != name, other).otherwise(F.col("doc_id")).alias("id"),
        "doc_id", "t", "sig")


def index(reps: DataFrame, chunks: int) -> DataFrame:
    """(key, id): each chunk under its eight words with one position blanked."""
    keys = [F.xxhash64(F.col("sig")[c].bitwiseAND(F.lit(~(255 << (8 * p)) if p < 7 else 2 ** 56 - 1)),
                       F.lit(8 * c + p))
            for c in range(chunks) for p in range(8)]
    return reps.select("id", F.explode(F.array(*keys)).alias("key"))


def families(scratch: Scratch, reps: DataFrame, chunks: int) -> DataFrame:
    """(id, family) of all signatures that share a key with another one.

    The index is shuffled twice (pre-aggregated for each key's least id, and for the join),
    so that a hot key is combined before its shuffle and split by the adaptive join.
    """
    rows = index(reps, chunks)
    least = rows.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")) \
        .where("least < most").select("key", "least")
    ties = scratch.cut(rows.join(least, "key").where("id <> least")
                       .select(F.col("id").alias("a"), F.col("least").alias("b")).distinct(), "ties")
    out = components(scratch, ties, "families")
    return out.select("id", F.col("component").alias("family"))


class Forest:
    """Union-find over the rows of one cell."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def cell_links(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``: 100 * |a & b| >= percent * |a | b|.

    side: pairs of one side only are left out if there are two sides (another cell has
    them). Intersections of all pairs come from products of incidence blocks.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    two = side.min() != side.max()
    forest, out = Forest(n), []

    def linked(i, j, common):
        return 100 * common >= percent * (size[i] + size[j] - common)

    if n <= 6:
        for i in range(n):
            for j in range(i):
                if (two and side[i] == side[j]) or 100 * min(size[i], size[j]) < percent * max(
                        size[i], size[j]):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if linked(i, j, both) and forest.join(i, j):
                    out.append((i, j))
        return out
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times[column] > 1              # a shingle of one set only adds to no intersection
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    dense = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1 if len(column) else column
    common = np.zeros((n, n), np.float32)
    width = 4096
    for at in range(0, int(dense[-1]) + 1 if len(dense) else 0, width):
        lo, hi = np.searchsorted(dense, (at, at + width))
        block = np.zeros((n, width), np.float32)
        block[owner[lo:hi], dense[lo:hi] - at] = 1
        common += block @ block.T
    common = common.astype(np.int64)
    yes = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    if two:
        yes &= side[:, None] != side[None, :]
    for i, j in zip(*np.nonzero(np.tril(yes, -1))):
        if forest.join(int(i), int(j)):
            out.append((int(i), int(j)))
    return out


def verified(scratch: Scratch, docs: DataFrame, members: DataFrame, percent: int, width: int,
             block_rows: int, block_shingles: int) -> DataFrame:
    """Links (a, b) between class representatives of one family, as spanning forests."""
    # members: id, doc_id, t, family, n, cls (sets whose sizes are two classes apart can't be linked)
    by_class = members.groupBy("family", "cls").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    blocks = F.greatest(F.ceil(F.col("c") / block_rows), F.ceil(F.col("s") / block_shingles), F.lit(1))
    shape = by_class.withColumn("nb", blocks.cast("int")).groupBy("family").agg(
        F.sum("c").alias("fc"), F.sum("s").alias("fs"),
        F.map_from_entries(F.collect_list(F.struct("cls", "nb"))).alias("nb"))   # one entry a class
    small = (F.col("fc") <= block_rows) & (F.col("fs") <= block_shingles)
    total = members.agg(F.count("*").alias("c"), F.sum("n").alias("s")).first()
    pools = max(1, math.ceil((total["c"] or 0) / block_rows), math.ceil((total["s"] or 0) / block_shingles))
    placed = members.join(shape, "family")
    own = F.coalesce(F.element_at("nb", F.col("cls")), F.lit(1))
    up = F.coalesce(F.element_at("nb", F.col("cls") + 1), F.lit(0))
    down = F.coalesce(F.element_at("nb", F.col("cls") - 1), F.lit(0))
    blk = F.pmod(F.xxhash64("id"), own).cast("int")

    def cell(c1, b1, c2, b2, side):
        return F.struct(F.xxhash64("family", c1, b1, c2, b2).alias("cell"),
                        F.lit(side).alias("side") if isinstance(side, int) else side.alias("side"))

    def over(n, make):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), make)) \
            .otherwise(F.array().cast("array<struct<cell:bigint,side:int>>"))
    cls = F.col("cls")
    same = over(own, lambda j: cell(cls, F.least(blk, j), cls, F.greatest(blk, j),
                                    F.when(j >= blk, 0).otherwise(1)))
    cells = F.concat(same, over(up, lambda j: cell(cls, blk, cls + 1, j, 0)),
                     over(down, lambda j: cell(cls - 1, j, cls, blk, 1)))
    pool = F.array(F.struct(F.pmod(F.xxhash64("family"), F.lit(pools)).alias("cell"),
                            F.lit(0).alias("side")))
    placed = placed.select("id", "doc_id", "t", "family", small.alias("small"),
                           F.when(small, pool).otherwise(cells).alias("cells"))

    @F.pandas_udf("array<long>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width).view(np.int64) for t in texts])

    # the class's own text: rows alike in doc_id and text are one, so a cell's bound holds
    texts = docs.select("doc_id", F.xxhash64("text").alias("t"), "text") \
        .groupBy("doc_id", "t").agg(F.first("text").alias("text"))
    # one plan at every size: texts are shuffled once and never joined to a broadcast table
    rows = texts.join(placed.hint("merge"), ["doc_id", "t"]).select("id", "family", "small", "cells",
                                                                    shingles("text").alias("set"))
    rows = rows.select("id", "family", "small", "set", F.explode("cells").alias("c")) \
        .select("id", "family", "small", "set", "c.cell", "c.side")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.sort_values(["family", "id"]).groupby("family", sort=False):
            ids = g["id"].to_numpy()
            sets = [np.asarray(s, np.int64) for s in g["set"]]
            out += [(ids[i], ids[j]) for i, j in cell_links(sets, g["side"].to_numpy(), percent)
                    if ids[i] != ids[j]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return scratch.cut(rows.groupBy("small", "cell").applyInPandas(links, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, chunks: int = 10,
                    block_rows: int = 256, block_shingles: int = 500_000) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    docs = docs.select("doc_id", "text")
    signed = scratch.cut(sign(docs, chunks, width), "signed")
    full = signed.where("n > 0 and doc_id is not null")
    classes = scratch.cut(set_classes(full), "classes")
    # under width + 1 shingles no two unequal sets reach the threshold
    least = next(n for n in range(1, 1000) if 100 * n >= percent * (n + 1))
    reps = classes.where(F.col("n") >= least)
    group = families(scratch, reps.select("id", "sig"), chunks)
    step = 1.0001 * math.log(100 / percent)      # a margin for rounding
    members = scratch.cut(
        reps.select("id", "doc_id", "t", "n").join(group, "id")
        .withColumn("cls", F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("int")),
        "members")
    links = verified(scratch, docs, members, percent, width, block_rows, block_shingles)
    # classes that share a doc_id (rows that repeat it) belong together
    rep = classes.select("f", "g", "n", F.col("id").alias("rep"))
    rows = signed.join(rep, ["f", "g", "n"], "left").where("n > 0 and doc_id is not null")
    least = rows.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("b < a")
    shared = rows.join(least.select("doc_id", "b"), "doc_id").select(F.col("rep").alias("a"), "b")
    found = scratch.cut(components(scratch, links.union(shared), "near"), "components")
    label = rep.join(found, F.col("rep") == F.col("id"), "left").select(
        "f", "g", "n", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = scratch.cut(
        signed.join(label, ["f", "g", "n"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
            F.coalesce(own == F.col("doc_id"), F.lit(False)).alias("kept")), "result")
    scratch.drop("signed", "classes", "ties", "members", "links", "components")
    return out


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document, at Jaccard 0.85."""
    return near_duplicates(read(spark, sf_dir, "documents"))
