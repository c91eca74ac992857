"""Mixing sources to target weights by pivotal dependent rounding (operator 12), native.

1. Sizes (words) come from one scan. Sources are numbered in code-point order, null last;
   their weights repeat. ``share`` of all words is dealt by weight, no target goes above
   ``cap`` times its source, and what is over is dealt again by weight until none is above:
   the targets are ``least(cap * size, weight * level)``, and each round asks Spark for two
   sums only.
2. Every document of a source is to be taken ``target / source_size`` times: a whole number of
   copies, and a fraction that is rounded. Rows that are alike in id, source and size are one
   item with a count: transfers among equals leave whole copies and one fraction at most.
3. Fractions are rounded in a reduction tree. A leaf holds about ``fold`` items of one source,
   dealt by hash, so a source of any size has leaves alike. In a node two items meet: words
   move from one to the other, in a random direction with no change in expectation, until one
   of them is taken whole or not at all; the other one meets the next item. The one fraction
   that is left goes up to the node above, which takes ``fold`` of them. Each level is one
   shuffle, ``fold`` times smaller than the one below.
4. The words of all fractions of a source are the same after each transfer. The one fraction
   left at the root goes to the nearer whole number, so a source's taken words differ from its
   target by half of one document at most.

Randomness is a hash of the items that meet: reruns agree, however rows are partitioned.

Defined results: a null or blank text has size 0 and is taken 0 words; null sources are one
source, the last; null doc_ids are rounded like others; rows that are alike in id, source and
size are interchangeable, and each gets its own row; texts of any length are counted whole;
ties of hashes are broken by id and size; an empty table gives an empty result. Only
``doc_id``, ``source`` and ``text`` are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read
from arcash.operators.ranking import running_total

WORD = r"[^\x20\x09-\x0D]+"


def sized_rows(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, m): rows alike in all three are one, with their number."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size")) \
        .groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("m"))


def source_targets(scratch: Scratch, rows: DataFrame, weights, share: float, cap: float) -> DataFrame:
    """(source, place, source_size, items, target) for each source."""
    sizes = scratch.cut(rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count(F.lit(1)).alias("items"))
        .withColumn("one", F.lit(1)), "sizes")
    placed = running_total(sizes, [F.col("source").asc_nulls_last()], "one", scratch, "ranged")
    place = (F.col("_upto") - 1).cast("long")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (place % len(weights) + 1).cast("int"))
    sources = scratch.cut(placed.select("source", place.alias("place"), "source_size", "items",
                                        weight.alias("weight")), "sources")

    most = F.col("source_size") * F.lit(float(cap))
    total, level = sources.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while total:                         # water level: rises until no further target is capped
        over = most < F.col("weight") * F.lit(level)
        capped, free = sources.agg(F.sum(F.when(over, F.col("source_size")).otherwise(0)),
                                   F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        rise = (share * total - cap * capped) / free if free else level
        if rise <= level:
            break
        level = rise
    return sources.select("source", "place", "source_size", "items",
                          F.least(most, F.col("weight") * F.lit(level)).alias("target"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row."""
    return F.transform(F.array(value), body)[0]


def meet(acc: Column, new: Column, seed: int) -> Column:
    """One pivotal step: the carried item and a new one; one of them becomes whole."""
    old = acc["rest"]

    def settle(t: Column) -> Column:
        a, b = old["size"], new["size"]              # words of the two documents
        p, q = old["p"], new["p"]
        gain = t["gain"]
        # the mass that moves is the least that makes one of the two whole
        old_whole = F.when(gain, t["room"] <= t["give"]).otherwise(t["lose"] <= t["take"])
        moved = F.when(gain, F.least(t["room"], t["give"])).otherwise(-F.least(t["lose"], t["take"]))
        left = F.when(old_whole, q - moved / b).otherwise(p + moved / a)
        left = F.when(left < 1e-12, 0.0).when(left > 1 - 1e-12, 1.0).otherwise(left)
        whole = F.when(old_whole, old.withField("p", F.when(gain, 1.0).otherwise(0.0))) \
            .otherwise(new.withField("p", F.when(gain, 0.0).otherwise(1.0)))
        rest = F.when(old_whole, new.withField("p", left)).otherwise(old.withField("p", left))
        return F.struct(rest.alias("rest"), F.array_append(acc["done"], whole).alias("done"))

    draw = F.shiftrightunsigned(F.xxhash64(old["h"], new["h"], F.lit(seed)), 11) * F.lit(2.0 ** -53)
    room, lose = old["size"] * (1 - old["p"]), old["size"] * old["p"]
    give, take = new["size"] * new["p"], new["size"] * (1 - new["p"])
    up, down = F.least(room, give), F.least(lose, take)
    step = F.struct(room.alias("room"), lose.alias("lose"), give.alias("give"), take.alias("take"),
                    (draw * (up + down) < down).alias("gain"))
    settled = old.isNull() | (old["p"] == 0) | (old["p"] == 1)
    kept = F.when(old.isNull(), acc["done"]).otherwise(F.array_append(acc["done"], old))
    return F.when(settled, F.struct(new.alias("rest"), kept.alias("done"))).otherwise(let(step, settle))


def fold_nodes(nodes: DataFrame, keys: list, seed: int) -> DataFrame:
    """One level: the items of every node meet one after another, in the order of their hashes."""
    item = nodes.schema["item"].dataType.simpleString()
    start = F.struct(F.lit(None).cast(item).alias("rest"), F.array().cast(f"array<{item}>").alias("done"))
    met = F.aggregate(F.array_sort("items"), start, lambda acc, new: meet(acc, new, seed))
    return nodes.groupBy(*keys, "node").agg(F.collect_list("item").alias("items")) \
        .select(*keys, "node", met.alias("met")).select(*keys, "node", "met.done", "met.rest")


def one_row_each(items: DataFrame, keys: list, wide: int = 4096) -> DataFrame:
    """The rows an item stands for; items of very many rows are spread first."""
    cols = [*keys, "doc_id", "size", "base", "m", "ones"]
    few = items.where(F.col("m") <= wide).select(*cols, F.lit(0).cast("long").alias("at"))
    many = items.where(F.col("m") > wide) \
        .select(*cols, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / wide))).alias("at")) \
        .repartition("place", "doc_id", "size", "at")
    last = F.least(F.col("m") - F.col("at") * wide, F.lit(wide)) - 1
    rows = few.unionByName(many).select(*cols, "at", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i"))
    copies = F.col("base") + F.when(F.col("at") * wide + F.col("i") < F.col("ones"), 1).otherwise(0)
    return rows.withColumn("copies", copies.cast("long"))


def mix_sources(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0,
                fold: int = 64, seed: int = 12, broadcast_sources: int = 100_000) -> DataFrame:
    """One row per row of ``docs(doc_id, source, text)``: doc_id, source, size, source_size,
    target, copies (how often the mix takes the document) and taken (words).

    weights: of the sources in code-point order, repeating; share: the mix's words over all
    words; cap: most copies, on average, of a source; fold: items a tree node takes;
    broadcast_sources: up to so many sources (some 10 MB) their table is broadcast, a larger
    one is joined by a shuffle that adaptive execution splits.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.cut(sized_rows(docs), "rows")
    targets = scratch.cut(source_targets(scratch, rows, weights, share, cap), "targets")
    n_sources, most_items = targets.agg(F.count(F.lit(1)), F.max("items")).first()

    keys = ["source", "place", "source_size", "target"]
    known = targets.withColumnRenamed("source", "s")
    known = F.broadcast(known) if n_sources <= broadcast_sources else known
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = F.col("m") * (F.col("times") - F.col("base"))
    items = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s") \
        .withColumn("times", times).withColumn("base", F.floor("times")) \
        .withColumn("ones", F.floor(wanted)).withColumn("p", wanted - F.col("ones")) \
        .withColumn("h", F.xxhash64("doc_id", "size", F.lit(seed)))
    open_ = (F.col("size") > 0) & (F.col("p") > 0)

    leaves = F.greatest(F.ceil(F.col("items") / F.lit(fold)), F.lit(1))
    names = ["h", "doc_id", "size", "m", "base", "ones", "p"]
    level = items.where(open_).select(*keys, F.pmod("h", leaves).alias("node"), F.struct(*names).alias("item"))
    settled = [items.where(~open_).select(*keys, *names)]
    width, depth = max(1, math.ceil((most_items or 0) / fold)), 0
    while True:
        done = scratch.cut(fold_nodes(level, keys, seed), f"level{depth}")
        settled.append(done.select(*keys, F.explode("done").alias("item")).select(*keys, "item.*"))
        level = done.where("rest is not null").select(
            *keys, F.floor(F.col("node") / F.lit(fold)).alias("node"), F.col("rest").alias("item"))
        if width == 1:
            break
        width, depth = math.ceil(width / fold), depth + 1
    settled.append(level.select(*keys, "item.*"))

    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    found = found.withColumn("ones", F.col("ones") + F.when(F.col("p") >= 0.5, 1).otherwise(0))
    return one_row_each(found, keys).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    return mix_sources(read(spark, sf_dir, "documents")).drop("source", "copies")
