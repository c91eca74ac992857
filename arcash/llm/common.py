"""Shared helpers: run folders in the shared checkpoint folder, per-worker caches, word hashes.

Every operator module is pickled by value (``ship``), so executors need no installed copy.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.session import ensure_checkpoint_dir


def ship(name: str) -> None:
    """Send the functions of module ``name`` to executors by value, not by import."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


class Scratch:
    """A folder of intermediate Parquet tables under ``spark.checkpoint.dir`` for one call.

    ``cut`` writes a table and reads it back, which ends its lineage: lost executors cost
    only the work after the cut. ``drop`` deletes tables that no later step reads; what a
    returned DataFrame still reads is deleted when the Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        atexit.register(self._quiet_drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names or ("",):
            p = jvm.org.apache.hadoop.fs.Path(self.path(n).rstrip("/"))
            p.getFileSystem(conf).delete(p, True)

    def _quiet_drop(self) -> None:
        try:
            self.drop()
        except Exception:          # the session is already gone
            pass


def begin(owner: str) -> dict:
    """The values that ``owner`` keeps in this Python worker from task to task.

    Workers outlive stages, so only one owner's values are kept: when another operator begins,
    those of the one before are dropped and their pages handed back to the system (freed pages
    that the allocators keep would count against the executor in every later stage).
    """
    held = sys.__dict__.setdefault("_arcash_llm_state", {})
    if held.get("owner") != owner:
        held.clear()
        held["owner"] = owner
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):      # another C library than glibc
            pass
    return held


def worker_state(owner: str, key: str, make):
    """A value kept in one Python worker (vocabularies, word caches) while ``owner`` runs."""
    held = begin(owner)
    if key not in held:
        held[key] = make()
    return held[key]


class BoundedCache(dict):
    """``cache[word]`` computes and keeps a value; the cache is emptied when it is full."""

    def __init__(self, compute, limit: int = 600_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def word_hash(word: bytes) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(word)


MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
ROLL = np.uint64(0x9E3779B97F4A7C15)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


def hashed_words(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text: A-Z lowered, split at ASCII white space."""
    cache = worker_state("shingles", "words", lambda: BoundedCache(word_hash, 200_000))
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all ``width``-word shingles of the whole text.

    A text with fewer words gives one shingle, the whole sequence; without words, none.
    """
    w = hashed_words(text)
    n = len(w)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(width, n)
    with np.errstate(over="ignore"):
        h = np.full(n - size + 1, np.uint64(size), np.uint64)
        for j in range(size):
            h = mix64(h * ROLL + w[j:n - size + 1 + j])
    return np.unique(h)


def components(scratch: Scratch, edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` of long ids: one row ``(id, component)`` per
    vertex, ``component`` the smallest id reachable.

    Alternating large-star and small-star rounds: each is one aggregate and one join over
    the edge list, written to the run folder, so no vertex's neighbours ever meet in one
    task or on the driver; the driver sees only a row count and a checksum per round.
    """
    def both(e):
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e, large):
        # e(a, b): neighbours b of a, to be hung below the least of them (and of a)
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        j = e.join(low, "a")
        out = j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else \
            j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def stamp(e):
        r = e.agg(F.count("*").alias("n"),
                  F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["x"]

    cur = scratch.cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), f"{name}-0")
    seen, last = stamp(cur), 0
    for i in range(1, max_rounds + 1):
        # large star over both directions, then small star over edges from larger to smaller
        nxt = star(both(cur), True)
        nxt = star(nxt.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False)
        cur = scratch.cut(nxt, f"{name}-{i}")
        scratch.drop(f"{name}-{last}")
        last = i
        now = stamp(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    roots = cur.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
