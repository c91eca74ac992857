"""Nearest neighbours by learned partitions (operator 9).

1. A bounded sample (``sample_rows`` vectors, least by a hash of their id, copies counted
   once) gives a neighbour graph, which recursive spectral bisection with swaps cuts into
   equal parts with few neighbours apart.
2. A small network learns from a vector the parts of its neighbours. It is the index: a few
   thousand weights, broadcast.
3. Every row goes to its most probable part. A query goes to its most probable parts, as
   many as reach ``target`` recall on the sample (there neighbours are further apart, so
   the share found over all rows is no lower).
4. Parts are dealt into cells of bounded numbers of rows and queries. A cell finds its
   queries' best rows, rescored exactly; the best of a query's cells are its result. A
   query whose parts hold fewer rows than asked for is searched again in all parts.

Nearness is the largest inner product in double precision; ties go to the smaller id.

Defined results: vectors that are null, zero, of another length than most of the sample's, or
hold a null or non-finite number take no part; nor do rows with a null id; of rows that
repeat an id the least vector counts; an empty table gives an empty result; other columns
play no part.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read, ship

ship(__name__)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors that take part, one per id."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
            .where(finite & F.exists(v, lambda x: x != 0))
            .groupBy(F.col(vec_id).cast("long").alias("vec_id")).agg(F.min(F.col(vector)).alias("v")))


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` rows of largest inner product with each row, itself left out."""
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        s = x[at:at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect(a: np.ndarray, b: np.ndarray, n: int, rng) -> np.ndarray:
    """Halve a graph of ``n`` nodes with edges a-b: the lower half of the second eigenvector
    of the random walk, then swaps of the pairs that gain most."""
    degree = np.maximum(1, np.bincount(a, minlength=n) + np.bincount(b, minlength=n)).astype(float)

    def around(x):
        return np.bincount(a, x[b], n) + np.bincount(b, x[a], n)
    x = rng.standard_normal(n)
    for _ in range(60):
        x = x + around(x) / degree
        x -= (x * degree).sum() / degree.sum()
        x /= np.linalg.norm(x) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2:]] = True
    for _ in range(4):
        other = around(np.where(side, 1.0, 0.0))
        gain = np.where(side, degree - 2 * other, 2 * other - degree)   # neighbours across less own
        p, q = (np.flatnonzero(s) for s in (side, ~side))
        p, q = p[np.argsort(-gain[p], kind="stable")], q[np.argsort(-gain[q], kind="stable")]
        t = min(len(p), len(q), max(1, n // 20))
        t = int((gain[p[:t]] + gain[q[:t]] > 2).sum())
        if t == 0:
            break
        side[p[:t]], side[q[:t]] = False, True
    return side


def balanced_parts(near: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Labels of ``parts`` (a power of two) equal parts of the neighbour graph."""
    rng = np.random.default_rng(seed)
    n = len(near)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    label = np.zeros(n, np.int64)
    count = 1
    while count < parts:
        new = label * 2
        for part in range(count):
            mine = np.flatnonzero(label == part)
            local = np.full(n, -1)
            local[mine] = np.arange(len(mine))
            inside = (local[a] >= 0) & (local[b] >= 0)
            new[mine[bisect(local[a[inside]], local[b[inside]], len(mine), rng)]] += 1
        label, count = new, 2 * count
    return label


class Router:
    """A network with one hidden layer from vectors to the probabilities of parts."""

    def __init__(self, dim: int, parts: int, hidden: int = 64, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.w = [rng.standard_normal((dim, hidden)) * np.sqrt(2 / dim), np.zeros(hidden),
                  rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
        self.scale, self.rng = 1.0, rng

    def _forward(self, x):
        h = np.maximum(0, x @ self.w[0] + self.w[1])
        o = h @ self.w[2] + self.w[3]
        e = np.exp(o - o.max(axis=1, keepdims=True))
        return h, e / e.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x * self.scale)[1]

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int = 20, rate: float = 2e-3) -> "Router":
        self.scale = np.sqrt(x.shape[1]) / (np.linalg.norm(x, axis=1).mean() + 1e-30)
        x = x * self.scale
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = self.rng.permutation(len(x))
            for at in range(0, len(x), 256):
                i = order[at:at + 256]
                h, p = self._forward(x[i])
                d = (p - target[i]) / len(i)
                dh = (d @ self.w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((x[i].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (
                        np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self


class Index:
    """Router and the number of parts a query is sent to."""

    def __init__(self, sample: list[list[float]], max_parts: int, target: float, k: int):
        self.dim = Counter(map(len, sample)).most_common(1)[0][0] if sample else 0
        x = np.unique(np.array([s for s in sample if len(s) == self.dim], float).reshape(-1, max(1, self.dim)), axis=0)
        parts = 1
        while parts < max_parts and len(x) >= 256 * parts:      # 128 sample vectors a part at least
            parts *= 2
        self.parts, self.probes, self.router = parts, 1, None
        if parts == 1:
            return
        near = neighbours(x, 10)
        label = balanced_parts(near, parts)
        target_share = np.zeros((len(x), parts))
        np.add.at(target_share, (np.repeat(np.arange(len(x)), 10), label[near].ravel()), 1 / 11)
        target_share[np.arange(len(x)), label] += 1 / 11
        self.router = Router(self.dim, parts).fit(x, target_share)
        p = self.router(x)
        home = p.argmax(axis=1)
        asked = np.random.default_rng(1).permutation(len(x))[:1000]
        wanted = home[neighbours(x, min(k, len(x) - 1))[asked]]
        rank = np.argsort(np.argsort(-p[asked], axis=1, kind="stable"), axis=1)
        hit_at = np.take_along_axis(rank, wanted, axis=1)
        shares = [(hit_at < m).mean() for m in range(1, parts + 1)]
        self.probes = 1 + next(i for i, s in enumerate(shares) if s >= target or i == parts - 1)

    def probable(self, x: np.ndarray, m: int) -> np.ndarray:
        if self.router is None:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-self.router(x), axis=1, kind="stable")[:, :m]


def best_rows(q: np.ndarray, q_id: np.ndarray, d: np.ndarray, d_id: np.ndarray, k: int):
    """The ``k`` best rows of each query: arrays of query id, row id and exact score.

    A matrix product finds candidates with a margin over its rounding; these are scored
    by one summation order, so that equal vectors tie exactly.
    """
    out = []
    norms = np.linalg.norm(d, axis=1)
    step = max(1, 4_000_000 // max(1, len(d)))
    for at in range(0, len(q), step):
        s = q[at:at + step] @ d.T
        s[q_id[at:at + step, None] == d_id[None, :]] = -np.inf
        kth = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
        for r in range(len(s)):
            margin = 1e-13 * q.shape[1] * np.linalg.norm(q[at + r]) * norms.max()
            c = np.flatnonzero((s[r] >= kth[r] - margin) & (s[r] > -np.inf))
            exact = (d[c] * q[at + r]).sum(axis=1)
            best = np.lexsort((d_id[c], -exact))[:k]
            out.append((np.full(len(best), q_id[at + r]), d_id[c][best], exact[best]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 3


def search(vectors: DataFrame, is_query, k: int = 20, sample_rows: int = 8_000, max_parts: int = 32,
           target: float = 0.94, cell_rows: int = 16_384, cell_queries: int = 4_096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each row where
    ``is_query`` (a condition on vec_id) holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = scratch.cut(usable(vectors), "rows")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").collect()
    index = Index([r.v for r in sample], max_parts, target, k)
    sent = spark.sparkContext.broadcast(index)
    rows = rows.where(F.size("v") == index.dim)

    def routed(m: int):
        @F.pandas_udf("array<int>")
        def parts_of(v: pd.Series) -> pd.Series:
            x = np.array(v.tolist(), float).reshape(len(v), -1)
            return pd.Series(list(sent.value.probable(x, m).astype(np.int32)))
        return parts_of("v")

    data = scratch.cut(rows.withColumn("part", routed(1)[0]), "parts")
    held = data.groupBy("part").agg(F.count("*").alias("n"))
    found = cells(scratch, data, held, rows.where(is_query).withColumn("to", routed(index.probes)),
                  k, cell_rows, cell_queries, "first")
    # all rows but the query's own are its candidates
    wanted = min(k, (data.count() or 1) - 1)
    short = (rows.where(is_query).join(found.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.count("*").alias("got")), "vec_id", "left").where(F.coalesce("got", F.lit(0)) < wanted)
        .select("vec_id", "v"))
    if wanted > 0 and index.parts > 1 and not short.isEmpty():
        every = F.array(*[F.lit(i) for i in range(index.parts)])
        again = cells(scratch, data, held, short.withColumn("to", every), k, cell_rows, cell_queries, "again")
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(again)
    out = scratch.cut(found, "result")
    scratch.drop("rows", "parts", "first", "again")
    return out


def cells(scratch: Scratch, data: DataFrame, held: DataFrame, asked: DataFrame, k: int,
          cell_rows: int, cell_queries: int, name: str) -> DataFrame:
    """The ``k`` best of each query over the parts it is sent to, ranked."""
    asked = asked.select("vec_id", "v", F.explode("to").alias("part"))
    # bounded by the number of parts
    shape = held.join(asked.groupBy("part").agg(F.count("*").alias("m")), "part").select(
        "part", F.ceil(F.col("n") / cell_rows).cast("int").alias("nd"),
        F.ceil(F.col("m") / cell_queries).cast("int").alias("nq"))
    shape = F.broadcast(scratch.spark.createDataFrame(shape.collect(), "part int, nd int, nq int"))

    def dealt(df, own, other, own_n, other_n):
        return (df.join(shape, "part")
                .withColumn(own, F.pmod(F.xxhash64("vec_id"), own_n).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
                .select("part", "d", "q", "vec_id", "v"))
    rows = dealt(data, "d", "q", F.col("nd"), "nq")
    queries = dealt(asked, "q", "d", F.col("nq"), "nd")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        q, d = (np.array(x["v"].tolist(), np.float64) for x in (left, right))
        a, b, s = best_rows(q, left["vec_id"].to_numpy(), d, right["vec_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": a.astype("int64"), "vec_id": b.astype("int64"), "score": s})

    best = queries.groupBy("part", "d", "q").cogroup(rows.groupBy("part", "d", "q")).applyInPandas(
        run, "query_id long, vec_id long, score double")
    # a query has at most k rows from each of its cells
    ranked = best.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("r"))
    return scratch.cut(ranked.select("query_id", F.posexplode("r").alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.s")).alias("score")), name)


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
