"""Benchmark decontamination by q-gram lemma filtering (operator 6).

Texts and items are lowered and every run of other than letters and digits becomes a space.
An item of m characters may differ from a region of a text by k = min(max_edits * m,
m / q - 1) edits. By the q-gram lemma the region and the item then share at least
m + 1 - q (k + 1) q-grams, at diagonals (place in text less place in item) no further apart
than 2 k. Diagonals are dealt into bands of twice that width, each overlapping half of the
next, so every such region lies whole in one band. Shared q-grams are counted by item and
band, bands below the bound go, and a banded alignment of the whole item decides the rest;
bands that overlap are aligned once, together.

Texts and items that repeat a short passage share q-grams at very many diagonals. Shared q-grams
are held for ``room`` at a time, by ranges of items; one item that alone has more is filtered by
its q-grams in a window of the text instead of by diagonals, then aligned in the same way.

Items go out in blocks of ``block_chars`` characters at most (a benchmark of any size takes
more passes over the texts, never a larger broadcast). Texts are read once a block, whole,
in one pass without a shuffle; found pairs are few.

Defined results: null, blank or shorter-than-q items and texts match nothing; repeated items
and rows are matched each for itself; a null item_id or doc_id is carried as null; empty
tables give an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import begin, mix64, read, ROLL, ship

ship(__name__)

Q = 8
OTHER = re.compile(r"[\W_]+")


def normalised(text: str | None) -> np.ndarray:
    """Code points of the lowered text with single spaces between words."""
    t = OTHER.sub(" ", (text or "").lower()).strip()
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all q-grams."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(q):
            h = h * ROLL + codes[j:j + n]
        return mix64(h)


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int]:
    """Least edits between the item and any region of the text on diagonals low..high (k more
    on both sides), and the region's end; (k + 1, -1) if over k.

    One row an item character, one column a diagonal. Places outside the text match nothing,
    which costs as much as leaving out the item's character.
    """
    width = high - low + 1 + 2 * k
    steps = np.arange(width, dtype=np.int32)
    before = max(0, k - low)
    after = max(0, low - k + width + len(item) - len(text))
    padded = np.concatenate([np.full(before, 0xFFFFFFFF, np.uint32), text,
                             np.full(after, 0xFFFFFFFF, np.uint32)])
    first = low - k + before
    cost = np.zeros(width, np.int32)
    for i in range(len(item)):
        here = cost + (padded[first + i:first + i + width] != item[i])
        np.minimum(here[:-1], cost[1:] + 1, out=here[:-1])
        here -= steps
        np.minimum.accumulate(here, out=here)
        here += steps
        cost = here
        if i % 8 == 7 and cost.min() > k:
            return k + 1, -1
    best = int(cost.argmin())
    end = min(len(text), max(0, len(item) + low - k + best))
    return (int(cost[best]), end) if cost[best] <= k else (k + 1, -1)


class Items:
    """The q-gram index of a block of benchmark items; ``room`` bounds the meetings of q-grams of a
    text and of items that are held at once."""

    def __init__(self, rows: list[tuple], max_edits: float, q: int, room: int = 1_000_000):
        self.q, self.room, self.ids, self.codes = q, room, [], []
        for i, text in rows:
            c = normalised(text)
            if len(c) >= q:
                self.ids.append(i)
                self.codes.append(c)
        m = np.array([len(c) for c in self.codes], np.int64)
        self.k = np.minimum((m * max_edits).astype(np.int64), m // q - 1)
        self.bound = m + 1 - q * (self.k + 1)
        every = [grams(c, q) for c in self.codes]
        code = np.concatenate(every) if every else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(every)), [len(g) for g in every])
        place = np.concatenate([np.arange(len(g)) for g in every]) if every else item
        order = np.argsort(code, kind="stable")
        self.item, self.place = item[order], place[order]
        self.code, self.first, self.times = np.unique(code[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << 22, bool)         # which low bits occur: one lookup for most places
        self.seen[(self.code & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    @cached_property
    def ordered(self) -> np.ndarray:
        """Gram and item of every posting as one sorted number, to cut postings by item."""
        return (np.repeat(np.arange(len(self.code)), self.times) << 32) + self.item

    def matches(self, text: str | None, window: int = 200_000) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of the best region of each matching item.

        A long text goes in windows that overlap by more than the longest region.
        """
        codes = normalised(text)
        if not self.codes or not len(codes):
            return []
        found: dict[int, tuple[int, int]] = {}
        overlap = 2 * max(map(len, self.codes)) + 8 * int(self.k.max()) + 8
        for at in range(0, max(1, len(codes) - overlap), window):
            for i, edits, end in self._window(codes[at:at + window + overlap]):
                if i not in found or (edits, at + end) < found[i]:
                    found[i] = (edits, at + end)
        return [(i, e, max(0, end - len(self.codes[i])), end) for i, (e, end) in sorted(found.items())]

    def _window(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        g = grams(codes, self.q)
        at = np.flatnonzero(self.seen[(g & np.uint64((1 << 22) - 1)).astype(np.int64)])
        if len(at) < self.bound.min():
            return
        which = np.searchsorted(self.code, g[at])
        which[which == len(self.code)] = 0
        real = self.code[which] == g[at]
        at, which = at[real], which[real]
        yield from self._counted(codes, at, which, self.first[which], self.times[which], 0, len(self.codes))

    def _counted(self, codes: np.ndarray, at: np.ndarray, which: np.ndarray, first: np.ndarray,
                 times: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """Matches of items low..high, whose places of gram which[j] are the ``times[j]`` from ``first[j]``."""
        total = int(times.sum())
        if total <= self.room:
            yield from self._banded(codes, at, first, times, total)
        elif high - low == 1:
            yield from self._repetitive(codes, at[times > 0], low)
        else:
            middle = (low + high) // 2
            cut = np.searchsorted(self.ordered, (which << 32) + middle)
            yield from self._counted(codes, at, which, first, cut - first, low, middle)
            yield from self._counted(codes, at, which, cut, first + times - cut, middle, high)

    def _banded(self, codes: np.ndarray, at: np.ndarray, first: np.ndarray, times: np.ndarray,
                total: int) -> Iterator[tuple[int, int, int]]:
        # all (place in text, item, place in item)
        posting = np.repeat(first - np.cumsum(times) + times, times) + np.arange(total)
        item, place = self.item[posting], self.place[posting]
        diagonal = np.repeat(at, times) - place
        key = (item << 40) + diagonal // (2 * self.k[item] + 1) + (1 << 39)
        keys, counts = np.unique(key, return_counts=True)
        if not len(keys):
            return
        # a band is a step and the next one
        after = np.minimum(np.searchsorted(keys, keys + 1), len(keys) - 1)
        counts = counts + np.where(keys[after] == keys + 1, counts[after], 0)
        bands = keys[counts >= self.bound[keys >> 40]]
        if not len(bands):
            return
        order = np.argsort(key, kind="stable")
        key, place, diagonal = key[order], place[order], diagonal[order]
        left, right = np.searchsorted(key, bands), np.searchsorted(key, bands + 2)
        need = self.bound[bands >> 40]
        # one place of the item counts once
        kept = [j for j in range(len(bands)) if len(np.unique(place[left[j]:right[j]])) >= need[j]]
        for run in np.split(kept, np.flatnonzero(np.diff(bands[kept]) > 1) + 1) if kept else []:
            i = int(bands[run[0]] >> 40)
            c, step = self.codes[i], 2 * int(self.k[i]) + 1
            places, shared = np.unique(diagonal[left[run[0]]:right[run[-1]]], return_counts=True)
            exact = next((int(d) for d in places[shared > len(c) - self.q]
                          if d >= 0 and np.array_equal(codes[d:d + len(c)], c)), None)
            if exact is not None:
                yield i, 0, exact + len(c)
                continue
            base = (1 << 39) + (i << 40)
            yield from self._verified(codes, i, int(bands[run[0]] - base) * step,
                                      int(bands[run[-1]] - base + 2) * step - 1)

    def _repetitive(self, codes: np.ndarray, at: np.ndarray, i: int) -> Iterator[tuple[int, int, int]]:
        """Matches of an item whose q-grams meet those of the text too often to list each meeting.

        A region has at most m + k characters, so at least the bound of its places hold a q-gram of
        the item: places are counted in windows of that length, without diagonals.
        """
        m, k = len(self.codes[i]), int(self.k[i])
        hits = np.zeros(len(codes) + 1, np.int64)
        hits[at + 1] = 1
        hits = np.cumsum(hits)
        starts = np.arange(len(codes))
        enough = np.flatnonzero(hits[np.minimum(starts + m + k, len(codes))] - hits[starts] >= self.bound[i])
        for run in np.split(enough, np.flatnonzero(np.diff(enough) > 2 * k + 1) + 1) if len(enough) else []:
            yield from self._verified(codes, i, int(run[0]) - k, int(run[-1]) + k)

    def _verified(self, codes: np.ndarray, i: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """The best region of item i on diagonals low..high, by one alignment."""
        c, k = self.codes[i], int(self.k[i])
        begin = max(0, low - k)
        edits, end = aligned(c, codes[begin:high + len(c) + 2 * k + 1], low - begin, high - begin, k)
        if edits <= k:
            yield i, edits, begin + end


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The benchmark's items, in blocks of about ``block_chars`` characters."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        if r.text is None:
            continue
        block.append((r.item_id, r.text))
        size += len(r.text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


FOUND = "doc_id long, item_id long, edits int, start int, end int"


def contaminated(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.1, q: int = Q,
                 block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, edits, start, end) of each text and item that match, the region in
    characters of the normalised text."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], FOUND)
    for rows in item_blocks(benchmark, block_chars):
        out = out.union(texts.mapInPandas(matcher(spark.sparkContext.broadcast(rows), max_edits, q), FOUND))
    return out


def matcher(sent, max_edits: float, q: int):
    """The task that matches batches of texts with one block of items."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("decontamination")
        items = Items(sent.value, max_edits, q)
        for pdf in batches:
            out = [(d, items.ids[i], *rest) for d, t in zip(pdf["doc_id"].astype("Int64"), pdf["text"])
                   for i, *rest in items.matches(t)]
            got = pd.DataFrame(out, columns=["doc_id", "item_id", "edits", "start", "end"])
            yield got.astype({"doc_id": "Int64", "item_id": "Int64"})
    return run


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits, start, end of every document and benchmark item that match."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def clean(docs: DataFrame, benchmark: DataFrame, max_edits: float = 0.1, q: int = Q,
          block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; one pass, no join."""
    out = docs
    for rows in item_blocks(benchmark, block_chars):
        out = out.where(~holder(docs.sparkSession.sparkContext.broadcast(rows), max_edits, q)(F.col("text")))
    return out


def holder(sent, max_edits: float, q: int):
    """A function column: whether a text holds an item of the block."""
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        begin("decontamination")
        items = Items(sent.value, max_edits, q)
        for texts in batches:
            yield pd.Series([bool(items.matches(t)) for t in texts], dtype=bool)
    return holds
