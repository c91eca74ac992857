"""Bound-certified best-fit packing (operator 10).

1. Every whole text is tokenised; texts longer than a sequence are cut into full pieces and
   a rest. Only (doc, piece, start, length, checksum) go on; tokens never shuffle.
2. Pieces are dealt at random over parts of a bounded expected size. Each part packs its
   pieces best-fit decreasing and certifies the result: a lower bound on its bins from
   dual-feasible functions. A part whose bins equal the bound is optimal and closed.
3. A part with a gap gives up its worst-filled bins (the rest stay), and the given-up
   pieces of all such parts are dealt anew over fewer parts, which repack and certify
   again; what the last, small round cannot certify stays as packed.

The number of bins exceeds the sum of certified bounds by at most the last round's gap.

Defined results: a null text is empty (one piece of length 1, the end mark); rows with a
repeated or null doc_id are packed each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import BoundedCache, Scratch, read, ship, worker_state

ship(__name__)

PIECE = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


class ChunkIds:
    """Ids of a text as little-endian 32-bit bytes, by the tokenizer, chunk by chunk.

    Valid for tokenizers that split at white space and drop it, as word_bpe_49k does: a
    text's ids are then those of its space-free chunks in order. Chunks of plain Latin
    characters are lowered and cut into pre-tokens here (normalisation changes nothing else
    in them) and the tokenizer's model encodes each distinct pre-token once; any other chunk
    goes through the whole tokenizer.
    """

    PLAIN = r"[\x21-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]+"
    # FIXED VALUE: the tokenizer file's own split pattern
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, tokenizer_file: str, cached: int = 1_000_000):
        import regex
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(tokenizer_file)
        t.no_truncation()
        t.no_padding()
        self.tokenizer, self.model = t, t.model
        self.plain, self.split = regex.compile(self.PLAIN), regex.compile(self.SPLIT)
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.letter = {i: chr(i if i in set(own) else next(others)) for i in range(256)}
        self.pre_token = BoundedCache(self._pre_token, cached * 2 // 5)
        self.chunk = BoundedCache(self._chunk, cached * 3 // 5)
        probe = "It's \u00dcber-1.5 \u00c0 l'\u00e9t\u00e9, x\u00b2##"
        if self(probe) != self._bytes(t.encode(probe, add_special_tokens=False).ids) or self(" \n "):
            raise ValueError("this tokenizer does not split and drop white space as expected")

    @staticmethod
    def _bytes(ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pre_token(self, word: str) -> bytes:
        letters = word if word.isascii() else "".join(map(self.letter.get, word.encode()))
        return self._bytes([x.id for x in self.model.tokenize(letters)])

    def _chunk(self, chunk: str) -> bytes:
        latin = chunk.isascii()
        if latin and chunk.isalpha():       # letters only: one pre-token
            return self.pre_token[chunk.lower()]
        # without a space, printable ASCII is PLAIN
        if "<|" in chunk or not (chunk.isprintable() if latin else self.plain.fullmatch(chunk)):
            return self._bytes(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return b"".join(map(self.pre_token.__getitem__, self.split.findall(chunk.lower())))

    def __call__(self, text: str | None) -> bytes:
        return b"".join(map(self.chunk.__getitem__, (text or "").replace("\n", " ").split(" ")))


def cut_pieces(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int = 0,
               text: str = "text", cached: int = 1_000_000) -> DataFrame:
    """One row per piece of each document: its columns but the text, and piece, start,
    length, ids_crc32."""
    end = np.asarray([end_id], "<u4").tobytes()

    @F.pandas_udf(PIECE)
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = worker_state("ids", tokenizer_file, lambda: ChunkIds(tokenizer_file, cached))
        step = 4 * capacity
        for texts in batches:
            out = []
            for t in texts:
                b = ids(t) + end
                out.append([{"piece": i, "start": at // 4, "length": len(b[at:at + step]) // 4,
                             "ids_crc32": zlib.crc32(b[at:at + step])}
                            for i, at in enumerate(range(0, len(b), step))])
            yield pd.Series(out)

    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, F.explode(pieces(F.col(text))).alias("_p")).select(*rest, "_p.*")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that ``lengths`` need at least: the best over families of dual-feasible functions.

    u_k maps x to x if (k+1)x is whole, else floor((k+1)x)/k; U_e lifts lengths over 1-e to
    1 and drops those under e. Both are evaluated on the histogram in whole numbers.
    """
    if len(lengths) == 0:
        return 0
    size, count = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(whole, k * size, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    for e in np.unique(np.minimum(size, capacity - size)):
        if 0 < e <= capacity // 2:
            value = np.where(size > capacity - e, capacity, np.where(size >= e, size, 0))
            best = max(best, -(-int((value * count).sum()) // capacity))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: for each item its bin and offset, and the room left by bin.

    Bins are kept by their room, so an item finds the least sufficient room by bisection
    over the at most ``capacity`` distinct rooms.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    left: list[int] = []
    for i in order:
        need = int(lengths[i])
        at = bisect_left(rooms, need)
        if at < len(rooms):
            room = rooms[at]
            held = by_room[room]
            b = held.pop()
            if not held:
                del by_room[room], rooms[at]
        else:
            b, room = len(left), capacity
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        room -= need
        left[b] = room
        if room:
            if room in by_room:
                by_room[room].append(b)
            else:
                by_room[room] = [b]
                insort(rooms, room)
    return bins, offsets, np.asarray(left, np.int64)


def pack_part(lengths: np.ndarray, capacity: int, last: bool) -> tuple[np.ndarray, ...]:
    """One part: bin, offset and whether the bin stays; and its bins and certified bound.

    With a gap of g, the bins with the most room go, until their room is that of g bins:
    what the next round can save at most. Full bins always stay.
    """
    bins, offsets, left = best_fit(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    stays = np.ones(len(left), bool)
    gap = len(left) - bound
    if gap > 0 and not last:
        order = np.argsort(-left, kind="stable")
        room = np.cumsum(left[order])
        go = order[:int(np.searchsorted(room, gap * capacity)) + 1]
        stays[go[left[go] > 0]] = False
    return bins, offsets, stays[bins], np.int64(len(left)), np.int64(bound)


def packer(r: int, capacity: int, last: bool):
    """The task of one part in round ``r``; sequence numbers hold round, part and bin."""
    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", ignore_index=True)
        b, offset, stays, _, _ = pack_part(pdf["_len"].to_numpy(), capacity, last)
        seq = (np.int64(r) << np.int64(56)) | (np.int64(key[0]) << np.int64(28)) | b
        return pd.DataFrame({"_row": pdf["_row"], "_len": pdf["_len"], "_seq": seq,
                             "offset": offset, "_stays": stays})
    return run


def pack(scratch: Scratch, pieces: DataFrame, capacity: int, length: str = "length",
         part_rows: int = 20_000) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``part_rows`` bounds a task's expected rows. Parts
    with gaps exchange until one part is left or a round closes no bin."""
    spark = scratch.spark
    loose = scratch.cut(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    rows = spark.read.parquet(scratch.path("pieces")).select("_row", F.col(length).alias("_len"))
    n, before = rows.count(), None
    parts, placed, r = max(1, math.ceil(n / part_rows)), [], 0
    schema = "_row long, _len long, _seq long, offset long, _stays boolean"
    while n:
        last = parts == 1 or n == before

        done = scratch.cut(
            rows.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(r)), F.lit(parts)).cast("int"))
            .groupBy("_part").applyInPandas(packer(r, capacity, last), schema), f"round-{r}")
        placed.append(done.where("_stays"))
        if last:
            break
        rows = done.where("not _stays").select("_row", "_len")
        before, n, r = n, rows.count(), r + 1
        parts = max(1, math.ceil(n / part_rows))
    out = loose
    if not placed:
        return out.drop("_row").withColumns({"sequence_id": F.lit(0).cast("long"),
                                             "offset": F.lit(0).cast("long")})
    where = placed[0]
    for p in placed[1:]:
        where = where.union(p)
    return out.join(where.select("_row", F.col("_seq").alias("sequence_id"), "offset"),
                    "_row").drop("_row")


def op10_packing(spark: SparkSession, sf_dir: str, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for all documents."""
    return pack_documents(read(spark, sf_dir, "documents"), capacity)


def pack_documents(docs: DataFrame, capacity: int = 2048, cached: int = 1_000_000) -> DataFrame:
    """The pieces of ``docs(doc_id, text)``, packed. ``cached``: words and chunks whose ids a Python
    worker keeps (some 200 MB; fewer cost time, not results)."""
    import public_tokenizers
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = cut_pieces(docs.select("doc_id", "text"),
                        public_tokenizers.path("word_bpe_49k.json"), capacity, cached=cached)
    return pack(scratch, pieces, capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
