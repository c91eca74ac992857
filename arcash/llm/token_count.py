"""Token counts by heap-and-linked-list byte-pair merging (operator 5).

A text's symbols stand in a doubly linked list; a heap holds the adjacent pairs whose
joined piece is in the vocabulary. The pair of lowest rank (the leftmost of equals) is
popped again and again and merged, stale heap entries being skipped. The count is the
number of initial symbols less the number of merges; identifiers are never made.

No piece of the vocabulary holds a word mark after another character, so a merge never
crosses the start of a word: each word is merged by itself and its count kept in a bounded
cache of the worker. ``Vocabulary`` verifies this of the model and else merges whole texts.

Defined results: a null text counts as empty (0 bytes, 0 tokens); texts of any length are
counted whole; repeated rows are counted once each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import BoundedCache, read, ship, worker_state

ship(__name__)

MARK = "▁"        # the vocabulary's word mark, standing for a space


class Vocabulary:
    """Ranks of the pieces, read from a sentencepiece model with an identity normaliser."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.vocab_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        # texts are marked and otherwise left as they are
        probe = "  a ﬁ é \n\t① b "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("this model's normaliser changes texts")
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.rank)
        #: characters inside some longer piece; others can't take part in a merge
        self.joined = {c for p in self.rank if len(p) > 1 for c in p}
        # words are cut at line feeds when those can't take part in a merge
        self.cut_lines = "\n" not in self.joined
        self.cache, self.tail = BoundedCache(self.word), BoundedCache(self.merged)

    def merged(self, symbols: str) -> int:
        """Pieces of one marked word (or text) after all merges, bytes for unknown symbols."""
        rank = self.rank
        n = len(symbols)
        count = sum(1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in symbols)
        piece = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(piece[i] + piece[i + 1])
            if r is not None:
                heap.append((r, i, piece[i] + piece[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if piece[i] is None or j >= n or piece[i] + piece[j] != joined:
                continue               # one of the two was merged away since
            piece[i], piece[j] = joined, None
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(joined + piece[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, joined + piece[k]))
            h = before[i]
            if h >= 0:
                r = rank.get(piece[h] + joined)
                if r is not None:
                    heapq.heappush(heap, (r, h, piece[h] + joined))
        return count

    def word(self, word: str) -> int:
        """Tokens of a space-free word that stands after a space (or starts the text)."""
        if self.cut_lines and "\n" in word:
            head, *rest = word.split("\n")
            # a line feed is one token: a byte piece, or a piece of its own
            return self.cache[head] + len(rest) + sum(self.tail[x] for x in rest if x)
        return self.merged(MARK + word)

    def count(self, text: str | None) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if not self.by_word:
            return self.merged(MARK + text.replace(" ", MARK))
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            marked = MARK + text.replace(" ", MARK)
            return sum(self.cache[w[1:]] if w[1:2] != MARK and w[0] == MARK else self.merged(w)
                       for w in re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", marked))
        return sum(map(self.cache.__getitem__, text.split(" ")))


def count_tokens(docs: DataFrame, model_file: str, text: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """``docs`` with a column ``out``: the number of tokens of each whole text."""
    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = worker_state("bpe", model_file, lambda: Vocabulary(model_file))
        for texts in batches:
            yield pd.Series([vocabulary.count(t) for t in texts], dtype="int64")
    return docs.withColumn(out, tokens(F.col(text)))


def op5_token_counts(spark: SparkSession, sf_dir: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document, by piece_bpe_32k.model."""
    import public_tokenizers
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id",
                      F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
