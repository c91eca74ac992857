"""Spelling variant grouping by pivotal grams (operator 11).

1. Words are counted in one scan: maximal letter runs of whole texts, A-Z lowered. Every Python
   task counts in a table of bounded size, and the counts are summed by Spark.
2. Bigrams are ranked by the number of words that hold them, rarest first. A word's prefix is
   its three rarest bigrams (and all that share the rank of the third). Of the prefix, two
   disjoint bigrams of least total frequency are its pivots, chosen by dynamic programming.
3. One edit breaks one of two disjoint bigrams at most. So of two near words, the one whose
   third bigram ranks lower has a pivot that stands whole in the other's prefix. Pivots are
   indexed against prefixes with position limits: the edit lies before the shared bigram, then
   both words are alike from it on and its places differ by the words' lengths; or behind it,
   then they are alike up to its end and its places are the same. The join's key is that like
   side and the length, so words that merely share a bigram never meet.
4. Joined pairs are verified on the whole words, and each pair counts once in each direction.
5. A word's form is its near word of largest count, if that is ``ratio`` times its own; forms
   are followed to the last by pointer doubling (counts grow ``ratio``-fold each step, so a
   chain has at most log(largest count) steps).

Defined results: null, empty and blank texts, and texts without letters, hold no words; texts
of any length are read whole, in pieces cut between runs; a row that repeats (also one with a
null doc_id, written as ``None``) counts again; ties of count go to the least word in
code-point order; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read,
so other columns of any name do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read, ship

ship(__name__)

RUN = re.compile("[a-zÀ-ÿ]+")
PIECE = 1 << 20


def pieces(text: str):
    """The text, A-Z lowered, in pieces that cut no run of letters."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    at = 0
    while at < len(low):
        end = at + PIECE
        if end < len(low):
            rest = RUN.match(low, end)
            end = rest.end() if rest else end
        yield low[at:end]
        at = end


def document_words(doc_id, text: str | None, least: int, drop_one_in: int) -> Counter:
    """Occurrences of each word of one document, after the deletions that its hashes ask for."""
    out, long_runs = Counter(), re.compile(RUN.pattern[:-1] + "{%d,}" % least)
    start = zlib.crc32(f"{doc_id}:".encode())
    for piece in pieces(text or ""):
        for run, n in Counter(long_runs.findall(piece)).items():
            if drop_one_in:
                h = zlib.crc32(run.encode(), start)
                if h % drop_one_in == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < least:
                        continue
            out[run] += n
    return out


def word_counts(docs: DataFrame, least: int, drop_one_in: int, table: int = 200_000) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points. A task's table of counts is
    handed on when it holds ``table`` words, so its memory does not grow with the data."""
    def count(batches):
        held = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                if text:
                    held.update(document_words(doc_id, text, least, drop_one_in))
                if len(held) >= table:
                    yield pd.DataFrame(list(held.items()), columns=["word", "n"])
                    held.clear()
        yield pd.DataFrame(list(held.items()), columns=["word", "n"]).astype({"n": "int64"})

    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return ids.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pivots(grams: list[str], rank: dict) -> tuple[list[int], list[int]]:
    """(places of the prefix, places of the two pivots) of one word.

    The pivots are the cheapest pair of disjoint bigrams in the prefix: a table of the cheapest
    single place so far, two behind, extended place by place.
    """
    cost = [rank[g] for g in grams]
    third = sorted(cost)[2]
    prefix = [i for i, c in enumerate(cost) if c <= third]
    best_one, best_two = [], None            # cheapest place up to here; cheapest disjoint pair
    for at, place in enumerate(prefix):
        before = [j for j in range(at) if prefix[j] <= place - 2]
        if before:
            one = best_one[before[-1]]
            two = (cost[one] + cost[place], one, place)
            best_two = min(best_two or two, two)
        best_one.append(place if not best_one or cost[place] < cost[best_one[-1]] else best_one[-1])
    return prefix, list(best_two[1:])


def gram_keys(words: DataFrame, grams: DataFrame) -> DataFrame:
    """(word, is_pivot, keys): the like sides at each bigram of a word's prefix, and which are pivots.

    ``grams`` has a row for each bigram of the alphabet at most (90 letters: 8,100 rows), so its
    ranks are broadcast.
    """
    spark = words.sparkSession
    order = [r.gram for r in grams.orderBy("words", "gram").collect()]
    ranks = spark.sparkContext.broadcast({g: i for i, g in enumerate(order)})

    def keys(batches):
        for pdf in batches:
            out = []
            for word in pdf["word"]:
                prefix, chosen = pivots([word[i:i + 2] for i in range(len(word) - 1)], ranks.value)
                for i in prefix:
                    out.append((word, len(word), i in chosen, f"{i}<{word[:i + 2]}"))
                    out.append((word, len(word), i in chosen, f">{word[i:]}"))
            yield pd.DataFrame(out, columns=["word", "len", "pivot", "side"])

    return words.select("word").mapInPandas(keys, "word string, len int, pivot boolean, side string")


def near_words(scratch: Scratch, words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of ``words`` that one edit parts. Words have 4 letters or more."""
    gram = F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))))
    grams = words.select(gram.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("words"))
    keyed = scratch.cut(gram_keys(words, grams), "keys")
    offsets = F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)]))
    probe = keyed.where("pivot").select(F.col("word").alias("a"), "side", "len", offsets.alias("d")) \
        .select("a", "side", (F.col("len") + F.col("d")).alias("len"))
    pairs = keyed.select(F.col("word").alias("b"), "side", "len").join(probe, ["side", "len"]) \
        .where((F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("near"))))
    return pairs.select(both.alias("pair")).select("pair.*").distinct()


def last_forms(scratch: Scratch, forms: DataFrame, name: str = "roots") -> DataFrame:
    """(word, root) of each word with a form: forms followed to the last, doubling the steps."""
    roots, at = forms.select("word", F.col("form").alias("root")), 0
    while True:
        roots = scratch.cut(roots, f"{name}{at}")
        nxt = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = roots.join(nxt, "root", "left")
        if not joined.where("further is not null").limit(1).count():
            return roots
        roots, at = joined.select("word", F.coalesce("further", "root").alias("root")), at + 1


def spelling_groups(docs: DataFrame, least: int = 6, least_n: int = 5, ratio: int = 5,
                    drop_one_in: int = 0) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words of ``docs(doc_id, text)``.

    least: code points of a word (4 or more); least_n: occurrences; ratio: how much more often
    a form occurs; drop_one_in: plants spelling errors, a letter less in one of so many
    (document, run) pairs, chosen by their hash (0: none).
    """
    if least < 4:
        raise ValueError("words of fewer than 4 letters may lack two disjoint bigrams in three")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.cut(word_counts(docs, least, drop_one_in).where(F.col("n") >= least_n), "words")
    pairs = near_words(scratch, words)
    found = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    best = scratch.cut(found.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")), "best")
    seen = words.join(best, "word", "left")
    has: Column = F.col("near_n") >= ratio * F.col("n")
    result = scratch.cut(seen.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(has, F.col("near")).alias("form"),
                                     F.when(has, F.col("near_n")).alias("form_n")), "forms")
    roots = last_forms(scratch, result.where("form is not null"))
    return result.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n over all ``documents``, one letter in 199 runs deleted."""
    return spelling_groups(read(spark, sf_dir, "documents"), drop_one_in=199) \
        .select("word", "form", "root", "n", "n_near", "form_n")


def oracle_sql() -> str:
    """DuckDB: CRC-32 by its table, near words by the words that one deleted letter leaves."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with recursive bits as (select i, list_reduce(list_prepend(i, range(8)),
   lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) v from range(256) t(i)),
 tab as (select list(v order by i) t from bits),
 runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{upper}', '{lower}') run
  from documents),
 counted as (select doc_id, run, count(*) n from runs where length(run) >= 6 group by all),
 hashed as (select run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(doc_id::varchar || ':' || run, ''), lambda x: case when ord(x) < 128 then [ord(x)::bigint]
     else [195, ord(x)::bigint - 64] end))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) h
  from counted, tab),
 kept as (select case when h % 199 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
   else run end word, n from hashed),
 words as (select word, sum(n)::bigint n from kept where length(word) >= 6 group by word having sum(n) >= 5),
 cuts as (select word, i, left(word, i) || substr(word, i + 2) rest
  from (select word, unnest(range(length(word))) i from words)),
 pairs as (select a.word, b.word near from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word from cuts a join words b on a.rest = b.word
  union select b.word, a.word from cuts a join words b on a.rest = b.word),
 best as (select p.word, count(*) n_near, arg_min(p.near, {{'less': -w.n, 'near': p.near}}) near, max(w.n) m
  from pairs p join words w on w.word = p.near group by p.word),
 forms as (select w.word, w.n, coalesce(n_near, 0)::bigint n_near, case when m >= 5 * w.n then near end form,
   case when m >= 5 * w.n then m end form_n from words w left join best b using (word)),
 chain as (select word, word root, form nxt from forms
  union all select c.word, f.word, f.form from chain c join forms f on f.word = c.nxt)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f
join chain c on c.word = f.word and c.nxt is null
"""
