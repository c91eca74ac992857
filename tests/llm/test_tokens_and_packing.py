import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arcash.llm import packing as P
from arcash.llm import token_count as T
from tests.llm.helpers import doc

ODD = [None, "", " ", "\n", "  a  b ", "\n\na\n b", "▁x y▁▁z", "é ́x", "ﬁ Ａ①", "<s> </s><unk> x",
       "a\tb\x1fc\x85d\xa0e", "日本語 テキスト😀😀", "aaaa" * 500, "<|endoftext|>a <|startoftext|> b",
       "ΑΣ ΣΑΣ", "İstanbul DŽ ǅ", "it's I'M we'll 1234 !!??", "x\r\ny", "a b　c", "0\x01z",
       "Über-Größe l'été ²x½", "word " * 9000]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer
    return (sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")),
        Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


@pytest.fixture(scope="module")
def own():
    return (T.Vocabulary(public_tokenizers.path("piece_bpe_32k.model")),
            P.ChunkIds(public_tokenizers.path("word_bpe_49k.json")))


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n▁abeinst'é.ßİΣ#3"), st.characters(codec="utf-8"))))
def test_same_as_the_libraries(library, own, text):
    assert own[0].count(text) == len(library[0].encode(text))
    ids = library[1].encode(text, add_special_tokens=False).ids
    assert own[1](text) == np.asarray(ids, "<u4").tobytes()


def test_whole_words_merged_alike_without_the_word_cut(own):
    v = own[0]
    for t in ("the threshold of the text", "a  b", "x\ny z"):
        assert v.count(t) == v.merged("▁" + t.replace(" ", "▁"))


def test_op5(spark, tables, library):
    d = tables(documents=[doc(i, t) for i, t in enumerate(ODD)] + [doc(3, "x"), doc(None, "x")])
    rows = T.op5_token_counts(spark, d).collect()
    assert len(rows) == len(ODD) + 2
    got = {(r.doc_id, r.n_bytes): (r.n_tokens, r.over_limit) for r in rows}
    for i, t in enumerate(ODD):
        n = len(library[0].encode(t or ""))
        assert got[i, len((t or "").encode())] == (n, n > 4096)
    assert T.op5_token_counts(spark, tables(documents=[])).collect() == []


def test_op10(spark, tables, library):
    texts = ODD + ["short text number %d" % i * (1 + i % 70) for i in range(400)]
    d = tables(documents=[doc(i, t) for i, t in enumerate(texts)] + [doc(0, "again"), doc(None, "z")])
    got = P.op10_packing(spark, d).toPandas()
    for i, t in enumerate(texts[1:], 1):
        ids = np.asarray(library[1].encode(t, add_special_tokens=False).ids + [0], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert list(mine["start"]) == list(range(0, len(ids), 2048))
        assert list(mine["length"]) == [len(ids[s:s + 2048]) for s in mine["start"]]
        assert list(mine["ids_crc32"]) == [zlib.crc32(ids[s:s + 2048].tobytes()) for s in mine["start"]]
    assert sorted(got[got.doc_id == 0]["length"])[0] == 1 and got["doc_id"].isna().sum() == 1
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        ends = (g["offset"] + g["length"]).tolist()
        assert g["offset"].tolist() == [0] + ends[:-1] and ends[-1] <= 2048
    bound = P.lower_bound(got["length"].to_numpy(), 2048)
    assert bound <= got["sequence_id"].nunique() <= bound + 1
    assert P.op10_packing(spark, tables(documents=[])).collect() == []


def test_exchange_saves_bins(spark):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 100, 6000)
    rows = spark.createDataFrame([(int(i), int(n)) for i, n in enumerate(lengths)], "i long, length long")
    from arcash.llm.common import Scratch
    s = Scratch(spark, "test")
    got = P.pack(s, rows, 100, part_rows=100).toPandas()
    assert len(got) == 6000 and got.groupby("sequence_id")["length"].sum().max() <= 100
    alone = sum(len(P.best_fit(lengths[i::60], 100)[2]) for i in range(60))
    assert got["sequence_id"].nunique() < alone
    s.drop()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_bound_and_packing_against_all_packings(lengths):
    capacity = 12
    lengths = np.array(lengths, np.int64)

    def fewest(i, rooms):
        if i == len(lengths):
            return len(rooms)
        best = fewest(i + 1, rooms + [capacity - lengths[i]])
        for k, r in enumerate(rooms):
            if r >= lengths[i] and r not in rooms[:k]:
                best = min(best, fewest(i + 1, rooms[:k] + [r - lengths[i]] + rooms[k + 1:]))
        return best
    bins, offsets, left = P.best_fit(lengths, capacity)
    assert P.lower_bound(lengths, capacity) <= fewest(0, []) <= len(left)
    assert all(lengths[bins == b].sum() + left[b] == capacity for b in range(len(left)))
