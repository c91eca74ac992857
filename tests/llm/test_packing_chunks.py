"""Plain ASCII chunks reach the tokenizer's model without the pattern of plain characters."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from arcash.llm.packing import ChunkIds


def test_ascii_chunks_need_no_pattern_test():
    file = public_tokenizers.path("word_bpe_49k.json")
    whole, ids = Tokenizer.from_file(file), ChunkIds(file)
    ids.plain = None        # any use of it fails
    for text in ("Hello World", "it's 15,000 items -- IT'S", "a  b \n c", "<|endoftext|> x", "", None):
        assert ids(text) == np.asarray(whole.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
