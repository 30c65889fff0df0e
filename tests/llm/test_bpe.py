import hashlib
import random

import numpy as np
import pytest

from pairscore.llm.bpe import ForcedCutEncoder, encode_digests, encode_documents
from pairscore.llm.queries import tokenizer_path

from .helpers import documents

ALPHABET = [*"abcXYZ é'sÉßñ  \n\t\x1c\x1f\x85\xa0İΣσς中文字½²٣é☃!?..12<|endoftext|>", "😀", "<|endoftext|>", "'ll", "ſ", "K", "ﬁ", "Å", "ͅ"]


@pytest.fixture(scope="module")
def pair():
    from tokenizers import Tokenizer

    return ForcedCutEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())


def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(1500)]
    return [*made, "", "a" * 3000, "ab" * 2000, "!" * 2000, "xyzzyq" * 50, "Hello WORLD it's 42!"]


def test_same_ids_and_text_as_the_library(pair):
    own, library = pair
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(own.encode(text), "<u4").tolist()
        assert got == want, text
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_cuts_are_made(pair):
    own, _ = pair
    assert own.encode(None) == b""
    cut = next(a + b for a in "qzxj" for b in "qzxj" if a + b not in own.inside)
    assert own.word_ids("a" + cut + "b")  # a word with a certain cut


def test_queries(spark, pair):
    rows = [(1, "Hello hello"), (1, "Hello hello"), (2, None), (3, ""), (None, "x"), (4, "word " * 50_000)]
    got = encode_digests(documents(spark, rows).selectExpr("*", "1 as ids", "2 as n_tokens"), tokenizer_path()).collect()
    want = []
    for doc_id, text in rows:
        ids = pair[1].encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(pair[1].decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert encode_documents(documents(spark, []), tokenizer_path()).collect() == []


def test_the_vocabulary_is_found_where_the_worker_is(tmp_path):
    from pairscore.llm.bpe import where

    assert where(tokenizer_path()) == tokenizer_path()
    assert where(f"/no/such/folder/{tokenizer_path().rsplit('/', 1)[1]}") == tokenizer_path()
