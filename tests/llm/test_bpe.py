import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from prepframe.llm import bpe
from prepframe.llm.tokens import encoder, tokenizer_path

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def texts(seed, n=400):
    r = random.Random(seed)
    bits = ["the", "thing", "'s", "'re", "’s", " ", "  ", "   ", "\n", "\n ", " \n", "\t", " ", "é", "é", "ß", "日本", "🙂", "12", "3",
            "...", "!!", "<|endoftext|>", "<|startoftext|>", "A", "İ", "\x1c", " ", "aaaaaaaa", "-", "<", "́", "ς", "Σ", "\r\n", "\x85"]
    out = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "\n\n a"]
    return out + ["".join(r.choice(bits) for _ in range(r.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_memoised_encoder_equals_library(path):
    t, e = Tokenizer.from_file(path), encoder(path)
    for x in texts(1, 3000):
        assert np.frombuffer(e.encode(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_joined_parts_equal_whole():
    t, r = Tokenizer.from_file(BYTE), random.Random(5)
    pool = texts(2, 300) + ["".join(r.choice("abcdeé ") for _ in range(900)), "ab" * 700, " " * 900, "é" * 500, "x" * 1500]
    for _ in range(1500):
        x = "".join(r.choice(pool) for _ in range(r.randint(1, 8)))
        k = r.randint(0, len(x))
        e = encoder(BYTE)
        got = bpe.join_parts(BYTE, (x[:k].encode(), e.encode(x[:k])), (x[k:].encode(), e.encode(x[k:])))
        want = t.encode(x, add_special_tokens=False).ids
        assert got[0] == x.encode()
        assert np.frombuffer(got[1], "<u4").tolist() == want, (repr(x), k)


def test_tree_and_decoding(spark):
    t, r = Tokenizer.from_file(BYTE), random.Random(6)
    rows = [(i, x) for i, x in enumerate(texts(3, 60))]
    rows += [(900 + i, "".join(r.choice("abc dé\n  x'") for _ in range(r.randint(300, 4000)))) for i in range(8)]
    rows += [(999, None), (950, "z" * 5000), (950, "z" * 5000), (None, "a b")]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], "doc_id long, text string, ids int").repartition(4)
    got = bpe.decode(bpe.encode(df, BYTE, piece_chars=100), BYTE).collect()
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    have = sorted(((g["doc_id"], np.frombuffer(g["ids"], "<u4").tolist(), g["text"]) for g in got), key=key)
    want = sorted(((i, (e := t.encode(x or "", add_special_tokens=False).ids), t.decode(e, skip_special_tokens=False)) for i, x in rows), key=key)
    assert have == want
    assert bpe.encode(df.limit(0), BYTE).collect() == []
