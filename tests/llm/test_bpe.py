"""Byte-pair encoding against the tokenizers library."""

import random
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import frame, texts
from tidewick.llm import bpe, queries
from tidewick.llm.queries import tokenizer_path

ODD = ["", " ", "\n\t", "Hello world's <|endoftext|> x", "a<|startoftext|>b<|endoftext|", "ΟΔΟΣ İstanbul ÅNGSTRÖM ﬁ",
       "é ́x ạ́", "日本語の文", "12½ ٣٤ Ⅷ", "don't WE'LL it'S ''s 'tis", "a b c\u0085d\x1ce",
       "👩‍👩‍👧‍👦 ok", "x" * 63, "x" * 64, "x" * 65, "ab" * 500, "!" * 200 + "?", "\u0000z", "﻿q", "ǅ ß ẞ", "aaaa" * 99]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_like_library(name):
    own, library = bpe.Bpe(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    rng = random.Random(7)
    letters = "abcdeéÉßİ'!?.0123 \n日本́<|>endoftx"
    some = ["".join(rng.choices(letters, k=rng.randint(0, 90))) for _ in range(400)]
    for text in ODD + some + [t or "" for _, t in texts(5)]:
        ids, back = expected(library, text)
        assert own.encode([text.encode()]) == [ids], text
        assert own.decode(ids) == back, text


def test_short_and_long_agree():
    own = bpe.Bpe(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(3)
    words = ["".join(rng.choices("abehinorst", k=rng.randint(1, 60))) for _ in range(300)] + ["x日", "日", "日x日y"]
    assert own._short(words) == [own._long(w) for w in words]


def test_rows(spark):
    rows = texts(11) + [(None, None), (None, "x y"), (4, "Twice it's"), (4, "Twice it's")]
    library = Tokenizer.from_file(tokenizer_path())
    got = bpe.decode(bpe.encode(frame(spark, rows), tokenizer_path()), tokenizer_path()).collect()
    want = [(d, *expected(library, t)) for d, t in rows]
    assert sorted(((r.doc_id, bytes(r.ids), r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert bpe.encode(frame(spark, []), tokenizer_path()).collect() == []


def test_very_long_text(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 1000)
    own, library = bpe.Bpe(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    text = " ".join(f"word{i} it's\n" for i in range(3000)) + "y" * 5000
    assert own.encode([text.encode(), b""]) == [expected(library, text)[0], b""]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    library = Tokenizer.from_file(tokenizer_path())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op11_bpe(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        ids, back = expected(library, docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
