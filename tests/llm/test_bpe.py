import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import bpe
from tests.llm.conftest import prose

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_file())


@pytest.fixture(scope="module")
def own():
    return bpe.coder(None)


def both(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    coded = own.encode(text)
    assert np.frombuffer(coded, dtype="<u4").tolist() == ids, repr(text)
    assert own.decode(coded) == library.decode(ids, skip_special_tokens=False)


PIECES = [
    "don't", " I'LL ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "ΣΑΣ", "İ", "ﬁ", "é", "é", "\x1c", "\x85", " ", "²½٣", "中文",
    "’s", "😀", "_a_b", "ſ", "՘", "\n\t", "١", "a" * 300, "ß", "Ǆ", "ͅ", "K", "Å", "﻿", "‍", "", " ", "\x00", "1234",
]


def test_random_texts_equal_the_library(library, own):
    pick = random.Random(5)
    for _ in range(3000):
        odd = lambda: chr(pick.randrange(32, 0x600)) if pick.random() < 0.5 else ""
        both(library, own, "".join(pick.choice(PIECES) + odd() for _ in range(pick.randrange(1, 9))))


def test_every_character_of_the_first_plane(library, own):
    for start in range(0, 0x10000, 64):
        if not 0xD800 <= start < 0xE000:
            both(library, own, " a".join(chr(c) for c in range(start, start + 64)))


def test_long_words_and_small_caches(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 2)
    small = bpe.coder(None)
    for text in (prose(1, 200), "x" * 5000, "ab" * 4000 + " " + prose(2, 50)):
        both(library, small, text)


def test_columns(spark, make, odd_rows, library, nothing):
    docs = make(odd_rows, clashing=True)
    digest = bpe.digests(spark, with_ids=True)
    rows = docs.select("text", digest("text").alias("d"), bpe.encoder(spark)("text").alias("ids"))
    rows = rows.withColumn("back", bpe.decoder(spark)("ids"))
    seen = 0
    for r in rows.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.ids == ids == r.d.ids and r.d.n_tokens == len(ids) and r.back == decoded
        assert r.d.ids_sha256 == sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.d.decoded_sha256 == sha256(decoded.encode()).hexdigest()
        seen += 1
    assert seen == len(odd_rows)
    assert nothing.select(digest("text")).count() == 0
    assert docs.select(bpe.decoder(spark)(F.lit(None).cast("array<int>")).alias("x")).first().x == ""
