import re

import numpy as np
import pyarrow as pa
import pytest

from stratamart.llm import text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = ["a b  c a b", None, "", " \t", "one", "x\ny\r\x0bz\x0cw", "é中😀 é中😀", "a b c d e f", "no\xa0break\x85here", "a\x00b c"]


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_words_and_ngrams_equal_those_of_python(most):
    seen, by_gram = {}, {}
    place = 0
    for block in text.blocks(pa.array(TEXTS), most):
        assert block.first == place
        grams, at = block.ngrams(3, whole_if_short=True)
        for i in range(len(block)):
            raw = (TEXTS[place] or "").encode()
            words = WORD.findall(raw)
            own = block.word_hashes[block.word_offsets[i] : block.word_offsets[i + 1]]
            assert len(own) == block.words_per_text[i] == len(words)
            for word, code in zip(words, own):
                assert seen.setdefault(word, code) == code
            runs = [tuple(words[k : k + 3]) for k in range(len(words) - 2)] or ([tuple(words)] if words else [])
            assert at[i + 1] - at[i] == len(runs)
            for run, code in zip(runs, grams[at[i] : at[i + 1]]):
                assert by_gram.setdefault(run, code) == code
            place += 1
    assert place == len(TEXTS)
    assert len(set(seen.values())) == len(seen) and len(set(by_gram.values())) == len(by_gram)


def test_hashes_do_not_depend_on_place_or_block():
    one = next(text.blocks(pa.array(["zz word"]))).word_hashes[1]
    many = next(text.blocks(pa.array(["w " * 5000 + "word"]))).word_hashes[-1]
    assert one == many


def test_sliced_arrays():
    whole = pa.array(["a", "bb cc", "ddd", None, "e f g"])
    block = next(text.blocks(whole.slice(1, 3)))
    assert block.words_per_text.tolist() == [2, 1, 0]
    assert list(text.blocks(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("n", [1, 2, 5, 7])
def test_character_ngrams_stay_inside_texts(n):
    texts = [b"abcabc", b"", b"a", b"xyzxyzxyz", b"abc"]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    buckets, at = text.char_ngrams(data, offsets, n, 1 << 20)
    seen = {}
    for i, raw in enumerate(texts):
        runs = [raw[k : k + n] for k in range(len(raw) - n + 1)]
        assert at[i + 1] - at[i] == len(runs)
        for run, bucket in zip(runs, buckets[at[i] : at[i + 1]]):
            assert seen.setdefault(run, bucket) == bucket
    kept, cut = text.distinct_per_text(buckets, text.text_of(at), len(texts), 1 << 20)
    for i in range(len(texts)):
        assert kept[cut[i] : cut[i + 1]].tolist() == sorted(set(buckets[at[i] : at[i + 1]].tolist()))
