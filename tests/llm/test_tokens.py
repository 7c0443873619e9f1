"""Token counts and the alignment of two tokenizers, against the libraries on whole texts."""

import random

import pytest

from stratamart.llm import alignment, token_counts
from tests.llm.conftest import prose

sentencepiece = pytest.importorskip("sentencepiece")

PARTS = [
    " ", "  ", " " * 19, "▁", "▁ ▁", "\n", "\n\n", "\r\n", "\t", "1", "2024", " 7", "a", "word", " Word", "don't", "<s>", "</s>", "<unk>", "<0x41>",
    "é", "é", "中文", "😀", "\x00", "　", "ﬁ", "a" * 40, ".", "...", " ,", "İ", "‍", "﻿", "<|endoftext|>", "🏳️‍🌈",
]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_file())


def mixed_texts(n, seed=3):
    pick = random.Random(seed)
    odd = lambda: chr(pick.randrange(1, 0xD000)) if pick.random() < 0.2 else ""
    return ["".join(pick.choice(PARTS) + odd() for _ in range(pick.randrange(1, 12))) for _ in range(n)]


def check_counts(rows, out, pieces):
    expected = sorted((i is not None, i or 0, len((t or "").encode()), len(pieces.encode(t or ""))) for i, t, *_ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in out) == expected


# ---- counts -----------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [token_counts.HOT, 7, 0])
def test_counts_equal_the_library(make, odd_rows, pieces, hot):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate([*PARTS, *mixed_texts(800)])]
    out = token_counts.token_counts(make(rows, clashing=True), limit=50, hot=hot).collect()
    check_counts(rows, out, pieces)
    assert all(r.over_limit == (r.n_tokens > 50) for r in out) and any(r.over_limit for r in out)


def test_many_kinds_leave_a_task_in_parts(make, pieces, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 50)
    alone = token_counts.np.isin(token_counts.np.arange(256), [10])
    batches = [token_counts.pa.RecordBatch.from_pydict({"text": [prose(10 * k + i, 90) for i in range(10)]}) for k in range(4)]
    parts = list(token_counts._kinds(alone, token_counts._BASES[0])(iter(batches)))
    assert len(parts) > 1 and sum(sum(p.column("n").to_pylist()) for p in parts) == 40 * 90


def test_hashes_that_clash_are_made_anew(make, pieces, monkeypatch):
    rows = [(i, prose(i, 30)) for i in range(20)]
    first = token_counts._BASES[0]
    real = token_counts._kinds

    def clashing(alone, base):
        run = real(alone, base)

        def merged_hashes(batches):
            for part in run(batches):
                yield part.set_column(0, "hash", token_counts.pc.bit_wise_and(part.column("hash"), 7)) if base == first else part

        return merged_hashes

    monkeypatch.setattr(token_counts, "_kinds", clashing)
    check_counts(rows, token_counts.token_counts(make(rows)).collect(), pieces)


def test_counts_of_nothing(nothing, make):
    assert token_counts.token_counts(nothing).count() == 0
    assert token_counts.token_counts(make([(1, None), (2, "")])).select("n_bytes", "n_tokens").distinct().collect() == [(0, 0)]


def test_a_model_whose_pieces_cross_words_is_refused(monkeypatch):
    with open(token_counts.default_file(), "rb") as file:
        model = token_counts.Pieces(file.read())
    model.check()
    model.pieces.append("a▁b")
    with pytest.raises(ValueError):
        model.check()


# ---- alignment --------------------------------------------------------------------------------


def aligned_by_hand(pair, rows):
    """From the libraries' tokens, text by text, with sets and loops."""
    import json
    from collections import Counter
    from hashlib import sha256

    import public_tokenizers
    from tokenizers import Tokenizer

    a_library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_library.encode_special_tokens = True
    vocab = {i: entry for entry, i in json.loads(pair.file_text)["model"]["vocab"].items()}
    symbols = {c: b for b, c in enumerate(alignment.byte_symbols())}
    b_library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def b_bytes(i):
        piece = b_library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_library.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for i, text, *_ in rows:
        a = [(x, bytes(symbols[c] for c in vocab[x])) for x in a_library.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(x, b_bytes(x)) for x in b_library.encode(text or "")]
        wanted = b" " + (text or "").encode()
        if not text or any(b"".join(x for _, x in side) != wanted for side in (a, b)):
            found.append((i, 0, 0, 0, Counter(), ""))
            continue
        ends = []
        for side in (a, b):
            at = [0]
            for _, x in side:
                at.append(at[-1] + len(x))
            ends.append(at)
        groups, links, done = [], Counter(), [0, 0]
        for high in sorted(set(ends[0][1:]) & set(ends[1][1:])):
            upto = [at.index(high, k) for at, k in zip(ends, done)]
            own = [[x for x, _ in side[k:n]] for side, k, n in zip((a, b), done, upto)]
            links.update((x, y) for x in own[0] for y in own[1])
            groups.append("|".join(",".join(map(str, x)) for x in own))
            done = upto
        found.append((i, len(a), len(b), len(groups), links, sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for *_, links, _ in found for pair in links)
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    return Counter(
        (i, n_a, n_b, n_groups, links.total(), sum(n for p, n in links.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in links.items()), digest)
        for i, n_a, n_b, n_groups, links, digest in found
    )


def found(df):
    from collections import Counter

    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


@pytest.mark.parametrize("hot", [alignment.HOT, 20, 0])
def test_alignment_equals_the_definition(make, odd_rows, hot):
    pair = alignment.tokenizers()
    rows = odd_rows + [(100 + i, t) for i, t in enumerate([*PARTS, *mixed_texts(300, 8), *(prose(i, 60) for i in range(40))])]
    assert found(alignment.alignment(make(rows, clashing=True), pair, hot)) == aligned_by_hand(pair, rows)


def test_large_groups_are_linked_in_parts():
    pair = alignment.tokenizers()
    a = alignment.pa.table({"group": [0] * 60 + [1] * 3, "id_a": [i % 20 for i in range(60)] + [1, 2, 2]})
    b = alignment.pa.table({"group": [0] * 50 + [1] * 2, "id_b": [i % 25 for i in range(50)] + [1, 1]})
    doc = alignment.pa.array([0, 0])
    rows = lambda t: sorted(map(tuple, zip(*t.to_pydict().values())))
    assert rows(alignment.linked(a, b, doc, most=30)) == rows(alignment.linked(a, b, doc))
    assert sum(r[3] for r in rows(alignment.linked(a, b, doc))) == 60 * 50 + 3 * 2
    broken = alignment.align(pair, [b"fine text", b"broken \xff text", b""])
    assert broken.field("n_groups").to_pylist()[1:] == [0, 0] and broken.field("groups_sha256").to_pylist()[1:] == ["", ""]


def test_alignment_of_nothing(nothing, make):
    assert alignment.alignment(nothing).count() == 0
    assert found(alignment.alignment(make([(1, None), (2, "")]))) == {(1, 0, 0, 0, 0, 0, 0, ""): 1, (2, 0, 0, 0, 0, 0, 0, ""): 1}


def test_both_libraries_split_every_character_alike():
    """The faster library makes A's tokens; the vocabulary file's own one has to agree on every character."""
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    fast = alignment.tokenizers().a
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}! {chr(c)}{chr(c)}1  {chr(c)}" for c in points[start : start + 20_000]]
        assert [x.ids for x in own.encode_batch_fast(texts, add_special_tokens=False)] == fast.encode_ordinary_batch(texts, num_threads=4)
