"""The Merkle manifest, against whole trees built in plain Python."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from stratamart.llm import manifest
from tests.llm.conftest import prose


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_by_hand(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree_by_hand(nodes):
    """The root, and per leaf the list of (before, after)."""
    steps = [[] for _ in nodes]
    level, k = nodes, 0
    while len(level) > 1:
        for i in range(len(nodes)):
            at = i // 3**k
            run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(level)))
            steps[i].append(("".join(level[j] for j in run if j < at), "".join(level[j] for j in run if j > at)))
        level, k = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)], k + 1
    return level[0], steps


def by_hand(rows):
    sources = defaultdict(list)
    for i, text, lang, source in ((*r, *[None] * (4 - len(r))) for r in rows):
        n = None if text is None else len(text)
        leaf = start = leaf_by_hand(i, source, lang, n, text)
        if i is not None and zlib.crc32(str(i).encode()) % 2 == 0:
            start = leaf_by_hand(i, source, lang, n, None if text is None else text.replace("\n", ""))
        sources[source].append(((i is not None, i or 0, leaf), i, leaf, start))
    named = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_by_hand([x[2] for x in sorted(sources[s])]) for s in named}
    root, tops = tree_by_hand([trees[s][0] for s in named])
    out = Counter()
    for s, top in zip(named, tops):
        for (_, i, leaf, start), steps in zip(sorted(sources[s]), trees[s][1]):
            end = start
            for before, after in steps + top:
                end = h(before + end + after)
            out[i, leaf, trees[s][0], root, h("".join(a + b for a, b in steps + top)), end, end == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("levels", [0, 1, 2, 7])
def test_equals_trees_by_hand(make, odd_rows, levels):
    rows = odd_rows + [(100 + i, prose(i, 3) + "\n" * (i % 3), "en", f"s{i % 7 * (i % 5 > 2)}") for i in range(260)]
    out = found(manifest.manifest(make(rows, clashing=True), levels=levels))
    assert out == by_hand(rows)
    assert 0 < sum(n for r, n in out.items() if not r[-1]) < len(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 55])
def test_any_number_of_blocks(make, n):
    rows = [(i, f"line {i}\nend", "en", "one") for i in range(n)]
    assert found(manifest.manifest(make(rows), levels=0)) == by_hand(rows)


def test_many_sources_and_a_block_that_stands_in_for_many(make, monkeypatch):
    monkeypatch.setattr(manifest, "SERVED", 2)
    rows = [(i, f"{i}", "en", f"source {i}" if i < 40 else None) for i in range(40 + 82)]
    assert found(manifest.manifest(make(rows), levels=0)) == by_hand(rows)
    upper = manifest.exchange(make([(i, str(i)) for i in range(82)]).selectExpr("0L tree", "doc_id at", "82L n", "sha2(text, 256) root"), served=3)
    assert {r.root for r in upper.collect()} == {tree_by_hand([h(str(i)) for i in range(82)])[0]}


def test_repeated_rows_and_nothing(make, nothing):
    rows = [(5, "the same\n", "en", "a")] * 70 + [(4, "x", "en", "a"), (None, None, None, "a")]
    assert found(manifest.manifest(make(rows), levels=1)) == by_hand(rows)
    assert manifest.manifest(nothing).count() == 0
