import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import line_dedup, quality_rules
from tests.llm.conftest import CLASHING, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- line de-duplication ----------------------------------------------------------------------


def cut_by_hand(rows):
    """rows: (id, text), distinct. The text that stays, by id and text."""
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0))
    seen, covered = set(), {}
    for r in order:
        lines = r[1].split("\n")
        for i in range(len(lines) - 2):
            window = "\n".join(lines[i : i + 3])
            if not WORD.search(window):
                continue
            if window in seen:
                covered.setdefault(r, set()).update((i, i + 1, i + 2))
            seen.add(window)
    return {r: "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in covered.get(r, ())) for r in order}


def test_cut_lines_equal_brute_force(make):
    shared = [prose(k, 3) for k in range(7)]
    rows = [
        (1, "\n".join(["intro", *shared, "outro"])),
        (2, "\n".join(["other", *shared[1:5], "end"])),
        (3, "\n".join(shared[:2])),
        (4, "\n".join([*shared, *shared])),
        (5, "\n".join(["x", "x", "x", "x", "x"])),
        (6, "\n\n\n\n"),
        (7, "\n".join(["", "", "a", "", ""])),
        (8, "\n".join(["", "", "a", "", ""])),
    ]
    got = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(make(rows)).collect()}
    assert got == {(key[0], text) for key, text in cut_by_hand(rows).items()}


def test_cut_lines_of_odd_rows(make, odd_rows, nothing):
    docs = make(odd_rows, clashing=True)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(odd_rows)
    found = {(r.doc_id, r.text) for r in out.collect()}
    assert (1, None) in found and (None, None) in found and (2, "") in found and (None, "the null row") in found
    assert (7, "") in found  # a copy of the long text
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_a_passage_of_most_documents_is_kept_once(make):
    rows = [(i, f"{i} start\n" + "\n".join(prose(k, 4) for k in range(4)) + f"\n{i} end") for i in range(200)]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(make(rows)).collect()}
    assert out[0] == rows[0][1]
    assert all(out[i] == f"{i} start\n{i} end" for i in range(1, 200))


# ---- quality rules ----------------------------------------------------------------------------


def counts_by_hand(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def test_base_counts_equal_brute_force(make, odd_rows, labels_of):
    rows = odd_rows + [
        (20, "a b c d e a b c d e f a b"),
        (21, "x\nx\n x\nx\n\n \ny # $ <b> | & % *"),
        (22, "w " * 300),
        (23, "naïve 中文 " * 4),
    ]
    out = quality_rules.judge(make(rows, clashing=True), labels_of([])).collect()
    by_count = Counter((r.doc_id, *(r[c] for c in quality_rules.BASE_COUNTS)) for r in out)
    assert by_count == Counter((r[0], *counts_by_hand(r[1])) for r in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # nothing is trusted


def test_scores_equal_the_ratio_of_multinomials(make, labels_of):
    rows = [(i, prose(i % 30, 10 + i)) for i in range(40)] + [(100 + i, prose(i, 25, "JUNK")) for i in range(10)]
    labels = [(i, 1, 0) for i in range(0, 40, 2)] + [(100, 0, 0), (None, 1, 0)]
    n = 1 << 22  # so many buckets that features hardly share one
    out = {r.doc_id: r for r in quality_rules.judge(make(rows), labels_of(labels), n_buckets=n).collect()}

    def features(text):
        words = text.split()
        return words + list(zip(words, words[1:]))

    raw, good = Counter(), Counter()
    for i, text in rows:
        raw.update(features(text))
        if i < 40 and i % 2 == 0:
            good.update(features(text))
    weight = {f: math.log((good[f] + 1) / (sum(good.values()) + n)) - math.log((raw[f] + 1) / (sum(raw.values()) + n)) for f in raw}
    for i, text in rows:
        own = features(text)
        assert out[i].score == pytest.approx(sum(weight[f] for f in own) / len(own), abs=1e-4)
    trusted = sorted(out[i].score for i in range(0, 40, 2))
    assert trusted[0] - quality_rules.GRID <= out[0].threshold <= trusted[0]
    assert not any(out[100 + i].kept for i in range(10))


def test_rules_on_nothing(nothing, labels_of):
    assert quality_rules.judge(nothing, labels_of([(1, 1, 0)])).count() == 0
    assert np.isfinite(quality_rules.GRID) and "_row" in CLASHING
    assert quality_rules.trusted_ids(labels_of([(1, 1, 0), (1, 1, 1), (2, 0, 0)])).agg(F.count("*")).first()[0] == 1
