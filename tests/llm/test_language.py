"""Language identification against its definition in plain Python, from the same weights."""

import math

import pytest

from stratamart.llm import language_id
from tests.llm.conftest import prose

STEMS = {"en": "th", "de": "sch", "nl": "ij", "fr": "eau", "es": "ñ", "xx": "q"}


def decided_by_hand(model, text):
    data = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in (text or "").encode())
    if not any(c.isalpha() for c in text or ""):
        return language_id.UNKNOWN, 0.0
    bits = language_id.N_BUCKETS.bit_length() - 1
    buckets = []
    for size in language_id.SIZES:
        for i in range(len(data) - size + 1):
            packed = size
            for b in data[i : i + size]:
                packed = packed << 8 | b
            buckets.append((packed * 0x9E3779B97F4A7C15 % 2**64) >> (64 - bits))
    odds = []
    for k in range(model.weights.shape[1]):
        margin = sum(float(model.weights[b, k]) for b in buckets) / len(buckets) + float(model.bias[k])
        odds.append(1 / (1 + math.exp(-3 * margin)))
    n = len(model.families) if len(model.families) > 1 else 0
    families = dict(zip(model.families, odds[:n] if n else [1.0]))
    family = max(model.families, key=lambda name: (families[name], [-ord(c) for c in name]))
    votes = {}
    for language in model.languages:
        if language_id.family_of(language) == family:
            own = [odds[n + k] if a == language else 1 - odds[n + k] for k, (a, b) in enumerate(model.pairs) if language in (a, b)]
            votes[language] = sum(own) / len(own) if own else 1.0
    best = min(votes, key=lambda name: (-votes[name], name))
    return best, votes[best] * families[family] / sum(families.values())


@pytest.mark.parametrize("languages", [list(STEMS), ["en", "de"], ["fr"], ["en", "fr"]])
def test_predictions_equal_votes_counted_by_hand(spark, make, odd_rows, languages):
    rows = [(100 * k + i, prose(i, 12 + i, STEMS[lang]), lang, "a") for k, lang in enumerate(languages) for i in range(40)]
    model = language_id.train(make(rows, clashing=True))
    assert model.languages == sorted(languages)
    assert model.weights.shape[1] == len(model.pairs) + (len(model.families) if len(model.families) > 1 else 0)
    predict = language_id.predictor(spark, model)
    docs = make(rows[::3] + [r for r in odd_rows if r[0] not in (6, 7)], clashing=True)
    for r in docs.select("text", "lang", predict("text").alias("p")).collect():
        lang, score = decided_by_hand(model, r.text)
        assert r.p.lang_pred == lang and r.p.score == pytest.approx(score, abs=1e-9), r.text
    right = [r.lang == r.p.lang_pred for r in make(rows).select("lang", predict("text").alias("p")).collect()]
    assert sum(right) > 0.95 * len(right)


def test_without_languages_all_is_unknown(spark, make):
    model = language_id.train(make([(1, "some text", None, "a"), (2, "", "en", "a")]))
    out = make([(1, "some text")]).select(language_id.predictor(spark, model)("text").alias("p")).first().p
    assert (out.lang_pred, out.score) == (language_id.UNKNOWN, 0.0)
