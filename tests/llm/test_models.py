"""Perplexity, toxicity and language identification."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stratamart.llm import language_id, perplexity, toxicity
from stratamart.llm.linear import Rows, fit
from stratamart.llm.text import blocks
from tests.llm.conftest import prose


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ---- perplexity -------------------------------------------------------------------------------


class KneserNey:
    """Interpolated modified Kneser-Ney from the textbook, recursive and unsharded."""

    def __init__(self, texts, order, discounts=None):
        grams = Counter()
        for text in texts:
            padded = b"\n" * (order - 1) + text
            grams.update(padded[i : i + order] for i in range(len(text)))
        self.counts = {order: grams}
        for size in range(order - 1, 0, -1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.discount, self.rows = {}, {}
        for size, counts in self.counts.items():
            n = [sum(c == k for c in counts.values()) for k in range(1, 5)]
            if all(n):
                y = n[0] / (n[0] + 2 * n[1])
                self.discount[size] = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k) for k in (1, 2, 3)]
            else:
                self.discount[size] = [0.5, 1.0, 1.5]
            self.rows[size] = defaultdict(list)
            for gram, c in counts.items():
                self.rows[size][gram[:-1]].append(c)

    def p(self, gram):
        size = len(gram)
        if size == 0:
            return 1 / 256
        lower = self.p(gram[1:])
        own = self.rows[size].get(gram[:-1])
        if not own:
            return lower
        take = lambda c: self.discount[size][min(c, 3) - 1]
        c = self.counts[size].get(gram, 0)
        return (c - take(c) if c else 0) / sum(own) + sum(map(take, own)) / sum(own) * lower

    def perplexity(self, text, order):
        padded = b"\n" * (order - 1) + text
        return math.exp(-sum(math.log(self.p(padded[i : i + order])) for i in range(len(text))) / len(text))


@pytest.fixture(scope="module")
def corpus():
    rows = [(i, prose(i % 17, 20 + i), ("en", "de", None)[i % 3], "a") for i in range(300, 360)]
    rows += [(100 + i, prose(i, 15, "#Q!"), "en", "a") for i in range(4)] + [(200, "é", "xx", "a"), (201, "z", "xx", "a")]
    return rows


def test_perplexity_equals_the_textbook_model(make, labels_of, corpus, odd_rows):
    labels = [(i, 1, 0) for i in range(300, 360, 2)] + [(100, 0, 0)]
    docs = make(corpus + odd_rows, clashing=True)
    got = perplexity.judge(docs, labels_of(labels), order=3).collect()
    model = KneserNey([t.encode() for i, t, *_ in corpus if i >= 300 and i % 2 == 0 and fold(i, 5)], 3)
    for text in (b"ab", b"\n\n", b"qz"):
        assert sum(model.p(text + bytes([b])) for b in range(256)) == pytest.approx(1)
    expected = Counter((r[0], round(model.perplexity(r[1].encode(), 3), 6) if r[1] else None) for r in corpus + odd_rows)
    assert Counter((r.doc_id, None if r.perplexity is None else round(r.perplexity, 6)) for r in got) == expected
    assert all(r.kept == (r.perplexity is not None and r.perplexity <= r.limit) for r in got)
    limits = {r.lang: math.log(r.limit) for r in got}
    held = {lang: [math.log(model.perplexity(t.encode(), 3)) for i, t, own, _ in corpus if own == lang and i >= 300 and i % 2 == 0 and not fold(i, 5)] for lang in ("en", "de", None)}
    every = max(max(own) for own in held.values() if own)
    assert limits["xx"] == pytest.approx(every, abs=perplexity.GRID)  # no held-out text of its own: the threshold of all
    for lang, own in held.items():
        if own:  # so few that the quantile is the largest
            share = len(own) / (len(own) + perplexity.DRAWN)
            assert limits[lang] == pytest.approx(share * max(own) + (1 - share) * every, abs=2 * perplexity.GRID)


def test_grams_held_by_tasks_or_joined_give_the_same_sums(make, labels_of, corpus):
    labels = labels_of([(i, 1, 0) for i in range(300, 330)])
    rows = make(corpus + corpus[:3])
    judged = lambda hot: sorted(map(tuple, perplexity.judge(rows, labels, order=2, hot=hot).select("doc_id", "n_bytes", "perplexity").collect()))
    assert judged(perplexity.HOT) == judged(60) == judged(0)


def test_perplexity_without_text_or_trust(make, labels_of, nothing):
    assert perplexity.judge(nothing, labels_of([(1, 1, 0)])).count() == 0
    rows = perplexity.judge(make([(1, "abc"), (2, None)]), labels_of([]), order=2).collect()
    assert {(r.doc_id, r.kept, r.perplexity and round(r.perplexity)) for r in rows} == {(1, True, 256), (2, False, None)}


def test_an_outlier_does_not_set_the_limit(spark, make, labels_of):
    rows = [(None, "en", 1 + k / 1000) for k in range(100)] + [(None, "en", 9.0), (None, "en", 9.0)]
    rows += [(None, "de", 1.0 + k / 1000) for k in range(9)] + [(None, "de", 9.0)]
    held = spark.createDataFrame(rows, "doc_id long, lang string, log_ppl double")
    found = {("all" if r.every else r.lang): (r.limit, r.total) for r in perplexity.thresholds(held).collect()}
    assert found["en"] == (pytest.approx(1.098, abs=2e-4), 102) and found["all"][1] == 112
    assert found["de"] == (pytest.approx(9, abs=2e-4), 10)
    frame = spark.createDataFrame([(lang, *found[lang]) for lang in ("en", "de")], "lang string, limit double, total long")
    drawn = {r.lang: r.own for r in frame.select("lang", perplexity.own_limit(found["all"][0]).alias("own")).collect()}
    assert drawn["en"] == pytest.approx((102 * found["en"][0] + 10 * found["all"][0]) / 112, abs=1e-3)
    assert drawn["de"] == pytest.approx(0.5 * 9 + 0.5 * found["all"][0], abs=1e-3)

    texts = [(i, prose(i % 40, 30), "en", "a") for i in range(2000, 2400)] + [(2400 + i, prose(i, 30, "#Q!"), "en", "a") for i in range(20)]
    odd = next(i for i in range(3000, 3100) if not fold(i, 5))
    texts.append((odd, prose(99, 30, "@Z~"), "en", "a"))
    labels = [(i, 1, 0) for i in range(2000, 2400)] + [(odd, 1, 0)]
    kept = {r.doc_id: r.kept for r in perplexity.judge(make(texts), labels_of(labels), order=3).select("doc_id", "kept").collect()}
    assert not any(kept[2400 + i] for i in range(20)) and np.mean([kept[i] for i in range(2000, 2400)]) > 0.95


# ---- linear fits ------------------------------------------------------------------------------


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_fit_separates(loss):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(200, 5))
    sides = np.where(points @ [1, -2, 0, 0.5, 0] + 0.3 > 0, 1.0, -1.0)
    rows = Rows(np.tile(np.arange(5), 200), points.ravel(), np.arange(201) * 5, 5)
    weights, bias = fit(rows, sides, loss, steps=200)
    assert (np.sign(points @ weights + bias) == sides).mean() > 0.97


# ---- toxicity ---------------------------------------------------------------------------------


def test_toxicity_is_learnt_and_repeats(make, labels_of, odd_rows):
    bad = ("stupid", "worthless", "clownish")
    rows, labels = [], []
    for i in range(1000, 1400):
        words = prose(i, 30).split()
        toxic = i % 4 == 0
        if toxic:
            words[i % 29] = bad[i % 3]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None)]
    docs = make(rows + odd_rows, clashing=True)
    weights, bias = toxicity.train(docs, labels_of(labels))
    score = toxicity.scorer(docs.sparkSession, weights, bias)
    got = docs.select("doc_id", score("text").alias("s")).collect()
    held = [(r.s >= 0.5) == (r.doc_id % 4 == 0) for r in got if r.doc_id and r.doc_id >= 1000 and not fold(r.doc_id, 5)]
    assert len(held) > 50 and np.mean(held) > 0.97
    assert all(0 <= r.s <= 1 for r in got)
    kept = toxicity.without_toxic(docs, labels_of(labels))
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.s < 0.5 for r in got)


def test_rare_toxic_labels_do_not_make_the_cut_stricter(make, labels_of):
    rows, labels = [], []
    for i in range(5000, 6200):
        words = prose(i, 30).split()
        toxic = i % 25 == 0
        if toxic:
            words[i % 29] = ("stupid", "worthless", "clownish")[i % 3]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, int(toxic)))
    docs = make(rows)
    weights, bias = toxicity.train(docs, labels_of(labels))
    got = docs.select("doc_id", toxicity.scorer(docs.sparkSession, weights, bias)("text").alias("s")).collect()
    held = [(r.doc_id % 25 == 0, r.s >= 0.5) for r in got if not fold(r.doc_id, 5)]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert len(toxic) >= 8 and np.mean(toxic) >= 0.8 and np.mean(clean) < 0.05


def test_the_cut_has_the_fewest_errors():
    cut = lambda toxic, clean: toxicity.balanced_cut(np.array(toxic, float), np.array(clean, float))
    assert cut([5, 6], [1, 2]) == 3.5  # the middle of the gap
    assert cut([5], [1, 2] * 50) == 3.5  # however rare
    assert cut([1, 5, 6, 7], [0, 1, 2, 2]) == 3.5
    assert cut([2], [2]) == 2


def test_toxicity_ratios_equal_brute_force(make, labels_of):
    texts = {1: "aaaaa bbbbb", 2: "aaaaa ccccc", 3: "ddddd bbbbb", 4: "x", 6: "aaaaaaaaa"}
    for block in blocks(pa.array(list(texts.values()))):
        buckets, at = toxicity.distinct_features(block)
        for i, text in enumerate(texts.values()):
            runs = {text[k : k + n] for n in toxicity.SIZES for k in range(len(text) - n + 1)}
            assert at[i + 1] - at[i] == len(runs)
    counts = np.zeros((2, toxicity.N_BUCKETS))
    counts[:, 3] = 400, 100
    counts[:, 4] = 0, 50
    ratio = toxicity.log_ratios(counts, 10)
    share = 150 / 550
    for at, clean, toxic in ((3, 400, 100), (4, 0, 50)):
        expected = math.log((toxic + 10 * share) / 150) - math.log((clean + 10 * (1 - share)) / 400)
        assert ratio[at] == pytest.approx(expected if abs(expected) >= toxicity.LEAST_RATIO else 0, abs=1e-5)
    assert ratio[5] == 0


def test_toxicity_without_labels(make, labels_of, nothing, odd_rows):
    docs = make(odd_rows)
    assert toxicity.without_toxic(docs, labels_of([])).count() == len(odd_rows)
    assert toxicity.without_toxic(docs, labels_of([(6, 1, 0)])).count() == len(odd_rows)
    assert toxicity.without_toxic(nothing, labels_of([(6, 1, 1), (7, 1, 0)])).count() == 0


# ---- language identification ------------------------------------------------------------------

WORDS = {
    "en": "the and that with this from have would there which",
    "de": "und der die das nicht werden schön über einen können",
    "fr": "les des une être dans pour avec où très français",
    "es": "los las una para con años niño está qué más",
    "ja": "これ それ です ます から まで",
}


def sentence(lang, seed, n=12):
    words = WORDS[lang].split()
    return " ".join(words[(seed * 7 + k * k * 3 + k) % len(words)] for k in range(n))


def test_languages_are_told_apart(make, odd_rows):
    rows = [(i, sentence(lang, i), lang, "a") for k, lang in enumerate(WORDS) for i in range(100 * k + 10, 100 * k + 70)]
    docs = make(rows + [(900, "42 + !!", "en", "a"), (901, "ж", "en", "a")] + odd_rows, clashing=True)
    model = language_id.train(docs, per_language=30)
    assert set(model.languages) >= set(WORDS) and ("de", "en") in model.pairs and ("de", "fr") not in model.pairs
    predict = language_id.predictor(docs.sparkSession, model)
    got = {(r.doc_id, r.lang): r.p for r in docs.select("doc_id", "lang", predict("text").alias("p")).collect()}
    held = [got[(i, lang)].lang_pred == lang for i, _, lang, _ in rows if fold(i, 3) == 1]
    assert len(held) > 60 and np.mean(held) > 0.97
    assert all(0 <= p.score <= 1 for p in got.values())
    for key in ((900, "en"), (1, None), (2, "en"), (9, "de")):
        assert tuple(got[key]) == ("und", 0.0)
    assert got[(901, "en")].lang_pred != "und"


def test_one_language_and_none(make, nothing):
    docs = make([(i, f"text {i}", "en", "a") for i in range(6)] + [(9, "more", None, "a")])
    predict = language_id.predictor(docs.sparkSession, language_id.train(docs))
    assert {tuple(r.p) for r in docs.select(predict("text").alias("p")).collect()} == {("en", 1.0)}
    predict = language_id.predictor(docs.sparkSession, language_id.train(docs.where("lang IS NULL")))
    assert {tuple(r.p) for r in docs.select(predict("text").alias("p")).collect()} == {("und", 0.0)}
    assert nothing.select(predict("text").alias("p")).count() == 0


# ---- samples of ids that stand on many rows ----------------------------------------------------


@pytest.fixture
def fitted(monkeypatch):
    """Row counts of every fit."""
    seen = []
    for module in (toxicity, language_id):

        def counting(rows, sides, *args, own=module.fit, **kw):
            seen.append((int((sides > 0).sum()), int((sides < 0).sum())))
            return own(rows, sides, *args, **kw)

        monkeypatch.setattr(module, "fit", counting)
    return seen


def test_an_id_on_many_rows_teaches_toxicity_once(make, labels_of, fitted):
    rows = [(i, prose(i, 20) + (" stupid" if i % 2 else ""), "en", "a") for i in range(4000, 4100)]
    labels = labels_of([(i, 1, i % 2) for i in range(4000, 4100)])
    learnt = [i for i in range(4000, 4100) if fold(i, 5)]
    again = [(i, prose(k, 20), "en", "a") for i in learnt for k in range(3)]
    toxicity.train(make(rows), labels)
    toxicity.train(make(rows + again), labels)
    assert fitted[0] == fitted[1]
    toxicity.train(make(rows + again), labels, per_class=5)
    assert fitted[2] == (5, 5)


def test_an_id_on_many_rows_teaches_a_language_once(make, fitted):
    rows = [(i, sentence(lang, i), lang, "a") for k, lang in enumerate(("en", "de")) for i in range(100 * k + 10, 100 * k + 70)]
    again = [(i, sentence(lang, i + k), lang, "a") for i, _, lang, _ in rows if fold(i, 3) != 1 for k in range(30)]
    language_id.train(make(rows + again), per_language=20)
    assert fitted == [(20, 20)]
    model = language_id.train(make(rows + again + [(i, "42", "de", "a") for i in range(110, 170)]), per_language=200)
    assert model.languages == ["de", "en"] and sum(fitted[1]) == sum(fold(i, 3) != 1 for i, *_ in rows)


# ---- nothing labelled is left out of the toxicity fit -------------------------------------------


def test_every_labelled_row_and_feature_teaches_toxicity(make, labels_of, fitted, monkeypatch):
    ids = range(20_000, 23_500)
    texts = {i: prose(i % 97, 4) + (" stupid" if i % 10 == 0 else "") for i in ids}
    labels = labels_of([(i, 1, int(i % 10 == 0)) for i in ids])
    held, own = [], toxicity.balanced_cut

    def cut(toxic, clean):
        held.append((len(toxic), len(clean)))
        return own(toxic, clean)

    monkeypatch.setattr(toxicity, "balanced_cut", cut)
    docs = make([(i, text, "en", "a") for i, text in texts.items()])
    weights, _ = toxicity.train(docs, labels)
    learnt = [i for i in ids if fold(i, 5)]
    part = {r._id for r in toxicity.learning_labels(labels).where(toxicity.sets_cut(toxicity.F.col("_id"))).collect()}
    count = lambda chosen: (sum(i % 10 == 0 for i in chosen), sum(i % 10 > 0 for i in chosen))
    assert fitted == [count([i for i in learnt if i not in part])] and fitted[0][1] > 2000
    assert held == [count(part)] and held[0][1] > 500
    # any feature that is not equally common in both classes has a weight, however near its ratio is to 0
    counts = np.zeros((2, toxicity.N_BUCKETS))
    for i in learnt:
        if i not in part:
            (block,) = blocks(pa.array([texts[i]]))
            counts[int(i % 10 == 0), toxicity.distinct_features(block)[0]] += 1
    ratio = toxicity.log_ratios(counts, min(toxicity.SMOOTHING, fitted[0][0] / 4))
    near = (np.abs(ratio) > 1e-4) & (np.abs(ratio) < 0.3)
    assert near.sum() > 20 and np.count_nonzero(weights[near]) == near.sum()
    assert not weights[counts.sum(axis=0) == 0].any()


def test_lists_of_features_are_gone_after_training(spark, make, labels_of, tmp_path, monkeypatch):
    from stratamart.llm import storage

    rows = [(i, prose(i, 20) + (" stupid" if i % 2 else ""), "en", "a") for i in range(4000, 4100)]
    monkeypatch.setattr(storage, "fresh_path", lambda _, label: str(tmp_path / "shared" / label))
    weights, _ = toxicity.train(make(rows + rows[:10]), labels_of([(i, 1, i % 2) for i in range(4000, 4100)]), per_class=20)
    assert weights.any() and not list((tmp_path / "shared").rglob("*.parquet"))


def test_lists_of_buckets_are_read_as_written(monkeypatch):
    rows = [[], [0], [5, 6, 70_000, 1_048_575], [], [1_048_575], [65_535, 131_070], list(range(0, 1 << 20, 997)), []]
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    gaps, last = toxicity.packed(np.array(sum(rows, []), dtype=np.uint32), at)
    for chosen in (range(len(rows)), (2, 5, 0, 6), (3,), ()):
        chosen = list(chosen)
        index, offsets = toxicity.unpacked(gaps.take(pa.array(chosen, pa.int32())), last[chosen])
        assert [index[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [rows[i] for i in chosen]
    monkeypatch.setattr(toxicity, "PIECE_BYTES", 16)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(last), gaps], names=["toxic", "last", "gaps"])
    pieces = list(toxicity._listed([batch, batch.slice(2, 3)]))
    read = [(t, index[a:b].tolist()) for toxic, index, offsets in pieces for t, a, b in zip(toxic, offsets, offsets[1:])]
    assert read == [(i, rows[i]) for i in [*range(len(rows)), 2, 3, 4]] and len(pieces) > 4
    index, offsets = toxicity.unpacked(gaps.slice(2, 4), last[2:6])
    assert [index[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == rows[2:6]


def test_passes_over_a_table_fit_as_one_process_does(spark):
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, size=rng.integers(0, 12))) for _ in range(300)]
    sides = np.array([1 if rng.random() < (0.9 if 3 in r else 0.2) else -1 for r in rows])
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    index = np.concatenate(rows)
    ratio = np.zeros(toxicity.N_BUCKETS)
    ratio[:40] = rng.normal(size=40)
    gaps, last = toxicity.packed(index.astype(np.uint32), at)
    listed = spark.createDataFrame([(int(s > 0), int(e), g.as_py()) for s, e, g in zip(sides, last, gaps)], "toxic int, last int, gaps binary")
    found = toxicity._Scaled(listed.repartition(5), ratio)
    shares = {1: 0.5 / (sides > 0).sum(), -1: 0.5 / (sides < 0).sum()}
    share = np.where(sides > 0, shares[1], shares[-1])
    dense = np.zeros((300, 40))
    dense[np.repeat(np.arange(300), np.diff(at)), index] = ratio[index]

    def brute(weights, bias):
        margin = sides * (dense @ weights + bias)
        slope = -sides * share / (1 + np.exp(margin))
        return share @ np.log1p(np.exp(-margin)), dense.T @ slope, slope.sum()

    weights = np.zeros(toxicity.N_BUCKETS)
    weights[:40] = rng.normal(size=40)
    for got, expected in zip(found.evaluate(weights, 0.3, shares), brute(weights[:40], 0.3)):
        assert np.asarray(got).ravel()[:40] == pytest.approx(np.asarray(expected).ravel(), rel=1e-4, abs=1e-6)
    fitted_weights, bias = toxicity.fit(found, sides.astype(np.int8), penalty=1e-2, steps=60)
    _, slopes, bias_slope = brute(fitted_weights[:40], bias)
    start = np.linalg.norm(np.append(*brute(np.zeros(40), 0.0)[1:]))
    assert np.linalg.norm(np.append(slopes + 1e-2 * fitted_weights[:40], bias_slope)) < 2e-3 * start
    one, one_bias = fit(Rows(index, ratio[index], at, 40), sides, "logistic", penalty=1e-2, steps=3000)
    assert fitted_weights[:40] == pytest.approx(one, abs=0.02) and bias == pytest.approx(one_bias, abs=0.02)
