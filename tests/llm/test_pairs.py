"""Nearest neighbours and the similarity join."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratamart.llm import jaccard_join, nearest
from stratamart.llm.text import blocks
from tests.llm.conftest import prose

# ---- similarity join --------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def joined_by_hand(rows):
    """n_links and the members of the class of each row."""
    sets = [shingles(r[1]) for r in rows]
    links = [[j for j, b in enumerate(sets) if j != i and a and len(a & b) >= 0.8 * len(a | b)] for i, a in enumerate(sets)]
    roots = list(range(len(rows)))
    for _ in rows:
        roots = [min([roots[i], *(roots[j] for j in own)]) for i, own in enumerate(links)]
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None]
        out.append((r[0], min(ids) if ids else None, len(links[i])))
    return Counter(out)


def variants(seed, words, n, every):
    """n texts that differ from one another in single words."""
    base = prose(seed, words).split()
    out = []
    for k in range(n):
        own = list(base)
        for at in range(k % every, len(own), every):
            own[at] = f"v{k}"
        out.append(" ".join(own))
    return out


def test_join_equals_brute_force(make, odd_rows):
    rows = list(odd_rows)
    texts = variants(1, 120, 6, 60) + variants(2, 200, 5, 199) + variants(3, 60, 4, 12) + [prose(9, 4), prose(9, 4), prose(9, 5), prose(9, 200)]
    texts += [prose(50, 300), " ".join(prose(50, 300).split()[:270]), "  ".join(prose(50, 300).split())]
    rows += [(100 + i, t, "en", "a") for i, t in enumerate(texts)]
    docs = make(rows, clashing=True)
    got = jaccard_join.classes(docs).collect()
    assert Counter(map(tuple, got)) == joined_by_hand(rows)


def test_one_of_each_class_stays(make, odd_rows):
    rows = odd_rows + [(100 + i, t, "en", "a") for i, t in enumerate(variants(1, 150, 4, 149) * 2)]
    docs = make(rows, clashing=True)
    kept = jaccard_join.one_per_class(docs)
    assert kept.columns == docs.columns
    ids = Counter((r.doc_id, r.text) for r in kept.collect())
    assert ids[(100, rows[len(odd_rows)][1])] == 1 and not any(i and i > 100 for i, _ in ids)
    assert ids[(None, "the null row")] == 1 and ids[(5, "repeated row with some more words in it")] == 1
    assert ids[(1, None)] == ids[(2, "")] == ids[(None, None)] == 1 and (7, odd_rows[10][1]) not in ids


@pytest.mark.parametrize("block", [7, 1000])
def test_a_large_group_loses_no_link(make, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = [(i, t) for i, t in enumerate(variants(5, 60, 60, 55))]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    got = jaccard_join.classes(make(rows)).collect()
    assert Counter(map(tuple, got)) == joined_by_hand(rows)


def kept_and_named(make, rows):
    """Ids that stay, and the class ids that the join with counts names."""
    df = make(rows).repartition(4)
    kept = sorted(r.doc_id for r in jaccard_join.one_per_class(df).collect())
    return kept, sorted({r.class_id for r in jaccard_join.classes(df).collect()})


def test_texts_that_only_others_than_the_hub_link(make, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    # texts drifting word by word: neighbours are similar, far ones are not, so one hub cannot join them
    words = [f"w{k}" for k in range(160)]
    rows = [(k, " ".join(words[k : k + 60])) for k in range(0, 100, 2)]
    rows += [(1000 + k, " ".join(words[3 * k : 3 * k + 60]) + " x" * (k % 2)) for k in range(30)]
    kept, named = kept_and_named(make, rows)
    assert kept == named == sorted({c for _, c, _ in joined_by_hand(rows)})


def test_near_copies_cost_rows_in_proportion(make, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 20)
    template, n = [f"t{k}" for k in range(120)], 400
    docs = make([(k, " ".join([*template[:60], f"own{k}", *template[60:]])) for k in range(n)])
    bands, rows = jaccard_join.bands_and_rows()
    _, nodes = jaccard_join._texts(docs, bands, rows)
    met = jaccard_join._met(nodes)
    star = jaccard_join._star_units(met)
    # each text once per hub at most, and a hub once per block of its texts
    assert star.count() < (1 + 2 / 20) * bands * n
    verified = jaccard_join._verified_units(star, nodes, jaccard_join._sets(docs, nodes, met), 0.8)
    roots = jaccard_join.components(verified)
    assert roots.count() == n and roots.select("root").distinct().count() == 1
    assert jaccard_join._rest_units(met, roots).isEmpty()


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.bands_and_rows()
    assert bands * rows <= jaccard_join.MOST_HASHES
    assert 1 - (1 - 0.8**rows) ** bands >= jaccard_join.RECALL > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_minhash_estimates_the_similarity():
    a, b = prose(1, 400), " ".join(prose(1, 400).split()[:300])
    block = next(blocks(pa.array([a, b])))
    same = jaccard_join.band_hashes(block, 500, 1)
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert (same[0] == same[1]).mean() == pytest.approx(true, abs=0.08)


def test_components_of_a_long_path(spark):
    names = [bytes([k * 37 % 256, k]) for k in range(200)]
    edges = spark.createDataFrame([(a, b) for a, b in zip(names, names[1:])], "node binary, least binary")
    got = jaccard_join.components(edges).collect()
    assert len(got) == 200 and {bytes(r.root) for r in got} == {min(names)}


def test_join_of_nothing(nothing, make):
    assert jaccard_join.classes(nothing).count() == 0
    assert jaccard_join.one_per_class(nothing).count() == 0
    assert [tuple(r) for r in jaccard_join.classes(make([(3, None)])).collect()] == [(3, 3, 0)]


# ---- nearest neighbours -----------------------------------------------------------------------


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("k1", F.lit(1)).withColumn("leaf", F.lit("x"))
    out = {}
    for r in nearest.search(table, F.col("id") % 50 == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 16))
    vectors = (centers[rng.integers(0, 20, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    got = found(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], leaf=64, sample=1000)
    unit = vectors.astype(np.float64) / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        scores = unit @ unit[q]
        scores[q] = -2
        best = set(np.argsort(-scores)[:5].tolist())
        assert [x[0] for x in got[q]] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(scores[v], abs=1e-12) for _, v, s in got[q])
        assert [-s for *_, s in got[q]] == sorted(-s for *_, s in got[q])
        hits += len(best & {v for _, v, _ in got[q]})
    assert len(got) == 60 and hits / 300 >= 0.9


def test_vectors_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 2.0, 2.0]
    rows = [(0, good), (7, good), (3, good), (50, [2.0, 4.0, 4.0]), (51, [1.0, 0.0, 0.0]), (51, [1.0, 0.0, 0.0]), (52, [-1.0, -2.0, -2.0])]
    rows += [(100, None), (150, []), (200, [0.0, 0.0, 0.0]), (250, [1.0, nan, 1.0]), (300, [1.0, None, 1.0]), (350, [inf, 1.0, 1.0])]
    rows += [(None, good), (400, [1.0, 2.0])]
    got = found(spark, rows)
    assert set(got) == {0, 50}
    assert [v for _, v, _ in got[0]] == [3, 7, 50, 51, 52] and [v for _, v, _ in got[50]] == [0, 3, 7, 51, 52]
    assert [s for *_, s in got[0]] == pytest.approx([1, 1, 1, 1 / 3, -1])


def test_one_very_common_vector(spark):
    rows = [(i, [1.0, 1.0]) for i in range(400)] + [(1000 + i, [1.0, float(i)]) for i in range(60)]
    got = found(spark, rows)
    assert [v for _, v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for _, v, _ in got[350]] == [0, 1, 2, 3, 4]
    assert [s for *_, s in got[1050]][0] < 1 and len(got) == 10


def test_blocks_of_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(300)]
    got = found(spark, rows, recall=1.0)
    vectors = np.array([v for _, v in rows])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in range(0, 300, 50):
        scores = unit @ unit[q]
        scores[q] = -2
        assert [v for _, v, _ in got[q]] == np.argsort(-scores)[:5].tolist()


def test_few_or_no_vectors(spark):
    assert found(spark, [(1, [1.0])]) == {} and found(spark, []) == {} and found(spark, [(50, None)]) == {}
    assert found(spark, [(50, [1.0, 0.0])]) == {}
    assert [v for _, v, _ in found(spark, [(50, [1.0, 0.0]), (2, [0.0, 1.0]), (1, [0.0, 2.0])])[50]] == [1, 2]
