"""The whole pipeline and the registered queries."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from stratamart.llm import catalogue
from tests.llm.conftest import prose
from tests.llm.test_layout import mixed_by_hand
from tests.llm.test_lines_and_rules import cut_by_hand
from tests.llm.test_pairs import joined_by_hand

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def duck():
    return duckdb.connect()


@pytest.mark.parametrize("name", list(catalogue.ORACLE))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    for path in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"create or replace view {path.stem} as select * from '{path}'")
    got = catalogue.QUERIES[name](spark, sf_dir)
    expected = duck.sql(catalogue.ORACLE[name])
    assert sorted(got.columns) == sorted(expected.columns)
    order = sorted(got.columns)
    clean = lambda rows: Counter(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows)
    assert clean(got.select(*order).collect()) == clean(expected.select(*order).fetchall())


def test_all_are_registered():
    names = contract.queries()
    assert set(catalogue.QUERIES) | {"pipeline"} <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "bpe"]


def test_stages_against_brute_force(spark, make, labels_of, odd_rows, tmp_path):
    passage = "\n".join(prose(900 + k, 6) for k in range(4))
    rows, labels = list(odd_rows), []
    for i in range(100, 300):
        words = prose(i, 40).split()
        if i % 5 == 0:
            words[i % 30] = "worthless"
        text = "\n".join(" ".join(words[k : k + 10]) for k in range(0, 40, 10))
        rows.append((i, f"{text}\n{passage}" if i % 7 == 0 else text, "en", "abc"[i % 3]))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(400 + i, rows[len(odd_rows) + 1 + i][1].replace("\n", " "), "en", "a") for i in range(3)]
    docs = make(rows)
    labels_of(labels).write.parquet(str(tmp_path / "labels.parquet"))
    by_name = dict(corpus_pipeline.STAGES)

    def stage(name, docs):
        path = str(tmp_path / name)
        by_name[name](spark, docs, str(tmp_path)).write.parquet(path)
        return spark.read.parquet(path)

    clean = stage("toxicity", docs)
    assert clean.columns == DOCUMENTS
    left = Counter(r.doc_id for r in clean.collect())
    toxic = {i for i, _, t in labels if t}
    assert sum(left[i] for i in toxic) <= 1 and sum(left[i] for i, _, t in labels if not t) >= 158
    kept = [tuple(r)[:4] for r in clean.collect()]
    assert all(r in kept for r in odd_rows if r[0] not in (6, 7))  # so small a sample may misjudge the long text

    cut = stage("line_dedup", clean)
    assert cut.columns == DOCUMENTS and cut.count() == len(kept)
    expected = cut_by_hand(list(dict.fromkeys((r[0], r[1]) for r in kept if r[0] is not None and r[0] != 5)))
    got = {r.doc_id: r.text for r in cut.collect()}
    assert all(got[i] == text for (i, _), text in expected.items())
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.collect())

    single = stage("jaccard_join", cut)
    assert single.columns == DOCUMENTS
    mine = [tuple(r)[:4] for r in cut.collect()]
    classes = {c for i, c, _ in joined_by_hand(mine) if c is not None and i is not None}
    ids = Counter(r.doc_id for r in single.collect())
    assert {i for i in ids if i is not None} == classes
    assert not any(ids[400 + i] for i in range(3))

    mixed = stage("mixing", single)
    assert mixed.columns == DOCUMENTS
    weighed = mixed_by_hand([tuple(r)[:4] for r in single.collect()])
    assert Counter(r.doc_id for r in mixed.collect() if r.doc_id and r.doc_id >= 100) == Counter(
        {i: taken // size for (i, size, _, _, taken, _) in weighed if i and i >= 100 and taken}
    )

    coded = stage("bpe", mixed)
    assert coded.count() == mixed.count() and all(len(r.ids) == r.n_tokens for r in coded.collect())


def test_run_chains_the_stages(spark, make, labels_of, odd_rows, tmp_path):
    make(odd_rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of([(4, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    assert 0 < out.count() <= 3 * len(odd_rows)


def test_an_empty_table_passes(spark, nothing, labels_of, tmp_path):
    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    labels_of([]).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
