"""Sharding and mixing."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from stratamart.llm import mixing, sharding
from tests.llm.conftest import prose

# ---- sharding ---------------------------------------------------------------------------------


def check_shards(rows, out, n_shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    places = defaultdict(list)
    for r in out:
        places[r.shard].append(r.slot)
    assert set(places) <= set(range(n_shards))
    assert all(sorted(own) == list(range(len(own))) for own in places.values())


def test_every_record_has_one_place(make, odd_rows, nothing):
    rows = odd_rows + [(100 + i, prose(i, 5 + i % 40), "en", "a") for i in range(400)]
    out = sharding.shard(make(rows, clashing=True), n_shards=5, n_slots=64).collect()
    check_shards(rows, out, 5)
    assert all(r.map_version == 1 for r in out) and len({(r.virtual_slot, r.shard) for r in out}) <= 64
    assert sharding.shard(nothing, n_shards=5, n_slots=64).count() == 0


def test_bytes_are_near_equal_though_copies_abound(make):
    rows = [(i, prose(7, 30), "en", "a") for i in range(700)] + [(1000 + i, prose(i, 1 + i % 60), "en", "a") for i in range(1400)]
    out = sharding.shard(make(rows), n_shards=16).collect()
    check_shards(rows, out, 16)
    loads = Counter()
    for r in out:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values()) / 16


def test_a_row_repeated_many_times_fills_all_shards(make, monkeypatch):
    from stratamart.llm import copies

    monkeypatch.setattr(copies, "RUN_BITS", 5)
    rows = [(5, prose(3, 20), "en", "a")] * 1500 + [(None, prose(4, 9), None, "a")] * 400 + [(10 + i, prose(i, 1 + i % 60), "en", "a") for i in range(2000)]
    out = sharding.shard(make(rows)).collect()
    check_shards(rows, out, 16)
    loads = Counter()
    for r in out:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) < max(r.size for r in out)


def test_a_stored_map_is_loaded_edited_and_stored_anew(spark, make, tmp_path):
    path = str(tmp_path / "map")
    rows = [(i, prose(i, 1 + i % 40), "en", "a") for i in range(600)]
    run = lambda some, n: sharding.shard(make(some), n_shards=n, n_slots=256, map_path=path).collect()
    first = run(rows, 4)
    assert {r.map_version for r in first} == {1}
    assert {r.map_version for r in run(rows, 4)} == {1}  # nothing to move, no new version
    more = rows + [(1000 + i, prose(i, 30), "en", "a") for i in range(100)]
    second, third = run(more, 4), run(more, 5)
    assert {r.map_version for r in second} == {2} and {r.map_version for r in third} == {3}
    check_shards(more, third, 5)
    assert sharding.load_map(spark, path)[0] == 3 and sharding.load_map(spark, path, 0)[1] == sharding.first_map(256, 4)
    assert {(r.doc_id, r.virtual_slot) for r in first} <= {(r.doc_id, r.virtual_slot) for r in third}  # slots never change
    stay = {(r.doc_id, r.shard) for r in second} & {(r.doc_id, r.shard) for r in third}
    assert len(stay) > 0.6 * len(more)
    with pytest.raises(ValueError):
        sharding.shard(make(rows), n_shards=4, n_slots=128, map_path=path)


def test_map_versions_and_growth(spark, tmp_path):
    sizes = [(k * 7919) % 1000 + 1 for k in range(500)]
    first = sharding.first_map(500, 8)
    second = sharding.rebalanced(first, sizes, 8)
    third = sharding.rebalanced(second, sizes, 9)  # one more shard
    path = str(tmp_path / "map")
    for version, own in enumerate((first, second, third)):
        sharding.store_map(spark, path, version, own)
    assert sharding.load_map(spark, path) == (2, third) and sharding.load_map(spark, path, 1) == (1, second)
    for n, own in ((8, second), (9, third)):
        loads = [sum(s for s, at in zip(sizes, own) if at == shard) for shard in range(n)]
        assert max(loads) - min(loads) <= 2 * min(sizes) + 40
    assert sum(a != b for a, b in zip(second, third)) < 120  # most slots stay
    assert sharding.rebalanced([0, 0], [0, 0], 3) == [0, 0]


# ---- mixing -----------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_hand(sizes):
    """sizes: words per source. Water filling, one round after another."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        open_ones = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        over = [s for s in open_ones if share[s] >= 3 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 3 * sizes[s]
            left -= full[s]


def mixed_by_hand(rows):
    seen = Counter()
    docs = []
    for i, t, _, source in rows:  # rows alike are told apart by their number
        docs.append((i, source, len(WORD.findall(t or "")), (t, seen[i, t, source])))
        seen[i, t, source] += 1
    sizes, n = Counter(), Counter()
    for _, source, size, _ in docs:
        sizes[source] += size
        n[source] += 1
    target, out = targets_by_hand(sizes), []
    for source in sizes:
        whole = int(target[source] // sizes[source]) if sizes[source] else 0
        rest = target[source] - whole * sizes[source]
        ranked, order = defaultdict(int), {}
        for i, s, size, text in docs:
            if s == source:
                tag = "/".join(x for x in (mixing.SEED, None if i is None else str(i), text[0]) if x is not None)
                own = hashlib.md5(tag.encode()).hexdigest()
                own = hashlib.md5(f"{own}/{text[1]}".encode()).hexdigest() if text[1] else own
                u = (int(own[:13], 16) + 0.5) / 2**52
                order[(i, text)] = u / (1 - u) / (size / (size + sizes[s] / n[s])) if size else None
        taken = set()
        for _ in range(mixing.ROUNDS):
            gap, spent, limit = rest, 0, rest
            group = defaultdict(list)
            for i, s, size, text in docs:
                if s == source and size and size <= limit and (i, text) not in taken:
                    group[order[(i, text)]].append(((i, text), size))
            for q in sorted(group):
                if spent + sum(x for _, x in group[q]) > gap:
                    break
                spent += sum(x for _, x in group[q])
                taken |= {key for key, _ in group[q]}
            rest -= spent
        out += [(i, size, sizes[s], round(target[s], 6), (whole + ((i, text) in taken)) * size, s) for i, s, size, text in docs if s == source]
    return Counter(out)


def test_mix_equals_brute_force(make, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, 3 + i * i % 50), "en", "abcdefgh"[i % 7 if i % 3 else 0]) for i in range(300)]
    rows += [(900, "tiny", "en", "zz"), (901, "ünï", "en", "é"), (902, "", "en", "none")]
    got = mixing.mix(make(rows, clashing=True)).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.source) for r in got) == mixed_by_hand(rows)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.taken for r in own) <= own[0].target + 1e-6
        assert all(r.taken <= 3 * r.size for r in own)


def test_repeated_rows_do_not_stand_in_the_way(make, monkeypatch):
    """A source in which a third of the rows repeat ends within one document of its target."""
    from stratamart.llm import copies

    monkeypatch.setattr(copies, "RUN_BITS", 4)
    rows = [(1, prose(1, 11), "en", "b")] * 300 + [(1000 + i, prose(i, 11), "en", "b") for i in range(300)]
    rows += [(2, prose(2, 9), "en", "a")] * 200 + [(3000 + i, prose(i, 3 + i % 9), "en", "a") for i in range(300)]
    rows += [(4, "x y", "en", "b")] * 5 + [(4, "x y", "en", "c")] * 2
    got = mixing.mix(make(rows)).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.source) for r in got) == mixed_by_hand(rows)
    for source in "ab":
        own = [r for r in got if r.source == source]
        assert 0 <= own[0].target - sum(r.taken for r in own) < max(r.size for r in own)
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixing.mixed_documents(make(rows)).collect()) == +taken


def test_mixed_documents_repeat_whole_rows(make, odd_rows, nothing):
    rows = odd_rows + [(100 + i, prose(i, 3 + i % 9), "en", "ab"[i % 10 > 0]) for i in range(100)]
    docs = make(rows, clashing=True)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect() if r.doc_id and r.doc_id >= 100) == Counter(
        {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.doc_id and r.doc_id >= 100 and r.copies}
    )
    assert mixing.mix(nothing).count() == mixing.mixed_documents(nothing).count() == 0


def test_one_source_is_taken_once(make):
    got = mixing.mix(make([(i, prose(i, 9), "en", None) for i in range(50)])).collect()
    assert all(r.taken == r.size == 9 and r.target == pytest.approx(450) for r in got)


@pytest.mark.parametrize("bins", [1, 8])
def test_bins_change_nothing(make, monkeypatch, bins):
    docs = make([(i, prose(i, 1 + i % 30), "en", "abc"[i % 3]) for i in range(200)])
    expected = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing.ranked, "__defaults__", (bins,))
    monkeypatch.setattr(mixing.next_cut, "__defaults__", (bins,))
    assert sorted(map(tuple, mixing.mix(docs).collect())) == expected
