"""SimHash, repeats and vectors against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from arrears.llm import repeats, simhash, vectors
from arrears.llm.components import components, local_roots
from llm_fixtures import nothing, odd, odd_rows, prose


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [r[1] for r in odd_rows()])
def test_fingerprint_follows_its_definition(text):
    assert simhash.fingerprint(text or "") == slow_fingerprint(text)


@pytest.mark.parametrize("depth", [0, 1, 4, 7])
def test_tree_finds_every_pair(depth):
    rng = np.random.default_rng(depth)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 6)).astype(np.uint64)) for _ in range(900)])
    x = np.unique(np.concatenate([centres[rng.integers(0, 60, 900)] ^ flips, rng.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    points, radii = simhash.build_tree(x[::3], depth)
    homes, sent = {}, {}
    for shard, rows, home in simhash.route(x, points, radii, 4):
        homes.setdefault(shard, []).append(x[rows[home]])
        sent.setdefault(shard, []).append(x[rows[~home]])
    assert sum(len(h) for hs in homes.values() for h in hs) == len(x)
    links = []
    for shard, own in homes.items():
        a, b = simhash.shard_links(np.concatenate(own), np.concatenate(sent[shard]), 4)
        links += zip(a.tolist(), b.tolist())
        assert (np.bitwise_count(a ^ b) <= 64).all()
    near = [(int(a), int(b)) for k, a in enumerate(x) for b in x[k + 1 :][np.bitwise_count(x[k + 1 :] ^ a) <= 4]]
    assert near and roots(x.tolist(), links) == roots(x.tolist(), near)


def test_shards_spend_few_comparisons_on_a_dense_cluster():
    x = np.array([np.uint64(1) << np.uint64(i) | np.uint64(1) << np.uint64(j) for i in range(40) for j in range(i)], dtype=np.uint64)
    a, b = simhash.shard_links(np.unique(x), x[:0], 4)
    assert len(a) == len(np.unique(x)) - 1


def test_odd_documents_form_the_groups_of_their_fingerprints(spark):
    found = simhash.simhash_components(odd(spark)).collect()
    rows = [(r[0], simhash.fingerprint(r[1] or "")) for r in odd_rows()]
    assert sorted((str(r.doc_id), r.fingerprint) for r in found) == sorted((str(i), f"{f:016x}") for i, f in rows)
    fps = {f for _, f in rows}
    groups = roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    best = {}
    for i, f in rows:
        if i is not None:
            best[groups[f]] = min(i, best.get(groups[f], i))
    assert all(r.component_id == best.get(groups[int(r.fingerprint, 16)]) for r in found)
    kept = simhash.keep_one_per_group(odd(spark))
    assert kept.columns == odd(spark).columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(set(groups.values())) and len(set(left)) == len(left)
    assert {groups[simhash.fingerprint(t or "")] for _, t in left} == set(groups.values())
    assert all(i == best[groups[simhash.fingerprint(t or "")]] for i, t in left if i is not None)


def test_empty_tables_give_empty_groups(spark):
    assert simhash.simhash_components(nothing(spark)).count() == 0
    assert simhash.keep_one_per_group(nothing(spark)).count() == 0
    assert repeats.deduplicated(nothing(spark)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(5, 5), (7, 6), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1040)}


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
@settings(max_examples=60, deadline=None)
def test_local_roots(links):
    a, b = (np.array([x[k] for x in links], dtype=int) for k in (0, 1))
    assert dict(enumerate(local_roots(31, a, b).tolist())) == roots(range(31), links)


# --- repeats


def slow_removal(rows):
    """doc_id, words, removed, digest by a table of all windows."""
    windows = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k : k + 13])
                windows[key] = min(i, windows.get(key, i))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = {k + j for k in range(len(w) - 12) for j in range(13) if i is not None and windows[tuple(w[k : k + 13])] < i}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shown(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_odd_documents_lose_what_smaller_ones_hold(spark):
    found = shown(repeats.deduplicated(odd(spark)))
    assert found == slow_removal([r[:2] for r in odd_rows()])
    assert sum(r[2] for r in found) > 150


def test_passages_runs_and_overlaps(spark):
    passage, other = prose(50, 55), prose(51, 13)
    rows = [(k, f"{prose(100 + k, 17 + k)} {passage} {prose(200 + k, 9)}") for k in range(40, 20, -1)]
    rows += [(k, f"{'a ' * k} {other} {'b a ' * 12} {prose(300, 12)}") for k in range(1, 16)]
    rows += [(60, "a " * 500), (61, "a " * 700), (62, f"{other} {other} {passage} {passage}"), (62, passage), (63, None)]
    found = shown(repeats.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert found == slow_removal(rows)


@given(st.lists(st.lists(st.integers(0, 3), min_size=13, max_size=60), min_size=2, max_size=6), st.integers(20, 60))
@settings(max_examples=40, deadline=None)
def test_anchors_depend_on_the_window_alone(texts, cut):
    codes = np.array([11, 222, 3333, 44444], dtype=np.uint64)
    known = {}
    joined = [np.concatenate(texts).tolist()[:cut]] + texts
    for t in joined:
        words = repeats.mixed(codes[np.array(t)], np.uint64(9))
        key = repeats.anchors(words, np.zeros(len(t), dtype=int))
        for at in range(len(t) - 12):
            assert key[at] and known.setdefault(tuple(t[at : at + 13]), key[at]) == key[at]


def test_long_texts_go_through_in_slices(monkeypatch):
    text = prose(9, 3000, 60)
    own = repeats.Words([text], repeats.Codes())
    (_, position, words, unit), = own.parts()
    whole = dict(zip(position[repeats.whole(unit)], repeats.anchors(words, unit)[repeats.whole(unit)]))
    monkeypatch.setattr(repeats, "SLICE", 100)
    cut = {}
    for _, position, words, unit in repeats.Words([text], repeats.Codes()).parts():
        at = repeats.whole(unit)
        cut |= dict(zip(position[at], repeats.anchors(words, unit)[at]))
    assert cut == whole


# --- vectors


def slow_links(rows, threshold=0.93):
    ok = []
    for i, v, label in rows:
        good = label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
        ok.append(good)
    links = {k: [] for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(np.array(rows[k][1], dtype=np.float32), dtype=np.float64) for k in (a, b))
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[a].append(b)
                    links[b].append(a)
    group = roots(range(len(rows)), [(a, b) for a in links for b in links[a]])
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((str(i), len(links[k]), str(c), i is not None and i == c))
    return sorted(out)


def clustered(seed, clusters, each, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    return [
        (int(k * each + j), (centres[k] + 0.22 * rng.standard_normal(dim)).tolist(), k % 3)
        for k in range(clusters) for j in range(each)
    ]


VECTORS = "vec_id long, embedding array<float>, label int, leaf string"


def ran(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS).repartition(3)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vectors.near_duplicates(df).collect())


def test_odd_vectors(spark):
    rows = clustered(1, 6, 5) + [
        (100, [0.0] * 24, 1), (101, None, 1), (102, [1.0] * 24, None), (103, [float("nan")] + [1.0] * 23, 1),
        (104, [None] + [1.0] * 23, 1), (105, [1.0] * 24, 1), (106, [2.0] * 24, 1), (107, [2.0] * 24, 1), (107, [2.0] * 24, 1),
        (108, [2.0] * 24, 2), (None, [1.0] * 24, 1), (109, [1.0, 0.0], 1), (110, [], 1), (111, [1e38] * 24, 1), (112, [float("inf")] * 24, 1),
    ]
    assert ran(spark, rows) == slow_links(rows)
    assert ran(spark, []) == []


def test_deep_forest_and_divided_leaves(spark, monkeypatch):
    rows = clustered(2, 40, 20) + [(9000 + k, (np.ones(24) + 0.02 * np.random.default_rng(k).standard_normal(24)).tolist(), 0) for k in range(120)]
    want = slow_links(rows)
    monkeypatch.setattr(vectors, "LEAF", 30)
    monkeypatch.setattr(vectors, "BLOCK", 40)
    found = ran(spark, rows)
    all_links, got = sum(r[1] for r in want), sum(r[1] for r in found)
    assert 0.9 * all_links <= got <= all_links
    by_id = {r[0]: r[1] for r in want}
    assert all(r[1] <= by_id[r[0]] for r in found)
