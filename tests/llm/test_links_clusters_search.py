"""Jaccard links, centroids and ranked search against plain versions of them."""

import math
import random

import brute
import numpy as np
import pandas as pd
import pytest

from buycast.llm import centroids, lexical, parity_join, word_sets
from buycast.llm.common import block_pieces


def edited(rows, seed, groups=10, copies=10):
    """Chains of edited copies of some of ``rows``, which go on past a similarity of 0.8."""
    rng, out = random.Random(seed), {}
    base = [t for _, t in sorted(rows.items()) if t and 60 < len(t.split()) < 2000][:groups]
    for k, text in enumerate(base):
        words = text.split()
        for j in range(copies):
            words = list(words)
            for i in rng.sample(range(len(words)), max(1, len(words) * (1 + j % 3) // 100)):
                words[i] = f"edit{k}x{j}x{i}"
            out[5000 + 100 * k + j] = " ".join(words)
    return out


@pytest.mark.parametrize("chunk", [3, 1000])
def test_links_equal_brute_force(spark, docs, texts, monkeypatch, chunk):
    monkeypatch.setattr(parity_join, "CHUNK", chunk)
    monkeypatch.setattr(parity_join, "SHARD", 50)
    rows = {**texts, **edited(texts, 5)}
    want = brute.parity_links(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 80
    table = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.linked(table).collect()}
    assert got == want


def test_links_where_a_passage_is_in_all_and_short_texts(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = {i: passage + " " + " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(60))) for i in range(150)}
    rows |= {200 + i: " ".join(rng.choice("ab") for _ in range(rng.randrange(12))) for i in range(100)}
    table = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.linked(table).collect()}
    assert got == brute.parity_links(rows)


def test_links_of_odd_rows(repeated_rows, nobody):
    assert parity_join.linked(nobody).collect() == []
    rows = parity_join.linked(repeated_rows).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(["None"] * 3 + ["1"] * 3 + ["2"])
    assert {(r.doc_id, r.component_id) for r in rows if r.n_shingles > 20} == {(None, 1), (1, 1), (2, 1)}
    assert [(r.doc_id, r.component_id) for r in rows if r.n_shingles == 0] == [(None, None)]


def keys_of(own, bands, levels):
    return {int(k) for _, keys in parity_join.emitted(own, np.array([len(own)]), bands, levels) for k in keys}


@pytest.mark.parametrize("ratio", [(80, 100), (1, 2), (95, 100)])
def test_similar_sets_share_a_key_and_sketches_bound_their_difference(ratio):
    bands, rng = parity_join.Bands(ratio), np.random.default_rng(4)
    for size in [1, 2, 3, 4, 5, 6, 8, 9, 12, 13, 30, 41, 100, 333, 1000] * 6:
        levels = rng.integers(0, 5, parity_join.COUNTERS).astype(np.int8)
        a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        most = bands.differ(len(a), bands.largest(len(a)))
        keep = rng.permutation(a)[rng.integers(0, most + 1):]
        b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 64, rng.integers(0, most + 1), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and ratio[1] * both >= ratio[0] * (len(a) + len(b) - both):
            assert keys_of(a, bands, levels) & keys_of(b, bands, levels)
        if len(b):
            x, y = parity_join.parity(a).tobytes(), parity_join.parity(b).tobytes()
            width = min(len(x), len(y)) // 8
            far = int(np.bitwise_count(parity_join.folded(x, width) ^ parity_join.folded(y, width)).sum())
            assert far <= len(a) + len(b) - 2 * both


def test_keys_of_many_sets_are_those_of_each():
    bands, rng = parity_join.Bands(), np.random.default_rng(5)
    levels = rng.integers(0, 3, parity_join.COUNTERS).astype(np.int8)
    sets = [np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (0, 1, 5, 0, 40, 7, 300, 2, 41)]
    found = {}
    for which, keys in parity_join.emitted(np.concatenate(sets), np.array([len(s) for s in sets]), bands, levels):
        for w, k in zip(which, keys):
            found.setdefault(int(w), set()).add(int(k))
    assert found == {i: keys_of(s, bands, levels) for i, s in enumerate(sets) if len(s)}


@pytest.mark.parametrize("part", [1 << 19, 40])
def test_sets_of_texts_are_distinct_shingles(docs, monkeypatch, part):
    monkeypatch.setattr(word_sets, "PART", part)
    texts = [r.text for r in docs.select("text").collect()] + ["A b", "a B", "a b c d e", "A\tB\u00a0c", "a b\x85c", "é É", " x "]
    elements, sizes = word_sets.sets_of(texts, 5)
    ends, names = np.cumsum(sizes), {}
    for text, a, b in zip(texts, ends - sizes, ends):
        own = elements[a:b].tolist()
        want = brute.shingle_set(text) if brute.words(text) else set()
        assert own == sorted(set(own)) and len(own) == len(want)
        key = frozenset(want)
        assert names.setdefault(key, own) == own
    assert len({tuple(v) for v in names.values()}) == len(names)
    every = set().union(*names)
    assert len(set(elements.tolist())) == len(every)


def test_rows_of_a_key_meet_however_they_are_batched():
    rng = np.random.default_rng(6)
    rows = pd.DataFrame({"key": rng.integers(0, 40, 300), "node": rng.integers(0, 30, 300)})
    rows["n"], rows["like"] = 5 + rows["node"] % 7, rows["node"] % 7 // 3
    rows = rows.sort_values(["key", "like", "node"], ignore_index=True)
    whole = pd.concat(parity_join._met([rows]), ignore_index=True)
    several = rows.drop_duplicates().groupby("key")["node"].transform("size") > 1
    assert whole[["key", "node", "n"]].equals(rows.drop_duplicates()[several][["key", "node", "n"]].reset_index(drop=True))
    for size in (1, 2, 7):
        parts = [rows.iloc[i:i + size].reset_index(drop=True) for i in range(0, len(rows), size)]
        assert pd.concat(parity_join._met(parts), ignore_index=True).astype("int64").equals(whole.astype("int64"))


def test_clusters_equal_lloyds_rounds(spark):
    rng = random.Random(1)
    vectors = {i: [rng.choice([0.1, 0.2, 0.25, -0.4]) * (1 + i % 3) for _ in range(8)] for i in range(200)}
    odd = [(1000, None), (1001, [0.0] * 7), (1002, [0.0] * 9), (1003, [float("nan")] + [0.0] * 7), (1004, [float("inf")] + [0.0] * 7),
           (1005, [None] + [0.0] * 7)]
    table = spark.createDataFrame(list(vectors.items()) + odd, "vec_id long, embedding array<double>").withColumnsRenamed({})
    table = table.selectExpr("*", "'x' AS cluster", "1 AS v", "2 AS distance").repartition(5)
    want, centres = brute.lloyd({i: [math.floor(256 * x) for x in v] for i, v in vectors.items()}, 12, 3)
    rows = centroids.clustered(table, k=12, rounds=3, dims=8).collect()
    assert {r.vec_id: (r.cluster, r.distance) for r in rows} == want
    for c in {r.cluster for r in rows}:
        assert {r.cluster_inertia for r in rows if r.cluster == c} == {sum(d for k, d in want.values() if k == c)}
    assert {r.inertia for r in rows} == {sum(d for _, d in want.values())}
    assert len({r.centroid_sha256 for r in rows}) == len({tuple(centres[c]) for c, _ in want.values()})


def test_clusters_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert centroids.clustered(spark.createDataFrame([], kind)).collect() == []
    rows = [(None, [1.0] * 64), (1, [1.0] * 64), (1, [1.0] * 64), (2, [3e38] + [-3e38] * 63)]
    got = centroids.clustered(spark.createDataFrame(rows, kind)).collect()
    assert sorted((str(r.vec_id), r.cluster_inertia) for r in got) == [("1", 0), ("1", 0), ("2", 0), ("None", 0)]
    assert len({r.cluster for r in got}) == 2  # equal centroids: ties go to the first


def test_gathered_distances_are_squared_distances():
    rng = np.random.default_rng(3)
    v, c = rng.integers(-300, 300, (500, 16)), rng.integers(-300, 300, (7, 16))
    cluster, far = centroids.nearest(v, c)
    want = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert (far == want.min(axis=1)).all() and (cluster == want.argmin(axis=1)).all()


@pytest.mark.parametrize("per_pass", [2000, 7])
def test_search_equals_scoring_all(docs, texts, benchmark, per_pass):
    items = sorted((r.item_id, r.text) for r in benchmark.collect())
    more = [(900, None), (901, ""), (902, "?!"), (903, "nowhere999 to be found999"), (904, "THE the tHe " + items[0][1]), (905, items[1][1] * 3)]
    table = benchmark.sparkSession.createDataFrame(items + more, "item_id long, text string").repartition(2)
    got = [tuple(r) for r in lexical.ranked(docs, table, items_per_pass=per_pass).collect()]
    assert sorted(got) == sorted(brute.search(texts.items(), items + more))


def test_search_with_ties_and_odd_rows(spark, repeated_rows, nobody, docs, benchmark):
    assert lexical.ranked(nobody, benchmark).collect() == [] and lexical.ranked(docs, benchmark.limit(0)).collect() == []
    items = [(None, "alpha1 beta2 quite"), (7, "another text"), (7, "another text")]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in repeated_rows.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    for k in (1, 3, 20):
        got = [tuple(r) for r in lexical.ranked(repeated_rows, table, k=k).collect()]
        assert sorted(got, key=key) == sorted(brute.search(rows, items, k), key=key)


def test_bounds_are_never_below_scores():
    rng = random.Random(8)
    texts = [" ".join(f"t{rng.randrange(3000)}" for _ in range(rng.randrange(1, 900))) for _ in range(60)]
    items = [[b"t%d" % rng.randrange(3000) for _ in range(30)] for _ in range(20)]
    held = {t: 1 + rng.randrange(50) for q in items for t in q}
    queries = lexical.Queries(items, 60, sum(len(t.split()) for t in texts), held)
    sketch, exact = lexical.sketches(texts, queries, lexical.Terms())
    bounds = (sketch.astype(np.float64) @ queries.folded) * lexical.STEP
    for q in range(len(items)):
        assert (bounds[:, q] >= queries.scores(q, exact)).all()


def test_pieces_of_a_long_text():
    text = " ".join(f"w{i}\t" for i in range(5000)) + "x" * 400 + "\n"
    for limit in (1, 50, 10_000, 10**6):
        parts = list(block_pieces(text, limit))
        assert "".join(parts) == text and sum((p.split() for p in parts), []) == text.split()
    assert list(block_pieces("")) == []
