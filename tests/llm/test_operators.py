"""Each operator against a plain version of it, on 211 documents with odd ones among them."""

import itertools
import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from buycast.llm import (
    decontaminate, language, mixing, near_dedup, ngram_lm, outliers, quality, suffix_dedup, token_codes, token_counts,
)
from buycast.llm.common import remainder
from buycast.llm.queries import tokenizer_path


def by_id(df):
    rows = df.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [x.ids + [0] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files(docs, texts):
    manifest = token_codes.write_tokens(docs, tokenizer_path(), file_tokens=20_000)
    assert manifest.count() > 3
    got, at = by_id(token_codes.read_tokens(manifest)), 0
    for doc, ids in zip(sorted(texts), encoded([texts[d] for d in sorted(texts)])):
        want = (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == want
        at += len(ids)


def test_any_token_is_read_alone():
    rng = np.random.default_rng(0)
    lengths = np.array([0, 5, 4000, 1, 0, 700])
    ids = np.concatenate([rng.integers(0, 256, 4000), rng.integers(0, 1 << 32, 300), rng.integers(0, 70_000, 406)])
    held = token_codes.TokenFile(token_codes.pack(range(6), [0] * 6, lengths, ids.astype(np.uint32)))
    assert [held.token(i) for i in range(len(ids))] == ids.tolist()
    ends = np.cumsum(lengths)
    assert all(held.document(k).tolist() == ids[e - n:e].tolist() for k, (e, n) in enumerate(zip(ends, lengths)))
    assert all(held.ids(a, b).tolist() == ids[a:b].tolist() for a, b in ((0, 0), (3, 4), (511, 513), (1000, 4700)))
    with pytest.raises(IndexError):
        held.token(len(ids))


def test_pieces_encode_like_whole_texts():
    encode = token_codes.Encoder(tokenizer_path(), limit=8)
    odd = ["", " ", "\n", "\n\n", " a", "a ", "a  b", "a\n\nb", "x\x1cy !\x1c! .", "don't we'll  I'm\t\ttab\r\nq",
           "é,É. ß| naïve, 123,45 a1.", "\u00a0x \u00a0 y\u3000z", "<|endoftext|> a<|endoftext|>b <|endoftext|>",
           "日本語 テキスト。 x", "a\x0bb \x0c c", "hello, world! foo|bar | baz; \n x:\ny?", "٣٤ ａｂ ⅷ x²"]
    for text, ids in zip(odd, encoded(odd)):
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == ids[:-1], text


def test_longest_match(docs, texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = set(token_counts.read_vocabulary(path))
    longest, got = max(map(len, tokens)), by_id(token_counts.token_counts(docs, path))
    for doc, text in texts.items():
        own = (text or "").encode().split()
        want = (len(own), sum(brute.greedy_pieces(b" " + w, tokens, longest) for w in own))
        assert (got[doc].n_words, got[doc].n_tokens) == want


def test_longest_match_of_small_vocabularies():
    tokens = {b"a", b"b", b"ab", b"abcd", b"c", b"bc", b"d", b"bcde", b"e"}
    automaton = token_counts.LongestMatch(tokens)
    for n in range(7):
        for word in itertools.product(b"abcde", repeat=n):
            assert automaton.count(bytes(word)) == brute.greedy_pieces(bytes(word), tokens, 4)
    assert automaton.count(b"abx") == 1


def test_benchmark_windows(docs, texts, benchmark):
    items = {r.item_id: r.text for r in benchmark.collect()}
    first = items[min(items)].split()
    extra = [(2000, " ".join([*first[:10], "other", *first[11:]]) + " and more"), (2001, " ".join(first[:-1])), (2002, None)]
    more = docs.sparkSession.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    want = brute.contaminated({**texts, **dict(extra)}, items, decontaminate.words_of, threshold=0.5)
    for threshold in (0.8, 0.55):
        got = {(r.doc_id, r.item_id): r.similarity
               for r in decontaminate.contaminations(more, benchmark, threshold=threshold).collect()}
        assert got == pytest.approx({k: v for k, v in want.items() if v >= threshold})
        assert len(got) > 3
    left = {r.doc_id for r in decontaminate.decontaminated(docs, benchmark).collect()}
    assert left == set(texts) - {d for (d, _), s in want.items() if s >= 0.8}


def test_prints_within_the_radius_are_all_found():
    rng = np.random.default_rng(2)
    known = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    asked = np.concatenate([rng.integers(0, 1 << 63, 300, dtype=np.uint64), *(
        known ^ np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for _ in known], dtype=np.uint64)
        for k in (1, 12, 24, 25))])
    a, b = decontaminate.Prints(known).search(asked)
    want = np.nonzero(np.bitwise_count(asked[:, None] ^ known[None, :]) <= decontaminate.RADIUS)
    assert sorted(zip(a, b)) == sorted(zip(*want))


def test_near_duplicates(docs, texts):
    prints = {d: brute.fingerprint(t) for d, t in texts.items()}
    want, got = brute.components(prints), by_id(near_dedup.near_duplicates(docs))
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {d: r.component_id for d, r in got.items()} == want
    assert sorted(r.doc_id for r in near_dedup.deduplicated(docs).collect()) == sorted(set(want.values()))


def test_pipeline_keeps_one_of_each_component(spark, docs, texts):
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    want = brute.components({d: brute.fingerprint(t) for d, t in texts.items()})
    left = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, rows, None).collect())
    assert left == sorted(set(want.values()))


def test_vantage_shards_find_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    flip = lambda x: x ^ (np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64))
    every = np.unique(np.concatenate([base, flip(base[:900]), flip(flip(base[:900])), base[0] + np.arange(300, dtype=np.uint64)]))
    x, y = np.nonzero(np.triu(np.bitwise_count(every[:, None] ^ every[None, :]) <= 2, 1))
    want = {frozenset(p) for p in zip(every[x].view(np.int64).tolist(), every[y].view(np.int64).tolist())}
    table = spark.createDataFrame([(int(v),) for v in every.view(np.int64)], "fp long")
    found = [frozenset((r.u, r.v)) for r in near_dedup.pairs_within(table, sample=2048, shard=256).collect()]
    assert len(found) == len(want) and set(found) == want


def test_languages(docs, texts):
    got = by_id(language.identify(docs, remainder(F.col("doc_id"), 3) != 1))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [d for d in range(200) if zlib.crc32(str(d).encode()) % 3 == 1]
    assert np.mean([got[d].lang_pred == lang[d] for d in held]) > 0.97
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {1000, 1001, 1002, 1010}
    assert all(0 <= r.score <= 1 for r in got.values())


def test_trigrams_of_letters():
    keys, text, codes = language.trigram_counts(["Ab1c", None, "ab  C!", "?", "a"])
    shown = defaultdict(list)
    for t, c in zip(text, codes):
        shown[int(t)].append("".join(chr(int(keys[c]) >> s & 0x1FFFFF) for s in (42, 21, 0)))
    assert shown == {0: [" ab", "ab ", "b c", " c "], 2: [" ab", "ab ", "b c", " c "], 4: [" a "]}


def test_text_statistics_and_outliers(docs, texts, labels):
    got = by_id(outliers.judged(docs))
    assert all((r.distance is None) == r.base_failed for r in got.values())
    for d, text in texts.items():
        r, want = got[d], brute.stats(text)
        assert tuple(r[c] for c in outliers.STATS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    good = [r.doc_id for r in labels.filter("quality = 1").collect()]
    assert np.mean([got[d].kept for d in good if not got[d].base_failed]) > 0.98
    noisy = [d for d in range(200) if not got[d].base_failed and got[d].n_symbols > got[d].n_words]
    assert noisy and not any(got[d].kept for d in noisy)


def test_minimum_covariance_ignores_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(3)
    mixing_ = np.array([[1.0, 0.0], [0.8, 0.6]])
    clean, bad = rng.normal(size=(1500, 2)) @ mixing_.T + [3, -1], rng.normal(size=(350, 2)) * 0.3 + [9, 9]
    rows = [("g", x.tolist()) for x in np.concatenate([clean, bad])] + [("flat", [1.0, 2.0])] * 50
    shape = {r.group: r for r in outliers.minimum_covariance(
        spark.createDataFrame(rows, "group string, x array<double>"), 2, (0.01, 0.01)).collect()}
    assert np.allclose(shape["g"].centre, clean.mean(axis=0), atol=0.1)
    assert np.allclose(np.linalg.inv(np.reshape(shape["g"].inverse, (2, 2))), np.cov(clean.T), rtol=0.2, atol=0.1)
    assert np.allclose(shape["flat"].centre, [1, 2], atol=0.02)


def test_distances_and_verdicts_equal_brute_force(spark):
    """Groups of few rows, among them one of a single row, by plain concentration steps on lists."""
    rng = np.random.default_rng(7)
    rows = []
    for lang, source, n in (("a", "s", 60), ("a", "t", 9), ("b", "s", 25), (None, "s", 1)):
        for _ in range(n):
            words = [f"{lang}{rng.integers(0, 400)}" for _ in range(rng.integers(50, 300))] + ["#$%"] * int(rng.integers(0, 3) ** 3)
            rows.append((len(rows), " ".join(words) + "\n" * int(rng.integers(0, 2)), lang, source))
    rows.append((len(rows), "### $$$ %%% " * 30 + " ".join(f"x{i}" for i in range(90)), "a", "t"))
    got = by_id(outliers.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)))
    want = brute.judged([(d, brute.stats(t), lang, source) for d, t, lang, source in rows], outliers.FLOORS)
    limit = outliers.chi_square(len(outliers.FLOORS), 1 - 1e-6)
    assert len(want) > 80 and {d for d, r in got.items() if not r.base_failed} == set(want)
    for d, far in want.items():
        assert got[d].distance == pytest.approx(far, rel=1e-6, abs=1e-6) and got[d].kept == (far <= limit)
    assert sum(not got[d].kept for d in want) >= 1


def test_mix(docs):
    rows = mixing.mix(docs).collect()
    sizes, taken, copies = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        copies[r.doc_id] = r.copies
    want = brute.shares(sizes)
    largest = max(r["size"] for r in rows)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.copies <= 3
    assert all(abs(taken[s] - want[s]) <= largest for s in want)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in copies.items() if n}
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))


def test_targets_where_sources_reach_their_cap(spark):
    for sizes in ({"a": 10, "b": 1000, None: 5}, {"x": 0, "y": 7}, {"a": 100, "b": 1, "c": 1, "d": 900}):
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(table).collect()}
        assert got == pytest.approx(brute.shares(sizes))


def test_language_model(docs, texts):
    got = by_id(ngram_lm.score(docs, remainder(F.col("doc_id"), 7) != 2))
    for d, (held, n, known, total, base, full) in brute.language_model(texts, ngram_lm.MU, ngram_lm.GAMMA).items():
        r = got[d]
        assert (not r.train, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert abs(r.score - full) <= 0.02 * n  # 8-bit codes


def test_elias_fano():
    from buycast.llm.elias_fano import EliasFano, Level, Reader

    rng = np.random.default_rng(4)
    for bound, n in ((10, 50), (1 << 40, 500), (1, 3), (70_000, 66_000), (5, 0)):
        values = np.sort(rng.integers(0, bound, n))
        held = EliasFano(Reader(EliasFano.pack(values)))
        assert held.at(np.arange(n)).tolist() == values.tolist()
        x = np.concatenate([values, rng.integers(0, bound + 5, 100)]).astype(np.uint64)
        assert held.successor(x).tolist() == np.searchsorted(values, x).tolist()
    parents = np.sort(rng.integers(0, 40, 300))
    pairs = np.unique(np.stack([parents, rng.integers(0, 90, 300)], axis=1), axis=0)
    level = Level(Reader(Level.pack(pairs[:, 0], pairs[:, 1], 41, [])), 0)
    at = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    asked = [(p, c) for p in range(-1, 41) for c in range(95)]
    assert level.find(*np.array(asked).T).tolist() == [at.get(a, -1) for a in asked]


def test_repeats(docs, texts, monkeypatch):
    want = brute.without_repeats(texts)
    got = by_id(suffix_dedup.without_repeats(docs))
    assert {d: tuple(r)[1:] for d, r in got.items()} == want
    assert want[1009][1] >= 400 and want[1004][1] == len(texts[1004])


def test_crowded_anchors_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWDED", 3)
    line = "This very line stands in each of the documents, and nothing else does so. "
    texts = {d: "".join(f"{d}-{i}; " for i in range(5 * d)) + line + "".join(f"{i}/{d} " for i in range(20)) for d in range(12)}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(suffix_dedup.without_repeats(table))
    assert {d: tuple(r)[1:] for d, r in got.items()} == brute.without_repeats(texts)


def test_merged_transforms_share_what_sorted_suffixes_share():
    rng = np.random.default_rng(5)
    strings = list({bytes(rng.integers(97, 99, rng.integers(1, 30)).astype(np.uint8)) for _ in range(60)})
    for size in (60, 7, 1):
        parts = [suffix_dedup.Transform(strings[i:i + size]) for i in range(0, len(strings), size)]
        shard, shared = suffix_dedup.merge(parts, 40)
        at = [0] * len(parts)
        merged = []
        for s in shard:
            p = parts[s]
            merged.append(strings[s * size + p.text[at[s]]][p.place[at[s]]:])
            at[s] += 1
        assert merged == sorted(merged)
        common = [next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
                  for x, y in zip(merged, merged[1:])]
        assert shared[1:].tolist() == common


def test_importance_resampling(docs, texts, labels):
    rows = by_id(quality.importance(docs, labels))
    assert set(rows) == set(texts)
    label = {r.doc_id: r for r in labels.collect()}
    good = [d for d, r in label.items() if r.quality == 1 and r.toxic == 0]
    noisy = [d for d in texts if (texts[d] or "").count("%%%") + (texts[d] or "").count("***") > 20]
    assert np.mean([rows[d].kept for d in good]) > 0.95
    assert noisy and not any(rows[d].kept for d in noisy)
    kept = quality.resampled(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in rows.items() if r.kept}
    assert all(r.kept for r in quality.importance(docs, labels.limit(0)).collect())


def test_cut_of_largest(spark):
    values = [5, 5, 5, -7, 1 << 50, -(1 << 50), 0]
    table = spark.createDataFrame([(v,) for v in values], "key long")
    assert [quality.cut_of_largest(table, k) for k in range(1, 8)] == sorted(values, reverse=True)


def test_a_batch_of_texts_is_encoded_as_one_by_one():
    import pyarrow as pa

    encode = token_codes.Encoder(tokenizer_path(), limit=8)
    texts = ["left out", None, "", " ", "one two, two. two", "two\n\nthree  four ", "\nwas\u3000bé one", "<|endoftext|> one x<|endoftext|>", "one", "left out"]
    batch = pa.array(texts).slice(1, len(texts) - 2)
    assert list(encode.all(batch)) == [encode(text) for text in texts[1:-1]]
    parts = token_codes.chunks(batch, 20)
    assert len(parts) > 1 and [t for p in parts for t in p.to_pylist()] == texts[1:-1]
