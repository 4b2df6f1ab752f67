"""The registered queries of the operators, and SQL where SQL can express them."""

from pyspark.sql import functions as F

from buycast.llm import (
    centroids, decontaminate, language, lexical, mixing, near_dedup, ngram_lm, outliers, parity_join, quality, suffix_dedup, token_codes,
    token_counts,
)
from buycast.llm.common import documents, remainder

QUERIES, ORACLES = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def mix_sql(table="documents"):
    return f"""
  sized AS (
    SELECT doc_id, source, CAST({WORDS_SQL} AS BIGINT) AS size,
      md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key
    FROM {table}),
  per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
  ranked AS (
    SELECT *, 3.0::DOUBLE * source_size AS cap,
      CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
    FROM per_source),
  levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM ranked
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  goals AS (
    SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target
    FROM levels),
  placed AS (
    SELECT s.*, source_size, target, floor(target / nullif(source_size, 0)) AS whole,
      sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id)
        - sum(size) OVER (PARTITION BY s.source, key, doc_id) AS earlier,
      sum(size) OVER (PARTITION BY s.source, key, doc_id) AS unit
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
  mixed AS (
    SELECT *, CAST(coalesce(whole, 0) AS BIGINT) + CASE
        WHEN earlier + unit / 2.0 < target - coalesce(whole, 0) * source_size THEN 1 ELSE 0 END AS copies
    FROM placed)"""


@query("WITH " + mix_sql().strip() + """
SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed""")
def op7_mixed_sources(spark, sf):
    mixed = mixing.mix(documents(spark, sf))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op10_importance_resampling(spark, sf):
    return quality.importance(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")).drop("row")


@query()
def op4_simhash_components(spark, sf):
    return near_dedup.near_duplicates(documents(spark, sf))


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_token_codes(spark, sf):
    return token_codes.read_tokens(token_codes.write_tokens(documents(spark, sf), tokenizer_path()))


# Weighted Jaccard similarity of every window that shares a shingle with an item, by counting shingles.
WINDOWS_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
  item_words AS (
    SELECT item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
  item_sizes AS (SELECT item_id, w, least(5, len(w)) AS k, len(w) - least(5, len(w)) + 1 AS n FROM item_words WHERE len(w) > 0),
  item_shingles AS (
    SELECT item_id, k, n, s, count(*) AS c FROM (
      SELECT item_id, k, n, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, n + 1)]) AS s
      FROM item_sizes) GROUP BY ALL),
  widths AS (SELECT DISTINCT k FROM item_sizes),
  shingles AS (
    SELECT doc_id, k, len(w) - k + 1 AS n_doc, i AS place, array_to_string(w[i + 1:i + k], ' ') AS s FROM (
      SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM words, widths WHERE len(w) >= k)),
  starts AS (
    SELECT DISTINCT doc_id, item_id, k, n, m, unnest(range(greatest(0, place - m + 1), least(place, n_doc - m) + 1)) AS start FROM (
      SELECT doc_id, item_id, d.k, n, least(n, n_doc) AS m, n_doc, place
      FROM shingles d JOIN item_shingles i ON i.k = d.k AND i.s = d.s)),
  shared AS (
    SELECT w.doc_id, w.item_id, w.start, w.n, w.m, sum(least(c, own)) AS common FROM (
      SELECT t.doc_id, t.item_id, t.start, t.n, t.m, t.k, d.s, count(*) AS own
      FROM starts t JOIN shingles d ON d.doc_id = t.doc_id AND d.k = t.k AND d.place BETWEEN t.start AND t.start + t.m - 1
      GROUP BY ALL) w JOIN item_shingles i ON i.item_id = w.item_id AND i.s = w.s
    GROUP BY ALL)
SELECT doc_id, item_id, max(similarity) AS similarity, CAST(min(start) FILTER (WHERE similarity = best) AS BIGINT) AS first_word,
  CAST(count(*) AS BIGINT) AS n_windows FROM (
    SELECT *, max(similarity) OVER (PARTITION BY doc_id, item_id) AS best FROM (
      SELECT doc_id, item_id, start, CAST(common AS DOUBLE) / CAST(n + m - common AS DOUBLE) AS similarity FROM shared))
WHERE similarity >= 0.8 GROUP BY doc_id, item_id"""


@query(WINDOWS_SQL)
def op3_benchmark_windows(spark, sf):
    return decontaminate.contaminations(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query()
def op2_longest_match_counts(spark, sf):
    import public_tokenizers

    return token_counts.token_counts(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op5_hypervector_languages(spark, sf):
    docs = documents(spark, sf)
    held_out = remainder(F.col("doc_id"), 3) == 1
    learned = language.profiles(docs.filter(~held_out))
    named = language.identifier(learned)
    return docs.select("doc_id", held_out.alias("held_out"), named("text").alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score")


@query()
def op6_robust_outliers(spark, sf):
    return outliers.judged(documents(spark, sf))


@query()
def op8_trie_scores(spark, sf):
    docs = documents(spark, sf)
    scored = ngram_lm.score(docs, remainder(F.col("doc_id"), 7) != 2)
    return scored.withColumn("held_out", ~F.col("train")).drop("train")


@query()
def op9_merged_transforms(spark, sf):
    return suffix_dedup.without_repeats(documents(spark, sf))


# Pairs by counting shared shingles; components by reachability.
LINKS_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
  sets AS (
    SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
  shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
  pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * b.n >= 80 * a.n AND 100 * a.n >= 80 * b.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON p.u = r.v)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN (
  SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) USING (doc_id)"""


@query(LINKS_SQL)
def op11_parity_join(spark, sf):
    return parity_join.linked(documents(spark, sf))


def clusters_sql(k=40, rounds=5, seed=2):
    def assigned(i):
        return f"""
  near{i} AS MATERIALIZED (
    SELECT vec_id, v, min({{'d': list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v, c)]), 'c': cluster}}) AS best
    FROM vectors, centres{i} GROUP BY vec_id, v)"""

    def centres(i):
        means = ", ".join(f"CAST((t[{d}] - ((t[{d}] % n) + n) % n) // n AS BIGINT)" for d in range(1, 65))
        sums = ", ".join(f"CAST(sum(v[{d}]) AS BIGINT)" for d in range(1, 65))
        return f"""
  centres{i} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.means, c.c) AS c FROM centres{i - 1} c LEFT JOIN (
      SELECT cluster, [{means}] AS means FROM (
        SELECT best.c AS cluster, count(*) AS n, [{sums}] AS t FROM near{i - 1} GROUP BY best.c)) m USING (cluster))"""

    steps = ",".join(assigned(i) + "," + centres(i + 1) for i in range(rounds)) + "," + assigned(rounds)
    return rf"""
WITH vectors AS MATERIALIZED (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
  centres0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, v AS c FROM (
      SELECT sha256('{seed}:' || vec_id) AS h, v FROM vectors ORDER BY h LIMIT {k})),{steps},
  summed AS (SELECT best.c AS cluster, CAST(sum(best.d) AS BIGINT) AS s FROM near{rounds} GROUP BY best.c)
SELECT vec_id, best.c AS cluster, CAST(best.d AS BIGINT) AS distance, s AS cluster_inertia,
  CAST((SELECT sum(s) FROM summed) AS BIGINT) AS inertia, sha256(array_to_string(centres{rounds}.c, ',')) AS centroid_sha256
FROM near{rounds} JOIN summed ON summed.cluster = best.c JOIN centres{rounds} ON centres{rounds}.cluster = best.c"""


@query(clusters_sql())
def op12_tabulated_centroids(spark, sf):
    return centroids.clustered(spark.read.parquet(f"{sf}/embeddings.parquet"))


# Scores of all documents that share a term with an item.
RANKS_SQL = r"""
WITH terms AS (
    SELECT doc_id, row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM (SELECT *, row_number() OVER () AS row FROM documents)),
  sized AS (SELECT doc_id, row, t, len(t) AS n FROM terms WHERE len(t) > 0),
  corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
  found AS (SELECT row, doc_id, n, t AS term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(t) AS t FROM sized) GROUP BY ALL),
  weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM found GROUP BY term), corpus),
  asked AS (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS item FROM benchmark)),
  scored AS (
    SELECT item, item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN found USING (term), corpus GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20"""


@query(RANKS_SQL)
def op13_sketched_search(spark, sf):
    return lexical.ranked(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
