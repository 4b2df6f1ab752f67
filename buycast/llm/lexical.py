"""Ranked lexical search: hashed max-sketches bound every document's score, the best bounds are scored exactly."""

import itertools
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from buycast.llm.common import block_pieces, blocks, stored
from buycast.runtime import top_k_per_key

# Fixed value: terms are runs of ASCII letters, digits and all characters beyond ASCII.
_OTHER = bytes(i for i in range(128) if not chr(i).isalnum())
_TERMS = bytes.maketrans(_OTHER + bytes(range(65, 91)), b" " * len(_OTHER) + bytes(range(97, 123)))

#: Coordinates of a sketch; impacts are below a million and are rounded up to one of 255 steps.
COORDINATES, STEP = 1024, 3922
#: Items that one pass over the documents answers, at most.
ITEMS = 2000
#: Documents whose bounds are computed at a time.
ROWS = 512


def terms_of(text):
    """The terms of a text as bytes, A-Z lower-cased; none for null. Long texts are cut in pieces on the way."""
    out = []
    for piece in block_pieces(text) if text else ():
        out += piece.encode("utf-8", "surrogatepass").translate(_TERMS).split()
    return out


class Terms(dict):
    """64-bit hash per term, remembered up to a number of terms."""

    def __missing__(self, term):
        if len(self) >= 150_000:
            self.clear()
        value = self[term] = xxhash.xxh64_intdigest(term, 13)
        return value

    def of(self, terms):
        return np.fromiter(map(self.__getitem__, terms), dtype=np.uint64, count=len(terms))


def statistics(docs, vocabulary):
    """(N, L, {term: df}): documents with a term, all terms, and the documents that hold each term of ``vocabulary``.

    Counted over all documents, in one pass; a task sends one row per term of the vocabulary at most.
    """
    def count(batches):
        held, n, length = {}, 0, 0
        for batch in batches:
            for part in blocks(batch["text"]):
                for text in batch["text"].iloc[part]:
                    terms = terms_of(text)
                    n += bool(terms)
                    length += len(terms)
                    for t in vocabulary.intersection(terms):
                        held[t] = held.get(t, 0) + 1
        yield pd.DataFrame([(None, n, length), *((t, c, 0) for t, c in held.items())], columns=["term", "n", "length"])

    rows = docs.select("text").mapInPandas(count, "term binary, n long, length long")
    rows = rows.groupBy("term").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).collect()
    held = {bytes(r.term): r.n for r in rows if r.term is not None}
    n, length = next(((r.n, r.length) for r in rows if r.term is None), (0, 0))
    return n, length, held


class Queries:
    """A block of items: the weights of their terms, exactly by term and folded by coordinate."""

    def __init__(self, items, n, length, held):
        self.n, self.length = n, length
        words = sorted({t for terms in items for t in terms if held.get(t)})
        hashes = Terms().of(words)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        place = {words[o]: i for i, o in enumerate(order)}
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) for t in words}
        rows, cols, values = [], [], []
        self.folded = np.zeros((COORDINATES, len(items)))
        for q, terms in enumerate(items):
            own = {}
            for t in terms:
                if t in weight:
                    own[t] = own.get(t, 0) + weight[t]
            for t, w in own.items():
                rows.append(q)
                cols.append(place[t])
                values.append(w)
                self.folded[int(self.hashes[place[t]]) % COORDINATES, q] += w
        # the terms of item q are starts[q] to starts[q + 1]
        self.term = np.array(cols, dtype=np.int64)
        self.weight = np.array(values, dtype=np.int64)
        self.starts = np.searchsorted(np.array(rows, dtype=np.int64), np.arange(len(items) + 1))

    def scores(self, q, impacts):
        """Exact scores of item ``q`` for rows of dense impacts by term."""
        own = slice(self.starts[q], self.starts[q + 1])
        return impacts[:, self.term[own]] @ self.weight[own]


def impacts(counts, m):
    """What a term that occurs ``counts`` times adds for each unit of weight, in a document of norm ``m``."""
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


def sketches(texts, queries, hashes):
    """For some texts: max-sketches (rows of ``COORDINATES`` steps) and the impacts of the block's own terms.

    Each document's impacts, of all its terms, fold into the maximum per coordinate.
    """
    sketch = np.zeros((len(texts), COORDINATES), dtype=np.uint8)
    exact = np.zeros((len(texts), len(queries.hashes)), dtype=np.int32)
    for i, text in enumerate(texts):
        terms = terms_of(text)
        if not terms:
            continue
        m = 75 + (25 * len(terms) * queries.n) // queries.length
        own, counts = np.unique(hashes.of(terms), return_counts=True)
        own_impacts = impacts(counts.astype(np.int64), m)
        np.maximum.at(sketch[i], (own % np.uint64(COORDINATES)).astype(np.int64), (-(-own_impacts // STEP)).astype(np.uint8))
        if len(queries.hashes):
            at = np.minimum(np.searchsorted(queries.hashes, own), len(queries.hashes) - 1)
            same = queries.hashes[at] == own
            exact[i, at[same]] = own_impacts[same]
    return sketch, exact


class Best:
    """The best scores seen so far of each item: the ``k`` highest, equal ones by ascending id, null ids last."""

    def __init__(self, items, k):
        self.k, self.rows = k, [[] for _ in range(items)]

    def threshold(self, q):
        """A document must reach this score to matter."""
        return self.rows[q][-1][0] if len(self.rows[q]) == self.k else 1

    def add(self, q, scores, ids):
        some = np.flatnonzero(scores >= self.threshold(q))
        if len(some):
            self.rows[q] += [(int(scores[i]), ids[i]) for i in some]
            self.rows[q].sort(key=lambda r: (-r[0], r[1] is None, r[1]))
            del self.rows[q][self.k:]


def rescored(best, bounds, ids, exact, queries, step=32):
    """Score documents by descending bound, ``step`` at a time, until no bound reaches the threshold."""
    # an item none of whose bounds reaches its threshold is done
    least = np.array([best.threshold(q) for q in range(bounds.shape[1])])
    for q in np.flatnonzero(bounds.max(axis=0) >= least):
        able = np.flatnonzero(bounds[:, q] >= least[q])
        able = able[np.argsort(-bounds[able, q], kind="stable")]
        for at in range(0, len(able), step):
            some = able[at:at + step]
            some = some[bounds[some, q] >= best.threshold(q)]
            if not len(some):
                break
            best.add(q, queries.scores(q, exact[some]), [ids[i] for i in some])


def _search(docs, items, k):
    """(place, doc_id, score) of the ``k`` best documents per item of a list of (place, terms)."""
    vocabulary = {t for _, terms in items for t in terms}
    n, length, held = statistics(docs, vocabulary)
    queries = Queries([terms for _, terms in items], n, length, held)
    places = [p for p, _ in items]

    def search(batches):
        hashes, best = Terms(), Best(len(places), k)
        for batch in batches:
            texts, ids = batch["text"].tolist(), [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            for part in blocks(texts, most=ROWS):
                sketch, exact = sketches(texts[part], queries, hashes)
                bounds = (sketch.astype(np.float64) @ queries.folded) * STEP
                rescored(best, bounds, ids[part], exact, queries)
        rows = [(places[q], doc, score) for q, own in enumerate(best.rows) for score, doc in own]
        out = pd.DataFrame(rows, columns=["place", "doc_id", "score"])
        yield out.astype({"place": "int64", "doc_id": "Int64", "score": "int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInPandas(search, "place long, doc_id long, score long")
    ranked = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return top_k_per_key(found, ["place"], ranked, k)


def ranked(docs, benchmark, k=20, items_per_pass=ITEMS):
    """item_id, rank, doc_id and score of the ``k`` documents with the highest scores above 0 for each row of ``benchmark``.

    Documents lie where they are: a task keeps the k best of each item and sends no more. Bounds come from
    max-sketches by one matrix product per block of documents; documents are scored exactly in the order of
    their bounds until the next bound is below the k-th score so far, so that the result is that of
    scoring all. A bound never lies below a score: steps are rounded up, and a coordinate shared by several
    terms counts the largest impact. The benchmark is the query set: it passes the driver in blocks of
    ``items_per_pass`` items, each block two passes over the documents, its result written before the next begins.

    Documents and items without terms (null, empty) match nothing. Each row of ``benchmark`` is an item of
    its own, also where ids repeat or are null; repeated rows of ``docs`` are documents of their own, so the
    same doc_id may rank several times. Equal scores rank by ascending doc_id, null last. Very long texts
    are cut into terms piece by piece. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    items = ((p, r.item_id, terms_of(r.text)) for p, r in enumerate(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator()))
    out = spark.createDataFrame([], "place long, item_id long, doc_id long, score long")
    while block := list(itertools.islice(items, items_per_pass)):
        found = stored(_search(docs, [(p, terms) for p, _, terms in block], k))
        named = spark.createDataFrame([(p, i) for p, i, _ in block], "place long, item_id long")
        out = out.unionByName(found.join(F.broadcast(named), "place"))  # one block of items
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score")
