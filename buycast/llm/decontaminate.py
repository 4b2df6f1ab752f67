"""Benchmark items in documents: SimHash of item-sized windows, multi-index Hamming search, exact check."""

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from buycast.llm.common import blocks, mix64

WIDTH, SIMILARITY = 5, 0.8
#: Windows that are similar enough differ in 9 of 64 bits on average; 22 was the most in simulations
#: of 3,000 draws for each of many lengths.
RADIUS, PARTS = 24, 8
#: Items that one pass over the documents searches for, at most.
ITEMS = 50_000

# Words are runs of letters, digits and other signs that are no ASCII punctuation, in lower case.
_PUNCTUATION = bytes(i for i in range(128) if not chr(i).isalnum())
_SPACED = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def words_of(text):
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split() if text else []


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= 150_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 3)
        return value


def shingles(hashes, width):
    """Hash of each run of ``width`` word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for j in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[j:j + n]
    return mix64(out)


def window_prints(own, size, starts):
    """SimHash of the windows of ``size`` shingles at ``starts`` (ascending): a bit is set where most hashes set it."""
    low, high = starts[0], starts[-1] + size
    bits = np.unpackbits(own[low:high].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(bits) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = (sums[starts - low + size] - sums[starts - low]) * 2 > size
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


class Prints:
    """Finds all of a set of fingerprints within ``radius``.

    Fingerprints are cut into ``parts`` blocks. Two that differ in at most ``radius`` bits differ in at
    most radius / parts bits of some block, so each is listed in every block under all values that near.
    """

    def __init__(self, prints, radius=RADIUS, parts=PARTS):
        self.prints, self.radius, self.width = prints, radius, 64 // parts
        near = [sum(1 << b for b in some) for k in range(radius // parts + 1)
                for some in itertools.combinations(range(self.width), k)]
        near = np.array(near, dtype=np.uint64)
        self.mask, self.tables = np.uint64((1 << self.width) - 1), []
        for part in range(parts):
            value = (prints >> np.uint64(part * self.width)) & self.mask
            value = (value[:, None] ^ near[None, :]).ravel().astype(np.int64)
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << self.width) + 1))
            self.tables.append((order // len(near), first))

    def search(self, queries):
        """(query, print) index pairs of all within the radius, each once."""
        found = []
        for part, (who, first) in enumerate(self.tables):
            value = ((queries >> np.uint64(part * self.width)) & self.mask).astype(np.int64)
            n = first[value + 1] - first[value]
            query = np.repeat(np.arange(len(queries)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[value], n)
            item = who[place]
            close = np.bitwise_count(queries[query] ^ self.prints[item]) <= self.radius
            found.append(query[close] * len(self.prints) + item[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


def similarity(a, b):
    """Weighted Jaccard similarity of two arrays of shingle hashes; a shingle weighs as often as it occurs."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both)


class Items:
    """A block of benchmark items, by shingle width and number of shingles."""

    def __init__(self, texts, width=WIDTH, threshold=SIMILARITY):
        self.threshold, self.hashes, self.groups = threshold, WordHashes(), {}
        groups = {}
        for i, text in enumerate(texts):
            words = words_of(text)
            if words:  # an item without words is found nowhere
                k = min(width, len(words))
                groups.setdefault((k, len(words) - k + 1), []).append((i, shingles(self._of(words), k)))
        self.widths = sorted({k for k, _ in groups})
        self.known = {k: np.unique(np.concatenate([s for (w, _), g in groups.items() if w == k for _, s in g]))
                      for k in self.widths}
        for (k, size), group in groups.items():
            prints = np.concatenate([window_prints(s, size, np.array([0])) for _, s in group])
            mine = np.unique(np.concatenate([s for _, s in group]))
            self.groups.setdefault(k, []).append((size, [i for i, _ in group], [s for _, s in group], mine, Prints(prints)))

    def _of(self, words):
        return np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))

    def _windows(self, own, hits, group):
        """Matches of one text with the items of one size: (item, similarity, start, windows)."""
        size, items, item_shingles, mine, prints = group
        hits = hits[np.isin(own[hits], mine)]
        size = min(size, len(own))  # a text shorter than the item is one window
        if not len(hits):
            return
        starts = np.unique((hits[:, None] - np.arange(size)[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts <= len(own) - size)]
        best = {}
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):
            if not len(part):
                continue
            window, item = prints.search(window_prints(own, size, part))
            for w, i in zip(window.tolist(), item.tolist()):
                s = similarity(own[part[w]:part[w] + size], item_shingles[i])
                if s >= self.threshold:
                    old = best.get(i, (0.0, 0, 0))
                    best[i] = (s, int(part[w]), old[2] + 1) if s > old[0] else (*old[:2], old[2] + 1)
        for i, (s, start, n) in best.items():
            yield items[i], s, start, n

    def matches(self, texts):
        """(text, item, similarity, first word, windows) for all texts and items that match.

        Windows that hold no shingle of an item have similarity 0 and get no fingerprint; all others of
        an item's size do.
        """
        for part in blocks(texts):
            words = [words_of(t) for t in texts[part]]
            n = np.array([len(w) for w in words])
            ends = np.cumsum(n)
            hashes = self._of([w for own in words for w in own])
            for k in self.widths:
                every = shingles(hashes, k)
                place = np.minimum(np.searchsorted(self.known[k], every), len(self.known[k]) - 1)
                hit = np.flatnonzero(self.known[k][place] == every)
                text = np.searchsorted(ends, hit, side="right")
                inside = hit + k <= ends[text]
                hit, text = hit[inside], text[inside]
                for t in np.unique(text):
                    first = ends[t] - n[t]
                    own = every[first:ends[t] - k + 1]
                    for group in self.groups[k]:
                        for found in self._windows(own, hit[text == t] - first, group):
                            yield (part.start + int(t), *found)


def item_blocks(benchmark, width=WIDTH, threshold=SIMILARITY, limit=ITEMS):
    """The benchmark in blocks of about ``limit`` items: (ids, Items). It is the query set and comes to the
    driver a block at a time; every block is one pass over the documents."""
    n = max(1, -(-benchmark.count() // limit))
    for b in range(n):
        rows = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).select("item_id", "text").collect()
        yield [r.item_id for r in rows], Items([r.text for r in rows], width, threshold)


def contaminations(docs, benchmark, width=WIDTH, threshold=SIMILARITY):
    """doc_id, item_id, similarity, first_word and n_windows for every document and item that match.

    A window of as many words as the item (the whole text if that is shorter) matches if the weighted
    Jaccard similarity of its and the item's shingles of ``width`` words reaches ``threshold``;
    similarity and first_word are those of the best, the first of equals. Items with fewer words than ``width``
    are one shingle. Null and empty texts and items match nothing. Repeated documents and items match
    as often as they are given; null ids are allowed. Other columns are not read. Without documents or
    items there are no rows.
    """
    def find(ids, items):
        def search(batches):
            for batch in batches:
                docs_ = batch["doc_id"].astype("Int64")
                rows = [(docs_.iloc[t], ids[i], s, start, n)
                        for t, i, s, start, n in items.matches(batch["text"].tolist())]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "similarity", "first_word", "n_windows"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        return docs.select("doc_id", "text").mapInPandas(
            search, "doc_id long, item_id long, similarity double, first_word long, n_windows long")

    out = None
    for ids, items in item_blocks(benchmark, width, threshold):
        found = find(ids, items)
        out = found if out is None else out.union(found)
    return out


def decontaminated(docs, benchmark, width=WIDTH, threshold=SIMILARITY):
    """``docs`` without the rows whose text matches an item; see ``contaminations``. All columns stay, nothing is shuffled."""
    for _, items in item_blocks(benchmark, width, threshold):
        docs = docs.filter(~_matched(items)("text"))
    return docs


def _matched(items):
    @F.pandas_udf("boolean")
    def matched(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), dtype=bool)
        for t, *_ in items.matches(texts.tolist()):
            out[t] = True
        return pd.Series(out)

    return matched
