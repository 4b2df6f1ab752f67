"""Language identification with hyperdimensional profiles of letter n-grams."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from buycast.llm.common import blocks

DIMENSIONS, SEED = 1024, 5
UNKNOWN = "und"


class Hypervectors:
    """Random vectors of +1 and -1 per letter, bound to vectors per trigram.

    A trigram's vector is the product of its letters' vectors, the first turned by two places and the
    second by one, so the order of letters counts. A letter's vector follows from its code point alone.
    """

    def __init__(self, dimensions=DIMENSIONS, seed=SEED):
        self.dimensions, self.seed, self.letters = dimensions, seed, {}

    def letter(self, code):
        vector = self.letters.get(code)
        if vector is None:
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dimensions, dtype=np.int8)
            vector = self.letters[code] = bits * 2 - 1
        return vector

    def trigrams(self, keys):
        """A row per trigram key."""
        parts = np.stack([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF])
        codes, index = np.unique(parts, return_inverse=True)
        index = index.reshape(parts.shape)
        one = np.stack([self.letter(int(c)) for c in codes])
        return np.roll(one, 2, axis=1)[index[0]] * np.roll(one, 1, axis=1)[index[1]] * one[index[2]]


def trigram_counts(texts):
    """(keys, text, code): distinct trigrams of lower-cased letters, and text number and key index of each
    occurrence. Every run of anything else is one blank, also at both ends; texts without letters have none."""
    lowered = [f" {t.lower()} " if t else " " for t in texts]
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    codes, kinds = pd.factorize(chars)
    letter = np.array([chr(c).isalpha() for c in kinds.tolist()], dtype=bool)[codes]
    chars = np.where(letter, chars, 32)
    some = np.bincount(text[letter], minlength=len(texts)) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:] & (text[1:] == text[:-1]) & np.concatenate([[True], ~letter[:-2]])
    keep &= some[text]
    chars, text = chars[keep], text[keep]
    # a blank before and after a word may be two of one run: drop the second
    double = np.zeros(len(chars), dtype=bool)
    double[1:] = (chars[1:] == 32) & (chars[:-1] == 32) & (text[1:] == text[:-1])
    chars, text = chars[~double], text[~double]
    if len(chars) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = text[2:] == text[:-2]
    keys = (chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:])[inside]
    codes, kinds = pd.factorize(keys)
    return kinds, text[2:][inside], codes


def bundles(texts, vectors, rows=None, n=None):
    """Sum of the trigram vectors of each text, or of each of the ``n`` groups that ``rows`` puts them in."""
    keys, text, codes = trigram_counts(texts)
    rows = np.arange(len(texts)) if rows is None else rows
    n = len(texts) if n is None else n
    if not len(keys):
        return np.zeros((n, vectors.dimensions), dtype=np.float64)
    counts = np.bincount(rows[text] * len(keys) + codes, minlength=n * len(keys)).reshape(n, -1).astype(np.float32)
    return (counts @ vectors.trigrams(keys).astype(np.float32)).astype(np.float64)


def profiles(docs, dimensions=DIMENSIONS, seed=SEED):
    """{language: bundled vector} of all rows with a language: one vector per language comes to the driver."""
    def learn(batches):
        vectors, sums = Hypervectors(dimensions, seed), {}
        for batch in batches:
            texts, langs = batch["text"].tolist(), batch["lang"].tolist()
            for part in blocks(texts, 1_000_000, 256):
                names = sorted(set(langs[part]))
                rows = np.array([names.index(x) for x in langs[part]])
                for name, row in zip(names, bundles(texts[part], vectors, rows, len(names))):
                    sums[name] = sums.get(name, 0) + row
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": [v.astype(np.int64) for v in sums.values()]})

    parts = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInPandas(
        learn, "lang string, vector array<long>")
    rows = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("v")).collect()
    out = {}
    for r in rows:
        out.setdefault(r.lang, np.zeros(dimensions))[r.pos] = r.v
    return {lang: v for lang, v in out.items() if v.any()}


def identifier(learned, dimensions=DIMENSIONS, seed=SEED):
    """Column function: (lang_pred, score) of a text: the profile with the largest cosine, and that cosine
    (0 if negative); the first language by name of equals. ``und`` and 0 for texts without a letter, and
    where nothing was learned."""
    names = sorted(learned)
    table = np.array([learned[n] / np.linalg.norm(learned[n]) for n in names]).reshape(len(names), dimensions)

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        vectors, texts = Hypervectors(dimensions, seed), texts.tolist()
        langs, scores = [], []
        for part in blocks(texts, 1_000_000, 256):
            own = bundles(texts[part], vectors)
            size = np.linalg.norm(own, axis=1)
            if not names:
                size[:] = 0
            cosine = own @ table.T / np.maximum(size, 1e-300)[:, None] if names else np.zeros((len(own), 1))
            best = cosine.argmax(axis=1)
            langs += [names[b] if s else UNKNOWN for b, s in zip(best, size)]
            scores.append(np.where(size > 0, np.clip(cosine.max(axis=1), 0, 1), 0.0))
        return pd.DataFrame({"lang_pred": langs, "score": np.concatenate(scores) if scores else []})

    return identify


def identify(docs, learning, dimensions=DIMENSIONS, seed=SEED):
    """doc_id, lang_pred and score of every document; learns from the rows of ``docs`` where ``learning`` holds
    and lang is not null. A prediction looks at the text alone. Rows stay as they are given."""
    named = identifier(profiles(docs.filter(learning), dimensions, seed), dimensions, seed)
    return docs.select("doc_id", named("text").alias("found")).select("doc_id", "found.lang_pred", "found.score")
