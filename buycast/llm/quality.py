"""Importance resampling of documents: hashed n-gram models of target and raw text, Gumbel top-k."""

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from buycast.llm.common import Hashes, blocks, mix64, sampled, stored

# Fixed value: a token is a run of word characters or a run of other visible characters.
TOKEN = re.compile(r"\w+|[^\w\s]+")

BUCKETS = 1 << 18
CHUNK = 1 << 12


class Features:
    """Bucket numbers of the words and word pairs of texts."""

    def __init__(self, buckets):
        self.hashes, self.shift = Hashes(seed=10), np.uint64(64 - (buckets.bit_length() - 1))

    def of(self, texts):
        """Buckets of all n-grams of ``texts`` and how many each text has; null has none."""
        tokens = [TOKEN.findall(t.lower()) if t else [] for t in texts]
        n = np.array([len(x) for x in tokens], dtype=np.int64)
        one = self.hashes.of([w for x in tokens for w in x])
        owner = np.repeat(np.arange(len(n)), n)
        same = owner[1:] == owner[:-1]
        two = (one[1:] * np.uint64(3) + mix64(one[:-1]))[same]
        keys = np.concatenate([mix64(one), mix64(two)]) >> self.shift
        return keys.astype(np.int64), np.concatenate([owner, owner[1:][same]]), len(n)


def _counter(buckets):
    def count(batches):
        features, raw, target = Features(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            texts, wanted = batch["text"].tolist(), batch["target"].to_numpy(dtype=bool)
            for part in blocks(texts):
                keys, owner, _ = features.of(texts[part])
                raw += np.bincount(keys, minlength=buckets)
                target += np.bincount(keys[wanted[part][owner]], minlength=buckets)
        yield pd.DataFrame({
            "chunk": np.arange(0, buckets, CHUNK),
            "raw": [x.tobytes() for x in raw.reshape(-1, CHUNK)],
            "target": [x.tobytes() for x in target.reshape(-1, CHUNK)],
        })

    return count


def _added(group):
    total = {c: sum(np.frombuffer(x, dtype=np.int64) for x in group[c]) for c in ("raw", "target")}
    return pd.DataFrame({"chunk": group["chunk"].iloc[:1], **{c: [x.tobytes()] for c, x in total.items()}})


def _tree(parts, fanout=64):
    """Add the count vectors of all partitions, at most ``fanout`` of them in one task."""
    schema = "chunk long, raw binary, target binary"
    parts = parts.withColumn("group", F.floor(F.spark_partition_id() / fanout))
    first = parts.groupBy("chunk", "group").applyInPandas(lambda g: _added(g.drop(columns="group")), schema)
    return first.groupBy("chunk").applyInPandas(_added, schema)


class Importance:
    """Log ratio per bucket of the target's and the raw text's n-gram model.

    ``prior``: pseudo counts that pull a bucket's ratio to 1. Ratios within ``noise`` standard errors of
    1 are set to 1, else the many rare n-grams of a long text add up to a weight by chance.
    """

    def __init__(self, raw, target, prior=20.0, noise=8.0):
        expected = raw * (target.sum() / max(raw.sum(), 1))
        frequent = expected > 100
        if frequent.any():  # most n-grams are equally frequent in both; what junk takes up does not count for the rest
            expected = expected * np.median(target[frequent] / expected[frequent])
        ratio = np.log((target + prior) / (expected + prior))
        self.ratio = np.where(np.abs(target - expected) > noise * np.sqrt(expected + 1), ratio, 0.0)

    def weigh(self, scale):
        ratio = self.ratio

        @F.pandas_udf("double")
        def weight(texts: pd.Series) -> pd.Series:
            features, texts, out = Features(len(ratio)), texts.tolist(), np.zeros(len(texts))
            for part in blocks(texts):
                keys, owner, n = features.of(texts[part])
                total = np.bincount(owner, weights=ratio[keys], minlength=n)
                out[part] = scale * total / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))
            return pd.Series(out)

        return weight


def targets(labels, bound=50_000):
    """Ids of documents labelled good and not toxic, about ``bound`` at most, picked by hash: the target sample."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return sampled(good, "doc_id", bound)


def fit(docs, labels, buckets=BUCKETS, bound=50_000, prior=20.0, noise=8.0):
    """Fit both models: raw on all documents, target on those of ``targets``. Two vectors come to the driver."""
    good = targets(labels, bound).select(F.col("doc_id").alias("good_id"))
    marked = (
        docs.select("doc_id", "text").join(F.broadcast(good), F.col("doc_id") == F.col("good_id"), "left")
        .select("text", F.col("good_id").isNotNull().alias("target"))
    )
    rows = _tree(marked.mapInPandas(_counter(buckets), "chunk long, raw binary, target binary")).collect()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in rows:
        raw[r.chunk:r.chunk + CHUNK] = np.frombuffer(r.raw, dtype=np.int64)
        target[r.chunk:r.chunk + CHUNK] = np.frombuffer(r.target, dtype=np.int64)
    return Importance(raw, target, prior, noise)


def cut_of_largest(keys, k, bits=12):
    """The k-th largest value of the long column ``key``: histograms narrow it down, ``bits`` per pass."""
    low, width = -(1 << 62), 63
    while width > 0:
        step = max(0, width - bits)
        bins = (
            keys.filter((F.col("key") >= low) & (F.col("key") <= low + (1 << width) - 1))
            .groupBy(F.shiftright(F.col("key") - F.lit(low), step).alias("bin")).count()
            .orderBy(F.desc("bin")).collect()  # 2^bits rows at most
        )
        for r in bins:
            if k <= r["count"]:
                low, width = low + (r.bin << step), step
                break
            k -= r["count"]
        else:
            raise ValueError("fewer rows than k")
    return low


def importance(docs, labels, lost=0.002, scale=40.0, seed=11, **fitting):
    """doc_id, log_weight, gumbel, kept: the documents that importance resampling takes.

    A document's log weight is the sum of its n-grams' log ratios over the root of their number, times
    ``scale``. Gumbel noise, drawn from the hash of id and text, is added, and the k largest sums are
    kept: that is a sample without replacement in proportion to the weights. k is the number of
    documents whose weight is above that which all but ``lost`` of the target sample exceed.

    Null or empty text has weight 0. Without target documents all weights are 0 and every document
    stays, also where there are no labels. Sums equal to the k-th all stay. Equal rows share their noise
    and their fate. An empty table gives no rows. Other columns are not read.
    """
    weight = fit(docs, labels, **fitting).weigh(scale)
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weighed = stored(docs.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("row"), weight("text").alias("log_weight"),
        (-F.log(-F.log(uniform))).alias("gumbel"),
    ))
    keyed = weighed.withColumn("key", F.floor((F.col("log_weight") + F.col("gumbel")) * 1e9).cast("long"))
    good = targets(labels, fitting.get("bound", 50_000)).select(F.col("doc_id").alias("good_id"))
    own = weighed.join(F.broadcast(good), F.col("doc_id") == F.col("good_id")).select(
        F.floor(F.col("log_weight") * 1e9).cast("long").alias("key"))
    n = own.count()
    if n == 0:
        return keyed.withColumn("kept", F.lit(True)).drop("key")
    floor_ = cut_of_largest(own, n - int(lost * n))
    k = weighed.filter(F.floor(F.col("log_weight") * 1e9).cast("long") >= floor_).count()
    return keyed.withColumn("kept", F.col("key") >= cut_of_largest(keyed, k)).drop("key")


def resampled(docs, labels, **options):
    """The rows of ``docs`` that ``importance`` keeps, with all their columns."""
    kept = (
        importance(docs, labels, **options).filter("kept")
        .select(F.col("doc_id").alias("__keep_id"), F.col("row").alias("__keep_row")).distinct()
    )
    return docs.join(
        kept, F.xxhash64("doc_id", "text").eqNullSafe(F.col("__keep_row"))
        & F.col("doc_id").eqNullSafe(F.col("__keep_id")), "left_semi")
