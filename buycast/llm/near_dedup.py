"""SimHash near-duplicates: fingerprints, vantage-point shards of Hamming space, exact pairs, components."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from buycast.llm.common import blocks, mix64, sampled, stored
from buycast.llm.graph import components

#: Fingerprints that the top of the vantage-point tree is built from, about; its depth is bounded by them.
SAMPLE = 1 << 16
#: Fingerprints of a shard to aim at, and below which a shard is compared by brute force.
SHARD, BRUTE = 4096, 512


def _fingerprints(texts, width):
    out = np.zeros(len(texts), dtype=np.uint64)
    for part in blocks(texts):
        hashes, n = [], []
        for text in texts[part]:
            # lower() and split() of bytes touch A-Z and the six ASCII white-space characters only
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            if len(words) > width:
                own = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(width)))]
            else:
                own = [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
            hashes += own
            n.append(len(own))
        n = np.array(n)
        if not hashes:
            continue
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        some = n > 0
        ends = np.cumsum(n)
        counts = np.add.reduceat(bits, (ends - n)[some], axis=0, dtype=np.int32)
        ones = counts * 2 > n[some][:, None]
        own = np.zeros(len(n), dtype=np.uint64)
        own[some] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()
        out[part] = own
    return out


def fingerprint(width=3):
    """Column function: the SimHash of a text over its shingles of ``width`` lower-cased words, as a long."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(_fingerprints(texts.tolist(), width).view(np.int64))

    return simhash


class VantageTree:
    """The top of a vantage-point tree over 64-bit fingerprints; its leaves are the shards.

    A node holds a vantage point and a radius: fingerprints within the radius lie on its left. Two
    fingerprints within ``reach`` of each other differ by at most that in their distance to any vantage
    point, so a search crosses to the other side only that close to the radius. Node i has the children
    2i and 2i + 1; a node without a vantage point is a shard.
    """

    def __init__(self, sample, depth, reach):
        self.reach = reach
        self.point = np.zeros(1 << (depth + 1), dtype=np.uint64)
        self.radius = np.full(1 << (depth + 1), -1, dtype=np.int16)
        # values in no order, so that the first of a part is an arbitrary one
        waiting = [(1, sample[np.argsort(mix64(sample), kind="stable")])]
        while waiting:
            node, own = waiting.pop()
            if node >= 1 << depth or len(own) < 2:
                continue
            far = np.bitwise_count(own ^ own[0])
            radius = int(np.median(far))
            if (far > radius).sum() == 0:
                radius -= 1
            self.point[node], self.radius[node] = own[0], radius
            waiting += [(2 * node, own[far <= radius]), (2 * node + 1, own[far > radius])]

    def route(self, prints):
        """(index, shard, home) for all shards that a fingerprint lies in or must be compared with.

        Of a pair that a node separates, only the left one crosses, so a pair meets in one shard only.
        """
        index, node = np.arange(len(prints)), np.ones(len(prints), dtype=np.int64)
        home = np.ones(len(prints), dtype=bool)
        done = []
        while len(index):
            leaf = self.radius[node] < 0
            done.append((index[leaf], node[leaf], home[leaf]))
            index, node, home = index[~leaf], node[~leaf], home[~leaf]
            far = np.bitwise_count(prints[index] ^ self.point[node]).astype(np.int16)
            left = far <= self.radius[node]
            cross = np.where(left, far > self.radius[node] - self.reach, far - self.reach <= self.radius[node])
            cross &= left | ~home
            own, other = 2 * node + ~left, 2 * node + left
            index, node = np.concatenate([index, index[cross]]), np.concatenate([own, other[cross]])
            home = np.concatenate([home, np.zeros(cross.sum(), dtype=bool)])
        return tuple(np.concatenate(x) for x in zip(*done))


def close_pairs(home, visitors, reach):
    """All pairs within ``reach`` among ``home``, and of ``visitors`` with ``home``: a vantage-point tree
    down to small leaves, and brute force there. Arrays must hold no value twice; returns two arrays."""
    found = []
    waiting = [(home, visitors)]
    while waiting:
        home, visitors = waiting.pop()
        if len(home) == 0 or len(home) + len(visitors) < 2:
            continue
        if len(home) > BRUTE:
            far = np.bitwise_count(home ^ home[0]).astype(np.int16)
            radius = int(np.median(far))
            left = far <= radius
            if left.any() and not left.all():
                own = np.bitwise_count(visitors ^ home[0]).astype(np.int16)
                waiting.append((home[left], visitors[own - reach <= radius]))
                waiting.append((home[~left], np.concatenate([visitors[own + reach > radius],
                                                             home[left & (far + reach > radius)]])))
                continue
        step = max(1, (1 << 22) // len(home))
        for i in range(0, len(visitors), step):
            some = visitors[i:i + step]
            a, b = np.nonzero(np.bitwise_count(some[:, None] ^ home[None, :]) <= reach)
            found.append((some[a], home[b]))
        for i in range(0, len(home), step):
            some = home[i:i + step]
            a, b = np.nonzero(np.bitwise_count(some[:, None] ^ home[None, :]) <= reach)
            once = a + i < b
            found.append((some[a[once]], home[b[once]]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def pairs_within(prints, reach=2, sample=SAMPLE, shard=SHARD):
    """All pairs (u, v) of the distinct longs ``fp`` of ``prints`` that differ in at most ``reach`` bits.

    The tree's top is fitted on about ``sample`` fingerprints at most, picked by hash, on the driver; every
    fingerprint is then routed to its shard and, near the radius, to those beyond it. Shards are
    searched in tasks, by trees of their own.
    """
    n = prints.count()
    depth = max(0, min(int(np.ceil(np.log2(max(n, 1) / shard))), int(np.log2(sample / 8))))
    chosen = sorted(r.fp for r in sampled(prints, "fp", sample).select("fp").collect()) if depth else []
    tree = VantageTree(np.array(chosen, dtype=np.int64).view(np.uint64), depth, reach)

    def route(batches):
        for batch in batches:
            own = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for i in range(0, len(own), 20_000):
                some = own[i:i + 20_000]
                index, node, home = tree.route(some)
                yield pd.DataFrame({"shard": node, "fp": some[index].view(np.int64), "home": home})

    def search(rows):
        own, home = rows["fp"].to_numpy(dtype=np.int64).view(np.uint64), rows["home"].to_numpy(dtype=bool)
        u, v = close_pairs(own[home], own[~home], reach)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    routed = prints.select("fp").mapInPandas(route, "shard long, fp long, home boolean")
    return routed.groupBy("shard").applyInPandas(search, "u long, v long")


def fingerprinted(docs, width=3):
    """doc_id, row (hash of id and text) and fp of every document, written once."""
    return stored(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), fingerprint(width)("text").alias("fp")))


def _grouped(marked, reach):
    """(fp, first, label): per distinct fingerprint its first row and the label of its component."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = stored(marked.groupBy("fp").agg(first))
    linked = components(pairs_within(groups, reach))
    return groups.join(linked, groups["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("label"))


def near_duplicates(docs, width=3, reach=2):
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Documents with equal fingerprints fold to one node before any comparison, so copies cost one row.
    Nodes link at ``reach`` or fewer differing bits; component_id is the least doc_id that can be
    reached, null if no document there has an id. Null text counts as empty: fingerprint zero, linked
    like any other. Repeated rows appear as often as they are given; an empty table gives no rows;
    other columns are not read.
    """
    marked = fingerprinted(docs, width)
    groups = stored(_grouped(marked, reach))
    least = groups.groupBy("label").agg(F.min("first.doc_id").alias("component_id"))
    named = groups.join(least, "label").select(F.col("fp").alias("node"), "component_id")
    return marked.join(named, F.col("fp") == F.col("node")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _only(docs, kept):
    """The rows of ``docs`` named by ``kept``, each once."""
    out = docs.withColumn("__row", F.xxhash64("doc_id", "text")).join(
        kept, (F.col("__row") == F.col("__keep_row")) & F.col("doc_id").eqNullSafe(F.col("__keep_id")), "left_semi")
    return out.dropDuplicates(["__row", "doc_id"]).select(*docs.columns)


def deduplicated(docs, width=3, reach=2):
    """``docs`` with one row of each component: the one with the least doc_id (ids before null), of several
    texts under that id the one with the least row hash; equal rows count once. All columns stay."""
    marked = fingerprinted(docs, width)
    kept = (
        _grouped(marked, reach).groupBy("label").agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("__keep_id"), F.col("first.row").alias("__keep_row"))
    )
    return _only(docs, kept)
