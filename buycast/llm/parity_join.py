"""N-gram Jaccard join: parity sketches, their blocks as keys per size band, exact comparison, components."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from buycast.llm.common import blocks, mix64, stored
from buycast.llm.graph import components
from buycast.llm.word_sets import sets_of

WIDTH = 5
#: Least similarity, as a ratio of whole numbers.
SIMILARITY = (80, 100)
#: Counters of how often block values occur; they only order the blocks of a document.
COUNTERS = 1 << 16
#: Rounds of proposed pairs before all that are left are compared.
ROUNDS = 2
#: Rows of one key that a task compares with as many others, and rows of a task that compares, about.
CHUNK, SHARD = 1000, 20_000


class Bands:
    """Sizes of sets in bands, and the blocks that the sketches of a band have.

    A pair of sizes a <= b can be similar if b <= a / s; its sets then differ in at most
    ``(a + b) (1 - s) / (1 + s)`` elements. A pair is looked for in the band of its smaller set.
    """

    def __init__(self, similarity=SIMILARITY):
        self.part, self.whole = similarity
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2))
        self.edges = np.array(edges)

    def differ(self, a, b):
        """The most elements that similar sets of these sizes differ in."""
        return (a + b) * (self.whole - self.part) // (self.whole + self.part)

    def largest(self, size):
        """The largest set that can be similar to one of ``size``."""
        return size * self.whole // self.part

    def schemes(self, sizes):
        """For an array of sizes, steps of (which sets, band, blocks, keys): every band in which they look for others.

        Two similar sets differ in at most ``keys - 1`` blocks, so of the ``keys`` first of all blocks, in any
        order that both follow, they share one. The first step is that of each set's own band.
        """
        which = np.flatnonzero(sizes)
        size = sizes[which]
        own = band = np.searchsorted(self.edges, size, side="right") - 1
        while len(which):
            end = self.edges[band + 1] - 1
            most = self.differ(end, self.largest(end))
            yield which, band, most + 3 + (most + 1) // 8, self.differ(size, np.where(band == own, self.largest(size), end)) + 1
            some = (band > 0) & (size <= self.largest(self.edges[band] - 1))
            which, own, band, size = which[some], own[some], band[some] - 1, size[some]


def nodes_of(elements, sizes):
    """A hash of each set; 0 for empty ones."""
    ends = np.cumsum(sizes)
    return np.array([xxhash.xxh64_intdigest(elements[a:b].tobytes()) if b > a else 0 for a, b in zip((ends - sizes).tolist(), ends.tolist())],
                    dtype=np.uint64)


def _salt(band, place):
    return mix64(place.astype(np.uint64) + ((band.astype(np.uint64) + np.uint64(1)) << np.uint64(48)))


def block_keys(elements, sizes, which, band, n):
    """(set, key, number of elements, block) of every block that holds an element, for the sets ``which``, numbered from 0,
    with ``n`` blocks in ``band`` each.

    An element flips one bit of one block of its set's sketch. Blocks are so wide that no two elements share a
    bit, and are kept as the exclusive or of their set bits' names; equal blocks have equal keys.
    """
    chosen = np.full(len(sizes), -1)
    chosen[which] = np.arange(len(which))
    own = np.repeat(chosen, sizes)
    elements, own = elements[own >= 0], own[own >= 0]
    place = ((elements >> np.uint64(32)) * n.astype(np.uint64)[own]) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:] != own[:-1])]))
    values = np.bitwise_xor.reduceat(mix64(elements ^ np.uint64(0x5851F42D4C957F2D)), starts)
    key = mix64(values ^ _salt(band[own[starts]], place[starts]))
    return own[starts], key, np.diff(starts, append=len(elements)), place[starts]


def emitted(elements, sizes, bands, levels):
    """Steps of (set, key): in each of its bands, the first keys of a set's blocks by level, then the most elements, then key."""
    for which, band, n, keys in bands.schemes(sizes):
        own, key, held, place = block_keys(elements, sizes, which, band, n)
        order = np.lexsort((key, -held, levels[key >> np.uint64(48)], own))
        ordered = own[order]
        rank = np.arange(len(own)) - np.searchsorted(ordered, np.arange(len(which)))[ordered]
        chosen = order[rank < keys[ordered]]
        yield which[own[chosen]], key[chosen]
        used = np.bincount(own, minlength=len(which))
        for i in np.flatnonzero(used < keys):  # empty blocks come last
            empty = np.setdiff1d(np.arange(n[i], dtype=np.uint64), place[own == i])
            rest = np.sort(mix64(_salt(np.full(len(empty), band[i]), empty)))[:keys[i] - used[i]]
            yield np.full(len(rest), which[i]), rest


def levels_of(counts):
    """How far counters lie above what most have: 0 up to twice that, 1 up to four times, and so on."""
    usual = max(float(np.median(counts)), 1.0)
    return np.maximum(np.floor(np.log2(np.maximum(counts, 1) / usual)), 0).astype(np.int8)


def parity(own):
    """A dense sketch: bit ``hash mod width`` is flipped for each element. The distance of two never exceeds what the sets differ in."""
    width = max(64, 1 << int(2 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(sketch, width):
    """A sketch as 64-bit words, folded to ``width`` of them: that of the same set with fewer bits."""
    words = np.frombuffer(sketch, dtype="<u8")
    while len(words) > width:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def _marked(docs, bands, width):
    """doc_id, row, node and n_shingles of every document, and, once per task, counters of the block values it saw."""
    def mark(batches):
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            texts, nodes, sizes = batch["text"].tolist(), [], []
            for part in blocks(texts):
                elements, n = sets_of(texts[part], width)
                nodes.append(nodes_of(elements, n))
                sizes.append(n)
                own_band = next(bands.schemes(n), None)
                if own_band:
                    counts += np.bincount((block_keys(elements, n, *own_band[:3])[1] >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
            if len(texts):
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "row": batch["row"], "node": np.concatenate(nodes).view(np.int64),
                                    "n_shingles": np.concatenate(sizes), "counts": None})
        yield pd.DataFrame({"doc_id": pd.array([None], dtype="Int64"), "row": [0], "node": [0], "n_shingles": [-1], "counts": [counts.tobytes()]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    return stored(rows.mapInPandas(mark, "doc_id long, row long, node long, n_shingles long, counts binary"))


def _counted(marked):
    """The counters of all tasks added up; a fixed number."""
    def add(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for counts in batch["counts"]:
                total += np.frombuffer(counts, dtype=np.int64)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"place": some, "n": total[some]})

    rows = marked.filter("n_shingles < 0").select("counts").mapInPandas(add, "place int, n long")
    out = np.zeros(COUNTERS, dtype=np.int64)
    for r in rows.groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[r.place] = r.n
    return out


def _met(batches):
    """For rows sorted by key, likeness of size and node: those of keys that several nodes have, with the first node of like size."""
    held = None  # the last row so far: key, like, n, node, its pivot, whether its key has several nodes
    for batch in batches:
        key, like, n, node = (batch[c].to_numpy() for c in ("key", "like", "n", "node"))
        if held is not None:
            key, like, n, node = (np.concatenate([[h], x]) for h, x in zip(held, (key, like, n, node)))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        key, like, n, node = key[new], like[new], n[new], node[new]
        run = np.concatenate([[True], key[1:] != key[:-1]])
        first = run | np.concatenate([[True], like[1:] != like[:-1]])
        pivot = node[first][np.cumsum(first) - 1]
        places = np.cumsum(run) - 1
        several = np.bincount(places) > 1
        if held is not None:
            several[0] |= held[5]
            pivot[(places == 0) & (np.cumsum(first) == 1)] = held[4]
        out = several[places]
        if held is not None and held[5]:
            out[0] = False  # given before
        yield pd.DataFrame({"key": key[out], "node": node[out], "n": n[out], "pivot": pivot[out]})
        held = key[-1], like[-1], n[-1], node[-1], pivot[-1], several[-1]


def _shared(docs, bands, levels, width):
    """(key, node, n, pivot) of all keys that several nodes have."""
    def emit(batches):
        for batch in batches:
            texts = batch["text"].tolist()
            for part in blocks(texts):
                elements, n = sets_of(texts[part], width)
                node = nodes_of(elements, n)
                once = np.zeros(len(node), dtype=bool)  # equal sets of a block send their keys once
                once[np.unique(node, return_index=True)[1]] = True
                elements, node, n = elements[np.repeat(once, n)], node[once].view(np.int64), n[once]
                like = np.floor(np.log(np.maximum(n, 1)) / np.log(1.25)).astype(np.int8)
                for which, key in emitted(elements, n, bands, levels):
                    yield pd.DataFrame({"key": key.view(np.int64), "like": like[which], "node": node[which], "n": n[which]})

    keys = docs.select("text").mapInPandas(emit, "key long, like tinyint, node long, n int")
    return keys.repartition("key").sortWithinPartitions("key", "like", "node").mapInPandas(_met, "key long, node long, n int, pivot long")


def _sets(docs, marked, shared, width):
    """node, n, its dense sketch and its set, for the nodes of ``shared``: one text is read again for each."""
    wanted = shared.select("node").distinct().join(
        marked.filter("n_shingles > 0").groupBy("node").agg(F.min("row").alias("__row")), "node").select("node", "__row")

    @F.pandas_udf("n int, sketch binary, grams binary")
    def read(texts: pd.Series) -> pd.DataFrame:
        texts, out = texts.tolist(), []
        for part in blocks(texts):
            elements, n = sets_of(texts[part], width)
            ends = np.cumsum(n)
            for a, b in zip((ends - n).tolist(), ends.tolist()):
                out.append((b - a, parity(elements[a:b]).tobytes(), elements[a:b].astype("<u8").tobytes()))
        return pd.DataFrame(out, columns=["n", "sketch", "grams"])

    texts = docs.select(F.xxhash64("doc_id", "text").alias("__row"), "text").join(wanted, "__row").dropDuplicates(["__row"])
    return stored(texts.select("node", read("text").alias("of")).select("node", "of.*"))


def _close(pairs, sets, bands):
    """The (u, v) of ``pairs`` whose sketches are close enough."""
    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for x, y, most in zip(a, b, bands.differ(m.to_numpy(), n.to_numpy())):
            width = min(len(x), len(y)) // 8
            out.append(int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum()) <= most)
        return pd.Series(out, dtype=bool)

    of = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))
    near = F.least("u_n", "v_n") * bands.whole >= F.greatest("u_n", "v_n") * bands.part
    return pairs.join(of("u"), "u").join(of("v"), "v").filter(near).filter(close("u_sketch", "v_sketch", "u_n", "v_n")).select("u", "v")


def _similar(pairs, sets, bands):
    """The (u, v) of ``pairs`` whose sets are similar, compared element by element."""
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
            small, large = (a, b) if len(a) < len(b) else (b, a)
            both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
            out.append(bands.whole * both >= bands.part * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    of = lambda x: sets.select(F.col("node").alias(x), F.col("grams").alias(f"{x}_grams"))
    return pairs.join(of("u"), "u").join(of("v"), "v").filter(similar("u_grams", "v_grams")).select("u", "v")


def _apart(shared, labels, sets, bands, every):
    """(u, v) with a common key, different labels and close sketches that the stars did not compare.

    All such pairs if ``every``; else, of each key's nodes, pairs enough to connect what is close, at most one less
    than the key has labels. Keys with many nodes are cut in chunks that meet two by two, so no task holds all
    nodes of a key.
    """
    rows = stored(shared.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"))
    mixed = rows.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("many"), F.min("pivot").alias("p"), F.max("pivot").alias("q"))
    mixed = mixed.filter("low < high and (many > 2 or p < q)").select("key", F.ceil(F.col("many") / CHUNK).alias("chunks"))
    rows = rows.join(mixed, "key").withColumn("side", F.pmod(F.xxhash64("node"), "chunks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = stored(rows.select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "n", "pivot", "label"))
    shards = 1 + rows.count() // SHARD

    def search(rows):
        rows = rows.sort_values(["key", "low", "high", "node"])
        key, low, high, side, node, n, pivot, label = (
            rows[c].to_numpy(copy=True) for c in ("key", "low", "high", "side", "node", "n", "pivot", "label"))
        sketch, found = rows["sketch"].to_numpy(), [np.zeros((0, 2), dtype=np.int64)]
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]), [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if (label[a:b] == label[a]).all():
                continue
            width = min(map(len, sketch[a:b])) // 8
            words = np.stack([folded(x, width) for x in sketch[a:b]])
            for i in range(a, b - 1):
                j = i + 1 + np.flatnonzero(label[i + 1:b] != label[i])
                if low[a] != high[a]:
                    j = j[side[j] != side[i]]
                j = j[(pivot[j] != node[i]) & (pivot[i] != node[j])]
                j = j[np.minimum(n[j], n[i]) * bands.whole >= np.maximum(n[j], n[i]) * bands.part]
                if not len(j):
                    continue
                far = np.bitwise_count(words[j - a] ^ words[i - a]).sum(axis=1, dtype=np.int64)
                j, far = j[far <= bands.differ(n[j], n[i])], far[far <= bands.differ(n[j], n[i])]
                if len(j) and not every:  # the closest node of each label joins it
                    j = j[np.lexsort((far, label[j]))]
                    j = j[np.concatenate([[True], label[j[1:]] != label[j[:-1]]])]
                    joined = np.isin(label[a:b], label[j])
                    label[a:b][joined] = label[i]
                found.append(np.stack([np.full(len(j), node[i]), node[j]], axis=1))
        found = np.concatenate(found)
        found.sort(axis=1)
        found = np.unique(found, axis=0)
        return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    rows = rows.join(sets.select("node", "sketch"), "node").withColumn("shard", F.pmod(F.xxhash64("key", "low", "high"), F.lit(shards)))
    return rows.groupBy("shard").applyInPandas(search, "u long, v long").distinct()


def _edges(shared, sets, bands):
    """(u, v) of similar nodes that connect all that similar pairs connect.

    First every node is compared with the first of like size that shares its key. Then nodes of a key that
    are not connected yet propose pairs; proposals that hold connect them. Where all proposals hold, nothing
    close is left apart; else, after some rounds, all pairs left are compared.
    """
    stars = shared.filter("pivot <> node").select(F.least("pivot", "node").alias("u"), F.greatest("pivot", "node").alias("v")).distinct()
    edges = stored(_similar(_close(stars, sets, bands), sets, bands))
    for i in range(ROUNDS + 1):
        labels = stored(components(edges).select("node", "root"))
        proposed = stored(_apart(shared, labels, sets, bands, every=i == ROUNDS))
        held = stored(_similar(proposed, sets, bands))
        edges = edges.union(held)
        if proposed.count() == held.count():
            break
    return edges


def linked(docs, width=WIDTH, similarity=SIMILARITY):
    """doc_id, n_shingles and component_id of every document.

    A document's set are its distinct runs of ``width`` words, A-Z lower-cased; with fewer words the whole
    sequence is its only element. Documents link when the Jaccard similarity of their sets is at least
    ``similarity``, compared exactly; component_id is the least doc_id that links reach, itself included.

    Documents with equal sets fold to one node. Each node's sketch falls into blocks; per size band, similar
    sets agree in one of a known number of blocks, whichever order blocks are taken in, and are taken in the order
    of how common their values are, so that passages shared by many documents are no keys. How nodes with a
    key in common are compared: see ``_edges``.

    Null and texts without words have an empty set and link with nothing: component_id is their doc_id. Null
    doc_ids count for no minimum; a component without ids has null. Repeated rows appear as often as they are
    given. A very long text is read in pieces; its set takes 8 bytes an element. An empty table gives no
    rows; other columns are not read.
    """
    bands = Bands(similarity)
    marked = _marked(docs, bands, width)
    shared = stored(_shared(docs, bands, levels_of(_counted(marked)), width))
    sets = _sets(docs, marked, shared, width)
    found = components(_edges(shared, sets, bands))

    rows = marked.filter("n_shingles >= 0").select("doc_id", "n_shingles", "node")
    full = rows.filter("n_shingles > 0")
    ids = full.groupBy("node").agg(F.min("doc_id").alias("least")).join(found, "node", "left")
    ids = stored(ids.select("node", F.coalesce("root", "node").alias("label"), "least"))
    named = ids.join(ids.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("node", "component_id")
    return full.join(named, "node").select("doc_id", "n_shingles", "component_id").union(
        rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
