"""A trigram language model in Elias-Fano tries, one per shard of predicted words, and its scores."""

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from buycast.llm.common import Hashes, from_low_bytes, low_bytes, mix64, shuffle_partitions, stored
from buycast.llm.elias_fano import Codes, Level, Reader, framed, quantise

#: Pseudo counts of the unigram model behind each context, and the weight of a trigram's count.
MU, GAMMA = 40.0, 4.0
#: Tokens that a map task routes at a time.
BLOCK_TOKENS = 1_000_000
#: Tokens of a trie to aim at; a shard is as many tries as that takes.
TRIE_TOKENS = 200_000
#: A token's logarithm is handed back in steps of 1 / STEPS.
STEPS = 128

# Two hashes that no word has: words hold no white space.
END, START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b"\n\n")


def tokens_of(text, hashes):
    """Hashes of the words of a text, A-Z in lower case, and the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return [*map(hashes.__getitem__, words), END]


class ByteHashes(Hashes):
    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def token_blocks(batches, most=BLOCK_TOKENS):
    """Blocks of whole texts: (batch columns, tokens, tokens per text)."""
    hashes = ByteHashes()
    for batch in batches:
        tokens, sizes, start = [], [], 0
        for i, text in enumerate(batch["text"]):
            own = tokens_of(text, hashes)
            tokens += own
            sizes.append(len(own))
            if len(tokens) >= most:
                yield batch.iloc[start:i + 1], np.array(tokens, dtype=np.uint64), np.array(sizes)
                tokens, sizes, start = [], [], i + 1
        if sizes:
            yield batch.iloc[start:], np.array(tokens, dtype=np.uint64), np.array(sizes)


def _added(words, counts):
    """Equal words folded, their counts added."""
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
    return words[first], np.add.reduceat(counts, first) if len(first) else counts


def _shard_of(words, n):
    return (mix64(words) % np.uint64(n)).astype(np.int64)


def word_counts(docs, shards):
    """(shard, words, counts): counts of all training tokens, a row per shard with its words in order."""
    def count(batches):
        held = []
        for rows, tokens, sizes in token_blocks(batches):
            words, counts = np.unique(tokens[np.repeat(rows["train"].to_numpy(dtype=bool), sizes)], return_counts=True)
            held.append((words, counts))
            if len(held) > 16:
                held = [_added(*(np.concatenate(x) for x in zip(*held)))]
        if held:
            words, counts = _added(*(np.concatenate(x) for x in zip(*held)))
            shard = _shard_of(words, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            yield pd.DataFrame({
                "shard": [s for s in range(shards) if len(own[s])],
                "words": [words[o].tobytes() for o in own if len(o)],
                "counts": [counts[o].astype("<u8").tobytes() for o in own if len(o)],
            })

    def merge(rows):
        words = np.concatenate([np.frombuffer(x, dtype="<u8") for x in rows["words"]])
        counts = np.concatenate([np.frombuffer(x, dtype="<u8") for x in rows["counts"]])
        words, counts = _added(words, counts)
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "words": [words.tobytes()], "counts": [counts.tobytes()],
                             "n_words": [len(words)], "n_tokens": [int(counts.sum())]})

    parts = docs.select("text", "train").mapInPandas(count, "shard long, words binary, counts binary")
    return stored(parts.groupBy("shard").applyInPandas(
        merge, "shard long, words binary, counts binary, n_words long, n_tokens long"))


def frequent(counts, above):
    """{word: count} of the words with more than ``above`` training tokens."""
    def pick(batches):
        for batch in batches:
            for words, n in zip(batch["words"], batch["counts"]):
                words, n = np.frombuffer(words, dtype="<u8"), np.frombuffer(n, dtype="<u8")
                many = n > above
                yield pd.DataFrame({"word": words[many].view(np.int64), "n": n[many].astype(np.int64)})

    rows = counts.select("words", "counts").mapInPandas(pick, "word long, n long").collect()
    return {int(np.int64(r.word).view(np.uint64)): r.n for r in rows}


class Slice:
    """The tokens of a block that one shard predicts, packed: words in runs by 48 bits of their hash, the word
    before by its place in a table of 48-bit hashes, the one before that by 24 bits, documents by their
    distance."""

    @staticmethod
    def pack(words, one, two, text, train):
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        table, index = np.unique(one, return_inverse=True)
        kind = np.uint16 if len(table) <= 1 << 16 else np.uint32
        index = index.astype(kind)
        step = np.diff(text, prepend=0).astype(np.int32)
        data = b"".join([
            framed(low_bytes(_near(words[first]), 6)), framed(np.diff(np.append(first, len(words))).astype(np.uint32)),
            framed(low_bytes(table, 6)),
            np.uint8(kind().itemsize).tobytes(), framed(index),
            framed(two.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.ravel()),
            framed(step), framed(np.packbits(train)),
        ])
        return zstandard.compress(data, 1)

    def __init__(self, data):
        reader = Reader(zstandard.decompress(data))
        self.runs, self.lengths = from_low_bytes(reader.array(np.uint8), 6), reader.array(np.uint32)
        self.table = from_low_bytes(reader.array(np.uint8), 6)
        kind = {2: np.uint16, 4: np.uint32}[reader.number("<B")]
        self.one = reader.array(kind)
        two = reader.array(np.uint8).reshape(3, -1).astype(np.int32)
        self.two = two[0] | two[1] << 8 | two[2] << 16
        self.step = reader.array(np.int32)
        self.train = np.unpackbits(reader.array(np.uint8), count=len(self.one)).astype(bool)


def _near(hashes):
    return hashes >> np.uint64(16)  # the upper bits, so order stays


class Head:
    """The documents of a block: ids, training marks and tokens."""

    @staticmethod
    def pack(ids, train, sizes):
        none = ids.isna().to_numpy()
        ids = ids.astype("Int64").fillna(0).to_numpy(dtype=np.int64)
        return b"".join([framed(ids), framed(none.astype(np.uint8)), framed(train.astype(np.uint8)), framed(sizes)])

    def __init__(self, data):
        reader = Reader(data)
        self.ids, self.none = reader.array("<i8"), reader.array(np.uint8).astype(bool)
        self.train, self.sizes = reader.array(np.uint8).astype(bool), reader.array("<i8")


def route(docs, shards, heavy):
    """(block, shard, head, data): the tokens of all documents, a row per block and shard.

    A word's tokens go to one shard, those of the ``heavy`` words to a shard for each word before them.
    The row with ``head`` carries the block's documents. Blocks are named by partition and place, so a
    task that runs again sends the same rows.
    """
    heavy = np.array(sorted(heavy), dtype=np.uint64)

    def send(batches):
        for seq, (rows, tokens, sizes) in enumerate(token_blocks(batches)):
            block = (TaskContext.get().partitionId() << 32) + seq
            text = np.repeat(np.arange(len(sizes)), sizes)
            start = np.cumsum(sizes) - sizes
            one = np.concatenate([[np.uint64(START)], tokens[:-1]]).astype(np.uint64)
            one[start] = START
            two = np.concatenate([[np.uint64(START)], one[:-1]]).astype(np.uint64)
            two[start] = START
            shard = _shard_of(tokens, shards)
            if len(heavy):
                many = heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens
                shard[many] = _shard_of(tokens[many] ^ mix64(one[many]), shards)
            order = np.lexsort((tokens, shard))
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            train = rows["train"].to_numpy(dtype=bool)
            near_one, near_two = _near(one), (mix64(two ^ mix64(one)) >> np.uint64(40)).astype(np.uint32)
            own = [(block % shards, True, Head.pack(rows["doc_id"], train, sizes))]
            for s in range(shards):
                o = order[cuts[s]:cuts[s + 1]]
                if len(o):
                    own.append((s, False, Slice.pack(tokens[o], near_one[o], near_two[o], text[o], train[text[o]])))
            out = pd.DataFrame(own, columns=["shard", "head", "data"])
            yield out.assign(block=block)[["block", "shard", "head", "data"]]

    return docs.select("doc_id", "text", "train").mapInPandas(send, "block long, shard long, head boolean, data binary")


class Trie:
    """One shard of the model: predicted words, under each the word before, under that the one before it.

    Of a token w after v after u, the model's probability is
    (gamma c(u v w) + c(v w) + mu p(w)) / (gamma c(u v) + c(v) + mu), with p(w) = (c(w) + 1) / (N + V + 1).
    The nodes on w's side hold the logarithm of the numerator; the denominator is that of v as a
    context after u, and lies with v. So a token's two parts are looked up where its word is, and no
    shard needs another's counts.
    """

    @staticmethod
    def pack(words, counts, names, node, one, two, mu, gamma, unigram):
        behind = mu * (counts + 1) * unigram
        key, n2 = np.unique(node * len(names) + one, return_counts=True)
        parent, name = key // max(len(names), 1), key % max(len(names), 1)
        second = np.searchsorted(key, node * len(names) + one)
        key3, n3 = np.unique(second << 24 | two, return_counts=True)
        parent3, name3 = key3 >> 24, key3 & 0xFFFFFF
        context2 = np.log10(gamma * n2 + counts[parent] + mu)
        value2 = np.log10(n2 + behind[parent])
        value3 = np.log10(gamma * n3 + n2[parent3] + behind[parent[parent3]])
        return b"".join([
            framed(words), quantise(np.log10(behind)), quantise(np.log10(counts + mu)), framed(names),
            Level.pack(parent, name, len(words), [value2, context2]), Level.pack(parent3, name3, len(key), [value3]),
        ])

    def __init__(self, buffer):
        reader = Reader(buffer)
        self.words, self.value, self.context = reader.array("<u8"), Codes(reader), Codes(reader)
        self.names = reader.array("<u8")
        self.two, self.three = Level(reader, 2), Level(reader, 1)

    @staticmethod
    def place(sorted_, wanted):
        """Places of ``wanted`` in ``sorted_``; -1 where it is not."""
        if not len(sorted_):
            return np.full(len(wanted), -1, dtype=np.int64)
        place = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
        return np.where(sorted_[place] == wanted, place, -1)

    def look_up(self, node, one, two, unknown, unknown_context):
        """Logarithms of numerator and of the denominator that the word gives the next one."""
        known = node >= 0
        value, context = np.full(len(node), unknown), np.full(len(node), unknown_context)
        value[known], context[known] = self.value.at(node[known]), self.context.at(node[known])
        second = self.two.find(node, one)
        found = np.flatnonzero(second >= 0)
        value[found], context[found] = self.two.columns[0].at(second[found]), self.two.columns[1].at(second[found])
        third = self.three.find(second, two)
        found = np.flatnonzero(third >= 0)
        value[found] = self.three.columns[0].at(third[found])
        return value, context


def _score_shard(rows, words, counts, model):
    """Build the shard's tries from its training tokens and look all its tokens up, a range of words at a time."""
    slices = [Slice(d) for d in rows["data"]]
    words, first = np.unique(np.concatenate([_near(words), _near(np.array(list(model["heavy"]), dtype=np.uint64))]),
                             return_index=True)
    counts = np.concatenate([counts, np.array(list(model["heavy"].values()), dtype=np.int64)])[first]
    tokens = sum(int(s.lengths.sum()) for s in slices)
    met = np.sort(np.concatenate([s.runs for s in slices]))
    cuts = np.unique(met[np.arange(TRIE_TOKENS, tokens, TRIE_TOKENS) * len(met) // tokens])
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), 1 << 48]):
        a, b = np.searchsorted(words, np.array([low, high], dtype=np.uint64))
        yield from _score_range(rows["block"].tolist(), slices, low, high, words[a:b], counts[a:b], model)


def _score_range(blocks, slices, low, high, words, counts, model):
    parts = []
    for block, s in zip(blocks, slices):
        a, b = np.searchsorted(s.runs, np.array([low, high], dtype=np.uint64))
        if a < b:
            ends = np.cumsum(s.lengths, dtype=np.int64)
            parts.append((block, s, slice(a, b), slice(int(ends[a] - s.lengths[a]), int(ends[b - 1]))))
    if not parts:
        return
    run = [Trie.place(words, s.runs[r]) for _, s, r, _ in parts]
    node = [np.repeat(x, s.lengths[r]) for x, (_, s, r, _) in zip(run, parts)]
    used = [np.unique(s.one[t]) for _, s, _, t in parts]
    names = np.unique(np.concatenate([s.table[u] for u, (_, s, _, _) in zip(used, parts)]))
    one, two = [], [s.two[t].astype(np.int64) for _, s, _, t in parts]
    for u, (_, s, _, t) in zip(used, parts):
        place = np.zeros(len(s.table), dtype=np.int64)
        place[u] = np.searchsorted(names, s.table[u])
        one.append(place[s.one[t]])
    train = np.concatenate([s.train[t] for _, s, _, t in parts])
    lengths = [len(x) for x in node]
    node, one, two = np.concatenate(node), np.concatenate(one), np.concatenate(two)
    trie = Trie(Trie.pack(words, counts, names, node[train], one[train], two[train],
                          model["mu"], model["gamma"], model["unigram"]))
    value, context = trie.look_up(node, one, two, np.log10(model["mu"] * model["unigram"]), np.log10(model["mu"]))
    at, end = 0, _near(np.array([END], dtype=np.uint64))[0]
    for x, n, (block, s, r, t) in zip(run, lengths, parts):
        v, c = value[at:at + n], context[at:at + n]
        at += n
        c = np.where(np.repeat(s.runs[r], s.lengths[r]) == end, 0.0, c)  # nothing follows the end
        seen = np.where(x >= 0, counts[x] if len(counts) else 0, 0)
        text = np.cumsum(s.step, dtype=np.int64)[t]
        yield block, False, zstandard.compress(b"".join([
            framed(np.diff(text, prepend=0).astype(np.int32)), framed(np.rint((v - c) * STEPS).astype(np.int16)),
            framed(s.lengths[r]), framed(seen.astype("<i8"))]), 1)


def score(docs, train, mu=MU, gamma=GAMMA):
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from the rows where the boolean column ``train`` holds. Tokens are a text's words, A-Z in
    lower case, and an end; null and empty texts have the end alone. base_score adds up
    log10((c + 1) / (N + V + 1)); score is the trigram model's log10 probability (see ``Trie``), read from
    quantised tries. Words are known by a 64-bit hash, within a shard by 48 bits of it, and the word before
    last within its node by 24 bits.

    All tokens go to the shard of their word: tries are built and read there, so the model may be as
    large as the corpus and no task holds more than a shard. Words with more tokens than an even shard
    are spread by the word before them. Their number is bounded by that of the shards; they are all
    that the driver sees. Rows stay as they are given, null and repeated doc_ids too. Without
    training rows all counts are 0. Other columns are not read.
    """
    spark = docs.sparkSession
    shards = 2 * shuffle_partitions(spark)
    docs = docs.select("doc_id", "text", train.alias("train"))
    counts = word_counts(docs, shards)
    size = counts.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    total, kinds = size[0] or 0, size[1] or 0
    heavy = frequent(counts, total / shards)
    ends = heavy.get(END) or _count_of(counts, END, shards)
    model = {"mu": mu, "gamma": gamma, "unigram": 1 / (total + kinds + 1), "heavy": heavy}
    opening = np.log10((gamma + 1) * ends + mu)

    def search(key, rows, known):
        heads, rows = rows.loc[rows["head"], ["block", "head", "data"]], rows[~rows["head"]]
        if not len(rows):
            return heads
        words = np.frombuffer(known["words"].iloc[0], dtype="<u8") if len(known) else np.zeros(0, "<u8")
        n = np.frombuffer(known["counts"].iloc[0], dtype="<u8") if len(known) else np.zeros(0, "<u8")
        found = list(_score_shard(rows, words, n.astype(np.int64), model))
        return pd.concat([heads, pd.DataFrame(found, columns=["block", "head", "data"])])

    def add(rows):
        head = Head(rows.loc[rows["head"], "data"].iloc[0])
        n = head.sizes
        score_, base, known = (np.zeros(len(n)) for _ in range(3))
        for data in rows.loc[~rows["head"], "data"]:
            reader = Reader(zstandard.decompress(data))
            text = np.cumsum(reader.array(np.int32))
            value, lengths = reader.array(np.int16) / STEPS, reader.array(np.uint32)
            seen = np.repeat(reader.array("<i8"), lengths)
            score_ += np.bincount(text, weights=value, minlength=len(n))
            base += np.bincount(text, weights=np.log10((seen + 1) * model["unigram"]), minlength=len(n))
            known += np.bincount(text, weights=seen > 0, minlength=len(n))
        return pd.DataFrame({
            "doc_id": pd.Series(head.ids, dtype="Int64").mask(head.none), "train": head.train, "n_tokens": n,
            "n_known": known.astype(np.int64), "train_tokens": total, "base_score": base, "score": score_ - opening})

    found = (
        route(docs, shards, heavy).groupBy("shard").cogroup(counts.select("shard", "words", "counts").groupBy("shard"))
        .applyInPandas(search, "block long, head boolean, data binary")
    )
    return found.groupBy("block").applyInPandas(
        add, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _count_of(counts, word, shards):
    row = counts.filter(F.col("shard") == int(_shard_of(np.array([word], dtype=np.uint64), shards)[0])).first()
    if row is None:
        return 0
    place = Trie.place(np.frombuffer(row.words, dtype="<u8"), np.array([word], dtype=np.uint64))[0]
    return int(np.frombuffer(row.counts, dtype="<u8")[place]) if place >= 0 else 0
