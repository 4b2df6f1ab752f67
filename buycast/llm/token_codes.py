"""Token ids in files of directly addressable codes: any token is read without decoding a block."""

import functools
import itertools
import operator
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from buycast.llm.common import blocks, shuffle_partitions, stored
from buycast.runtime import checkpoint_dir

#: Tokens of a file to aim at. A file holds whole documents, so a longer document makes a longer file.
FILE_TOKENS = 1 << 22
#: Bytes of texts that a task encodes at a time, about; a longer text is encoded on its own.
CHUNK_BYTES = 16 << 20

# Fixed values of the file format. All numbers are little-endian.
#   magic, version, documents, tokens, levels
#   ids of the documents (int64, 0 where null), null marks (uint8), token offsets (uint64, documents + 1)
#   per level: number of chunks (uint64), chunks (uint8),
#              and unless it is the last: continuation bits (uint8, low bit first, whole blocks), rank directory (uint64)
MAGIC, VERSION = b"DACS", 1
HEAD = "<4sIQQQ"
RANK_BYTES = 64  # continuation bits are counted in blocks of so many bytes

PACKS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _level(values):
    """Chunks of ``values``, whether each goes on, and what goes on."""
    more = values > 0xFF
    return (values & 0xFF).astype(np.uint8), more, values[more] >> 8


def pack(doc_ids, nulls, lengths, ids):
    """The bytes of a file that holds ``ids`` of documents with ``lengths`` tokens each.

    An id is cut into chunks of 8 bits, lowest first. Level k holds the k-th chunk of every id that has
    one, and a bit that tells whether the id goes on in level k + 1; its place there is the number of
    set bits before it, for which the rank directory holds the count at every block's start.
    """
    levels, values = [], ids
    while True:
        chunks, more, rest = _level(values)
        levels.append((chunks, more))
        if not len(rest):
            break
        values = rest
    out = [struct.pack(HEAD, MAGIC, VERSION, len(doc_ids), len(ids), len(levels)),
           np.asarray(doc_ids, dtype="<i8").tobytes(), np.asarray(nulls, dtype=np.uint8).tobytes(),
           np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes()]
    for k, (chunks, more) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k + 1 < len(levels):
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % RANK_BYTES, np.uint8)])
            ones = np.bitwise_count(bits).reshape(-1, RANK_BYTES).sum(axis=1, dtype=np.uint64)
            out += [bits.tobytes(), np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes()]
    return b"".join(out)


class TokenFile:
    """Reads a file from a buffer, also a memory map. Only the bytes asked for are touched."""

    def __init__(self, buffer):
        magic, version, n, self.tokens, levels = struct.unpack_from(HEAD, buffer)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        self.at, self.buffer = struct.calcsize(HEAD), buffer
        self.doc_ids, self.nulls = self._array("<i8", n), self._array(np.uint8, n)
        self.offsets = self._array("<u8", n + 1)
        self.levels = []
        for k in range(levels):
            size = int(self._array("<u8", 1)[0])
            chunks, bits, ranks = self._array(np.uint8, size), None, None
            if k + 1 < levels:
                n_blocks = -(-size // (8 * RANK_BYTES))
                bits, ranks = self._array(np.uint8, n_blocks * RANK_BYTES), self._array("<u8", n_blocks + 1)
            self.levels.append((chunks, bits, ranks))

    def _array(self, kind, n):
        out = np.frombuffer(self.buffer, dtype=kind, count=n, offset=self.at)
        self.at += out.nbytes
        return out

    @staticmethod
    def _rank(bits, ranks, i):
        """Set bits before place i."""
        block, byte = i // (8 * RANK_BYTES), i // 8
        inside = int(np.bitwise_count(bits[block * RANK_BYTES:byte]).sum())
        last = int(bits[byte]) & ((1 << (i % 8)) - 1) if i % 8 else 0
        return int(ranks[block]) + inside + last.bit_count()

    def token(self, i):
        """The id at place i: one chunk and one rank per level."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None or not bits[i // 8] >> (i % 8) & 1:
                return value
            i, shift = self._rank(bits, ranks, i), shift + 8

    def ids(self, start, end):
        """The ids at places start to end: a range stays a range on every level."""
        out = np.zeros(end - start, dtype=np.uint32)
        where, shift = np.arange(end - start), 0
        for chunks, bits, ranks in self.levels:
            if start == end:
                break
            out[where] |= chunks[start:end].astype(np.uint32) << np.uint32(shift)
            if bits is None:
                break
            low = start // 8
            more = np.unpackbits(bits[low:-(-end // 8)], bitorder="little")[start - 8 * low:end - 8 * low].astype(bool)
            where, shift = where[more], shift + 8
            start = self._rank(bits, ranks, start)
            end = start + len(where)
        return out

    def document(self, k):
        return self.ids(int(self.offsets[k]), int(self.offsets[k + 1]))


class Recent(dict):
    """What ``make`` returns for a key, remembered for ``limit`` keys at least and twice as many at most."""

    def __init__(self, limit):
        super().__init__()
        self.limit, self.old, self.make = limit, {}, None

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.hold(key, value)
        return value

    def hold(self, key, value):
        if len(self) >= self.limit and key not in self:
            self.old = dict(self)
            self.clear()
        self[key] = value


class Encoder:
    """Byte-level BPE of whole texts by the tokenizers library, remembering what it has encoded.

    White space starts a new pre-token wherever it follows something else, so a text falls into pieces
    that are encoded on their own; most pieces of a text have been met before.
    """

    def __init__(self, path, limit=200_000):
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer is not None or type(split).__name__ != "ByteLevel" or split.add_prefix_space:
            raise ValueError("only tokenizers with a plain byte-level pre-tokenizer encode piece by piece")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split, self.model, self.parts = split.pre_tokenize_str, self.tokenizer.model.tokenize, Recent(limit)
        # the sign that a byte-level vocabulary has for each byte of white space, ASCII and Latin letters
        self.signs = {}
        for code in range(0x250):
            self.signs.update(zip(chr(code).encode(), split.pre_tokenize_str(chr(code))[0][0]))
        self.space = self.signs[0x20]
        # white space of other kinds does not end a piece
        self.cut = re.compile(r"\s*\S+(?:[^\S \n\t\r]\s*\S*)*|\s+").findall
        self.spaced = Recent(limit)
        self.id_of = operator.attrgetter("id")
        self.spaced.make = self._spaced
        self.parts.make = self._part

    def _part(self, part):
        ids = list(map(self.id_of, self.model(part)))
        return PACKS[len(ids)](*ids) if len(ids) < len(PACKS) else struct.pack(f"<{len(ids)}I", *ids)

    def _spaced(self, word):
        """Codes of a piece that follows a space, or starts with a line break."""
        if not word or word[-1].isspace():
            raise KeyError(word)  # what comes next would not start a pre-token
        # Latin letters, with at most one other sign behind them, need no pattern
        if word.isascii() or max(word) < "\u0250":
            letters = word if word.isalpha() else word[:-1] if word[:-1].isalpha() and word[-1] in ".,;:!?|" else ""
            if letters is word:
                return self._part(self.space + (word if word.isascii() else word.encode().decode("latin-1").translate(self.signs)))
            if letters:
                return (self.spaced.get(letters) or self._spaced(letters)) + self.parts[word[-1]]
        return self.encoded(word if word[0] == "\n" else " " + word)

    def encoded(self, piece):
        if any(t in piece for t in self.added):
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        return b"".join([self.parts[part] for part, _ in self.split(piece)])

    def __call__(self, text):
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        words = text.replace("\n", " \n").split(" ")
        try:
            if words[0][-1:].isspace():
                raise KeyError(text)
            first = self.encoded(words[0]) if words[0] else b""
            return first + b"".join(map(self.spaced.__getitem__, words[1:]))
        except KeyError:
            return b"".join(map(self.encoded, self.cut(text)))

    def _codes(self, words, counts):
        """Codes of distinct words that follow a space or start with a line break; None where the next would not start a
        pre-token, and anything where the count is 0."""
        known, older = self.spaced.get, self.spaced.old.get
        codes = [known(word) or older(word) for word in words]
        for i, code in enumerate(codes):
            if counts[i] and (code is None or counts[i] > 1) and words[i] and not words[i][-1].isspace():
                codes[i] = code or self._spaced(words[i])
                if counts[i] > 1:  # most words that come once do not come again
                    self.spaced.hold(words[i], codes[i])
        return codes

    def all(self, texts):
        """The ids of each of an Arrow array of texts, as for one text. Each distinct word is looked up once."""
        words = pc.split_pattern(pc.replace_substring(texts.fill_null(""), pattern="\n", replacement=" \n"), pattern=" ")
        starts = words.offsets.to_numpy()
        words = words.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        starts = starts - starts[0]
        lead, places = words.take(pa.array(starts[:-1])).to_pylist(), words.indices.to_numpy()
        # a text's first word follows no space; it is encoded apart
        later = np.ones(len(places), dtype=bool)
        later[starts[:-1]] = False
        counts = np.bincount(places[later], minlength=len(words.dictionary))
        codes = self._codes(words.dictionary.to_pylist(), counts.tolist())
        odd = np.array([code is None for code in codes], dtype=bool)
        found = pa.array(codes, pa.large_binary()).take(words.indices)
        data, ends = found.buffers()[2], np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset:found.offset + len(found) + 1]
        whole = np.add.reduceat(odd[places] & later, starts[:-1]) > 0
        for i, first in enumerate(lead):
            if not first and starts[i + 1] - starts[i] == 1:
                yield b""
            elif whole[i] or first[-1:].isspace():
                yield self(texts[i].as_py())
            else:
                low, high = ends[starts[i] + 1], ends[starts[i + 1]]
                yield (self.encoded(first) if first else b"") + (data[low:high].to_pybytes() if high > low else b"")


def chunks(texts, most):
    """An Arrow array of texts in slices of about ``most`` bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


@functools.lru_cache(maxsize=1)
def encoder(path):
    """The encoder of this process: tasks that run in it one after the other share its tokenizer and what it remembers."""
    return Encoder(path)


def filesystem(uri):
    """The store a folder lies in, and the folder's path there."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), *[
    (name, pa.int64()) for name in ("n_docs", "n_tokens", "n_bytes", "crc")]])


def _writer(tokenizer, folder, end_id, file_tokens):
    def flush(store, path, held, seq):
        ids = np.frombuffer(b"".join(h[2] for h in held), dtype="<u4")
        lengths = np.array([len(h[2]) // 4 for h in held])
        data = pack([h[0] for h in held], [h[1] for h in held], lengths, ids)
        name = f"{path}/{TaskContext.get().partitionId():08d}-{seq:06d}-{uuid.uuid4().hex}.dac"
        with store.open_output_stream(name) as out:
            out.write(data)
        return (TaskContext.get().partitionId(), seq, name, len(held), len(ids), len(data), zlib.crc32(data))

    def write(batches):
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        encode, end = encoder(tokenizer), struct.pack("<I", end_id)
        held, size, seq, done = [], 0, 0, []
        for batch in batches:
            ids = batch.column("doc_id")
            nulls, ids = ids.is_null().to_pylist(), ids.cast("int64").fill_null(0).to_pylist()
            codes = itertools.chain.from_iterable(map(encode.all, chunks(batch.column("text"), CHUNK_BYTES)))
            for i, code in enumerate(codes):
                code += end
                held.append((ids[i], nulls[i], code))
                size += len(code) // 4
                if size >= file_tokens:
                    done.append(flush(store, path, held, seq))
                    held, size, seq = [], 0, seq + 1
        if held:
            done.append(flush(store, path, held, seq))
        yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST.names, row)) for row in done], MANIFEST)

    return write


def write_tokens(docs, tokenizer, folder=None, end_id=0, file_tokens=FILE_TOKENS):
    """Encode all of ``docs`` (doc_id, text) in ascending doc_id order into token files; returns their manifest:
    part, seq, path, n_docs, n_tokens, n_bytes, crc, and start (ids before the file).

    Texts, not ids, are range-sorted, so every text is encoded once. ``end_id`` closes every document.
    A null or empty text has the end alone; null doc_ids come first; rows with the same doc_id follow
    each other in the order of a hash. Columns other than doc_id and text are not read. An empty table
    has an empty manifest. Files are named by attempt: a task that ran twice leaves a file that no
    manifest names. ``folder``, by default a new one below the checkpoint folder, must be reachable by
    all executors through pyarrow.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    order = ["doc_id", "tie"]
    placed = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    )
    schema = "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long, crc long"
    manifest = stored(placed.mapInArrow(_writer(tokenizer, folder, end_id, file_tokens), schema))
    # one row per part first, then files within each part: no window sees more than that
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        manifest.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(parts, "part").withColumn("start", F.col("before") + F.col("inside")).drop("inside", "before")
    )


def read_tokens(manifest):
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document of the files."""
    def read(batches):
        for batch in batches:
            for path, start, folder, crc in zip(batch["path"], batch["start"], batch["store"], batch["crc"]):
                store, _ = filesystem(folder)
                with store.open_input_file(path) as data:
                    buffer = data.read()
                if zlib.crc32(buffer) != crc:
                    raise OSError(f"{path} is damaged")
                held = TokenFile(buffer)
                offsets = held.offsets.astype(np.int64)
                sums = [zlib.crc32(held.document(k).astype("<u4").tobytes()) for k in range(len(held.doc_ids))]
                yield pd.DataFrame({
                    "doc_id": pd.Series(held.doc_ids, dtype="Int64").mask(held.nulls.astype(bool)),
                    "start": start + offsets[:-1], "n_tokens": np.diff(offsets),
                    "ids_crc32": np.array(sums, dtype=np.int64),
                })

    spark = manifest.sparkSession
    files = manifest.select("part", "seq", "path", "start", "crc", F.lit(checkpoint_dir(spark)).alias("store"))
    # a file a task, whichever wrote it
    files = files.repartition(shuffle_partitions(spark), "part", "seq")
    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
