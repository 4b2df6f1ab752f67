"""Words, hashes and small helpers shared by the text operators."""

import re
import uuid

import numpy as np
import xxhash
from pyspark.sql import functions as F

from buycast.runtime import checkpoint_dir

# Fixed value: a word is a run of characters other than the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

#: Python texts are handled in blocks of about this many characters, so memory does not depend on the batch.
BLOCK_CHARS = 1_500_000


def words_of(text):
    """The words of a text; none for null."""
    return WORD.findall(text) if text else []


class Hashes(dict):
    """64-bit hash per word, remembered up to ``limit`` words."""

    def __init__(self, limit=150_000, seed=0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), self.seed)
        return value

    def of(self, words):
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(x):
    """Spread the bits of an array of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def low_bytes(x, n):
    """The low ``n`` bytes of unsigned integers, packed."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).ravel()


def from_low_bytes(x, n):
    return np.pad(x.reshape(-1, n), ((0, 0), (0, 8 - n))).view("<u8").ravel()


def blocks(texts, limit=BLOCK_CHARS, most=1 << 20):
    """Slices of ``texts`` with about ``limit`` characters and at most ``most`` texts each; a longer text is a
    block of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and (size + n > limit or i - start >= most):
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


SPACE = re.compile(r"[\x20\x09-\x0D]")


def block_pieces(text, limit=BLOCK_CHARS):
    """Consecutive pieces of a text of about ``limit`` characters or more, cut before ASCII white space only."""
    start = 0
    while start < len(text):
        cut = SPACE.search(text, start + limit) if len(text) - start > limit else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def sampled(rows, column, bound):
    """All rows if there are at most ``bound``, else about that many, picked by the hash of ``column``."""
    n = rows.count()
    share = int((1 << 30) * bound / max(n, 1))
    return rows if n <= bound else rows.filter(F.pmod(F.xxhash64(column), F.lit(1 << 30)) < share)


def remainder(doc_id, divisor):
    """crc32 of the id as text, modulo ``divisor``; null ids count as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % divisor, F.lit(0))


def stored(df):
    """Write ``df`` as compact Parquet below the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/text-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
