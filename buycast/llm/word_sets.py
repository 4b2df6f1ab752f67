"""Shingle sets of many texts at once: word hashes from prefix sums over bytes, no step per word."""

import numpy as np

from buycast.llm.common import mix64

#: Bytes that are hashed at a time, about; longer texts are cut at white space.
PART = 1 << 19

_random = np.random.default_rng(20_240_229)
#: A number per byte, and the base of the polynomial over them.
BYTE = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
FACTOR = np.uint64(0xD1342543DE82EF95)


class Powers:
    """BASE ** i modulo 2 ** 64, upwards and downwards."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n):
        if len(cls.up) < n:
            n = 1 << int(n - 1).bit_length()
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            for name, base in (("up", BASE), ("down", inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))
        return cls.up, cls.down


def word_hashes(raw):
    """(hashes, places) of the words of lower-cased bytes: runs of other bytes than ASCII white space."""
    a = np.frombuffer(raw, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(SPACE[a], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = Powers.of(len(a) + 1)
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(BYTE[a] * up[:len(a)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * FACTOR), starts


def _parts(texts):
    """Lists of (text number, bytes) with about ``PART`` bytes each; pieces of a text follow each other."""
    own, size = [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
        start = 0
        while len(raw) - start > PART:
            end = start + PART
            while end < len(raw) and not SPACE[raw[end]]:
                end += 1
            own.append((i, raw[start:end]))
            yield own
            own, size, start = [], 0, end
        own.append((i, raw[start:]))
        size += len(raw) - start
        if size > PART:
            yield own
            own, size = [], 0
    if own:
        yield own


def words_of_all(texts):
    """(hashes, lengths): the hashes of all words of all texts in their order, and the number of words per text."""
    found, lengths = [np.zeros(0, dtype=np.uint64)], np.zeros(len(texts), dtype=np.int64)
    for own in _parts(texts):
        # a line feed parts the texts
        hashes, places = word_hashes(b"\n".join(raw for _, raw in own))
        ends = np.cumsum([len(raw) + 1 for _, raw in own])
        counts = np.diff(np.searchsorted(places, ends), prepend=0)
        np.add.at(lengths, [i for i, _ in own], counts)
        found.append(hashes)
    return np.concatenate(found), lengths


def sets_of(texts, width):
    """(elements, sizes): per text the ascending distinct hashes of its runs of ``width`` words, one after the other.

    With fewer words the whole sequence is the only element, without any there is none. A-Z count as a-z.
    """
    words, lengths = words_of_all(texts)
    ends = np.cumsum(lengths)
    runs = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    text = np.repeat(np.arange(len(lengths)), runs)
    first = np.cumsum(runs) - runs
    start = (ends - lengths)[text] + np.arange(len(text)) - first[text]
    out = words[start]
    for j in range(1, width):
        inside = start + j < ends[text]
        following = words[np.minimum(start + j, max(len(words) - 1, 0))]
        out = np.where(inside, out * FACTOR + following, out)
    # sequences of different lengths differ
    out = mix64(out + np.minimum(lengths, width)[text].astype(np.uint64))
    for a, b in zip(first.tolist(), (first + runs).tolist()):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[new], np.bincount(text[new], minlength=len(lengths))
