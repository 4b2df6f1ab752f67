"""Greedy word-piece counts by a linear longest-match automaton, without building pieces."""

import base64
from collections import deque

import numpy as np
import pandas as pd


def read_vocabulary(path):
    """The tokens of a rank file: a base64 token and a number per line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class LongestMatch:
    """A trie of the vocabulary with failure links.

    Standing at node v after reading some bytes, what cannot go on is cut into the longest tokens from
    the left: ``popped[v]`` of them, after which the unread rest stands at ``failure[v]``. Both follow
    from the parent's in breadth-first order, so a word takes one step per byte and per piece at most.
    """

    def __init__(self, tokens):
        self.next, is_token, parents = {}, [False], [(0, 0)]
        for token in tokens:
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.next:
                    self.next[key] = len(is_token)
                    is_token.append(False)
                    parents.append((node, byte))
                node = self.next[key]
            is_token[node] = node > 0
        self.failure, self.popped = [-1] * len(is_token), [0] * len(is_token)
        children = [[] for _ in is_token]
        for key, node in self.next.items():
            children[key >> 8].append(node)
        queue = deque(children[0])
        while queue:
            node = queue.popleft()
            queue.extend(children[node])
            if is_token[node]:
                self.failure[node], self.popped[node] = 0, 1
                continue
            at, byte = parents[node]
            pops, at = self.popped[at], self.failure[at]
            while at >= 0 and (at << 8 | byte) not in self.next:
                pops, at = pops + self.popped[at], self.failure[at]
            if at >= 0:
                self.failure[node], self.popped[node] = self.next[at << 8 | byte], pops

    def count(self, word):
        """Pieces of a word of bytes; one if it holds a part that no token starts with."""
        node, n, go, failure, popped = 0, 0, self.next, self.failure, self.popped
        for byte in word:
            while (node << 8 | byte) not in go:
                n += popped[node]
                node = failure[node]
                if node < 0:
                    return 1
            node = go[node << 8 | byte]
        while node > 0:
            n += popped[node]
            node = failure[node]
        return n if node == 0 else 1


class WordCounts(dict):
    """Pieces per word, remembered up to ``limit`` words."""

    def __init__(self, automaton, limit=400_000):
        super().__init__()
        self.automaton, self.limit = automaton, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        n = self[word] = self.automaton.count(b" " + word)
        return n


def token_counts(docs, vocabulary):
    """doc_id, n_words and n_tokens of every document: pieces of its words by greedy longest match.

    ``vocabulary``: path of a rank file, present on the executors. A word is a run of anything but the
    six ASCII white-space characters and is matched with a space before it, as byte-level vocabularies
    hold it. Null and empty texts have no words. Rows stay as they are given, null and repeated
    doc_ids too; other columns are not read.
    """
    def count(batches):
        pieces = WordCounts(LongestMatch(read_vocabulary(vocabulary)))
        for batch in batches:
            words, tokens = [], []
            for text in batch["text"]:
                own = text.encode("utf-8", "surrogatepass").split() if text else []
                words.append(len(own))
                tokens.append(sum(map(pieces.__getitem__, own)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_words": np.array(words, dtype=np.int64),
                                "n_tokens": np.array(tokens, dtype=np.int64)})

    return docs.select("doc_id", "text").mapInPandas(count, "doc_id long, n_words long, n_tokens long")
