"""Plain versions of the operators, for small tables: {doc_id: text} in, {doc_id: result} out."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, reach=2):
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= reach:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def shingle_set(text, width=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def linked_by_jaccard(texts, least=0.8):
    """The least id that can be reached over pairs of similar texts, by id."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids, holds = sorted(sets), {}
    for d in ids:
        for s in sets[d]:
            holds.setdefault(s, []).append(d)
    for b in ids:
        for a in {a for s in sets[b] for a in holds[s] if a < b}:
            if min(len(sets[a]), len(sets[b])) >= least * max(len(sets[a]), len(sets[b])) - 1:
                both = len(sets[a] & sets[b])
                if both / (len(sets[a]) + len(sets[b]) - both) >= least:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def stats(text):
    text, w = text or "", words(text)
    often = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if often[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def without_repeats(texts, length=50):
    """Texts by ascending id: (n_bytes, n_removed, n_spans, sha256)."""
    first, out = {}, {}
    for doc, text in sorted(texts.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first.setdefault(raw[i:i + length], doc) < doc:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def language_model(texts, mu, gamma):
    """(held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    tokens = {d: words((t or "").translate(LOWER)) + ["\n"] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    n = 0
    for d, x in tokens.items():
        if not held[d]:
            y = [None, None, *x]
            n += len(x)
            one.update(y[1:])
            two.update([(None, None), *zip(y[1:], y[2:])])
            three.update(zip(y, y[1:], y[2:]))
    kinds = len(one) - (None in one)
    out = {}
    for d, x in tokens.items():
        base = full = 0.0
        u = v = None
        for w in x:
            p = (one[w] + 1) / (n + kinds + 1)
            base += math.log10(p)
            full += math.log10((gamma * three[u, v, w] + two[v, w] + mu * p) / (gamma * two[u, v] + one[v] + mu))
            u, v = v, w
        out[d] = (held[d], len(x), sum(one[w] > 0 for w in x), n, base, full)
    return out


def greedy_pieces(word, tokens, longest):
    n = i = 0
    while i < len(word):
        j = min(len(word), i + longest)
        while word[i:j] not in tokens:
            j -= 1
        n, i = n + 1, j
    return n


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets per source by resharing the excess until none is above its cap."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left, of = total - sum(most * sizes[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        out = {s: most * sizes[s] if s in capped else left * weight[s] / of for s in names}
        above = {s for s in names if s not in capped and out[s] > most * sizes[s]}
        if not above:
            return out
        capped |= above


def contaminated(texts, items, words_of, width=5, threshold=0.8):
    """{(doc, item): similarity} over all windows of an item's size."""
    def shingles(w, k):
        return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]

    out = {}
    for item, text in items.items():
        w = words_of(text)
        if not w:
            continue
        k = min(width, len(w))
        wanted = collections.Counter(shingles(w, k))
        size = sum(wanted.values())
        for doc, text_ in texts.items():
            own = shingles(words_of(text_), k)
            m = min(size, len(own))
            if not m or not set(own) & set(wanted):
                continue
            best = 0
            for i in range(len(own) - m + 1):
                both = sum((collections.Counter(own[i:i + m]) & wanted).values())
                best = max(best, both / (m + size - both))
            if best >= threshold:
                out[doc, item] = best
    return out


def parity_links(texts):
    """(n_shingles, component_id): documents without words link with nothing."""
    full = {d: t for d, t in texts.items() if words(t)}
    linked = linked_by_jaccard(full)
    return {d: (len(shingle_set(t)) if d in full else 0, linked.get(d, d)) for d, t in texts.items()}


def lloyd(vectors, k, rounds, seed=2):
    """{vec_id: (cluster, distance)} and the centroids, for lists of integers by id."""
    order = sorted(vectors, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centres = [list(vectors[i]) for i in order[:k]]

    def assign():
        far = {i: [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres] for i, v in vectors.items()}
        return {i: (f.index(min(f)), min(f)) for i, f in far.items()}

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for i, (c, _) in assign().items():
            own[c].append(vectors[i])
        for c, members in own.items():
            centres[c] = [sum(x) // len(members) for x in zip(*members)]
    return assign(), centres


def search(texts, items, k=20):
    """[(item, rank, doc_id, score)] for texts as (doc_id, text) and items as (item_id, text)."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(d, collections.Counter(term.findall((t or "").translate(LOWER)))) for d, t in texts]
    docs = [(d, c) for d, c in docs if c]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        asked = [t for t in term.findall((text or "").translate(LOWER)) if t in df]
        scored = []
        for d, c in docs:
            m = 75 + 25 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored)[:k])]
    return out


def _estimate(xs, floors, share=0.75, steps=8, cell=0.02):
    """(centre, covariance) of a list of vectors by concentration steps from medians and quartiles of binned values."""
    import numpy as np

    from buycast.llm.outliers import chi_square, chi_square_cdf

    x, p, floor2 = np.array(xs), len(floors), np.diag(np.square(floors))
    at = lambda q: np.array([(sorted(np.floor(c / cell))[math.ceil(q * len(c)) - 1] + 0.5) * cell for c in x.T])
    centre, covariance = at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + floor2
    for step in range(steps + 1):
        last = step == steps
        d = x - centre
        far = np.maximum(np.einsum("ij,jk,ik->i", d, np.linalg.inv(covariance), d), 0)
        bins = np.floor(np.log2(far + 1) * 64)
        order = sorted(set(bins))
        upto = {b: (bins <= b).sum() for b in order}
        if last:
            limit = chi_square(p, 0.975)
            b = next(b for b in order if 2 ** (b / 64) - 1 > limit or upto[b] == len(x))
        else:
            b = next(b for b in order if upto[b] >= math.ceil(share * len(x)))
        own, q = d[bins <= b], 0.975 if last else share
        mean = own.mean(axis=0)
        covariance = (own.T @ own / len(own) - np.outer(mean, mean)) / (chi_square_cdf(p + 2, chi_square(p, q)) / q) + floor2
        centre = centre + mean
    return centre, covariance


def judged(rows, floors, weight=500):
    """{doc_id: squared distance} of rows (doc_id, stats, lang, source) that pass the base rules."""
    import numpy as np

    good = {d: (s, lang, source) for d, s, lang, source in rows if s[0] >= 50 and 100 * s[4] <= 50 * s[0]}
    x = {d: [math.log(s[0]), math.log(s[1] / s[0]), *[math.log1p(100 * v / s[0]) for v in s[2:]]] for d, (s, _, _) in good.items()}
    out = {}
    for d, (_, lang, source) in good.items():
        centre = covariance = None
        for same in (lambda o: True, lambda o: o[1] == lang, lambda o: o[1:] == (lang, source)):
            members = [x[o] for o, v in good.items() if same(v)]
            c, s = _estimate(members, floors)
            share = 1.0 if centre is None else len(members) / (len(members) + weight)
            centre = c if centre is None else share * c + (1 - share) * centre
            covariance = s if covariance is None else share * s + (1 - share) * covariance
        far = np.array(x[d]) - centre
        out[d] = float(far @ np.linalg.inv(covariance) @ far)
    return out
