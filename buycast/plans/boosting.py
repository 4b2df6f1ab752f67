"""Gradient-boosted trees grown by Spark: binned rows, one aggregated histogram per step, second-order gains.

Rows are binned once, by exact quantiles. A step of the growth is one job: tasks route their rows down the tree so far
and add up gradients and hessians per (node, feature, bin); Spark sums what the tasks send. Those sums, whose number
depends on leaves, features and bins only, decide the splits on the driver. Gradients are whole multiples of 2^-30, so
neither the partitions nor their order change a tree.
"""

import heapq
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.operators.metrics import auc
from buycast.operators.trees import TreeModel
from buycast.runtime import dealt, running_totals, stored

UNIT = 1 << 30
#: Codes of a feature: 0 is missing, the others are value bins.
CODES = 256
#: A split must gain more than this.
LEAST_GAIN = 1e-6
#: Rounds after which the margins are written anew; until then tasks add the newest trees themselves. Best-first growth
#: takes many jobs a tree, each of which would add them again: its margins are written after every round.
BLOCK = 10
#: Rows of a block: a task passes over arrays, not over rows one by one.
BLOCK_ROWS = 32_768
STATE = "n int, y binary, margin binary, codes binary"


def cut_points(df: DataFrame, features, bins=255):
    """Per feature the ascending values that end its bins: all distinct values if they are ``bins`` or fewer, else the exact
    quantiles j / ``bins``. The largest value ends no bin; null and NaN do not count."""
    if not 2 <= bins < CODES:
        raise ValueError(f"bins must be 2 to {CODES - 1}")
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(features)])))
    per_value = long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(per_value, "value", ["n"], groups=["feature"])
    totals = ranked.groupBy("feature").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("different"), F.max("value").alias("largest"))
    reached = lambda n: F.floor(n * bins / F.col("total"))
    ends = ranked.join(totals, "feature").filter(
        (F.col("value") < F.col("largest"))
        & ((F.col("different") <= bins) | (reached(F.col("n_before") + F.col("n")) > reached(F.col("n_before")))))
    out = [[] for _ in features]
    for r in ends.select("feature", "value").collect():  # fewer than features x bins
        out[r.feature].append(r.value)
    return [np.array(sorted(values)) for values in out]


def binned(df: DataFrame, features, cuts, label="label", base=0.0):
    """(y, margin, codes): the label, the margin ``base`` and a byte per feature, dealt over tasks. Rows without a label go."""
    def code(batches):
        for batch in batches:
            x = np.stack(batch["x"].to_numpy()).astype(float) if len(batch) else np.zeros((0, len(cuts)))
            codes = np.stack([np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(c, x[:, j])) for j, c in enumerate(cuts)], axis=1)
            yield pd.DataFrame({"y": batch["y"], "margin": float(base), "codes": [r.tobytes() for r in codes.astype(np.uint8)]})

    rows = df.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("y"), F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"))
    return dealt(rows).mapInPandas(code, "y int, margin double, codes binary")


def _packed(rows, width):
    """Blocks of up to ``BLOCK_ROWS`` rows of ``binned``, written once: (n, y, margin, codes), the last three the bytes of arrays.
    Codes lie feature by feature."""
    def block(parts):
        some = pd.concat(parts)
        codes = np.frombuffer(b"".join(some["codes"]), dtype=np.uint8).reshape(len(some), width)
        return pd.DataFrame({"n": [len(some)], "y": [some["y"].to_numpy(dtype=np.int32).tobytes()],
                             "margin": [some["margin"].to_numpy(dtype=np.float64).tobytes()], "codes": [codes.T.tobytes()]})

    def pack(batches):
        parts, free = [], BLOCK_ROWS
        for batch in batches:
            while len(batch):
                parts.append(batch.iloc[:free])
                batch, free = batch.iloc[free:], free - len(parts[-1])
                if not free:
                    yield block(parts)
                    parts, free = [], BLOCK_ROWS
        if parts:
            yield block(parts)

    return _kept(rows.mapInPandas(pack, STATE))


def _kept(state):
    """``stored``, with row groups of some MB: a reader holds one at a time."""
    return stored(state, **{"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1})


def _blocks(batches, width):
    """(labels, margins, codes) of each block; the codes are a matrix with a row per feature."""
    for batch in batches:
        for n, y, margin, codes in zip(batch["n"], batch["y"], batch["margin"], batch["codes"]):
            yield np.frombuffer(y, dtype=np.int32), np.frombuffer(margin), np.frombuffer(codes, dtype=np.uint8).reshape(width, n)


class _Leaf:
    """A node that may be split: its sums, histogram and best split, what lies below it if that was looked at, and its
    children once it is split."""

    def __init__(self, sums, depth):
        self.sums, self.depth = sums, depth  # gradients, hessians, rows
        self.histogram = self.split = self.below = self.children = None


class _Arrays:
    """The nodes under a root, by their ``children`` or what is known ``below`` them, as arrays."""

    def __init__(self, root, kind):
        nodes = [root]
        rows = []
        for node in nodes:  # grows while it is read
            under = getattr(node, kind)
            if under:
                rows.append((*node.split[1:4], len(nodes), len(nodes) + 1))
                nodes += under
            else:
                rows.append((-1, 0, False, 0, 0))
        self.nodes = nodes
        self.feature, self.cut, self.missing_left, self.left, self.right = (np.array(c) for c in zip(*rows))

    def reached(self, codes, ends):
        """(node, places of its rows) for those of the nodes ``ends`` that rows of the block reach. What lies beside the way to them
        is not looked at."""
        above = np.zeros(len(self.feature), dtype=bool)
        above[ends] = True
        on_way = above.copy()
        for node in range(len(on_way) - 1, -1, -1):  # children come after their parent
            if self.feature[node] >= 0:
                on_way[node] |= on_way[self.left[node]] | on_way[self.right[node]]
        open_ = [(0, None)]  # None: all rows
        while open_:
            node, rows = open_.pop()
            if above[node]:
                yield node, np.arange(codes.shape[1]) if rows is None else rows
            feature = self.feature[node]
            if feature < 0 or not on_way[[self.left[node], self.right[node]]].any():
                continue
            value = codes[feature] if rows is None else codes[feature][rows]
            goes_left = value <= self.cut[node]
            if not self.missing_left[node]:
                goes_left &= value != 0
            for child, side in ((self.left[node], goes_left), (self.right[node], ~goes_left)):
                if on_way[child]:
                    part = np.flatnonzero(side) if rows is None else rows[side]
                    if len(part):
                        open_.append((child, part))


def _margins(margin, codes, trees):
    out = margin.copy()
    for arrays, values in trees:
        for node, rows in arrays.reached(codes, np.flatnonzero(arrays.feature < 0)):
            out[rows] += values[node]
    return out


def _histograms(state, width, trees, arrays, wanted):
    """Sums per (wanted node, feature, code): an array of shape (nodes, features, codes, 3)."""
    plain = _Plain(arrays)
    slot = {node: i for i, node in enumerate(wanted)}

    def add(batches):
        total = np.zeros((3, len(wanted), width, CODES), dtype=np.int64)
        for y, margin, codes in _blocks(batches, width):
            found = list(plain.reached(codes, wanted))
            if not found:
                continue
            rows = np.concatenate([r for _, r in found])
            first = np.repeat([slot[node] * CODES for node, _ in found], [len(r) for _, r in found])
            p = 1 / (1 + np.exp(-_margins(margin, codes, trees)[rows]))
            g = np.rint((p - y[rows]) * UNIT)
            h = np.rint(np.maximum(p * (1 - p), 1e-16) * UNIT)
            # feature by feature, so that what is added to stays in the processor's cache
            for j in range(width):
                cell = first + codes[j][rows]
                # whole numbers below 2^53, so these floats are exact
                for i, w in enumerate((g, h, None)):
                    total[i, :, j] += np.bincount(cell, w, len(wanted) * CODES).astype(np.int64).reshape(-1, CODES)
        total = total.reshape(3, -1)
        some = np.flatnonzero(total[2])
        yield pd.DataFrame({"cell": some, "g": total[0, some], "h": total[1, some], "n": total[2, some]})

    sent = state.mapInPandas(add, "cell long, g long, h long, n long")
    sums = sent.groupBy("cell").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
    out = np.zeros((len(wanted) * width * CODES, 3), dtype=np.int64)
    out[sums["cell"].to_numpy()] = np.stack([sums[c].to_numpy() for c in "ghn"], axis=1)
    return out.reshape(len(wanted), width, CODES, 3)


class _Plain(_Arrays):
    """What tasks need of a tree: its arrays without the driver's sums."""

    def __init__(self, arrays):
        self.feature, self.cut, self.missing_left, self.left, self.right = (
            arrays.feature, arrays.cut, arrays.missing_left, arrays.left, arrays.right)


class Growth:
    """How trees grow and what splits may do.

    ``max_depth`` grows level by level; ``leaves`` grows best-first, the leaf with the highest gain next, up to that
    many leaves; both may be given. ``alpha`` and ``lam`` are the L1 and L2 terms of leaf weights. A child needs
    ``min_weight`` of hessian and ``min_rows`` rows.
    """

    def __init__(self, max_depth=None, leaves=None, alpha=0.0, lam=0.0, min_weight=0.0, min_rows=1):
        if max_depth is None and leaves is None:
            raise ValueError("give max_depth, leaves or both")
        self.max_depth, self.leaves, self.alpha, self.lam = max_depth, leaves, alpha, lam
        self.min_weight, self.min_rows = min_weight, min_rows

    def _shrunk(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.alpha, 0.0)

    def strength(self, g, h):
        """What a node with these sums is worth."""
        return self._shrunk(g) ** 2 / np.maximum(h + self.lam, 1e-300)

    def weight(self, sums):
        g, h, _ = sums
        return float(-self._shrunk(g / UNIT) / max(h / UNIT + self.lam, 1e-300))

    def best_split(self, histogram, sums):
        """(gain, feature, code, missing_left, sums of the left child), the first of equals; None if no split gains."""
        cum = np.cumsum(histogram[:, 1:-1], axis=1)
        # missing values left, then right
        left = np.stack([cum + histogram[:, :1], cum], axis=2)
        right = np.array(sums) - left
        able = (np.minimum(left[..., 2], right[..., 2]) >= max(self.min_rows, 1)) & (
            np.minimum(left[..., 1], right[..., 1]) >= self.min_weight * UNIT)
        parts = self.strength(left[..., 0] / UNIT, left[..., 1] / UNIT) + self.strength(right[..., 0] / UNIT, right[..., 1] / UNIT)
        gain = np.where(able, parts - self.strength(sums[0] / UNIT, sums[1] / UNIT), -np.inf)
        feature, code, side = np.unravel_index(np.argmax(gain), gain.shape)
        if not gain[feature, code, side] > LEAST_GAIN:
            return None
        return (float(gain[feature, code, side]), int(feature), int(code) + 1, bool(side == 0),
                tuple(int(v) for v in left[feature, code, side]))

    def may_split(self, leaf):
        return self.max_depth is None or leaf.depth < self.max_depth

    def grow(self, state, width, trees):
        """The root of one tree, its children set where it is split, and the split nodes in the order of their splits."""
        root = _Leaf(None, 0)
        root.histogram = _histograms(state, width, trees, _Arrays(root, "below"), [0])[0]
        root.sums = tuple(int(v) for v in root.histogram[0].sum(axis=0))
        done, order, waiting, ahead = [], itertools.count(), [], []

        def look(leaf):
            if leaf.histogram is not None and self.may_split(leaf):
                leaf.split = self.best_split(leaf.histogram, leaf.sums)
                if leaf.split:
                    ahead.append(leaf)

        def offer(leaf):
            if leaf.split:
                heapq.heappush(waiting, (-leaf.split[0] if self.leaves else leaf.depth, next(order), leaf))

        look(root)
        offer(root)
        while waiting and (self.leaves is None or len(done) + 1 < self.leaves):
            leaf, left_over = waiting[0][2], None if self.leaves is None else self.leaves - len(done) - 1
            if leaf.below is None:
                # one job for the next leaf and all others that may follow, also below leaves not split yet
                ahead.sort(key=lambda x: (x is not leaf, -x.split[0]))
                some, ahead[:] = ahead[:left_over], [] if left_over is None else ahead[left_over:]
                self._divide(state, width, trees, root, some, last=left_over == 1)
                for node in some:
                    for child in node.below:
                        look(child)
            heapq.heappop(waiting)
            leaf.children = leaf.below
            done.append(leaf)
            for child in leaf.children:
                offer(child)
        return root, done

    def _divide(self, state, width, trees, root, some, last):
        """Set what lies below the nodes ``some``: of each pair the smaller is counted, the other is the difference."""
        counted = []
        for leaf in some:
            left = leaf.split[4]
            leaf.below = [_Leaf(left, leaf.depth + 1), _Leaf(tuple(a - b for a, b in zip(leaf.sums, left)), leaf.depth + 1)]
            if self.may_split(leaf.below[0]) and not last:
                counted.append((leaf, *sorted(leaf.below, key=lambda c: c.sums[2])))
        if counted:
            arrays = _Arrays(root, "below")
            place = {id(n): i for i, n in enumerate(arrays.nodes)}
            found = _histograms(state, width, trees, arrays, [place[id(small)] for _, small, _ in counted])
            for (leaf, small, large), histogram in zip(counted, found):
                small.histogram, large.histogram = histogram, leaf.histogram - histogram


def _rows(growth, number, root, done, features, cuts, step):
    """Node rows of a grown tree; nodes are numbered by the order of the splits."""
    nodes = [root]
    for leaf in done:
        leaf.places = len(nodes), len(nodes) + 1
        nodes += leaf.children
    out = []
    for i, node in enumerate(nodes):
        row = {"tree": number, "node": i, "feature": None, "threshold": None, "missing_left": None, "left": None, "right": None,
               "value": step * growth.weight(node.sums), "gain": None, "cover": node.sums[1] / UNIT, "n": node.sums[2]}
        if node.children:
            gain, feature, code, missing_left, _ = node.split
            # a code beyond the cuts parts the missing values from all others
            threshold = float(cuts[feature][code - 1]) if code <= len(cuts[feature]) else float("inf")
            row |= {"feature": features[feature], "threshold": threshold, "missing_left": missing_left, "left": node.places[0],
                    "right": node.places[1], "value": 0.0, "gain": gain}
        out.append(row)
    return out


def _advance(state, width, trees):
    """The state with the newest trees added to its margins, written anew."""
    def add(batches):
        for batch in batches:
            margins = [_margins(margin, codes, trees).tobytes() for _, margin, codes in _blocks([batch], width)]
            yield batch.assign(margin=margins)

    return _kept(state.mapInPandas(add, STATE))


def boost(train: DataFrame, features, rounds, step, growth: Growth, bins=255, label="label", start="half",
          evaluation: DataFrame | None = None, patience=None) -> TreeModel:
    """Boosted trees for a 0/1 label with logistic loss.

    ``start`` is "half" (margin 0) or "mean" (the log odds of the labels; 0 with one class). With
    ``evaluation`` and ``patience``, growth stops once the best AUC on that table is ``patience`` rounds old, looked at every
    ``BLOCK`` rounds, and the model keeps its best round. An empty table gives a model without trees.
    """
    features = list(features)
    cuts = cut_points(train, features, bins)
    base = 0.0
    if start == "mean":
        p = train.agg(F.avg(F.col(label).cast("double")).alias("p")).first().p
        base = float(np.log(p / (1 - p))) if p and p < 1 else 0.0
    state = _packed(binned(train, features, cuts, label, base), len(features))
    nodes, recent = [], []
    for number in range(rounds):
        root, done = growth.grow(state, len(features), recent)
        if root.sums[2] == 0:
            break
        nodes += _rows(growth, number, root, done, features, cuts, step)
        arrays = _Arrays(root, "children")
        recent.append((_Plain(arrays), np.array([0.0 if n.children else step * growth.weight(n.sums) for n in arrays.nodes])))
        last = number == rounds - 1
        if patience is not None and evaluation is not None and ((number + 1) % BLOCK == 0 or last):
            model = TreeModel(features, nodes, base)
            best = best_round(model, evaluation, label)
            if number + 1 - best >= patience or last:
                return model.first(best)
        if not last and (len(recent) == BLOCK or growth.leaves):
            state, recent = _advance(state, len(features), recent), []
    return TreeModel(features, nodes, base)


def staged_scores(model: TreeModel, df: DataFrame, label="label") -> DataFrame:
    """(iteration, label, margin) of every labelled row after each tree."""
    rows = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), model.staged().alias("margins"))
    return rows.select((F.posexplode("margins")), "label").select((F.col("pos") + 1).alias("iteration"), "label", F.col("col").alias("margin"))


def staged_auc(model: TreeModel, df: DataFrame, label="label") -> DataFrame:
    """(iteration, auc) on ``df`` after each tree, from one pass over the rows."""
    return auc(staged_scores(model, df, label), "label", "margin", groups=("iteration",))


def best_round(model: TreeModel, df: DataFrame, label="label") -> int:
    """The first round with the highest AUC."""
    curve = staged_auc(model, df, label)
    at = F.struct("auc", (-F.col("iteration")).alias("early"))
    return curve.agg(F.max_by("iteration", at).alias("n")).first().n or 0


def staged_loss(model: TreeModel, df: DataFrame, label="label") -> DataFrame:
    """(iteration, loss): mean log loss on ``df`` after each tree."""
    y, z = F.col("label").cast("double"), F.col("margin")
    loss = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    return staged_scores(model, df, label).groupBy("iteration").agg(F.avg(loss).alias("loss"))
