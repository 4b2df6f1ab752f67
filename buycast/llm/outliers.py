"""Quality rules: text statistics, and robust multivariate outliers per language and source."""

import itertools
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from buycast.llm.common import WORD, blocks, stored

# The signs counted as symbols, and the six ASCII white-space characters.
SYMBOLS, WHITE = "#*$%&|<>", " \t\n\v\f\r"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Spread that each measure has at least: most texts have no symbols or repeated lines at all, and a
#: group where the covariance is singular would reject every text that has one.
FLOORS = (0.5, 0.08, 0.5, 0.5, 0.6)


def measures():
    """The statistics compared: logarithms, shares per hundred words as log(1 + x)."""
    per_hundred = [F.log1p(100 * F.col(c) / F.col("n_words")) for c in STATS[2:]]
    return [F.log(F.col("n_words").cast("double")), F.log(F.col("word_chars") / F.col("n_words")), *per_hundred]


def _repeated(words):
    """Per text, how many of its words lie in three-word windows that occur twice or more in it."""
    n = np.array([len(w) for w in words], dtype=np.int64)
    text = np.repeat(np.arange(len(n)), n)
    out = np.zeros(len(n), dtype=np.int64)
    if len(text) < 3:
        return out
    one, kinds = pd.factorize(np.array([w for own in words for w in own], dtype=object))
    two, pairs = pd.factorize(one[:-1] * len(kinds) + one[1:])
    inside = text[2:] == text[:-2]
    # numbers of pairs, then of triples, then of triples within a text: no product passes 2^63
    three, triples = pd.factorize((two[:-1] * len(kinds) + one[2:])[inside])
    own, windows = pd.factorize(text[2:][inside] * max(len(triples), 1) + three)
    often = np.bincount(own, minlength=len(windows))[own] > 1
    start = np.flatnonzero(inside)[often]
    covered = np.zeros(len(text), dtype=bool)
    for k in range(3):
        covered[start + k] = True
    return np.bincount(text[covered], minlength=len(n))


def _stats(texts):
    rows = []
    for part in blocks(texts):
        own = [t or "" for t in texts[part]]
        words = [WORD.findall(t) for t in own]
        repeated = _repeated(words)
        for text, w, r in zip(own, words, repeated.tolist()):
            lines = [x for x in text.split("\n") if x.strip(WHITE)]
            rows.append((len(w), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
                         len(lines) - len(set(lines)), r))
    return pd.DataFrame(rows, columns=list(STATS), dtype="int64")


def text_stats():
    """Column function: words, code points in words, symbols, repeated lines, words in repeated three-word windows."""

    @F.pandas_udf(", ".join(f"{c} long" for c in STATS))
    def stats(texts: pd.Series) -> pd.DataFrame:
        return _stats(texts.tolist())

    return stats


def chi_square(p, q):
    """Quantile q of the chi-square distribution with p degrees of freedom (Wilson and Hilferty)."""
    c = 2 / (9 * p)
    return p * (1 - c + NormalDist().inv_cdf(q) * c ** 0.5) ** 3


def chi_square_cdf(p, x):
    c = 2 / (9 * p)
    return NormalDist().cdf(((x / p) ** (1 / 3) - 1 + c) / c ** 0.5)


def levels(rows):
    """``rows`` with ``groups``, the names of their language and source, of their language, and of all. Null is a value like any other."""
    def name(*columns):
        return F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in columns]))

    return rows.withColumn("groups", F.array(name("lang", "source"), name("lang"), F.lit("[]")))


def _quartiles(rows, p, step=0.02):
    """Per group: centre (median) and spread (from the quartiles) of each measure, from counts in steps of ``step``."""
    cells = rows.select("group", F.posexplode("x").alias("k", "v")).select(
        "group", "k", F.floor(F.col("v") / step).alias("bin"))
    counts = cells.groupBy("group", "k", "bin").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy("group", "k").orderBy("bin")
    whole = Window.partitionBy("group", "k")
    counts = counts.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(whole))
    at = {q: F.min(F.when(F.col("upto") >= q * F.col("all"), (F.col("bin") + 0.5) * step)) for q in (0.25, 0.5, 0.75)}
    found = counts.groupBy("group", "k").agg(at[0.25].alias("a"), at[0.5].alias("m"), at[0.75].alias("b"))
    return found.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("k", "m", "a", "b"))).alias("q")).select(
        "group", F.transform("q", lambda s: s["m"]).alias("centre"),
        F.transform("q", lambda s: (s["b"] - s["a"]) / 1.349).alias("spread"))


def _inverse(covariance, floors):
    return np.linalg.inv(covariance + np.diag(np.square(floors))).ravel()


def _distance(p):
    """Squared Mahalanobis distance of ``x`` from ``centre`` by the inverse covariance ``inverse``."""
    d = [F.col("x")[i] - F.col("centre")[i] for i in range(p)]
    return sum(F.col("inverse")[i * p + j] * d[i] * d[j] for i in range(p) for j in range(p))


def _step(rows, shape, p, floors, inside, share):
    """One concentration step: mean and covariance per group of the rows that lie nearest by ``shape``.

    Rows fall into classes by distance, about 1 % wide; per group and class there is one row of sums, and
    running sums over the classes give the moments of all rows up to any distance. ``inside`` picks the
    last class that counts, from columns upto, all and near; ``share`` is what a normal sample has there.
    """
    pairs = list(itertools.combinations_with_replacement(range(p), 2))
    near = rows.join(shape, "group").withColumn("far", F.greatest(_distance(p), F.lit(0.0)))
    near = near.withColumn("bin", F.floor(F.log2(F.col("far") + 1) * 64))
    d = [F.col("x")[i] - F.col("centre")[i] for i in range(p)]
    sums = {f"s{i}": d[i] for i in range(p)} | {f"s{i}_{j}": d[i] * d[j] for i, j in pairs}
    classes = near.groupBy("group", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("centre").alias("centre"), *[F.sum(c).alias(k) for k, c in sums.items()])
    up, whole = Window.partitionBy("group").orderBy("bin"), Window.partitionBy("group")
    classes = classes.select(
        "group", "centre", F.col("bin"), F.sum("n").over(up).alias("upto"), F.sum("n").over(whole).alias("all"),
        *[F.sum(k).over(up).alias(k) for k in sums])
    classes = classes.withColumn("near", F.pow(F.lit(2.0), F.col("bin") / 64) - 1)
    chosen = classes.filter(inside).withColumn("rank", F.row_number().over(
        Window.partitionBy("group").orderBy("bin"))).filter("rank = 1")

    # the nearest share of a normal sample has a smaller covariance than the whole by this factor
    shrunk = chi_square_cdf(p + 2, chi_square(p, share)) / share

    def shapes(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                n = r["upto"]
                mean = np.array([r[f"s{i}"] for i in range(p)]) / n
                second = np.zeros((p, p))
                for i, j in pairs:
                    second[i, j] = second[j, i] = r[f"s{i}_{j}"] / n
                covariance = (second - np.outer(mean, mean)) / shrunk
                out.append((r["group"], np.asarray(r["centre"]) + mean, _inverse(covariance, floors)))
            yield pd.DataFrame({"group": [o[0] for o in out], "centre": [o[1].tolist() for o in out],
                                "inverse": [o[2].tolist() for o in out]})

    return chosen.mapInPandas(shapes, "group string, centre array<double>, inverse array<double>")


def minimum_covariance(rows, p, floors, share=0.75, steps=8):
    """(group, centre, inverse): minimum-covariance-determinant estimate per group of (group, x array).

    Starts from medians and quartiles and repeats concentration steps on the nearest ``share`` of all
    rows, none left out; a step never raises the determinant. A last step takes all rows within the
    97.5 % distance. Every step is one aggregation whose result has a row per group and distance class.
    """
    def start(batches):
        for batch in batches:
            yield pd.DataFrame({"group": batch["group"], "centre": [list(c) for c in batch["centre"]],
                                "inverse": [_inverse(np.diag(np.square(s)), floors).tolist() for s in batch["spread"]]})

    schema = "group string, centre array<double>, inverse array<double>"
    shape = stored(_quartiles(rows, p).mapInPandas(start, schema))
    for _ in range(steps):
        shape = stored(_step(rows, shape, p, floors, F.col("upto") >= F.ceil(share * F.col("all")), share))
    limit = chi_square(p, 0.975)
    inside = (F.col("near") > limit) | (F.col("upto") == F.col("all"))
    return stored(_step(rows, shape, p, floors, inside, 0.975))


def _leaning(found, p, weight):
    """(group, centre, inverse) per pair of language and source: its estimate, leaning on that of its language, which leans on
    that of all. An estimate from n rows counts n, the one it leans on ``weight``.

    ``found`` has one row per pair: group, and for each level from the widest to the pair ``n``, ``centre`` and ``inverse``.
    """
    def lean(batches):
        for batch in batches:
            out = []
            for group, estimates in zip(batch["group"], batch["estimates"]):
                centre = covariance = None
                for e in estimates:
                    own = np.array(e["centre"]), np.linalg.inv(np.reshape(e["inverse"], (p, p)))
                    share = 1.0 if centre is None else e["n"] / (e["n"] + weight)
                    centre = own[0] if centre is None else share * own[0] + (1 - share) * centre
                    covariance = own[1] if covariance is None else share * own[1] + (1 - share) * covariance
                out.append((group, centre.tolist(), np.linalg.inv(covariance).ravel().tolist()))
            yield pd.DataFrame(out, columns=["group", "centre", "inverse"])

    return found.mapInPandas(lean, "group string, centre array<double>, inverse array<double>")


def shapes_of(good, p, floors, weight=500, **options):
    """(group, centre, inverse) for every pair of language and source of ``good`` (groups, x)."""
    long = good.select(F.explode("groups").alias("group"), "x")
    estimates = minimum_covariance(long, p, floors, **options).join(long.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "group")
    estimates = stored(estimates.select("group", F.struct("n", "centre", "inverse").alias("e")))
    # one row per pair and level
    pairs = good.select("groups").distinct().select(F.col("groups")[0].alias("pair"), F.posexplode("groups").alias("level", "group"))
    found = pairs.join(estimates, "group").groupBy("pair").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("level")).alias("k"), "e"))).alias("l"))
    return stored(_leaning(found.select(F.col("pair").alias("group"), F.transform("l", lambda x: x["e"]).alias("estimates")), p, weight))


def judged(docs, least_words=50, most_repeated=50, cut=1 - 1e-6, weight=500, **options):
    """doc_id, the statistics, base_failed, distance (squared Mahalanobis, null if the base rules fail) and kept.

    Texts with fewer than ``least_words`` words, or over ``most_repeated`` % of them in repeated windows,
    fail the base rules and take no part in the estimates. Every other text is judged by the estimate for
    its language and source and rejected beyond the ``cut`` quantile of the distance of a normal sample. Estimates
    lean on that for the language, and those on that for all texts, as if ``weight`` of their rows came
    from there: a pair with one text is judged by its language, one with thousands by itself, all by one formula.

    Null text has no words. Null languages and sources are groups like others; doc_id may be null or
    repeated, equal rows are judged alike; other columns are not read. A very long text is a row of
    statistics like any other. An empty table gives no rows.
    """
    counted = stored(docs.select("doc_id", "lang", "source", text_stats()("text").alias("s")).select(
        "doc_id", "lang", "source", "s.*"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    good = stored(levels(counted.filter(~failed).withColumn("x", F.array(*measures()))))
    p = len(FLOORS)
    shape = shapes_of(good.select("groups", "x"), p, FLOORS, weight, **options)
    far = good.withColumn("group", F.col("groups")[0]).join(shape, "group", "left").select("doc_id", *STATS, _distance(p).alias("distance"))
    bad = counted.filter(failed).select("doc_id", *STATS, F.lit(None).cast("double").alias("distance"))
    limit = chi_square(p, cut)
    return far.withColumn("base_failed", F.lit(False)).withColumn("kept", F.col("distance") <= limit).unionByName(
        bad.withColumn("base_failed", F.lit(True)).withColumn("kept", F.lit(False)))
