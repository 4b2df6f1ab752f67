"""Recommender model on sequence samples: a factorisation machine over customer, history and candidate.

The customer's side (its id and its history) and the candidate's side (good and class) are hashed to
two separate vectors. The score of a pair is then a sum of a customer term, a candidate term and the
product of two short vectors, which is what lets whole candidate sets be scored without building them.
"""

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buycast.functions.numbers import or_empty, sigmoid
from buycast.operators.encode import decode
from buycast.operators.sequences import catalog, encode_events, histories, sequence_samples, target_customers
from buycast.operators.submit import fill_template, rollup_candidates
from buycast.plans.models import get_estimator, score
from buycast.runtime import dealt, global_index, stored

#: Goods of a block of the catalog: what a task holds of it at a time.
GOODS_PER_BLOCK = 16_384
#: Customers that one task multiplies with a block, about.
CUSTOMERS_PER_PART = 50_000
ROWS_PER_PRODUCT = 128


def _tag(prefix, col):
    return F.concat(F.lit(prefix), col.cast("string"))


def user_tokens(df: DataFrame) -> DataFrame:
    """Add ``user_tokens``: customer and distinct history entries as text."""
    return df.withColumn("user_tokens", F.concat(
        F.array(_tag("u", F.col("customer_id"))),
        F.transform(F.array_distinct("history_goods"), lambda x: _tag("hg", x)),
        F.transform(F.array_distinct("history_classes"), lambda x: _tag("hc", x)),
    ))


def item_tokens(df: DataFrame) -> DataFrame:
    """Add ``item_tokens``: candidate good and class as text."""
    return df.withColumn("item_tokens", F.array(
        _tag("g", F.col("candidate_good")), _tag("c", F.col("candidate_class"))))


def fit_recommender(samples: DataFrame, params=None) -> PipelineModel:
    """The fitted model. Samples are dealt over tasks as numbers, before they get their tokens, which are several times as long."""
    return get_estimator("fm", params=params).fit(item_tokens(user_tokens(dealt(samples))))


def score_pairs(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(customer_id, candidate_good, probability) for samples or candidates given as rows."""
    scored = score(model, item_tokens(user_tokens(rows)), ("customer_id", "candidate_good"))
    return scored.withColumnRenamed("score", "probability")


def _sums(index_lists, factors, linear):
    """Per row: sum of its factor rows, and its own share of the score (linear and inner pair terms)."""
    lengths = np.fromiter((len(x) for x in index_lists), dtype=np.int64, count=len(index_lists))
    flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in index_lists])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    rows = factors[flat]
    total = np.add.reduceat(rows, starts, axis=0)
    squares = np.add.reduceat((rows * rows).sum(axis=1), starts)
    return total, np.add.reduceat(linear[flat], starts) + 0.5 * ((total * total).sum(axis=1) - squares)


class CandidateSearch:
    """The best good of the whole catalog for each customer, without building the pairs.

    ``customers`` holds customer_idx, history_goods and history_classes; ``goods`` holds goods_idx and
    class_idx. A pair's margin is a customer term, a good's term and the product of two vectors, so
    no good of a block can pass the largest term of the block plus the product of the vectors' norms. Goods are
    range-sorted by norm and cut in blocks. Every customer meets the block of the largest norms first, and of
    the others only those whose bound reaches the best margin found there. A block of customers meets a block
    of the catalog as a matrix product inside a task; of each block only a customer's best good goes on.
    """

    def __init__(self, model: PipelineModel, customers: DataFrame, goods: DataFrame, goods_per_block=GOODS_PER_BLOCK,
                 customers_per_part=CUSTOMERS_PER_PART):
        spark = customers.sparkSession
        self.user_tf, self.item_tf, fm = model.stages[0], model.stages[1], model.stages[3]
        self.width = self.user_tf.getNumFeatures()
        # size fixed by the model parameters (hash width × factor size), not by the data
        self.table = spark.sparkContext.broadcast((fm.factors.toArray(), fm.linear.toArray(), float(fm.intercept)))
        listed = customers.select(
            F.col("customer_idx").alias("customer_id"), or_empty("history_goods").alias("history_goods"),
            or_empty("history_classes").alias("history_classes"))
        # a customer listed twice is looked for once
        users = self._vectors(self.user_tf.transform(user_tokens(listed.dropDuplicates(["customer_id"]))).select(
            F.col("customer_id").alias("id"), F.unwrap_udt("user_vector")["indices"].alias("indices")), users=True)
        self.users = stored(users)
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.users.count() // customers_per_part))
        self.parts = parts
        items = self._vectors(self.item_tf.transform(item_tokens(goods.select(
            F.col("goods_idx").alias("candidate_good"), F.coalesce("class_idx", F.lit(0)).alias("candidate_class"),
        ))).select(F.col("candidate_good").alias("id"), F.unwrap_udt("item_vector")["indices"].alias("indices")), users=False)
        placed = global_index(items, [F.desc("norm"), F.col("id")], "place")
        self.items = stored(placed.withColumn("block", F.floor(F.col("place") / goods_per_block).cast("int")).drop("place"))
        # one entry per block of the catalog
        self.blocks = self.items.groupBy("block").agg(F.max("norm").alias("norm"), F.max("share").alias("share"), F.count(F.lit(1)).alias("n"))

    def _vectors(self, rows, users):
        """(id, vector, share, norm): the sum of a row's factors, its own share of the margin, and the sum's length."""
        table, first = self.table, 0 if users else self.width

        def sums(batches):
            for batch in batches:
                if len(batch):
                    factors, linear, _ = table.value
                    total, share = _sums(list(batch["indices"]), factors[first:first + width], linear[first:first + width])
                    yield pd.DataFrame({"id": batch["id"].astype("int64"), "vector": list(total), "share": share, "norm": np.sqrt((total * total).sum(axis=1))})

        width = self.width
        return rows.mapInPandas(sums, "id long, vector array<double>, share double, norm double")

    def _met(self, users, items):
        """(customer_id, candidate_good, margin): the best good of a block for each customer that meets it."""
        table = self.table

        def best(own, offered):
            if not len(own) or not len(offered):
                return pd.DataFrame({"customer_id": [], "candidate_good": [], "margin": []})
            vectors, shares = np.stack(offered["vector"].to_numpy()), offered["share"].to_numpy()
            ids, out = offered["id"].to_numpy(dtype=np.int64), []
            for i in range(0, len(own), ROWS_PER_PRODUCT):
                some = own.iloc[i:i + ROWS_PER_PRODUCT]
                block = np.stack(some["vector"].to_numpy()) @ vectors.T + shares
                top = block.max(axis=1)
                # the least good of equals
                pick = np.where(block == top[:, None], ids[None, :], np.iinfo(np.int64).max).min(axis=1)
                out.append(pd.DataFrame({"customer_id": some["id"], "candidate_good": pick,
                                         "margin": table.value[2] + some["share"].to_numpy() + top}))
            return pd.concat(out)

        users = users.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(self.parts)).cast("int"))
        items = items.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))
        keys = ["block", "part"]
        return users.groupBy(*keys).cogroup(items.groupBy(*keys)).applyInPandas(
            best, "customer_id long, candidate_good long, margin double")

    def _first(self):
        return stored(self._met(self.users.withColumn("block", F.lit(0)), self.items.filter("block = 0")))

    def _open(self, first):
        """Customers with the further blocks whose bound reaches their best margin so far."""
        listed = self.blocks.filter("block > 0").agg(F.collect_list(F.struct("block", "norm", "share", "n"))).scalar()
        ahead = self.users.join(first.select(F.col("customer_id").alias("id"), "margin"), "id").withColumn("blocks", listed)
        # far above what rounding can change
        slack = 1e-6 + 1e-9 * F.abs("margin")
        base = F.lit(float(self.table.value[2])) + F.col("share")
        able = F.filter("blocks", lambda b: base + b["share"] + b["norm"] * F.col("norm") >= F.col("margin") - slack)
        return ahead.withColumn("open", F.explode(able)).select("id", "vector", "share", "norm", "open.block", "open.n")

    def best(self) -> DataFrame:
        """(customer_id, candidate_good, probability)."""
        first = self._first()
        met = first.union(self._met(self._open(first).drop("n"), self.items.filter("block > 0")))
        best_row = F.max(F.struct("margin", (-F.col("candidate_good")).alias("g")))
        return met.groupBy("customer_id").agg(best_row.alias("b")).select(
            "customer_id", (-F.col("b.g")).alias("candidate_good"), sigmoid(F.col("b.margin")).alias("probability"))

    def pairs(self) -> DataFrame:
        """(pairs, looked_at): all pairs of customers and goods, and how many of them were multiplied."""
        first = self._first()
        customers, goods = self.users.count(), self.items.count()
        seed = self.items.filter("block = 0").count() * customers
        return self._open(first).agg(
            F.lit(customers * goods).alias("pairs"), (F.lit(seed) + F.coalesce(F.sum("n"), F.lit(0))).alias("looked_at"))


def best_candidates(model: PipelineModel, customers: DataFrame, goods: DataFrame,
                    goods_per_block=GOODS_PER_BLOCK) -> DataFrame:
    """(customer_id, candidate_good, probability): the best good of the whole catalog for each customer, the same as
    scoring all pairs and keeping the maximum; see ``CandidateSearch``."""
    return CandidateSearch(model, customers, goods, goods_per_block).best()


def recommend_buyers(lines: DataFrame, template: DataFrame, train_month: str, predict_month: str, ord_col,
                     params=None, threshold=0.5) -> DataFrame:
    """(customer_id, result) for every row of the template: 1 if some good of the catalog scores above ``threshold``.

    Learns on the samples of ``train_month`` and scores the histories before ``predict_month``.
    Customers without any line get 0.
    """
    events, codes = encode_events(lines, ord_col)
    goods = catalog(events, ord_col)
    model = fit_recommender(stored(sequence_samples(events, train_month, ord_col, goods=goods)), params)
    targets = target_customers(template, codes["customer"])
    with_history = targets.join(histories(events, predict_month, ord_col), "customer_idx", "left")
    rolled = rollup_candidates(best_candidates(model, with_history, goods), threshold)
    named = decode(rolled, codes["customer"], "customer_id", "original")
    return fill_template(template, named.select(F.col("original").alias("customer_id"), "result"))
