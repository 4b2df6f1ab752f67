"""Mix sources to target weights: hash-random order, range sums per source, a cut at the exact budget."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from buycast.llm.common import WORD_PATTERN, stored

# The weights that sources take in turn.
WEIGHTS = (1, 2, 3)


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes, weights=WEIGHTS, share=1.0, max_epochs=3):
    """Target per source from a table (source, source_size): one row per source.

    Sources in code-point order, null last, take ``weights`` in turn and share ``share`` of all sizes.
    No target passes ``max_epochs`` times its source; what is cut off goes to the others by weight.
    That is a water level: sources in the order of cap per weight, each capped while its cap lies
    below the level that the rest would get.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    levels = (
        sizes.withColumn("rank", F.row_number().over(rank) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level",
                    (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        # the level rises while capped sources are passed, and falls after them
        .withColumn("water", F.max("level").over(everything))
    )
    return levels.select(
        "source", "source_size", F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def _key(seed):
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(F.col("text"), F.lit(""))))


def mix(docs, weights=WEIGHTS, share=1.0, max_epochs=3, seed="mix"):
    """How often the mix takes each document: one row per row of ``docs`` with doc_id, source, key (random),
    size (words), source_size, target and copies.

    Every document gets a hash-random key. Within its source, rows are ordered by it; the first hex
    digits of the key cut each source into ranges, whose sums give every row the words that lie before
    it. All whole epochs that fit the target take every document once; the last, partial one takes the
    documents up to the budget, the one on the cut if more than half of it lies inside. No range grows
    with a source's share, and only one row per source and one per (source, range) is ever summed up.

    Null text has size 0, null source is a source of its own, null doc_id is allowed. Rows with the same
    doc_id, text and source are taken equally often. A source without words is not taken. Columns other
    than doc_id, text and source are not read. An empty table gives no rows.
    """
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _key(seed).alias("key")))
    sized = sized.withColumn("range", F.substring("key", 1, 4))
    sums = sized.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    per_source = targets(sums.groupBy("source").agg(F.sum("in_range").alias("source_size")), weights, share, max_epochs)
    per_source = per_source.withColumnRenamed("source", "source_")
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.withColumn("offset", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
        .join(per_source, F.col("source").eqNullSafe(F.col("source_")))
        .select("source_", F.col("range").alias("range_"), "offset", "source_size", "target")
    )
    up_to_equals = Window.partitionBy("source", "range").orderBy("key", "doc_id")  # equal rows included
    equals = Window.partitionBy("source", "range", "key", "doc_id")
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    return (
        sized.withColumn("unit", F.sum("size").over(equals))
        .withColumn("inside", F.sum("size").over(up_to_equals) - F.col("unit"))
        .join(offsets, F.col("source").eqNullSafe(F.col("source_")) & (F.col("range") == F.col("range_")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("long"))
        .withColumn("inner", F.col("offset") + F.col("inside") + F.col("unit") / 2 < rest)
        .select("doc_id", "source", "key", "size", "source_size", "target",
                (F.col("epochs") + F.col("inner").cast("long")).alias("copies"))
    )


def mixed_documents(docs, weights=WEIGHTS, share=1.0, max_epochs=3, seed="mix"):
    """``docs`` with each row as often as ``mix`` takes it, all columns kept; see ``mix`` for odd rows."""
    taken = (
        mix(docs, weights, share, max_epochs, seed).filter("copies > 0")
        .select(F.col("doc_id").alias("__mix_doc"), F.col("source").alias("__mix_source"),
                F.col("key").alias("__mix_key"), F.col("copies").alias("__mix_copies")).distinct()
    )
    return (
        docs.withColumn("__mix_own", _key(seed))
        .join(taken, (F.col("__mix_own") == F.col("__mix_key")) & F.col("doc_id").eqNullSafe(F.col("__mix_doc"))
              & F.col("source").eqNullSafe(F.col("__mix_source")))
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
        .select(*docs.columns)
    )
