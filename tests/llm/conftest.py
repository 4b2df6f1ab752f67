import random

import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def docs(spark):
    """200 documents, with odd ones among them: null, empty and very long texts, copies, no language or source, and
    columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    passage = rows.orderBy("doc_id").first().text[:400]
    odd = [(1000, None, "en", "src0"), (1001, "", None, None), (1002, " \n\t ", "fr", None), (1003, LONG, "en", "src1"),
           (1004, LONG, None, "src1"), (1005, "x" * 49, "en", "ü"), (1006, "a b", "en", "src0"), (1007, "A  B", "de", "src2"),
           (1008, "日本語 " * 20, None, "src0"), (1009, "intro " + passage + " outro", "fr", "src0"), (1010, "12 34 !?", "en", None)]
    odd = spark.createDataFrame([(*r, 0) for r in odd], rows.schema)
    return rows.union(odd).withColumns({
        "size": F.lit("mine"), "key": F.lit(1), "fp": F.lit(2), "row": F.lit(3), "low": F.lit(4), "score": F.lit(5.0),
        "shard": F.lit(6), "block": F.lit(7), "copies": F.lit(8), "group": F.lit("g"), "kept": F.lit(False)}).repartition(5)


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def nobody(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="session")
def repeated_rows(spark):
    """Rows without an id, equal rows, and one id with two texts."""
    rng = random.Random(1)
    text = " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) + str(rng.randrange(50)) for _ in range(80))
    rows = [(None, text, "en", "a"), (None, text, "en", "a"), (1, text, "en", "a"), (1, text, "en", "a"),
            (1, "quite another text " * 9, "en", "b"), (2, text + " tail", None, None), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
