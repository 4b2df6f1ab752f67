"""Every operator on an empty table, and on rows without ids, equal rows and one id with two texts."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from buycast.llm import (
    decontaminate, language, mixing, near_dedup, ngram_lm, outliers, quality, suffix_dedup, token_codes, token_counts,
)
from buycast.llm.queries import tokenizer_path


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


PER_ROW = {
    "token files": lambda d, _: token_codes.read_tokens(token_codes.write_tokens(d, tokenizer_path())),
    "token counts": lambda d, _: token_counts.token_counts(d, vocabulary()),
    "near duplicates": lambda d, _: near_dedup.near_duplicates(d),
    "languages": lambda d, _: language.identify(d, F.lit(True)),
    "outliers": lambda d, _: outliers.judged(d),
    "mix": lambda d, _: mixing.mix(d),
    "language model": lambda d, _: ngram_lm.score(d, F.lit(True)),
    "repeats": lambda d, _: suffix_dedup.without_repeats(d),
    "importance": quality.importance,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(name, nobody, repeated_rows, labels):
    assert PER_ROW[name](nobody, labels).collect() == []
    rows = PER_ROW[name](repeated_rows, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(["None"] * 3 + ["1"] * 3 + ["2"])


def test_results_of_repeated_rows(repeated_rows):
    rows = suffix_dedup.without_repeats(repeated_rows).collect()
    of = lambda d: sorted(r.n_removed for r in rows if r.doc_id == d)
    assert of(1)[0] == of(1)[1] == 0 and of(2)[0] > 400 and of(None)[-1] > 400  # no id counts as the largest
    groups = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(repeated_rows).collect()}
    assert (None, 1) in groups and (1, 1) in groups and (None, None) in groups
    kept = near_dedup.deduplicated(repeated_rows).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "1", "2", "None"]
    copies = [r.copies for r in mixing.mix(repeated_rows).collect() if r.doc_id == 1 and r.source == "a"]
    assert len(set(copies)) == 1


def test_benchmark_without_items_or_documents(nobody, docs, benchmark, repeated_rows):
    assert decontaminate.contaminations(nobody, benchmark).collect() == []
    assert decontaminate.contaminations(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.decontaminated(docs, benchmark.limit(0)).count() == docs.count()
    odd = benchmark.sparkSession.createDataFrame([(None, "quite another text"), (1, None), (2, " "), (2, "?!")],
                                                 "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminations(repeated_rows, odd).collect()] == [(1, None)]


def test_stages(spark, docs):
    """The stages keep the columns, take effect one after the other, and end in a row per document left."""
    rows, sf = docs.select("doc_id", "text", "lang", "source", "n_chars"), "/root/testdata/sf0.001"
    names, sizes = rows.columns, [rows.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.stored(stage(spark, rows, sf))
        assert rows.columns == names
        sizes.append(rows.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf).count() == sizes[4]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.select(*names).limit(0), sf).collect() == []
