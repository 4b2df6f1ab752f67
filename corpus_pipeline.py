"""From documents to token files: five stages, each one of the text operators, each written before the next reads it."""

from buycast.llm import decontaminate, mixing, near_dedup, quality, token_codes
from buycast.llm.common import documents, stored
from buycast.llm.queries import tokenizer_path


def quality_classifier(spark, docs, sf_dir):
    """Importance resampling towards documents labelled good and not toxic; rejected documents go."""
    return quality.resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark, docs, sf_dir):
    """Of documents linked by SimHash fingerprints of three-word shingles that differ in at most two bits, the one with the
    least doc_id stays."""
    return near_dedup.deduplicated(docs, width=3, reach=2)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark, docs, sf_dir):
    """Sources meet their target weights; a document taken several times is as many rows."""
    return mixing.mixed_documents(docs)


def token_files(spark, docs, sf_dir):
    """Token ids in files of directly addressable codes, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_codes.read_tokens(token_codes.write_tokens(docs, tokenizer_path()))


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("token files", token_files),
]


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Models, Hamming searches and token files are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None
