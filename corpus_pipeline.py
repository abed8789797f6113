"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and
read again as the next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm.bpe import encode_decode
from tidewright.llm.common import cut_lineage, fresh
from tidewright.llm.decontam import decontaminate
from tidewright.llm.fmindex import remove_repeated_words
from tidewright.llm.quality import filter_quality
from tidewright.llm.queries import TOKENIZERS, table
from tidewright.llm.simhash import keep_one_of_each


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of a few MB: what a worker holds at once, and what the
    JVM holds for it, follow from that."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or are junk by the weighed votes go."""
    small_batches(spark)
    return filter_quality(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document of the smallest id stays."""
    small_batches(spark)
    return keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that stand elsewhere too are cut from the texts; a document keeps
    its row even if no word is left, and n_chars follows its text."""
    small_batches(spark)
    words, spans, kept = (fresh(docs, name) for name in ("__words", "__spans", "__kept"))
    found = remove_repeated_words(docs, words_col=words, spans_col=spans, kept_col=kept)
    new = {"text": F.col(kept), "n_chars": F.length(kept).cast("bigint")}
    return found.select(*(F.when(F.size(spans) > 0, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(f"`{c}`")
                          for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the length and a digest of what they decode to."""
    small_batches(spark)
    return encode_decode(docs, f"{TOKENIZERS}/word_bpe_49k.json").select(
        "doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

# Voting rules weighed by expectation-maximisation, XXH64, string tiling and BPE are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
