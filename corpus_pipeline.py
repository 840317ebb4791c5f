"""From raw documents to token ids: rules, near-dedup, decontamination, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and reads it back as the next one's input.
Every stage takes empty tables, repeated rows and columns of any other name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellate.llm import bpe, decontam, minmax, rules, secrets
from stellate.llm.catalog import vocabulary
from stellate.llm.common import freeze, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Nulls: no words, so they go; ties and repeats: judged alike; long texts: whole."""
    return rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: word shingles of five, a similarity of 0.8.

    Documents are told apart by id and text; the smallest id stays, null ids last. Texts without words all stay.
    """
    return minmax.one_of_each(docs, settings=minmax.Settings(shingle=5))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages. Null texts and items have no words; an empty benchmark removes nothing."""
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows with secrets replaced by a mark; null texts stay null."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests that a decoding of them gives; a null text is an empty one."""
    codec = bpe.ByteBpe(spark, vocabulary())
    ids = codec.decode(codec.encode(docs))
    return bpe.digests(ids, extra=("lang", "source", "input_ids"))


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret scan", scan_secrets),
    ("byte-level BPE", encode),
]

# Near-duplicate components, line frequencies over min-hashes and byte-pair merges
# have no SQL form; tests hold run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
