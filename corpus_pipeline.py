"""From raw documents to token ids: quality rules, language, near-duplicates, benchmark passages, BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

Null and blank texts fail the first stage. Of equal fingerprints one row stays, the
one with the smallest id; repeated rows are separate until then. Very long texts
are worked on whole in every stage. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, decontaminate, langid, quality_rules, simhash
from daybook.llm.common import carried, prepared_session, staged, table

#: None: expectation-maximisation, language profiles, connected classes and merges have no SQL form.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of being good is at least one half and that pass the base rule."""
    return quality_rules.judge_quality(carried(docs, text="text"), keep=["row"]).where("kept").select("row.*")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without a letter have none."""
    found = langid.identified(carried(docs, doc_id="doc_id", text="text", lang="lang"))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints."""
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands, within its error budget."""
    found = decontaminate.find_leaks(carried(docs, text="text"), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), their number, and digests of ids and decoded text."""
    import public_tokenizers

    out = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), shape="bytes")
    return out.select("doc_id", "lang", "source", "bpe.n_tokens", "bpe.ids", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES = [
    ("quality rules", keep_good),
    ("language ID", keep_known_language),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepared_session(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
