"""A corpus made ready for training: quality, language, exact and near copies, packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
stage before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storesales.llm.common import cut, read
from storesales.llm.exact_dedup import exact_dedup, sha256
from storesales.llm.jaccard_join import jaccard_sets, mark_of
from storesales.llm.language import UNKNOWN, identify
from storesales.llm.packing import pack
from storesales.llm.quality import score_quality
from storesales.sources.shared import checkpoint, new_path, remove, scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# A text goes if its languages explain it worse than chance by more than so many standard errors: few trigrams say little.
CERTAIN = 1.0


def _keep(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The rows that ``kept`` (``id``, ``key`` of the text, ``n``) names, NULL ids too; of ``n`` > 1 such rows one."""
    kept = cut(kept, "pipeline-kept")
    rows = docs.select(*COLUMNS, key.alias("key"))
    found = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (rows["key"] == kept["key"])).select(*COLUMNS, "n")
    if kept.where("n > 1").isEmpty():
        return found.select(*COLUMNS)
    same = ("doc_id", F.coalesce("text", F.lit("")).alias("same"))  # NULL counts as the empty text
    repeated = found.where("n > 1").groupBy(*same).agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("row"))
    return found.where("n = 1").select(*COLUMNS).unionByName(repeated.select("doc_id", "row.*"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of those at hand, takes for good."""
    scored = score_quality(docs.select(*COLUMNS), read(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those go that rather come from chance than from the languages found in them.

    That is a likelihood ratio, set against its own standard error, so a short
    text goes only if it is the less like a language. Texts without a letter go,
    and all where there is nothing to learn from.
    """
    judged = identify(docs.select(*COLUMNS), carry=True, background=True)
    spoken = F.col("gain") + CERTAIN * F.col("error") >= 0
    return judged.where((F.col("lang_pred") != UNKNOWN) & spoken).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text one row, with the largest id; a NULL id stays if the text has no other."""
    kept = exact_dedup(docs).where("kept").groupBy(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("key"))
    return _keep(docs, F.unhex(sha256(F.coalesce("text", F.lit("")))), kept.agg(F.count(F.lit(1)).alias("n")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word 5-grams with a Jaccard similarity of 0.8 one row, with the smallest id.

    A NULL id stays if none is linked to it that has one. Of an id's rows with
    different linked texts one stays. Texts without words are not linked.
    """
    texts = jaccard_sets(docs).groupBy("comp", F.col("doc_id").alias("id"), "mark").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.isnull("id").alias("last"), "id", "mark", "n")).alias("row")
    linked = texts.where("comp IS NOT NULL").groupBy("comp").agg(first).select("row.id", "row.mark", "row.n")
    alone = texts.where("comp IS NULL").select("id", "mark", F.lit(1).cast("long").alias("n"))
    return _keep(docs, mark_of("text"), linked.unionByName(alone).withColumnRenamed("mark", "key"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("quality", quality),
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("packing", packed),
]

#: The stages learn models and follow hashes, which SQL cannot say; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next; what a stage leaves behind is removed."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        with scratch(spark):
            docs = checkpoint(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
