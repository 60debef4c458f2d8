"""Exact deduplication by salted, content-comparing aggregates (native)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import cut, texts_of

# Sub-groups that copies of one text are dealt to before they meet.
SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Which row of equal texts stays: ``doc_id, keep_id, group_size, kept, text_sha256``, a row per input row.

    1. Each map task folds its own copies: the partial step of an aggregate by
       (digest, salt, text).
    2. The salted digest groups are merged, so a text that makes up a third of
       all rows is spread over ``salts`` reducers.
    3. The winners of the salts are combined by (digest, text).

    The text itself is a key at every stage, so texts are only ever equal when
    they are identical. Rows then look up their group by digest; where two
    different texts share one, they look it up by digest and text.

    NULL counts as the empty text, and all empty texts are copies of each
    other. Of equal texts the largest id stays. Repeated rows count as copies;
    rows that repeat the winning id are all ``kept``. NULL ids never win unless
    all ids of the group are NULL. An empty table gives an empty result. Other
    columns are neither read nor returned.
    """
    rows = texts_of(docs, id_col, text_col).withColumn("digest", digest(F.col("text")))
    salted = rows.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    merged = salted.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    groups = cut(merged.drop("text"), "dedup-groups")
    contested = cut(groups.groupBy("digest").count().where("count > 1").select("digest"), "dedup-contested")
    shared = groups.where("group_size > 1")
    keys = rows.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256"))
    if not contested.isEmpty():
        disputed = rows.join(contested, "digest", "left_semi")
        winners = disputed.groupBy("digest", "text").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        by_text = _decided(
            disputed.withColumn("text_sha256", sha256(F.col("text"))).join(winners, ["digest", "text"], "left")
        )
        by_digest = _decided(
            keys.join(contested, "digest", "left_anti").join(
                shared.join(contested, "digest", "left_anti"), "digest", "left"
            )
        )
        return by_digest.unionByName(by_text)
    return _decided(keys.join(shared, "digest", "left"))


def _decided(rows: DataFrame) -> DataFrame:
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
