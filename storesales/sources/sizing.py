"""Shuffle sizes that follow the input, and scans in small splits."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"

# Where the number is kept that this module set itself, to tell it from the user's.
OWN_NUMBER = "storesales.shuffle.sized"

# Option: the most partitions to start with. Beyond the default the number of
# shuffle blocks costs more than larger partitions do.
MOST_PARTITIONS_OPTION = "storesales.shuffle.mostPartitions"
MOST_PARTITIONS = 100_000

# Of the stored, compressed files; in memory it is several times as much.
BYTES_PER_PARTITION = 16 * 1024 * 1024

# What a task reads from files and from a shuffle at most, if the user sets nothing. A task that aggregates or
# sorts holds several times as much in memory, so with Spark's own 128 MB and 64 MB it spills.
READ_AT_ONCE = {
    "spark.sql.files.maxPartitionBytes": 16 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 * 1024 * 1024,
}


def stored_bytes(frames: Iterable[DataFrame]) -> int:
    """Size of the files behind plain reads, as the optimizer knows it from their listing; no job runs."""
    return sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames)


def size_shuffles(
    spark: SparkSession, frames: Iterable[DataFrame], bytes_per_partition: int = BYTES_PER_PARTITION
) -> int:
    """Let shuffles start with enough partitions for the files behind ``frames``; returns the number.

    Adaptive execution merges small partitions but cannot split ordinary ones,
    so the start must be high enough. A number set by the user stays, and so
    does the session's own number where it is higher. A number set here for an
    earlier input gives way to that of this one.
    """
    chosen = spark.conf.get(INITIAL_PARTITIONS, None)
    if chosen is not None and chosen != spark.conf.get(OWN_NUMBER, None):
        return int(chosen)
    own = int(spark.conf.get(SHUFFLE_PARTITIONS))
    wanted = math.ceil(stored_bytes(frames) / bytes_per_partition)
    most = int(spark.conf.get(MOST_PARTITIONS_OPTION, str(MOST_PARTITIONS)))
    if wanted > most:
        logger.warning("%d shuffle partitions wanted, %s allows %d", wanted, MOST_PARTITIONS_OPTION, most)
        wanted = most
    if wanted > own:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
        spark.conf.set(OWN_NUMBER, str(wanted))
    elif chosen is not None:
        spark.conf.unset(INITIAL_PARTITIONS)
        spark.conf.unset(OWN_NUMBER)
    return max(wanted, own)


def size_tasks(spark: SparkSession) -> None:
    """Let tasks read little enough at once to aggregate and sort it in memory; what the user has set stays."""
    for key, size in READ_AT_ONCE.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(size))
