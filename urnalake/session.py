"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Partitions a shuffle starts with; adaptive execution merges small ones but does not split
#: evenly large ones, so there must be enough of them for the largest input.
INITIAL_PARTITIONS = 4000


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings this library expects.

    All settings are made here. Operators and sources change none, so a session that is shared
    with other work stays as it is, and a cluster's own sizing counts.
    """
    builder = (
        SparkSession.builder.appName("urnalake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # A sort-merge join becomes a hash join where every build partition turns out small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_PARTITIONS)
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    Only where the cluster names none (local tests) a local temporary folder stands in.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="urnalake-")
    return f"{shared.rstrip('/')}/urnalake/{purpose}-{uuid.uuid4().hex}"
