"""Spark session helpers.

``build_session`` is for local runs and tests.  On a cluster the session comes
from spark-submit.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI semantics, UTC, AQE with skew handling.
_CORE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A partition is "skewed" when it is 5x the median and above 64 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Broadcast only on a checked size: a side is broadcast at once if its estimated size
    # is under 4 MB (compressed files undershoot a few times, so that stays small), and AQE
    # turns a shuffle join into a broadcast join once the small side's shuffle output is
    # known to be under 32 MB; any other join is a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Rows that lie by (student, city) stay there for joins and sums on more columns.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # dt partitions are yyyy-MM-dd text stamps; keep them text when read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lumenrec", extra: dict | None = None) -> SparkSession:
    """Local session: no UI, loopback networking, small shuffle fan-out."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("LUMENREC_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**_CORE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (driver-made ones too)."""
    for k, v in _CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked setting: keep the cluster's value
            pass
