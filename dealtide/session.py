"""Session settings that the plans in this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does three jobs here: it merges small shuffle partitions, turns joins into
# broadcasts once the real size of a side is known, and splits skewed partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


# Size to aim for in one shuffle partition, so that a sort or a hash table fits in memory.
_SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions for the largest shuffle; AQE merges those that turn out small."""
    return max(200, -(-shuffled_bytes // _SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "dealtide",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots.

    On a cluster leave ``master`` unset so that spark-submit decides, and give the
    expected bytes of the largest shuffle.
    """
    if shuffled_bytes is not None:
        conf.setdefault("spark__sql__shuffle__partitions", str(shuffle_partitions(shuffled_bytes)))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
