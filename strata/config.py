"""Recommended session settings for a cluster run of the warehouse builds.

The library never changes session configuration itself; a deployment applies
these (``SparkSession.builder.config(...)`` or ``spark-submit --conf``).
"""

CLUSTER_CONF = {
    # runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # turn a shuffle join into a broadcast only when the *measured* side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # AQE merges small partitions and splits skewed ones, but never raises this
    # count: set it to about (bytes shuffled) / 256 MB.  20000 suits 5 TB shuffled
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # no broadcast on planner estimates for unknown-size sides; runtime
    # (measured) broadcast stays on through the adaptive threshold
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # every cast in the library is try_cast, so results do not depend on this
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # lost executors: keep shuffle files served by the external shuffle service
    "spark.shuffle.service.enabled": "true",
    "spark.dynamicAllocation.enabled": "true",
    "spark.ui.enabled": "false",
    # also required: "spark.checkpoint.dir" = a folder on the shared file system
    # (frozen intermediate tables of the sequential key live there)
}
