"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. Wall-clock timestamps are TIMESTAMP_NTZ, but a few
# conversions (epoch seconds, text formatting) still read the session zone: pin UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide parse projections (30 aliased columns over one from_json) make
    # constraint inference grow exponentially in the optimizer; the inferred
    # IS NOT NULL join filters it would add are not needed by these plans.
    "spark.sql.constraintPropagation.enabled": "false",
    # The JVM only interprets methods of more than 8,000 bytes; wide projections
    # are faster as many small methods than as one of whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "skyroll",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings the library depends on (idempotent)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.constraintPropagation.enabled",
              "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(k, DEFAULT_CONF[k])


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and split sizes for a cluster run over ``input_bytes`` of input.

    Scan splits of 256 MiB and an AQE advisory shuffle partition of the same
    size keep each task's working set well under executor memory. The initial
    shuffle partition count starts at input / 256 MiB (at least 2x the cores) so
    AQE only ever coalesces and never needs to split. Skew-join splitting stays
    on for joins with a hot key; aggregates rely on map-side combining instead.
    For 100 TB on 8000 cores this gives ~400k initial partitions.
    """
    initial = max(2 * cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
