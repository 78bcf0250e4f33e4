"""Session settings that suit these workloads. Sessions are the caller's; nothing here is set by itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods over 8000 bytes of bytecode: wide projections run several
    # times faster as split code than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def recommend(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the recommended settings to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder
