"""Session settings the operators of this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from larkspur.session import configure

SETTINGS = {
    # A join that needs few documents filters them by the wanted ids before their texts are shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    # Texts reach Python in batches of bounded size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8MB",
}


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
