"""Session settings the library relies on. All are runtime SQL settings, so an existing session can be used."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import sievework

RUNTIME_SETTINGS = {
    # Timestamps are written and compared in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Replies may repeat a JSON key; the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rows travel to Python in batches of so many bytes at most, however long texts are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it.

    Partition counts, memory and the checkpoint folder are the cluster's business and stay untouched.
    Python functions of this package travel to the workers with the plan, so it need not be installed there.
    """
    cloudpickle.register_pickle_by_value(sievework)
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark
