"""How the derived inputs are dealt out to tasks."""

import pytest
from pyspark.sql import functions as F

from sievework.catalog import inputs as fx


@pytest.fixture
def folder(spark, tmp_path):
    """1000 customers in one file of one row group, which is one task's share."""
    key = F.col("id")
    rows = spark.range(1, 1001, numPartitions=1).select(
        key.alias("c_custkey"), F.concat(F.lit("N"), key).alias("c_name"), (key % 25).alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment")
    )
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, numPartitions=1).select(F.col("id").alias("page_id"), F.lit("https://a.example.com").alias("url")).write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def most_in_a_task(df):
    return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.sum("count"), F.max("count")).first()


def test_profiles_are_dealt_out_before_they_grow(spark, folder, monkeypatch):
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 100, raising=False)
    rows, most = most_in_a_task(fx.profile_responses(spark, folder))
    assert rows == 1000 and most <= 200


@pytest.mark.parametrize("made", [fx.person_replies, fx.contacts])
def test_replies_and_contacts_are_dealt_out_before_they_grow(spark, folder, monkeypatch, made):
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 100, raising=False)
    rows, most = most_in_a_task(made(spark, folder))
    assert rows == 1000 and most <= 200
