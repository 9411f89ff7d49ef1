"""Snapshots from deltas: what batches write follows the batch, and the union is the snapshot computed at once."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sievework.catalog import inputs as fx
from sievework.plans.qualify import ADDED_COLUMNS, RunPaths
from sievework.sources.tables import land_page_texts
from sievework.streaming.incremental import contacts_stream, snapshot_from_deltas, snapshot_of_all, start_incremental_run

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def finished_run(spark, tmp_path_factory):
    """Three batches; replies come after the first, so later batches change results of earlier contacts."""
    base = tmp_path_factory.mktemp("snapshots")
    source, landed = str(base / "contacts"), str(base / "answers")
    everyone = fx.contacts(spark, SF)
    for b in range(3):
        everyone.filter(F.crc32(F.col("contact_id").cast("string").cast("binary")) % 4 == b).coalesce(1).write.mode("append").parquet(source)
    fx.website_answers(spark, SF).write.parquet(landed)
    pages, answers = land_page_texts(fx.table(spark, SF, "pages"), str(base / "pages")), spark.read.parquet(landed)
    paths, asked = RunPaths(str(base / "out"), str(base / "cache")), []

    def tables(session):
        asked.append(1)
        return pages, answers.filter("false") if len(asked) == 1 else answers

    stream = contacts_stream(spark, source, everyone.schema, files_per_batch=1)
    start_incremental_run(stream, tables, paths, "deltas", NOW, str(base / "checkpoint"), revise=True).awaitTermination()
    assert len(asked) == 3
    return everyone, paths


def test_deltas_merge_to_the_snapshot(spark, finished_run):
    everyone, paths = finished_run  # a quarter of the contacts never arrives
    columns = [*everyone.columns, *ADDED_COLUMNS]
    for b in range(3):
        merged = snapshot_from_deltas(everyone, paths, b, F.lit(NOW)).select(columns)
        whole = snapshot_of_all(everyone, paths, b, F.lit(NOW)).select(columns)
        assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_only_contacts_of_changed_sites_are_written_again(spark, finished_run):
    _, paths = finished_run
    revised = spark.read.parquet(paths.of("revised"))
    by_batch = {r["batch"]: r["count"] for r in revised.groupBy("batch").count().collect()}
    assert by_batch.get(0, 0) == 0 and by_batch[1] > 0
    assert revised.filter("s1_error = 'no_answer'").count() == 0
    reached = spark.read.parquet(paths.of("qualified"))
    earlier = reached.filter("s1_error = 'no_answer'").select("contact_id")
    assert revised.join(earlier, "contact_id", "left_anti").count() == 0
    assert revised.select("contact_id").distinct().count() == revised.count()
