"""The cache across generations: what readers see, what a batch reads, and attempts that die."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sievework.functions.stages import PERSON, WEBSITE
from sievework.operators.cache import latest_entries
from sievework.sinks import cache as sink
from sievework.sinks.cache import append_entries, clear_cache, fold_cache, forget_keys, remove_folded
from sievework.sources.cache import added_entries, base_folder, cache_schema, current_generation, entries_folder, folded_entries, read_cache

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def day(n):
    return START + timedelta(days=n)


def entries(spark, rows, stage=WEBSITE):
    """Rows of key, score, error and day."""
    result = cache_schema(stage)["result"].dataType
    made = spark.createDataFrame(rows, "cache_key string, score int, error string, day int")
    values = [
        F.col("score") if f.name == stage.score_column else F.col("error") if f.name == stage.error_column else F.lit(None).cast(f.dataType)
        for f in result.fields
    ]
    return made.select(
        "cache_key",
        F.lit(stage.prefix).alias("stage"),
        F.struct(*[v.alias(f.name) for v, f in zip(values, result.fields)]).alias("result"),
        "error",
        F.timestamp_add("DAY", "day", F.lit(START)).alias("written_at"),
    )


def seen(spark, path, keys=None, stage=WEBSITE):
    wanted = None if keys is None else spark.createDataFrame([(k,) for k in keys], "cache_key string")
    latest = latest_entries(read_cache(spark, path, stage, wanted), stage)
    return {r["cache_key"]: r["result"][stage.score_column] for r in latest.collect()}


def test_folding_keeps_the_newest_entry_of_each_key(spark, tmp_path):
    path = str(tmp_path)
    assert fold_cache(spark, path).number == 1 and seen(spark, path) == {}
    append_entries(entries(spark, [("a", 1, "", 1), ("b", 1, "", 1), ("c", 0, "x", 1)]), path, "r1")
    append_entries(entries(spark, [("a", 2, "", 2), ("c", 2, "", 1)]), path, "r2")
    before = seen(spark, path)
    assert before == {"a": 2, "b": 1, "c": 2}
    made = fold_cache(spark, path, rows_per_bucket=1)
    assert made.buckets > 1 and current_generation(spark, path, WEBSITE) == made
    folded = folded_entries(spark, path, WEBSITE, made)
    assert {(r["cache_key"], r["run_id"]) for r in folded.collect()} == {("a", "r2"), ("b", "r1"), ("c", "r2")}
    assert folded.columns == read_cache(spark, path, WEBSITE).columns == cache_schema(WEBSITE).fieldNames()
    assert seen(spark, path) == before and seen(spark, path, ["a", "z"]) == {"a": 2} and seen(spark, path, []) == {}
    # A run that comes after, and the first again: its own folder, the folded entries beside it.
    append_entries(entries(spark, [("b", 7, "", 3)]), path, "r3")
    append_entries(entries(spark, [("a", 9, "", 9)]), path, "r1")
    assert seen(spark, path) == {"a": 9, "b": 7, "c": 2}
    fold_cache(spark, path)
    fold_cache(spark, path)
    assert seen(spark, path) == {"a": 9, "b": 7, "c": 2}


def test_forgotten_keys_stay_gone(spark, tmp_path):
    path = str(tmp_path)
    append_entries(entries(spark, [("a", 1, "", 1), ("b", 1, "", 1)]), path, "r1")
    fold_cache(spark, path)
    forget_keys(spark.createDataFrame([("a",), ("a",), ("z",)], "cache_key string"), path, WEBSITE, day(2))
    for _ in range(4):
        assert seen(spark, path) == {"b": 1} and seen(spark, path, ["a", "b"]) == {"b": 1}
        fold_cache(spark, path)
        remove_folded(spark, path)
    append_entries(entries(spark, [("a", 5, "", 3)]), path, "r2")
    assert seen(spark, path) == {"a": 5, "b": 1}


def test_additions_during_a_fold_are_not_lost(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    append_entries(entries(spark, [("a", 1, "", 1), ("b", 1, "", 1)]), path, "r1")
    make_current = sink._make_current

    def late(*args):
        assert seen(spark, path) == {"a": 1, "b": 1}
        append_entries(entries(spark, [("c", 3, "", 2)]), path, "r2")
        forget_keys(spark.createDataFrame([("a",)], "cache_key string"), path, WEBSITE, day(5))
        return make_current(*args)

    monkeypatch.setattr(sink, "_make_current", late)
    fold_cache(spark, path)
    monkeypatch.undo()
    for _ in range(4):
        assert seen(spark, path) == {"b": 1, "c": 3}
        fold_cache(spark, path)
        remove_folded(spark, path)


def test_an_attempt_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    append_entries(entries(spark, [("a", 1, "", 1)]), path, "r1")
    fold_cache(spark, path)
    append_entries(entries(spark, [("b", 1, "", 1)]), path, "r2")

    def dies(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(sink, "_make_current", dies)
    with pytest.raises(RuntimeError):
        fold_cache(spark, path)
    monkeypatch.undo()
    assert current_generation(spark, path, WEBSITE).number == 1 and seen(spark, path) == {"a": 1, "b": 1}
    assert fold_cache(spark, path).number == 2 and seen(spark, path) == {"a": 1, "b": 1}
    left = [p for p in remove_folded(spark, path) if "bucket-by-key" in p]
    assert len(left) == 1  # what the dead attempt left
    assert seen(spark, path) == {"a": 1, "b": 1}


def test_an_open_reader_survives_a_fold_and_the_removal_after_it(spark, tmp_path):
    path = str(tmp_path)
    append_entries(entries(spark, [("a", 1, "", 1)]), path, "r1")
    fold_cache(spark, path)
    reader = read_cache(spark, path, WEBSITE)
    append_entries(entries(spark, [("a", 2, "", 2)]), path, "r2")
    fold_cache(spark, path)
    remove_folded(spark, path)
    assert {r["result"]["s1_score"] for r in reader.collect()} == {1}
    for n in range(3):
        fold_cache(spark, path)
    assert len(remove_folded(spark, path)) > 0 and seen(spark, path) == {"a": 2}
    assert added_entries(spark, path, WEBSITE, current_generation(spark, path, WEBSITE)).isEmpty()


def test_clearing_a_folded_cache(spark, tmp_path):
    path = str(tmp_path)
    append_entries(entries(spark, [("a", 1, "", 1)]), path, "r1")
    append_entries(entries(spark, [("p", 1, "", 1)], PERSON), path, "r1", PERSON)
    fold_cache(spark, path)
    fold_cache(spark, path, PERSON)
    append_entries(entries(spark, [("b", 1, "", 1)]), path, "r2")
    clear_cache(spark, path, WEBSITE)
    assert seen(spark, path) == {} and seen(spark, path, stage=PERSON) == {"p": 1}
    append_entries(entries(spark, [("c", 1, "", 1)]), path, "r3")
    fold_cache(spark, path)
    assert seen(spark, path) == {"c": 1}


def test_any_order_of_runs_folds_and_deletions(spark, tmp_path):
    chance, path, model = random.Random(5), str(tmp_path), {}
    for step in range(14):
        kind = chance.choice(["run", "run", "fold", "forget", "remove"])
        keys = sorted(chance.sample("abcdefgh", 3))
        if kind == "run":
            append_entries(entries(spark, [(k, step, "", step) for k in keys]), path, f"r{step}")
            model.update(dict.fromkeys(keys, step))
        elif kind == "forget":
            forget_keys(spark.createDataFrame([(k,) for k in keys], "cache_key string"), path, WEBSITE, day(step))
            model = {k: v for k, v in model.items() if k not in keys}
        elif kind == "fold":
            fold_cache(spark, path, rows_per_bucket=2)
        else:
            remove_folded(spark, path)
        assert seen(spark, path, keys) == {k: model[k] for k in keys if k in model}
    assert seen(spark, path) == model


def test_a_batch_reads_the_folders_of_its_keys_only(spark, tmp_path):
    path = str(tmp_path)
    shape = entries(spark, [("a", 1, "", 1)]).drop("cache_key")
    many = spark.range(1_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("cache_key")).join(F.broadcast(shape))
    append_entries(many, path, "r1")
    made = fold_cache(spark, path)
    assert 900 <= made.buckets <= 1100
    keys = spark.range(100).select(F.sha2((F.col("id") * 1000).cast("string"), 256).alias("cache_key"))
    part = folded_entries(spark, path, WEBSITE, made, keys)
    plan = part._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [bucket#" in plan.toString().replace("isnotnull(bucket", "bucket")
    part.write.format("noop").mode("overwrite").save()
    files = part.select(F.input_file_name()).distinct().count()
    assert files <= 100 and part.count() < 150_000
    for _ in range(2):  # what the run added is read until the generation after the next
        made = fold_cache(spark, path)
    assert read_cache(spark, path, WEBSITE, keys).count() == 100
    assert base_folder(path, WEBSITE, made.name).startswith(path) and entries_folder(path, WEBSITE).startswith(path)
