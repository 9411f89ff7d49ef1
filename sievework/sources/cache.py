"""Reading the cache: a folded generation laid out by key, and what runs have added since.

Below the cache folder lie, per stage,

    stage=s1/after=G/run_id=R                 entries of run R, which began when generation G was current
    forgotten/stage=s1/after=G/order=ID       keys whose entries written until ``forgotten_at`` are gone
    generations/stage=s1/bucket-by-key/NAME   folded entries, one row a key, in folders ``bucket=B``
    generations/stage=s1/current              a row per generation; the last one counts

A generation counts from the moment its row is there, which Spark commits as one file, so a reader sees one
generation or the next. Generation G holds what came after G - 2 at the latest; readers take additions from G - 1 on, so
those of a run that was still writing while its generation was folded are seen twice rather than never.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.stages import Stage
from sievework.operators.cache import KEY

GENERATION_SCHEMA = "generation long, name string, buckets int"
FORGOTTEN_SCHEMA = f"{KEY} string, forgotten_at timestamp, after long"
MAX_BUCKETS = 8192


@dataclass(frozen=True)
class Generation:
    """The current generation; ``name`` is None before the first one and after the cache was cleared."""

    number: int = 0
    name: str | None = None
    buckets: int = 1


def entries_folder(path: str, stage: Stage) -> str:
    return f"{path}/stage={stage.prefix}"


def forgotten_folder(path: str, stage: Stage) -> str:
    return f"{path}/forgotten/stage={stage.prefix}"


def current_folder(path: str, stage: Stage) -> str:
    return f"{path}/generations/stage={stage.prefix}/current"


def base_folder(path: str, stage: Stage, name: str) -> str:
    return f"{path}/generations/stage={stage.prefix}/bucket-by-key/{name}"


def bucket_of(key: Column, buckets: int) -> Column:
    """The folder of a key; the same for every reader and writer of a generation."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def cache_schema(stage: Stage) -> T.StructType:
    """Columns of a stage's cache."""
    answers = [T.StructField(q.column, T.BooleanType()) for q in stage.questions]
    title = [T.StructField(stage.title_column, T.StringType())] if stage.has_title else []
    result = T.StructType(
        [
            *answers,
            *title,
            T.StructField(stage.score_column, T.IntegerType()),
            T.StructField(stage.error_column, T.StringType()),
            T.StructField(stage.reasoning_column, T.StringType()),
        ]
    )
    return T.StructType(
        [
            T.StructField(KEY, T.StringType()),
            T.StructField("stage", T.StringType()),
            T.StructField("result", result),
            T.StructField("error", T.StringType()),
            T.StructField("written_at", T.TimestampType()),
            T.StructField("run_id", T.StringType()),
        ]
    )


def _folder(spark: SparkSession, path: str, schema: str | T.StructType, base: str | None = None) -> DataFrame:
    """A folder's rows; none if nothing has been written there yet."""
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def current_generation(spark: SparkSession, path: str, stage: Stage) -> Generation:
    rows = _folder(spark, current_folder(path, stage), GENERATION_SCHEMA)
    last = rows.agg(F.max(F.struct("generation", "name", "buckets")).alias("last")).first()["last"]
    return Generation() if last is None else Generation(last["generation"], last["name"], last["buckets"])


def added_entries(spark: SparkSession, path: str, stage: Stage, generation: Generation) -> DataFrame:
    """What runs have added since the generation before the given one."""
    schema = T.StructType([*cache_schema(stage).fields, T.StructField("after", T.LongType())])
    added = _folder(spark, entries_folder(path, stage), schema, path)
    return added.filter(F.col("after") >= generation.number - 1).select(cache_schema(stage).fieldNames())


def folded_entries(spark: SparkSession, path: str, stage: Stage, generation: Generation, keys: DataFrame | None = None) -> DataFrame:
    """The generation's entries. With ``keys`` only the folders in which these lie are read.

    The numbers of the folders come to the driver, at most ``MAX_BUCKETS``, and become a filter on the partition.
    """
    fields = [f for f in cache_schema(stage).fields if f.name != "stage"]
    schema = T.StructType([*fields, T.StructField("bucket", T.IntegerType())])
    base = _folder(spark, base_folder(path, stage, generation.name), schema)
    if keys is not None:
        wanted = [r[0] for r in keys.select(bucket_of(F.col(KEY), generation.buckets)).distinct().collect()]
        base = base.filter(F.col("bucket").isin(wanted))
    return base.withColumn("stage", F.lit(stage.prefix)).select(cache_schema(stage).fieldNames())


def not_forgotten(spark: SparkSession, entries: DataFrame, path: str, stage: Stage, generation: Generation) -> DataFrame:
    """Entries but for those whose key was forgotten when they were written already."""
    orders = _folder(spark, forgotten_folder(path, stage), FORGOTTEN_SCHEMA).filter(F.col("after") >= generation.number - 1)
    last = orders.groupBy(KEY).agg(F.max("forgotten_at").alias("forgotten_at"))
    gone = last.select(F.col(KEY).alias("_key"), "forgotten_at")
    return entries.join(gone, (F.col(KEY) == F.col("_key")) & (F.col("written_at") <= F.col("forgotten_at")), "left_anti")


def read_cache(spark: SparkSession, path: str, stage: Stage, keys: DataFrame | None = None) -> DataFrame:
    """A stage's entries, several of a key possibly; with ``keys`` (stored, with ``cache_key``) those of these keys only.

    A reader that knows its keys reads their part of the folded entries and all that was added since: that
    part follows the keys, whatever the cache's size, as long as it is folded now and then.
    """
    generation = current_generation(spark, path, stage)
    entries = added_entries(spark, path, stage, generation)
    if generation.name is not None:
        entries = entries.unionByName(folded_entries(spark, path, stage, generation, keys))
    entries = not_forgotten(spark, entries, path, stage, generation)
    return entries if keys is None else entries.join(keys.select(KEY), KEY, "left_semi").select(entries.columns)
