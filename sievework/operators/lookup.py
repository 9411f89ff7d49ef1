"""Lookup joins. The right side always holds one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with at least this many rows is cut into pieces of about this size.
ROWS_PER_PIECE = 1_000_000


def key_counts(left: DataFrame, key: str) -> DataFrame:
    """Rows per key, as ``key, n``."""
    return left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: str,
    counts: DataFrame | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``key``, with hot keys of ``left`` spread over many tasks.

    Every key of at least ``rows_per_piece`` rows is cut into pieces: left rows take a piece by their ``row_id``,
    right rows are repeated once per piece. Which keys those are comes from exact ``counts`` of the left side
    (``key, n``; counted here if not given). The list holds hashes of keys, 16 bytes each; as each stands for
    ``rows_per_piece`` rows, a trillion rows give a million entries at most, so it is broadcast. Keys that share a
    hash are cut alike on both sides. Rows without a key, which match nothing, are spread by their id too.
    """
    hot = F.broadcast(
        (key_counts(left, key) if counts is None else counts)
        .filter(F.col("n") >= rows_per_piece)
        .groupBy(F.xxhash64(key).alias("_hash"))
        .agg(F.max(F.ceil(F.col("n") / rows_per_piece)).alias("_pieces"))
    )
    pieces = F.coalesce("_pieces", F.lit(1).cast("long"))
    row_hash = F.xxhash64(row_id)
    spread = (
        left.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
        .withColumn("_piece", F.when(F.col(key).isNull(), row_hash).otherwise(F.pmod(row_hash, pieces)))
        .drop("_pieces", "_hash")
    )
    repeated = (
        right.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
        .drop("_pieces", "_hash")
    )
    return spread.join(repeated, [key, "_piece"], "left").drop("_piece")


def page_flags_for_sites(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``page_blank`` and ``page_error`` of each site's ``fetch_url``, NULL where nothing was crawled.

    The page of smallest id stands for its URL. The flags are a few bytes, so pages are read once and reduced
    to one row per URL before the shuffle.
    """
    flags = F.min_by(F.struct("page_blank", "page_error"), "page_id")
    per_url = pages.groupBy(F.col("page_url").alias("fetch_url")).agg(flags.alias("_flags"))
    return sites.join(per_url, "fetch_url", "left").select(*sites.columns, "_flags.page_blank", "_flags.page_error")


def page_for_sites(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """Add the page columns, texts included, of each site's ``fetch_url``; NULL where nothing was crawled.

    The page of smallest id stands for its URL. It is chosen on two slim columns, and only then is the rest
    of the row read and shuffled, once, by the unique ``page_id``.
    """
    chosen = pages.groupBy("page_url").agg(F.min("page_id").alias("page_id"))
    located = sites.join(chosen, F.col("fetch_url") == F.col("page_url"), "left").drop("page_url")
    return located.join(pages.drop("page_url"), "page_id", "left")


def profile_for_people(people: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add ``person`` (a VARIANT object), NULL where no profile was found."""
    chosen = profiles.withColumnRenamed("profile_url", "profile")
    return people.join(chosen, "profile", "left")


def answer_for_keys(keys: DataFrame, answers: DataFrame) -> DataFrame:
    """Add ``raw_answer``, NULL where no reply is there yet."""
    return keys.join(answers.withColumnRenamed("answer_key", "cache_key"), "cache_key", "left")
