"""One row per site or profile, so that every lookup and every request happens once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.keys import cache_key, with_scheme
from sievework.functions.text import strip


def distinct_sites(contacts: DataFrame) -> DataFrame:
    """Sites of contacts that carry lookup keys, each represented by its contact of smallest id.

    Grouped by the normal URL, from which the cache key and the fetch URL follow, so a plan that does not
    use the representative prunes it and is left with a hash aggregate on one column. The partial
    aggregation before the shuffle sends at most one row per site and task, however many contacts share it.
    """
    first = F.min_by(F.struct("company", "website"), "contact_id")
    return (
        contacts.filter(F.col("site").isNotNull())
        .groupBy("site")
        .agg(first.alias("first"), F.min("contact_id").alias("first_contact_id"), F.count("*").alias("n_contacts"))
        .select(
            "site",
            cache_key(F.lit("s1"), F.col("site")).alias("cache_key"),
            with_scheme(F.col("site")).alias("fetch_url"),
            F.col("first.company").alias("company"),
            with_scheme(strip(F.col("first.website"))).alias("url"),
            "first_contact_id",
            "n_contacts",
        )
    )


def distinct_profiles(contacts: DataFrame) -> DataFrame:
    """Profile URLs of contacts that carry lookup keys, represented as in :func:`distinct_sites`."""
    first = F.min_by("name", "contact_id")
    return (
        contacts.filter(F.col("profile").isNotNull())
        .groupBy("profile")
        .agg(first.alias("name"), F.min("contact_id").alias("first_contact_id"), F.count("*").alias("n_contacts"))
        .select("profile", cache_key(F.lit("s2"), F.col("profile")).alias("cache_key"), "name", "first_contact_id", "n_contacts")
    )


def best_per_key(df: DataFrame, key: str, values: list[str], rank: list[Column]) -> DataFrame:
    """The ``values`` of the row of greatest ``rank`` per ``key`` (NULL ranks lowest), ties by hash; combined before the shuffle.

    Each value is an aggregate of its own, so that one which a plan does not use is not shuffled.
    """
    ranks = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.xxhash64(*values).alias("tie"))
    ranked = df.select(key, *values, ranks.alias("_rank"))
    return ranked.groupBy(key).agg(*[F.max_by(v, "_rank").alias(v) for v in values])
