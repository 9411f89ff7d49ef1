"""Snapshots of all contacts as deltas: what a batch finished, and what it changed of earlier batches' contacts.

A batch writes its own contacts (``qualified``) and the contacts of earlier batches whose site it gave another result
(``revised``). A snapshot is their union, the last revision of a contact first, put together when it is read; what is
written follows the batch, however many contacts came before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import errors
from sievework.functions.stages import WEBSITE
from sievework.plans.qualify import ADDED_COLUMNS, checkpoint_snapshot, prepared, scored


def changed_sites(earlier: DataFrame, results: DataFrame) -> DataFrame:
    """The ``results`` (one per site) that differ from the site's last one in ``earlier`` (with ``batch``, one per site and batch).

    Sites met for the first time are not among them. Only hashes of the earlier results are shuffled.
    """
    values = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in WEBSITE.result_columns])
    known = earlier.select("site", "batch", values.alias("_hash")).join(results.select("site"), "site", "left_semi")
    last = known.groupBy("site").agg(F.max_by("_hash", "batch").alias("_before"))
    return results.join(last, "site").filter(values != F.col("_before")).select(results.columns)


def revised_contacts(reached: DataFrame, changed: DataFrame, qualified_at: Column) -> DataFrame:
    """Earlier batches' contacts (``reached``) of ``changed`` sites, scored by the new results."""
    contacts = reached.drop(*ADDED_COLUMNS, "batch")
    ready = prepared(contacts).join(changed.select("site"), "site", "left_semi")
    return scored(ready, changed, qualified_at).select(*contacts.columns, *ADDED_COLUMNS)


def merged_snapshot(contacts: DataFrame, reached: DataFrame, revisions: DataFrame, finished: DataFrame, qualified_at: Column) -> DataFrame:
    """What ``checkpoint_snapshot`` gives for all ``contacts`` and the ``finished`` sites, from deltas with ``batch``.

    Only contacts that no batch has reached, and those without a site, are joined with results here. The revisions
    are few, so neither all contacts nor all reached ones are sorted by contact.
    """
    last = revisions.groupBy("contact_id").agg(F.max("batch").alias("batch"))
    newest = revisions.join(last, ["contact_id", "batch"], "left_semi").drop("batch")
    unchanged = reached.drop("batch").join(last.select("contact_id"), "contact_id", "left_anti")
    done = unchanged.unionByName(newest).filter(~F.col("s1_error").eqNullSafe(errors.NO_WEBSITE))
    rest = checkpoint_snapshot(contacts.join(done.select("contact_id"), "contact_id", "left_anti"), finished, qualified_at)
    return rest.unionByName(done.select(rest.columns))
