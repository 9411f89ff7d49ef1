"""Sharing one evaluation among all contacts of a site or profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.answers import without_answer
from sievework.functions.stages import Stage
from sievework.operators.lookup import spread_left_join


def merge_stage_results(
    contacts: DataFrame, results: DataFrame, stage: Stage, key: str, counts: DataFrame | None = None
) -> DataFrame:
    """Left-join a stage's columns to contacts by ``key``; contacts without a result get NULLs.

    ``counts`` (``key, n``) saves counting the contacts per key again.
    """
    return spread_left_join(contacts, results.select(key, *stage.result_columns), key, "contact_id", counts)


def fill_missing_stage(merged: DataFrame, stage: Stage, key: str, error: str) -> DataFrame:
    """Give contacts that have no key the stage's defaults and ``error``."""
    defaults = without_answer(stage, F.lit(error))
    absent = F.col(key).isNull()
    filled = {c: F.when(absent, defaults[c]).otherwise(F.col(c)) for c in stage.result_columns}
    return merged.withColumns(filled)


def default_rows(contacts: DataFrame, evaluated: DataFrame, stage: Stage, error: str) -> DataFrame:
    """The standalone form: default results for contacts absent from ``evaluated``."""
    absent = contacts.select("contact_id").join(evaluated.select("contact_id"), "contact_id", "left_anti")
    defaults = without_answer(stage, F.lit(error))
    return absent.select("contact_id", *[defaults[c].alias(c) for c in stage.result_columns])
