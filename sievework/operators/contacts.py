"""Row selection on contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.keys import normal_url
from sievework.functions.text import is_blank

REQUIRED_COLUMNS = ("name", "company")
OPTIONAL_COLUMNS = ("website", "linkedin_url")


def require_columns(df: DataFrame) -> DataFrame:
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"Contacts lack required columns: {missing}")
    return df


def add_optional_columns(df: DataFrame) -> DataFrame:
    absent = [F.lit("").alias(c) for c in OPTIONAL_COLUMNS if c not in df.columns]
    return df.select("*", *absent) if absent else df


def reject_result_columns(df: DataFrame, added: list[str]) -> DataFrame:
    clashing = [c for c in added if c in df.columns]
    if clashing:
        raise ValueError(f"Contacts already hold result columns: {clashing}")
    return df


def _nothing_to_look_up():
    return F.coalesce(is_blank(F.col("website")), F.lit(True)) & F.coalesce(is_blank(F.col("linkedin_url")), F.lit(True))


def kept(contacts: DataFrame) -> DataFrame:
    """Contacts with a website or a profile URL."""
    return contacts.filter(~_nothing_to_look_up())


def skipped(contacts: DataFrame) -> DataFrame:
    """Contacts with neither."""
    return contacts.filter(_nothing_to_look_up())


def with_website(contacts: DataFrame) -> DataFrame:
    return contacts.filter(~is_blank(F.col("website")))


def with_profile_url(contacts: DataFrame) -> DataFrame:
    return contacts.filter(~is_blank(F.col("linkedin_url")))


def with_lookup_keys(contacts: DataFrame) -> DataFrame:
    """Add ``site`` and ``profile``, the normal URLs contacts share results by; NULL where blank."""

    def key(column: str):
        url = normal_url(F.col(column))
        return F.when(url != "", url)

    return contacts.select("*", key("website").alias("site"), key("linkedin_url").alias("profile"))
