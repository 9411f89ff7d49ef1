"""Cache keys and the URLs used to look pages and profiles up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import strip


def normal_url(url: Column) -> Column:
    """The form under which URLs are compared: stripped and lowercased."""
    return F.lower(strip(url))


def cache_key(*parts: Column) -> Column:
    """SHA-256 hex of the non-empty parts, stripped, lowercased and joined with ``|``.

    A part is dropped only if it is empty before stripping, so a blank part still adds a separator.
    """
    kept = [F.when(p != "", F.lower(strip(p))) for p in parts]
    return F.sha2(F.concat_ws("|", *kept), 256)


def with_scheme(url: Column) -> Column:
    """Prefix ``https://`` to a non-empty, stripped URL that names no http(s) scheme; keeps the case."""
    lowered = F.lower(url)
    has_scheme = lowered.startswith("http://") | lowered.startswith("https://")
    return F.when((url == "") | has_scheme, url).otherwise(F.concat(F.lit("https://"), url))


def fetch_url(url: Column) -> Column:
    """The join key between a contact's website and the crawl table."""
    return with_scheme(normal_url(url))
