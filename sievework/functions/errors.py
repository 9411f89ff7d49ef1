"""Stage error texts: ``kind`` or ``kind: detail``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The error kinds.
NO_WEBSITE = "no_website"
FETCH_ERROR = "fetch_error"
EMPTY_PAGE = "empty_page"
JSON_PARSE_ERROR = "json_parse_error"
NO_LINKEDIN_URL = "no_linkedin_url"
PROFILE_ERROR = "pdl_error"
PROFILE_NOT_FOUND = "profile_not_found"
API_ERROR = "api_error"
# Ours: a reply that is JSON but no object, and a reply not present in the answers table yet.
JSON_NOT_OBJECT = "json_not_object"
NO_ANSWER = "no_answer"


def error_kind(error: Column) -> Column:
    """The part before the first colon."""
    return F.substring_index(error, ":", 1)


def prefixed(kind: str, detail: Column) -> Column:
    """``kind: detail``, or NULL when there is no detail."""
    return F.when(detail.isNotNull() & (detail != ""), F.concat(F.lit(kind + ": "), detail))
