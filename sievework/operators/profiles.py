"""Shaping of person profiles, kept as VARIANT because their fields come in any shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Profile fields that go into a request, in order, and how much of the work history.
PROFILE_FIELDS = (
    "full_name",
    "headline",
    "summary",
    "job_title",
    "job_company_name",
    "experience",
    "skills",
    "industry",
    "location_country",
)
MAX_EXPERIENCE = 10


# JSON texts that count as no profile.
_EMPTY = r'^\s*(?:null|\{\s*\}|\[\s*\]|""|false|0)?\s*$'


def found_person(data: Column) -> Column:
    """The person in the JSON text of a response's data, as VARIANT; NULL if it is absent, empty or no JSON."""
    return F.when(~data.rlike(_EMPTY), F.try_parse_json(data))


def trimmed_profile(person: Column) -> Column:
    """JSON text of the profile's kept fields: those present, also as null, with a bounded work history."""
    fields = {name: F.try_variant_get(person, f"$.{name}", "variant") for name in PROFILE_FIELDS}
    entries = F.try_variant_get(person, "$.experience", "array<variant>")
    whole = fields["experience"]
    fields["experience"] = F.when(
        F.size(entries) > MAX_EXPERIENCE, F.parse_json(F.to_json(F.slice(entries, 1, MAX_EXPERIENCE)))
    ).otherwise(whole)
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]))
