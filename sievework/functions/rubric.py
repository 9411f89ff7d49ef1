"""Phrase rules taken from the written question definitions.

A labelled heuristic that stands in for a model's judgement where no replies are available; it makes no
claim of accuracy. A question is answered true if one of its phrases occurs and none of its excluding ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    field: str
    phrases: str
    excludes: bool = False


# Phrases named in the definitions, as alternatives of one pattern.
MAJOR_PROCESSORS = r"stripe|square|worldpay|chase|first data|fiserv|paypal|adyen"

WEBSITE_RULES = (
    Rule("q1_sells_payments", r"payment processing|merchant services|card processing|merchant accounts?"),
    Rule("q2_is_independent_iso", r"independent iso|independent sales organi[sz]ation|msp|merchant service provider|sales agent"),
    Rule("q2_is_independent_iso", MAJOR_PROCESSORS, excludes=True),
    Rule("q3_zero_cost_pricing", r"zero[- ]cost|cash discount(?:ing|s)?|surcharg(?:e|es|ing)|dual pricing"),
    Rule("q4_value_added_products", r"pos systems?|point of sale|business funding|merchant cash advance|atms?|payroll|loyalty"),
    Rule("q5_has_agent_program", r"(?:agent|partner|referral) program|sub-iso|residual(?:s| income)?|white[- ]label|reseller"),
)


def evidence(text: Column, rules: Sequence[Rule], fields: Sequence[str]) -> dict[str, Column]:
    """One boolean column per field; a field without rules is false."""

    def occurs(excludes: bool, field: str) -> Column:
        phrases = [r.phrases for r in rules if r.field == field and r.excludes == excludes]
        if not phrases:
            return F.lit(False)
        return F.coalesce(text.rlike(rf"(?i)\b(?:{'|'.join(phrases)})\b"), F.lit(False))

    return {field: occurs(False, field) & ~occurs(True, field) for field in fields}
