"""Request texts. ``{company}``-style slots are filled per row; both templates can be replaced by the caller."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Request size and texts.
MAX_TOKENS = 400

WEBSITE_SYSTEM = """\
You are an expert business development analyst specialising in the independent \
payment processing and merchant services industry. You will be given text scraped \
from a company website. Answer five yes/no qualification questions about the company.

Answer ONLY with a valid JSON object — no markdown, no explanation, no extra text.
"""

WEBSITE_USER = """\
Company name: {company}
Website URL: {url}

--- BEGIN WEBSITE TEXT ---
{text}
--- END WEBSITE TEXT ---

Answer ONLY based on the website text above. Return a JSON object with exactly these keys:

{{
  "q1_sells_payments": true or false,
  "q2_is_independent_iso": true or false,
  "q3_zero_cost_pricing": true or false,
  "q4_value_added_products": true or false,
  "q5_has_agent_program": true or false,
  "reasoning": "one sentence (max 200 chars) explaining your answers"
}}

Definitions — answer true only when there is clear evidence:

q1_sells_payments:
  TRUE  if the company actively sells or provides payment processing / merchant
        services TO other businesses (i.e. they are on the selling side).
  FALSE if the company merely accepts payments as a regular merchant, or is
        unrelated to payments.

q2_is_independent_iso:
  TRUE  if the company appears to be an independent ISO, MSP, or sales agent —
        a smaller, independently operated payments business.
  FALSE if they appear to be a major processor (Stripe, Square, Worldpay, Chase,
        First Data / Fiserv, etc.) or a non-payments company.

q3_zero_cost_pricing:
  TRUE  if the site mentions zero-cost processing, cash discounting, surcharging,
        dual pricing, or any program that passes processing fees to the cardholder.
  FALSE otherwise.

q4_value_added_products:
  TRUE  if they offer products BEYOND basic card processing — such as POS systems,
        business funding / merchant cash advance, ATM services, payroll, or loyalty.
  FALSE if they appear to offer card processing only.

q5_has_agent_program:
  TRUE  if the site explicitly mentions a sales agent program, ISO partner program,
        referral program, sub-ISO recruiting, residual income for agents, or
        white-label / reseller opportunities.
  FALSE otherwise.
"""

PERSON_SYSTEM = """\
You are an expert business development analyst specialising in the independent \
payment processing and merchant services industry. You will be given a LinkedIn \
profile in JSON format. Answer five yes/no qualification questions about whether \
this person is a high-value ISO / merchant services contact.

Answer ONLY with a valid JSON object — no markdown, no explanation, no extra text.
"""

PERSON_USER = """\
Contact name: {name}

--- BEGIN LINKEDIN PROFILE (JSON) ---
{profile_json}
--- END LINKEDIN PROFILE ---

Answer ONLY based on the LinkedIn data above. Return a JSON object with exactly these keys:

{{
  "q1_person_sells_payments": true or false,
  "q2_person_at_independent_iso": true or false,
  "q3_person_is_decision_maker": true or false,
  "q4_person_has_payments_experience": true or false,
  "q5_person_manages_team": true or false,
  "title": "current job title (max 80 chars, empty string if not found)",
  "reasoning": "one sentence (max 200 chars) explaining your answers"
}}

Definitions — answer true only when there is clear evidence:

q1_person_sells_payments:
  TRUE  if the person's current role involves actively selling or providing
        payment processing or merchant services to other businesses — e.g. they
        are an ISO agent, merchant services rep, payments sales executive, or
        owner of a merchant services company.
  FALSE if they are a regular business owner who only accepts payments, a
        software engineer, marketer, or otherwise not in payments sales.

q2_person_at_independent_iso:
  TRUE  if they appear to work at or own an independent ISO, MSP, or small
        payments agency — not at a major processor (Stripe, Square, Worldpay,
        Chase, Fiserv, First Data, PayPal, Adyen, etc.).
  FALSE otherwise.

q3_person_is_decision_maker:
  TRUE  if their current title includes Owner, Founder, President, CEO, COO,
        VP, Director, Partner, or Head of — at a payments-related company.
  FALSE otherwise.

q4_person_has_payments_experience:
  TRUE  if their work history shows 2 or more years in roles where payment
        processing or merchant services was a primary responsibility.
  FALSE otherwise.

q5_person_manages_team:
  TRUE  if their profile mentions managing, building, or leading a sales team,
        agent network, or ISO channel (e.g. "manage a team of agents",
        "recruited 20+ agents", "built ISO channel").
  FALSE otherwise.
"""


@dataclass(frozen=True)
class Template:
    system: str
    user: str


WEBSITE_REQUEST = Template(WEBSITE_SYSTEM, WEBSITE_USER)
PERSON_REQUEST = Template(PERSON_SYSTEM, PERSON_USER)


def filled(template: str, slots: dict[str, Column]) -> Column:
    """The template with each ``{slot}`` replaced by a column; ``{{`` and ``}}`` are literal braces."""
    columns = []
    for token in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        name = token[1:-1]
        if token in ("{{", "}}"):
            columns.append(F.lit(token[0]))
        elif re.fullmatch(r"\{\w+\}", token):
            columns.append(slots[name])
        else:
            columns.append(F.lit(token))
    return F.concat(*columns)
