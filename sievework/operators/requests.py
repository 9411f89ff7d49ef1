"""Requests to an external answer service, and answers by a plugged-in provider."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.prompts import MAX_TOKENS, PERSON_REQUEST, WEBSITE_REQUEST, Template, filled
from sievework.functions.rubric import Rule, evidence
from sievework.functions.stages import Stage

REQUEST_COLUMNS = ("cache_key", "system", "user", "max_tokens")


def _requests(df: DataFrame, template: Template, slots: dict) -> DataFrame:
    return df.select(
        "cache_key",
        F.lit(template.system).alias("system"),
        filled(template.user, slots).alias("user"),
        F.lit(MAX_TOKENS).alias("max_tokens"),
    )


def website_requests(pages: DataFrame, template: Template = WEBSITE_REQUEST) -> DataFrame:
    """One request per site; needs ``company``, ``url`` and a non-blank ``page_text``."""
    slots = {"company": F.coalesce("company", F.lit("")), "url": F.col("url"), "text": F.col("page_text")}
    return _requests(pages, template, slots)


def person_requests(people: DataFrame, template: Template = PERSON_REQUEST) -> DataFrame:
    """One request per profile; needs ``name`` and ``profile_json``."""
    slots = {"name": F.coalesce("name", F.lit("")), "profile_json": F.col("profile_json")}
    return _requests(people, template, slots)


def answers_from(requests: DataFrame, provider: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
    """Answers by a Python provider, which maps batches of requests to ``answer_key, raw_answer`` batches."""
    return requests.mapInPandas(provider, "answer_key string, raw_answer string")


def answers_from_rubric(texts: DataFrame, text: str, rules: tuple[Rule, ...], stage: Stage) -> DataFrame:
    """Answers by the phrase rules, in the shape a model's replies have; nothing leaves the JVM."""
    found = evidence(F.col(text), rules, [q.field for q in stage.questions])
    reply = F.to_json(F.struct(*[c.alias(f) for f, c in found.items()], F.lit("phrase rules").alias("reasoning")))
    return texts.select(F.col("cache_key").alias("answer_key"), reply.alias("raw_answer"))
