"""Gates, final score, tier and hot flag."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.rounding import round_array_style
from sievework.functions.stages import WEBSITE
from sievework.functions.text import strip

# Tiers, best first, and the upper score bounds of the lower ones.
TIERS = ("ideal", "hot", "warm", "cold", "disqualified")
TIER_LABELS = {
    "ideal": "Ideal ICP",
    "hot": "Hot",
    "warm": "Warm",
    "cold": "Cold",
    "disqualified": "Disqualified",
}
TIER_UPPER_BOUNDS = (("cold", 4), ("warm", 6), ("hot", 8))
HOT_TIERS = ("hot", "ideal")

_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def flag(df: DataFrame, name: str) -> Column:
    """A boolean column that may be text: true only for "true" in any case; false if the column is missing."""
    if name not in df.columns:
        return F.lit(False)
    return F.coalesce(F.lower(F.col(name).cast("string")) == "true", F.lit(False))


def stage_ran(df: DataFrame, error_column: str) -> Column:
    """True where the stage left a blank error. NULL means it did not run; a missing column means it did."""
    if error_column not in df.columns:
        return F.lit(True)
    return F.coalesce(strip(F.col(error_column).cast("string")) == "", F.lit(False))


def number(df: DataFrame, name: str) -> Column:
    """A column as double, 0 where it is no number or missing."""
    if name not in df.columns:
        return F.lit(0.0)
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        value = F.when(value.rlike(_NUMBER), strip(value).try_cast("double"))
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def tier(score: Column, disqualified: Column) -> Column:
    chain = F.when(disqualified, "disqualified")
    for name, bound in TIER_UPPER_BOUNDS:
        chain = chain.when(score <= bound, name)
    return chain.otherwise("ideal")


def with_scores(df: DataFrame) -> DataFrame:
    """Add ``final_score``, ``lead_tier`` and ``hot_lead`` from the website stage's columns."""
    ran = stage_ran(df, WEBSITE.error_column)
    failed_gate = F.lit(False)
    for gate in WEBSITE.gates:
        failed_gate = failed_gate | ~flag(df, gate.column)
    disqualified = ran & failed_gate
    score = F.when(ran & ~disqualified, number(df, WEBSITE.score_column)).otherwise(0.0)
    scored = df.select("*", round_array_style(score, 2).alias("final_score"), disqualified.alias("_disqualified"))
    scored = scored.withColumn("lead_tier", tier(F.col("final_score"), F.col("_disqualified"))).drop("_disqualified")
    return scored.withColumn("hot_lead", F.col("lead_tier").isin(*HOT_TIERS))


@dataclass(frozen=True)
class Weights:
    """The documented two-stage score, an alternative to the point model above."""

    website: float = 0.4
    person: float = 0.6
    hot_from: float = 7.0

    def __post_init__(self) -> None:
        if not (0.0 < self.website < 1.0 and 0.0 < self.person < 1.0):
            raise ValueError("Both weights must lie between 0 and 1.")
        if abs(self.website + self.person - 1.0) > 1e-6:
            raise ValueError(f"The weights must sum to 1.0, got {self.website + self.person}.")


def with_weighted_score(df: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Add ``weighted_score`` and ``weighted_hot`` from both stage scores."""
    score = number(df, "s1_score") * weights.website + number(df, "s2_score") * weights.person
    return df.withColumn("weighted_score", score).withColumn("weighted_hot", F.col("weighted_score") >= weights.hot_from)
