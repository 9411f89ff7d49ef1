"""Run summary, tier counts and the tier scorecard. Everything is summed per tier before it is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.errors import error_kind
from sievework.functions.rounding import round_half_even, to_fixed
from sievework.functions.scoring import TIER_LABELS, TIERS
from sievework.functions.stages import WEBSITE
from sievework.functions.text import strip


def tier_counts(scored: DataFrame) -> DataFrame:
    """Rows per tier, most frequent first, then by name."""
    return scored.groupBy("lead_tier").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lead_tier")


def run_summary(scored: DataFrame) -> DataFrame:
    """One row: totals, shares, mean score, tier map and number of website errors.

    Scores have two places, so they are summed as whole hundredths: exact, hence independent of task order.
    """
    error = F.col(WEBSITE.error_column)
    # A NULL error (the stage did not run) counts as one.
    is_error = F.coalesce(strip(error.cast("string")) != "", F.lit(True)) if WEBSITE.error_column in scored.columns else F.lit(False)
    per_tier = scored.groupBy("lead_tier").agg(
        F.count("*").alias("n"),
        F.count_if("hot_lead").alias("hot"),
        F.sum(F.rint(F.col("final_score") * 100)).alias("hundredths"),
        F.count_if(is_error).alias("errors"),
    )
    n = F.coalesce(F.sum("n"), F.lit(0))
    entries = F.collect_list(F.struct((-F.col("n")).alias("rank"), "lead_tier", "n"))  # five tiers
    totals = per_tier.agg(
        n.alias("total"),
        F.coalesce(F.sum("hot"), F.lit(0)).alias("hot_leads"),
        F.sum("hundredths").alias("hundredths"),
        F.coalesce(F.sum(F.when(F.col("lead_tier") == "disqualified", F.col("n"))), F.lit(0)).alias("disqualified"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("s1_errors"),
        F.sort_array(entries).alias("entries"),
    )
    total = F.col("total")
    return totals.select(
        "total",
        "hot_leads",
        F.when(total > 0, round_half_even(F.try_divide(F.col("hot_leads"), total) * 100, 1)).otherwise(0.0).alias("hot_lead_pct"),
        round_half_even(F.try_divide(F.col("hundredths") / 100, total), 2).alias("avg_final_score"),
        "disqualified",
        F.map_from_entries(F.transform("entries", lambda e: F.struct(e["lead_tier"], e["n"]))).alias("tiers"),
        "s1_errors",
    )


def tier_scorecard(scored: DataFrame) -> DataFrame:
    """The five tiers in fixed order, absent ones as 0, with their share of all rows as text."""
    spark = scored.sparkSession
    rows = [(i, t, TIER_LABELS[t]) for i, t in enumerate(TIERS, start=1)]
    tiers = spark.createDataFrame(rows, "position int, lead_tier string, label string")
    counts = scored.groupBy("lead_tier").agg(F.count("*").alias("n"))
    # Five rows on the left, at most five on the right, and five in the window.
    card = tiers.join(F.broadcast(counts), "lead_tier", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    card = card.withColumn("total", F.sum("n").over(Window.partitionBy()))
    share = F.coalesce(F.try_divide(F.col("n"), F.col("total")) * 100, F.lit(0.0))
    return card.select("position", "lead_tier", "label", "n", to_fixed(share, 1).alias("pct")).orderBy("position")


def error_counts(scored: DataFrame) -> DataFrame:
    """Rows per error kind; '' stands for no error."""
    kind = error_kind(F.col(WEBSITE.error_column))
    return scored.groupBy(kind.alias("error_kind")).agg(F.count("*").alias("n"))
