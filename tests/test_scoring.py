import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.functions.scoring import TIERS, Weights, tier, with_scores, with_weighted_score
from sievework.operators.summary import error_counts, run_summary, tier_counts, tier_scorecard


def scored_by_pandas(rows):
    """The scoring rules in pandas, for text columns."""
    df = pd.DataFrame(rows, columns=["q1", "q2", "score", "error"])
    ran = df["error"].map(lambda e: e is not None and e.strip() == "")
    yes = lambda c: df[c].map(lambda v: v is not None and v.lower() == "true")
    disqualified = ran & ~(yes("q1") & yes("q2"))
    number = pd.to_numeric(df["score"], errors="coerce").fillna(0)
    final = number.where(ran & ~disqualified, 0.0).round(2)
    return list(zip(final, disqualified))


def test_scores_of_text_columns(spark):
    booleans = ["true", "True", "TRUE", " true ", "false", "1", None]
    scores = ["10", "6.0", "x", "nan", "", None, "7.125", "2.675", "8.005", " 6 ", "1e1", "-3", "1d", "0x10"]
    errors = ["", "  ", " ", "empty_page", None]
    rows = [(q, "true", s, e) for q in booleans for s in scores for e in errors] + [("true", q, "8", "") for q in booleans]
    schema = "id int, s1_sells_payments string, s1_is_independent_iso string, s1_score string, s1_error string"
    found = with_scores(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)).orderBy("id").collect()
    for row, r, (final, disqualified) in zip(rows, found, scored_by_pandas(rows)):
        if row[2] == "0x10":  # hexadecimal text is no score
            continue
        assert r["final_score"] == final, row
        assert (r["lead_tier"] == "disqualified") == disqualified, row
        assert r["hot_lead"] == (r["lead_tier"] in ("hot", "ideal"))


def test_tier_bounds(spark):
    bounds = {0.0: "cold", 4.0: "cold", 4.01: "warm", 6.0: "warm", 6.01: "hot", 8.0: "hot", 8.01: "ideal", 10.0: "ideal"}
    df = spark.createDataFrame([(s,) for s in bounds], "s double")
    assert {r["s"]: r["t"] for r in df.select("s", tier(F.col("s"), F.lit(False)).alias("t")).collect()} == bounds
    assert df.select(tier(F.col("s"), F.lit(True))).distinct().collect()[0][0] == "disqualified"


def test_missing_columns(spark):
    # Without an error column the stage counts as run, without answers its gates fail.
    row = with_scores(spark.createDataFrame([(1,)], "id int")).first()
    assert (row["final_score"], row["lead_tier"], row["hot_lead"]) == (0.0, "disqualified", False)


def test_typed_columns(spark):
    schema = "s1_sells_payments boolean, s1_is_independent_iso boolean, s1_score int, s1_error string"
    rows = [(True, True, 9, ""), (True, False, 0, ""), (None, None, None, None), (False, False, 0, "no_website")]
    found = with_scores(spark.createDataFrame(rows, schema)).collect()
    assert [(r["final_score"], r["lead_tier"]) for r in found] == [(9.0, "ideal"), (0.0, "disqualified"), (0.0, "cold"), (0.0, "cold")]


def test_weights(spark):
    for bad in ((0.0, 1.0), (0.5, 0.6), (1.2, -0.2)):
        with pytest.raises(ValueError):
            Weights(*bad)
    df = spark.createDataFrame([(10, 5), (7, 7), (None, 10)], "s1_score int, s2_score int")
    rows = with_weighted_score(df).collect()
    assert [(round(r["weighted_score"], 6), r["weighted_hot"]) for r in rows] == [(7.0, True), (7.0, True), (6.0, False)]


SCORED = "s1_error string, final_score double, lead_tier string, hot_lead boolean"


def test_summary(spark):
    rows = [("", 9.0, "ideal", True), ("", 8.0, "hot", True), ("", 6.0, "warm", False), (None, 0.0, "cold", False)]
    rows += [("no_website", 0.0, "cold", False), (" ", 0.0, "disqualified", False), ("fetch_error: a: b", 0.0, "cold", False)]
    df = spark.createDataFrame(rows, SCORED)
    row = run_summary(df).first().asDict()
    assert row == {
        "total": 7,
        "hot_leads": 2,
        "hot_lead_pct": round(2 / 7 * 100, 1),
        "avg_final_score": round(23 / 7, 2),
        "disqualified": 1,
        "tiers": {"cold": 3, "disqualified": 1, "hot": 1, "ideal": 1, "warm": 1},
        "s1_errors": 3,
    }
    assert [tuple(r) for r in tier_counts(df).collect()] == [("cold", 3), ("disqualified", 1), ("hot", 1), ("ideal", 1), ("warm", 1)]
    assert {r["error_kind"]: r["n"] for r in error_counts(df.filter("s1_error is not null")).collect()} == {
        "": 3, " ": 1, "no_website": 1, "fetch_error": 1,
    }


def test_empty_summary_and_scorecard(spark):
    df = spark.createDataFrame([], SCORED)
    row = run_summary(df).first()
    assert (row["total"], row["hot_lead_pct"], row["avg_final_score"], row["tiers"], row["s1_errors"]) == (0, 0.0, None, {}, 0)
    card = tier_scorecard(df).collect()
    assert [(r["lead_tier"], r["n"], r["pct"]) for r in card] == [(t, 0, "0.0") for t in TIERS]


def test_scorecard_rounds_ties_up(spark):
    # 1 of 16 is 6.25 percent.
    df = spark.createDataFrame([("", 9.0, "ideal", True)] + [("x", 0.0, "cold", False)] * 15, SCORED)
    card = {r["lead_tier"]: (r["n"], r["pct"]) for r in tier_scorecard(df).collect()}
    assert card["ideal"] == (1, "6.3") and card["cold"] == (15, "93.8") and card["hot"] == (0, "0.0")
