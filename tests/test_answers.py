import itertools
import json

import pytest
from pyspark.sql import functions as F

from sievework.functions.answers import with_decoded
from sievework.functions.stages import PERSON, WEBSITE

GOOD = '{"q1_sells_payments":true,"q2_is_independent_iso":true}'
RAW = [
    GOOD, f"  {GOOD}\n", f" {GOOD}　", f"{GOOD} x", f"{GOOD}{GOOD}", f"{GOOD},", f"{GOOD}]", f"[{GOOD}", f"```json\n{GOOD}\n```",
    "", " ", "{}", "[]", "null", "true", "1", '"text"', "[true]", "{", "}", '{"a":}', "{'a':1}", '{"a":1,}', "{a:1}", '{"a":01}',
    '{"q1_sells_payments":"false","q2_is_independent_iso":1}',
    '{"q1_sells_payments":0,"q2_is_independent_iso":0.0,"q3_zero_cost_pricing":-1,"q4_value_added_products":1e-3,"q5_has_agent_program":1e400}',
    '{"q1_sells_payments":"","q2_is_independent_iso":[],"q3_zero_cost_pricing":{},"q4_value_added_products":null,"q5_has_agent_program":" "}',
    '{"q1_sells_payments":[0],"q2_is_independent_iso":{"a":null},"q3_zero_cost_pricing":"0","q4_value_added_products":-0.0}',
    '{"q1_sells_payments":true,"q1_sells_payments":false,"q2_is_independent_iso":true}',
    '{"q1_sells_payments":12345678901234567890123456789012345678901234567890}',
    '{"reasoning":"' + "é" * 400 + '"}', '{"reasoning":null}', '{"reasoning":true}', '{"reasoning":12}', '{"reasoning":"a\\nb\\"c\\u00e9"}',
    '{"reasoning":"a\nb"}', '// c\n{}', '{"nested":{"q1_sells_payments":true}}', '{"q1_sells_payments":true},"x"]', '{"q1_sells_payments":true}, {"a":1}',
]


def expected(raw):
    names = [q.field for q in WEBSITE.questions]
    try:
        data = json.loads(raw.strip())
    except json.JSONDecodeError:
        return [False] * 5 + ["", 0, "json_parse_error"]
    if not isinstance(data, dict):
        return [False] * 5 + ["", 0, "json_not_object"]
    flags = [bool(data.get(n, False)) for n in names]
    score = 6 + flags[2] + flags[3] + 2 * flags[4] if flags[0] and flags[1] else 0
    return flags + [str(data.get("reasoning", ""))[:300], score, ""]


def test_decoding_equals_python(spark):
    df = spark.createDataFrame(list(enumerate(RAW)), "id int, raw_answer string")
    rows = with_decoded(df, WEBSITE).orderBy("id").collect()
    columns = [q.column for q in WEBSITE.questions] + ["s1_reasoning", "s1_score", "s1_error"]
    for r in rows:
        assert [r[c] for c in columns] == expected(RAW[r["id"]]), RAW[r["id"]]


def test_missing_reply_stays_null(spark):
    row = with_decoded(spark.createDataFrame([(1, None)], "id int, raw_answer string"), WEBSITE).first()
    assert set(row.asDict().values()) == {1, None}


@pytest.mark.parametrize("stage", [WEBSITE, PERSON], ids=["website", "person"])
def test_every_combination_of_answers(spark, stage):
    combos = list(itertools.product([False, True], repeat=5))
    raws = [(json.dumps(dict(zip([q.field for q in stage.questions], c))),) for c in combos]
    decoded = with_decoded(spark.createDataFrame(raws, "raw_answer string"), stage)
    points = [q.points for q in stage.questions]
    assert sum(points) == 10
    seen = {tuple(r[q.column] for q in stage.questions): r[stage.score_column] for r in decoded.collect()}
    assert seen == {c: sum(p for p, yes in zip(points, c) if yes) if c[0] and c[1] else 0 for c in combos}


def test_titles(spark):
    titles = {'"CEO"': "CEO", "null": "None", "true": "True", "7": "7", '"' + "x" * 300 + '"': "x" * 200, '["a"]': '["a"]'}
    df = spark.createDataFrame([(i, f'{{"title":{t}}}') for i, t in enumerate(titles)], "id int, raw_answer string")
    rows = with_decoded(df, PERSON).orderBy("id").select("s2_title").collect()
    assert [r[0] for r in rows] == list(titles.values())
    assert with_decoded(spark.createDataFrame([("{}",)], "raw_answer string"), PERSON).select(F.col("s2_title")).first()[0] == ""
