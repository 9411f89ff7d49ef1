"""The pipeline, stage by stage, against plain versions; and the registered queries against their SQL."""

from collections import Counter

import numpy as np
import pytest
from compare import connect, difference, spark_rows, sql_rows
from test_operators import plain_components, plain_mix
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from sievework.llm import language, quality
from sievework.llm.oracle import ORACLE_SQL
from sievework.llm.queries import QUERIES
from sievework.llm.tables import given, stored
from sievework.llm.tokens import vocabulary_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [given(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), name.replace(" ", "-")))
    return docs


def test_filters_keep_what_their_scores_say(spark, stages):
    documents, good, known = stages[:3]
    scores = quality.score_quality(documents, given(spark, SF, "labels")).collect()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scores if r["score"] >= 0.3}
    langs = language.identify(good).collect()
    assert {r["doc_id"] for r in known.collect()} == {r["doc_id"] for r in langs if r["lang_pred"] != "und" and r["score"] >= language.LEAST}
    labels = {r["doc_id"]: r["quality"] for r in given(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in known.collect()}
    assert np.mean([d in kept for d, q in labels.items() if q == 1]) > 0.97
    for df in stages[1:5]:
        assert df.schema == documents.schema


def test_one_of_each_group_stays(stages):
    before, after = stages[2:4]
    of, _ = plain_components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(d for d, c in of.items() if d == c)


def test_mix_and_packing(stages):
    before, mixed, packed = stages[3:6]
    rows = {r["doc_id"]: r for r in before.collect()}
    size = {d: len(r["text"].split()) for d, r in rows.items()}
    _, target = plain_mix([(r["source"], size[d]) for d, r in rows.items()])
    copies = Counter(r["doc_id"] for r in mixed.collect())
    for source, words in target.items():
        own = [d for d, r in rows.items() if r["source"] == source]
        assert abs(sum(copies[d] * size[d] for d in own) - words) <= max(size[d] for d in own)
    whole = Tokenizer.from_file(vocabulary_path())
    lengths = Counter()
    for r in packed.collect():
        lengths[r["doc_id"]] += r["length"]
    assert lengths == Counter({d: n * (len(whole.encode(rows[d]["text"], add_special_tokens=False).ids) + 1) for d, n in copies.items() if n})


def test_run_and_registration(spark, stages):
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {k.partition("_")[0] + "_" for k in QUERIES} and "pipeline" in names
    got = names["pipeline"](spark, SF)
    assert got.columns == stages[5].columns
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, got.select(key).collect())) == Counter(map(tuple, stages[5].select(key).collect()))


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_sql(spark, name):
    assert difference(spark_rows(QUERIES[name](spark, SF)), sql_rows(connect(SF), ORACLE_SQL[name])) == ""
