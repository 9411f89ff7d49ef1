"""Substring dedup against brute force over all windows."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.llm import substrings
from sievework.llm.substrings import Settings

SCHEMA = "doc_id long, text string"


def plain(rows, window):
    """rows: (doc_id, text) in the order of documents, each once."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen, out = set(), []
    for own in words:
        gone = set()
        for i in range(len(own) - window + 1):
            body = tuple(own[i : i + window])
            if body in seen:
                gone.update(range(i, i + window))
            seen.add(body)
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def got_of(df):
    return [(r["doc_id"], (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"])) for r in df.collect()]


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, passage), (2, f"before {passage}\tafter"), (3, passage), (4, None), (5, ""), (6, " \t "), (7, "a " * 100), (8, passage.upper()),
        (9, f"{passage} x {passage}"), (10, "short text"), (11, "short text"), (12, " ".join(f"w{i}" for i in range(5, 24))), (13, " ".join(f"w{i}" for i in range(5, 26))),
        (14, "a " * 19), (15, "日本 " + passage), (16, " ".join(f"n{i}" for i in range(3000)) + " " + passage),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4, "doc_id")
    docs = docs.withColumns({c: F.lit("clash") for c in ("row", "digest1", "number", "ranges", "kept", "part", "at", "span")})
    got = dict(got_of(substrings.remove_repeats(docs)))
    for (doc_id, _), want in zip(rows, plain(rows, 20), strict=True):
        assert got[doc_id] == want, doc_id
    bare = substrings.remove_repeats(docs, keep_text=False).collect()
    assert {r["kept"] for r in bare} == {None} and {r["doc_id"]: r["kept_sha256"] for r in bare} == {k: v[2] for k, v in got.items()}


def test_rows_without_id_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"w{i}" for i in range(10, 60))
    rows = [(None, text), (5, text), (5, text), (5, other), (None, "alone " + text)]
    got = got_of(substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert len(got) == 5
    assert sorted(v[1] for k, v in got if k is None) == [40, 40]  # both after document 5
    fives = [v for k, v in got if k == 5]
    assert len(fives) == 3 and len(set(fives)) == 2  # equal rows are alike
    assert sorted({v[:2] for v in fives}) in ([(40, 0), (50, 30)], [(40, 30), (50, 0)])  # one of the texts comes first


def test_no_rows(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    assert got_of(substrings.remove_repeats(spark.createDataFrame([(1, None)], SCHEMA))) == [(1, (0, 0, hashlib.sha256(b"").hexdigest(), ""))]


@pytest.mark.parametrize("first,window,seed", [(5, 20, 1), (2, 8, 2), (1, 4, 3), (3, 6, 4), (4, 16, 5)])
def test_random_texts(spark, first, window, seed, monkeypatch):
    random = np.random.default_rng(seed)
    monkeypatch.setattr(substrings, "_ROWS_AT_ONCE", 200)  # tasks send several times
    common = [" ".join(f"c{x}" for x in random.integers(0, 40, random.integers(3, 60))) for _ in range(12)]
    rows = []
    for doc_id in range(120):
        parts = [" ".join(f"v{x}" for x in random.integers(0, 4 if random.random() < 0.3 else 400, random.integers(0, 30))) for _ in range(3)]
        parts += [common[k] for k in random.integers(0, len(common), random.integers(0, 3))]
        random.shuffle(parts)
        rows.append((doc_id * 7, rows[-1][1] if rows and random.random() < 0.1 else " ".join(parts)))
    got = dict(got_of(substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), Settings(window, first))))
    wanted = plain(rows, window)
    for (doc_id, _), want in zip(rows, wanted, strict=True):
        assert got[doc_id] == want, doc_id
    assert sum(w[1] for w in wanted) > 0


def test_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    got = dict(got_of(substrings.remove_repeats(docs.repartition(6))))
    assert [got[doc_id] for doc_id, _ in rows] == plain(rows, 20)


def test_long_documents_take_several_numbers(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_BITS", 6)
    rows = [(i, " ".join(f"w{k % 150}" for k in range(i, i + 400))) for i in range(4)] + [(9, " ".join(f"x{k}" for k in range(300)))]
    got = dict(got_of(substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(2))))
    assert [got[doc_id] for doc_id, _ in rows] == plain(rows, 20)


def test_lengths_double():
    assert Settings().lengths() == [5, 10]
    for window, first in ((20, 3), (20, 4 * 5 * 2), (12, 4), (20, 0)):
        with pytest.raises((ValueError, ZeroDivisionError)):
            Settings(window, first).lengths()


@given(st.lists(st.integers(0, 5), min_size=1, max_size=30), st.integers(1, 30))
def test_sliding(values, n):
    if n <= len(values):
        want = [min(values[i : i + n]) for i in range(len(values) - n + 1)]
        assert substrings.sliding(np.minimum, np.array(values), n).tolist() == want
