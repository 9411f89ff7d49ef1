"""The prefix trie against a plain version, and running sums over ranges."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import prefix_trie as trie
from sievework.llm.running import running

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def plain(rows, rebuild):
    convs = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs[c].append((role or "", text or ""))
    convs = rebuilt(convs) if rebuild else convs
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    below, kids, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            kids[n[:-1]] += 1
    for n, own in members.items():
        for d in range(len(n) + 1):
            below[n[:d]] += (len(own) - 1) * words[n]
            leaves[n[:d]] += not kids[n]
    out = []
    for n, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(n))
        out.append((own[0], len(n), members[n[:-1]][0] if n else None, len(own), kids[n], leaves[n], below[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got_of(df):
    assert set(COLUMNS) <= set(df.columns)
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def log():
    random = np.random.default_rng(12)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {random.integers(0, 2)} {'x ' * (t % 3)}") for c in range(90) for t in range(random.integers(1, 7))]
    rows += [(200 + c, t, "user", "hot first" if t == 0 else f"then {c} {t}") for c in range(30) for t in range(3)]  # one turn, many follow
    rows += [(300 + c, t, None, f"copy {t}") for c in range(25) for t in range(4)]  # copies
    rows += [(400, t, "user", f"long {t}") for t in range(150)] + [(401, t, "user", f"long {t}") for t in range(149)]
    rows += [(None, 0, "user", "lost"), (500, None, None, None), (500, 1, None, "b"), (500, 1, None, "b"), (520, 0, "user", "a"), (525, 0, "user", "b"), (-7, 0, "user", "below"), (-20, 3, "user", "base")]
    rows += [(600, 0, "a", "bc"), (601, 0, "ab", "c"), (602, 5, "", None)]
    return rows


@pytest.mark.parametrize("rebuild,most_turns", [(True, trie.MOST_TURNS), (False, 40), (True, 3), (False, 1)])
def test_nodes(spark, rebuild, most_turns, monkeypatch):
    monkeypatch.setattr(trie, "IDS_PER_BLOCK", 4)
    rows = log()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("clash") for c in ("place", "words", "rep", "depth", "p1", "row")})
    wanted = plain([r for r in rows if r[0] is None or r[0] >= 0 or not rebuild], rebuild)  # c % 20 of negative ids is another in Python
    df = df.filter("conv_id is null or conv_id >= 0") if rebuild else df
    assert got_of(trie.prefix_trie(df, rebuild, most_turns)) == wanted


def test_turnless_alone_and_none(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(none).collect() == [] and trie.prefix_trie(none, rebuild=True).collect() == []
    # 3 % 20 = 3, and 0 is absent: its first turns go.
    ids = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1][:2]
    rows = [(c, 0, "user", "gone") for c in ids]
    assert got_of(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), rebuild=True)) == plain(rows, True)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert got_of(trie.prefix_trie(df, rebuild=True, most_turns=12)) == plain(rows, True)


def test_running_sums_of_groups_over_many_ranges(spark):
    rows = [(1, i, i * 7 % 31) for i in range(3000)] + [(k, i, k * i % 13) for k in range(2, 40) for i in range(k)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(3, "v")
    got = running(df, "k", [F.col("i")], ["v"], ["i"]).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for k, i, v in rows:
        by[k].append((i, v))
    for r in got:
        own = by[r["k"]][: r["i"] + 1]
        assert (r["place"], r["run_v"], r["run_i"]) == (len(own), int(np.bitwise_xor.reduce([v for _, v in own])), sum(i for i, _ in own))
