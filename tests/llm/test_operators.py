"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; and brute force."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievework.llm import ann, chat, language, lm, mixing, near_texts, near_vectors, packing, quality, tokens
from sievework.llm.components import components
from sievework.llm.hashing import word_hashes
from sievework.llm.near_texts import Settings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} other{i % 1013}" for i in range(30_000))


def documents(spark, rows, **extra):
    df = spark.createDataFrame([(*r, None) if len(r) == 4 else r for r in rows], DOCS)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}).repartition(3, "n_chars", "text")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "The cat sat on the mat", "en", "a"), (2, "The cat sat on the mat", "en", "a"), (3, None, None, None), (4, "", "en", "b"),
        (5, " \t\n", None, "b"), (6, "12 !!", "en", None), (7, LONG, "en", "a"), (None, "le chat noir dort ici", "fr", "b"),
        (8, "le chat est sur la table", "fr", "b"), (8, "le chat est sur la table", "fr", "b"), (9, "Ünïcode 日本 😀 <|endoftext|> x", "de", "c"),
    ]
    return documents(spark, rows, size="clash", score=0.5, kept=True, draw="z", component="c", rep=7, n=1, held_out="?").cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def columns(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


# -- language-model scores


def test_scores_of_words(spark, odd, none):
    s = lm.Settings(words=24, buckets=8, group=8, batch=16, masked=0.5, rounds=1)
    got = lm.score_documents(odd, s).collect()
    assert len(got) == 11
    by_id = {r["doc_id"]: r for r in got}
    for doc_id in (3, 4, 5):
        assert (by_id[doc_id]["n_tokens"], by_id[doc_id]["log_probability"], by_id[doc_id]["score"]) == (0, 0.0, None)
    assert by_id[1]["n_tokens"] == 6 and by_id[1]["log_probability"] == by_id[2]["log_probability"] < 0
    assert abs(by_id[7]["score"] - by_id[7]["log_probability"] / 60_000) < 1e-9
    assert lm.score_documents(none, s).collect() == []


def test_network_learns_order(spark):
    pattern = "a b c d e f g h " * 50
    rows = [(i, pattern, "en", "a") for i in range(40)] + [(100, "a b c d e f g h a b c d", "en", "a"), (101, "d a c b h g f e b a d c", "en", "a")]
    got = {r["doc_id"]: r["score"] for r in lm.score_documents(documents(spark, rows), lm.Settings(words=8, buckets=8, group=8, batch=64)).collect()}
    assert got[100] > got[101] + 1


def test_words_of_a_bucket_have_their_own_probabilities(spark):
    words = [f"w{i}" for i in range(150)]
    rows = [(i, w, "en", "a") for i, w in enumerate(words)]
    rows += [(1000 + i, " ".join(words[:: 1 + i % 5] + ["w77"] * 20), "en", "a") for i in range(30)]
    rows += [(2000, "w1 w77 w77 w77", "en", "a"), (2001, "w1 w77 w77 w77", "en", "a")]
    for held in (1 << 20, 40):  # all counts held by tasks; most joined
        s = lm.Settings(words=16, buckets=16, group=8, batch=64, held=held)
        got = {r["doc_id"]: r for r in lm.score_documents(documents(spark, rows), s).collect()}
        assert len(got) == len(rows)
        assert abs(sum(np.exp(got[i]["log_probability"]) for i in range(150)) - 1) < 1e-4  # all words, of the same neighbours
        assert got[2000]["log_probability"] == got[2001]["log_probability"]


def test_scores_word_by_word(spark, odd):
    s = lm.Settings(words=24, buckets=8, group=8, batch=512, rounds=2)
    model = lm.learned_model(odd, s)
    network = lm.Network(s, model.flat)
    rows = odd.collect()
    texts = {r["text"]: (r["text"] or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split() for r in rows}
    counts = Counter(w for r in rows for w in texts[r["text"]])
    names = sorted(counts)
    hashes = word_hashes(pa.array([w.decode() for w in names]))[0]
    ids = dict(zip(names, model.vocabulary.ids(hashes).tolist(), strict=True))
    buckets = Counter()
    for w, n in counts.items():
        buckets[ids[w]] += n

    def plain(words):
        out = []
        for i, w in enumerate(words):
            context = [ids[words[j]] if 0 <= j < len(words) else s.outputs for j in (i - 2, i - 1, i + 1, i + 2)]
            p = network.log_probability(np.array([context]), np.array([ids[w]]))[0]
            out.append(p + (np.log(counts[w] / buckets[ids[w]]) if ids[w] >= s.words else 0))
        return out

    for r in lm.score_documents(odd, s).collect():
        for row in rows:
            if row["doc_id"] == r["doc_id"] and r["n_tokens"] and r["n_tokens"] < 100:
                assert r["log_probability"] == pytest.approx(sum(plain(texts[row["text"]])), abs=1e-3)


def test_every_position_is_masked_once():
    words, bounds = word_hashes(pa.array(["a b c", "", None, "a", LONG]))
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found = lm.folds(words, bounds, of, lm.Settings(rounds=3))
    assert set(found.tolist()) == {0, 1, 2} and np.bincount(found).min() > 19_000
    alone = word_hashes(pa.array([LONG]))
    assert (lm.folds(*alone, np.zeros(len(alone[0]), np.int64), lm.Settings(rounds=3)) == found[4:]).all()
    share = (lm.folds(words, bounds, of, lm.Settings(rounds=3, masked=0.3)) < 3).mean()
    assert 0.29 < share < 0.31


def test_loss_on_texts_not_learned_from_is_below_that_of_frequencies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").distinct().repartition(4, "text")
    s = lm.Settings(words=448, buckets=64, batch=512)
    own = F.crc32(F.col("text").cast("binary")) % 5 == 0
    model = lm.learned_model(docs.filter(~own), s)
    words, bounds = word_hashes(pa.array([r["text"] for r in docs.filter(own).collect()]))
    ids, of = model.vocabulary.ids(words), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    network = lm.Network(s, model.flat)
    loss = -network.log_probability(lm.neighbours(ids, of, s, np.arange(len(ids))), ids).mean()
    frequencies = -np.log((model.totals + 1) / (model.totals + 1).sum())[ids].mean()
    assert loss < frequencies - 0.2


# -- mixing


def plain_mix(rows, weights=(3, 1, 2), share=1.5, cap=2):
    sizes = Counter()
    for source, size in rows:
        sizes[source] += size
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, budget, target = set(names), share * sum(sizes.values()), {}
    while left:
        level = budget / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > cap * sizes[s]}
        if not over:
            return sizes, target | {s: level * weight[s] for s in left}
        for s in over:
            target[s] = cap * sizes[s]
            budget -= target[s]
        left -= over
    return sizes, target


def test_mix_against_plain_water_filling(spark, odd, none):
    rows = [(i, "w " * (1 + i * 7 % 40), "en", ["s1", "s2", "s3", None, "é"][i % 5 if i < 60 else 0]) for i in range(150)]
    for df in (documents(spark, rows), odd):
        got = mixing.mix(df).collect()
        assert len(got) == df.count()
        sizes, target = plain_mix([(r["source"], r["size"]) for r in got])
        taken = Counter()
        for r in got:
            assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
            assert 0 <= r["taken"] <= 2 * r["size"]
            taken[r["source"]] += r["taken"]
        assert all(abs(taken[s] - target[s]) <= 2 for s in sizes)
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    by_id = {r["doc_id"]: r["size"] for r in mixing.mix(odd).collect()}
    assert by_id[3] == by_id[4] == by_id[5] == 0 and by_id[6] == 2 and by_id[7] == 60_000
    assert mixing.mix(none).collect() == []


def test_weights_go_to_sources_in_code_point_order_without_one_sorted_list(spark):
    names = sorted({f"{c}{i}" for i in range(700) for c in "aBé\U0001f600"} | {"", " "}, key=lambda n: n.encode())
    sizes = spark.createDataFrame([(n,) for n in [*names[::2], None, *names[1::2]]], "source string").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = mixing.weighted_sources(sizes, (3, 1, 2))
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = {r["source"]: r["weight"] for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert found == {n: float((3, 1, 2)[i % 3]) for i, n in enumerate([*names, None])}
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("row_number" in line and "[range#" in line for line in windows) == 1


def test_mixed_documents_keep_columns_and_copies(spark, odd, none):
    mixed = mixing.mixed_documents(odd)
    assert columns(mixed) == columns(odd)
    copies = Counter(r["doc_id"] for r in mixed.collect())
    want = Counter()
    for r in mixing.mix(odd).collect():
        want[r["doc_id"]] += r["copies"]
    assert copies == +want
    assert mixing.mixed_documents(none).collect() == []


# -- quality


def test_quality_learns_and_keeps_the_fold_out(spark, odd, none):
    good = [(i, f"plain words number {i} follow here and there", "en", "a") for i in range(200)]
    bad = [(i, f"buy!! now!! {i} cheap!! cheap!! pills!!", "en", "a") for i in range(200, 400)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)] + [(0, None), (None, 1), (5, 1)], "doc_id long, quality int")
    s = quality.Settings(bits=12)
    got = quality.score_quality(docs, labels, s).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    assert all(r["predicted"] == int(r["doc_id"] < 200) for r in got if r["held_out"])
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(str, quality.score_quality(docs, turned, s).collect())) == sorted(map(str, got))
    strange = quality.score_quality(odd, labels, s).collect()
    assert len(strange) == 11 and all(r["score"] is not None for r in strange)
    assert quality.score_quality(none, labels, s).collect() == []
    assert {r["score"] for r in quality.score_quality(odd, labels.limit(0), s).collect()} == {0.5}
    kept = quality.good_documents(docs, labels, s)
    assert columns(kept) == columns(docs) and kept.count() == sum(r["predicted"] for r in got)


# -- tokens and packing


def test_token_counts(spark, odd, none):
    whole = Tokenizer.from_file(tokens.vocabulary_path())
    texts = odd.select("doc_id", "text").collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), n, n > 2048) for r in texts for n in [len(whole.encode(r["text"] or "", add_special_tokens=False).ids)])
    assert Counter(tuple(r) for r in tokens.count_tokens(odd).collect()) == want
    assert tokens.count_tokens(none).collect() == []


def test_packing_round_trip(spark, odd, none):
    whole = Tokenizer.from_file(tokens.vocabulary_path())
    got = packing.pack(odd, capacity=64, pieces_per_group=4).collect()
    want = Counter((r["doc_id"], *whole.encode(r["text"] or "", add_special_tokens=False).ids, 1) for r in odd.collect())
    pieces, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 64 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, tokens_of in ((k, sorted(v)) for k, v in pieces.items()):
        copies = sum(n for w, n in want.items() if (w[0], len(w) - 1) == key)
        for start, ids in tokens_of:
            assert all((w[0], len(w) - 1) != key or list(w[1 + start : 1 + start + len(ids)]) == ids for w in want)
        assert sum(len(i) for _, i in tokens_of) == copies * key[1]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    slim = packing.pack(odd, capacity=64, keep_ids=False)
    assert {r["ids"] for r in slim.collect()} == {None}
    assert packing.pack(none).collect() == []


# -- language


def test_language(spark, odd, none):
    english = ["the", "of", "and", "which", "thing", "there", "with"]
    german = ["der", "und", "nicht", "schön", "straße", "ich", "auch"]
    rows = []
    for i in range(300):
        words = (english, german)[i % 2]
        rows.append((i, " ".join(words[(i * k) % 7] for k in range(1, 12)), ("en", "de")[i % 2], "a"))
    docs = documents(spark, [*rows, (1000, None, "en", "a"), (1001, "12 !?", "en", "a"), (1002, "", None, "a"), (1003, "the thing", None, "a")])
    got = {r["doc_id"]: r for r in language.identify(docs, dimensions=256).collect()}
    assert all(got[i]["lang_pred"] == ("en", "de")[i % 2] and 0 < got[i]["score"] <= 1 for i in range(300))
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"]
    assert got[1000]["score"] == 0.0
    kept = language.known_documents(docs, dimensions=256)
    assert columns(kept) == columns(docs) and {1000, 1001, 1002}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() == 301
    assert len(language.identify(odd, dimensions=256).collect()) == 11
    assert language.identify(none).collect() == []
    unknown = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unknown.collect()} == {("und", 0.0)}


def test_short_texts_of_a_language_stay(spark):
    english = ["the", "of", "and", "which", "thing", "there", "with"]
    rows = [(i, " ".join(english[(i * k) % 7] for k in range(1, 12)), "en", "a") for i in range(200)]
    short = ["A.", "Jump!", "Quick fox", "Sky", "Über uns", "Zebra", "My name is Bob", "Lucky us", "OK"]
    foreign = "".join(chr(0x430 + i * i % 31) + (" " if i % 6 == 5 else "") + chr(0x430 + i * 7 % 32) for i in range(400))
    texts = [(1000 + i, x, "en", "a") for i, x in enumerate(short)] + [(2000, foreign, None, "a"), (2001, "?! 12", None, "a")]
    kept = {r["doc_id"] for r in language.known_documents(documents(spark, rows + texts)).collect()}
    assert kept == {*range(200), *range(1000, 1000 + len(short))}


# -- near duplicates


def plain_components(texts, words, percent):
    sets = {}
    for doc_id, text in texts:
        w = (text or "").lower().split()
        sets[doc_id] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    of = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        for a, b in links:
            of[a] = of[b] = min(of[a], of[b])
    return of, {d: len(s) for d, s in sets.items()}


def edited(random, text, n):
    words = text.split()
    for _ in range(n):
        words[random.integers(len(words))] = f"new{random.integers(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("s", [Settings(words=3, percent=85), Settings(leaf=4, block=4), Settings(words=3, percent=85, leaf=8, block=300)])
def test_near_duplicates_against_brute_force(spark, s):
    random = np.random.default_rng(1)
    passage = " ".join(f"common{i}" for i in range(40))
    texts = []
    for g in range(30):
        base = " ".join(f"w{random.integers(3000)}" for _ in range(random.integers(1, 120)))
        texts += [base] + [edited(random, base, random.integers(0, 5)) for _ in range(random.integers(0, 4))]
    texts += [f"{passage} " + " ".join(f"v{random.integers(10**6)}" for _ in range(60)) for _ in range(25)]
    chain = " ".join(f"c{i}" for i in range(150))
    for _ in range(60):  # a group whose ends have little in common
        texts.append(chain)
        chain = edited(random, chain, 2)
    texts += [texts[0]] * 3 + ["one", "one", "ONE", "two words", "", None, " \n"]
    rows = [(int(i), t, "en", "a") for i, t in zip(random.permutation(len(texts)), texts, strict=True)]
    of, sizes = plain_components([(r[0], r[1]) for r in rows], s.words, s.percent)
    got = near_texts.near_duplicates(documents(spark, rows), s).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == of
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(spark, odd, none):
    got = near_texts.near_duplicates(odd)
    by_id = {r["doc_id"]: (r["component_id"], r["kept"]) for r in got.collect()}
    assert got.count() == 11
    assert by_id == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (5, True), 6: (6, True), 7: (7, True), None: (None, True), 8: (8, True), 9: (9, True)}
    left = near_texts.without_near_duplicates(odd)
    assert columns(left) == columns(odd)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "None"])
    assert near_texts.near_duplicates(none).collect() == [] and near_texts.without_near_duplicates(none).collect() == []


def test_components(spark):
    random = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    of = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            of[a] = of[b] = min(of[a], of[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in of.items() if any(x in e for e in edges if e[0] != e[1])}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -- vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("links", F.lit("x")).repartition(3)


ODD = [
    (9001, None), (9002, [0.0] * 8), (9003, [None] + [1.0] * 7), (9004, [float("nan")] * 8), (9005, [float("inf")] * 8), (9006, [1.0]),
    (9007, []), (None, [1.0] * 8),
]


def test_nearest_neighbours_against_brute_force(spark):
    random = np.random.default_rng(4)
    values = np.vstack([random.standard_normal((600, 8)) * random.uniform(0.5, 2, (600, 1)), np.tile(random.standard_normal(8), (60, 1))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    df = vectors(spark, rows + rows[:5] + ODD)
    s = ann.Settings(list_size=40, block=16)
    got = ann.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), k=20, settings=s).collect()
    exact = values.astype(float) @ values.astype(float).T
    queries = range(0, 660, 20)
    assert Counter(r["query_id"] for r in got) == {q: 20 for q in queries}
    found = 0
    for q in queries:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and q not in [m[1] for m in mine]
        assert all(abs(m[2] - exact[q, m[1]]) < 1e-9 for m in mine)
        assert mine == [(k + 1, *x) for k, x in enumerate(sorted([m[1:] for m in mine], key=lambda x: (-x[1], x[0])))]
        others = sorted((-exact[q, j], j) for j in range(660) if j != q)[:20]
        found += len({j for _, j in others} & {m[1] for m in mine})
    assert found / (20 * len(queries)) >= 0.9


def test_nearest_neighbours_with_hundreds_of_lists(spark):
    random = np.random.default_rng(11)
    values = random.standard_normal((9000, 64))
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(values.astype(np.float32))])
    got = ann.nearest_neighbours(df, df.filter("vec_id % 45 = 0"), k=20, settings=ann.Settings(list_size=30)).collect()
    exact = values @ values.T
    np.fill_diagonal(exact, -np.inf)
    found = sum(r["vec_id"] in set(np.argsort(-exact[r["query_id"]])[:20].tolist()) for r in got)
    assert found / (20 * 200) >= 0.9


def test_nearest_neighbours_of_few_and_none(spark):
    few = vectors(spark, [(i, [float(i), 1.0, -0.5]) for i in range(1, 6)] + [(7, None), (8, [0.0, 0.0, 0.0])])
    got = ann.nearest_neighbours(few, few).collect()
    assert Counter(r["query_id"] for r in got) == {i: 4 for i in range(1, 6)}
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 1] == [5, 4, 3, 2]
    empty = vectors(spark, ODD[:2])
    assert ann.nearest_neighbours(empty, empty).collect() == []


def test_near_vectors_against_brute_force(spark):
    random = np.random.default_rng(5)
    base = random.standard_normal((120, 8))
    near = base[:40].repeat(3, axis=0) + random.standard_normal((120, 8)) * 0.25
    values = np.vstack([base, near, base[:10], base[:10] * 3, np.tile(base[0], (30, 1))]).astype(np.float32)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(values)] + ODD)
    unit = values.astype(float) / np.linalg.norm(values.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    of = np.arange(len(unit))
    for _ in range(len(unit)):
        new = np.array([min(of[i], *of[linked[i]]) if linked[i].any() else of[i] for i in range(len(unit))])
        if (new == of).all():
            break
        of = new
    for s in (near_vectors.Settings(), near_vectors.Settings(block=8)):
        got = {r["vec_id"]: r for r in near_vectors.near_vectors(df, s).collect()}
        assert len(got) == len(values) + len(ODD)
        assert sum(got[i]["n_links"] for i in range(len(unit))) >= 0.99 * linked.sum()
        assert all(got[i]["n_links"] <= linked[i].sum() for i in range(len(unit)))
        assert np.mean([got[i]["component_id"] == of[i] for i in range(len(unit))]) > 0.98
        for i in range(9001, 9008):
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
        assert (got[None]["component_id"], got[None]["kept"]) == (None, True)
    assert near_vectors.near_vectors(df.limit(0)).collect() == []


# -- conversations

LOG = "conv_id long, turn long, role string, text string"


def test_chat(spark):
    talk = [(t, ("user", "assistant")[t % 2], f"line {t}") for t in range(10)]
    rows = [(1, *x) for x in talk[:4]] + [(2, *x) for x in talk[:7]] + [(3, *x) for x in talk[:7]] + [(4, *x) for x in talk[1:4]] + [(5, *talk[0])]
    rows += [(6, None, None, None), (6, 0, "user", "a <|im_end|> b"), (6, 0, "user", "a <|im_end|> b"), (6, 0, "system", "tie"), (None, 0, "user", "x")]
    rows += [(7, *x) for x in talk] + [(7, 2, "user", "another line 2")]
    log = spark.createDataFrame(rows, LOG).withColumn("part", F.lit("clash")).withColumn("n_turns", F.lit(0)).repartition(4)
    for per_part in (256, 3):
        got = {}
        for r in chat.formatted(log, per_part).orderBy("part").collect():
            got.setdefault(r["conv_id"], [r["n_turns"], r["copies"], "", r["part"]])
            got[r["conv_id"]][2] += r["rendered"]
        assert {k: v[:2] for k, v in got.items()} == {2: [7, 2], 4: [3, 1], 6: [3, 1], 7: [11, 1]}
        assert got[2][2] == "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, r, x in talk[:7])
        assert got[6][2].startswith("<|im_start|>user\n<|im_end|>\n") and "a < |im_end|> b<|im_end|>" in got[6][2]
    assert chat.formatted(log.limit(0)).collect() == []


def test_documents_of_one_id_are_told_apart_by_their_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(0, b, "en", "s"), (1, a, "en", "s"), (1, b + " x", "en", "s"), (2, a + " y", "en", "s"), (3, "c " * 30 + "d", "en", "s")]
    left = near_texts.without_near_duplicates(documents(spark, rows, row="clash", digest1="clash", given="clash")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted([rows[0][:2], rows[1][:2], rows[4][:2]])
    assert {r["digest1"] for r in left} == {"clash"}
    # Rows that are equal, of one set, or all of one doc_id.
    rows = [(5, a, "en", "s"), (5, a, "en", "s"), (5, a.upper(), "en", "s"), (5, a + " z", "en", "s"), (5, b, "en", "s"), (6, "", "en", "s"), (6, "", "en", "s"), (None, a, "en", "s")]
    left = [(r["doc_id"], r["text"]) for r in near_texts.without_near_duplicates(documents(spark, rows)).collect()]
    assert len(left) == 4 and (5, b) in left and (6, "") in left and (None, a) in left
    assert {t.lower() for i, t in left if i == 5 and t != b} in ({a}, {a + " z"})
    got = near_texts.near_duplicates(documents(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {5, 6, None}


def test_no_stage_of_near_dedup_runs_two_python_steps(spark, tmp_path, monkeypatch):
    seen = []
    write = near_texts.stored

    def watched(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        stages = plan.split("Exchange")
        seen.extend((name, part.count("MapInArrow")) for part in stages)
        return write(df, name)

    monkeypatch.setattr(near_texts, "stored", watched)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    near_texts.without_near_duplicates(docs).write.parquet(str(tmp_path / "out"))
    assert seen and max(n for _, n in seen) == 1, seen


def test_a_lower_percent_is_refused():
    with pytest.raises(ValueError, match="percent"):
        Settings(percent=70)
