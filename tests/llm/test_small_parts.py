"""The operators' own algorithms against plain versions, without Spark."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sievework.llm import ann, language, lm, packing, quality
from sievework.llm.hashing import shingle_sets, word_hashes
from sievework.llm.tokens import Counter, Identifiers, between_spaces, vocabulary_path

TEXTS = ["", None, " \t\n", "One", "one TWO one two", "a  b\vc\fd\re", "ÄÖ ä b x", "x" * 3000 + " y", " end ", "\x1c a"]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def test_word_hashes_tell_words_apart():
    texts = TEXTS * 3
    hashes, bounds = word_hashes(pa.array(texts))
    names = {}
    for text, low, high in zip(texts, bounds[:-1], bounds[1:], strict=True):
        words = words_of(text)
        assert len(words) == high - low
        for word, h in zip(words, hashes[low:high].tolist(), strict=True):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_word_hashes_do_not_depend_on_the_batch(monkeypatch):
    texts = [" ".join(random.Random(k).choices(["alpha", "be", "c", "delta" * 9], k=k)) for k in range(60)]
    whole = word_hashes(pa.array(texts))[0]
    monkeypatch.setattr("sievework.llm.hashing._CHUNK", 50)
    assert (whole == word_hashes(pa.array(texts))[0]).all()
    assert (whole == np.concatenate([word_hashes(pa.array([t]))[0] for t in texts])).all()


@pytest.mark.parametrize("n", [1, 3, 5])
def test_shingle_sets(n):
    texts = TEXTS + ["a b a b a b", "b a b", "a b"]
    sets = shingle_sets(*word_hashes(pa.array(texts)), n)
    plain = []
    for text in texts:
        words = words_of(text)
        plain.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set()))
    assert [len(x) for x in sets] == [len(x) for x in plain]
    for a, p in zip(sets, plain, strict=True):
        for b, q in zip(sets, plain, strict=True):
            assert len(set(a.tolist()) & set(b.tolist())) == len(p & q)


STRANGE = [
    "", "Hello, world's  best", "don't we'LL 12345 ½ ²", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|endoftext|", "é é İ Σς ΑΣ",
    "日本語 テキスト", "😀👩‍👩‍👧 ok", "a b c\u0085d", "x\x1cy \x1d z", "A" * 400, "ab" * 3000, "́ ́a", "é<|endoftext|>́",
]


def test_token_counts_and_ids_equal_the_library():
    path = vocabulary_path()
    whole = Tokenizer.from_file(path)
    random.seed(5)
    alphabet = "abcdefg 'sST1²½é́Σ\n <|endoftext|>.,!–日😀\x1c\t"
    texts = STRANGE + ["".join(random.choices(alphabet, k=random.randint(1, 60))) for _ in range(400)]
    counter, ids = Counter(path), Identifiers(path)
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [sum(counter.of_text[w] for w in between_spaces(t)) for t in texts] == [len(w) for w in wanted]
    assert [np.frombuffer(b, "<u4").tolist() for b in ids.of(texts)] == wanted


def test_counter_refuses_other_kinds():
    with pytest.raises((ValueError, KeyError)):
        Counter(vocabulary_path("byte_bpe_50k.json"))


def test_first_fit_equals_a_scan_of_all_bins():
    random.seed(6)
    for _ in range(30):
        sizes = sorted(random.choices(range(1, 101), k=random.randint(0, 80)), reverse=True)
        room, bins, offsets = [], [], []
        for size in sizes:
            at = next((i for i, r in enumerate(room) if r >= size), len(room))
            room += [100] * (at == len(room))
            bins.append(at)
            offsets.append(100 - room[at])
            room[at] -= size
        assert packing.first_fit(sizes, 100) == (bins, offsets)


def test_bundles_equal_a_sum_over_grams():
    def plain(text):
        letters = "".join(c.lower() if c.isalpha() else " " for c in text or "")
        padded = f" {' '.join(letters.split())} "
        total = np.zeros(128)
        for i in range(len(padded) - 2):
            total += language.gram_vectors(np.array([[ord(c) for c in padded[i : i + 3]]]), 128, 7)[0]
        return total

    texts = ["a", "Hello World", "  x1y", "Été 12 où!", "ab", "日本"]
    found, known = language.bundles([*texts, "", None, "12 !"], 3, 128, 7)
    assert known.tolist() == [True] * 6 + [False] * 3
    for text, row in zip(texts, found, strict=False):
        assert np.allclose(row, plain(text))


def test_quality_features():
    s = quality.Settings(bits=12)
    texts = pa.array(["a b a b", None, "", "x x x x", "y y y y", "a b a b"])
    bounds, places, values = quality.features(texts, s)
    rows = [(places[a:b].tolist(), values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert rows[0] == rows[5] and len(rows[0][0]) == 4 and rows[1] == rows[2] == ([], [])
    assert len(set(rows[3][0]) & set(rows[4][0])) == 1  # repetition is one feature, whatever the word
    assert all(abs(sum(v * v for v in r[1]) - 1) < 1e-5 for r in rows if r[1]) and 0 not in places


def test_network_is_a_distribution_and_its_gradient_is_right():
    s = lm.Settings(words=6, buckets=2, side=1, width=3, hidden=4, group=4, rate=0.0)
    network = lm.Network(s, np.random.default_rng(1).standard_normal(len(lm.Network(s).flat)) * 0.5)
    context = np.array([[0, 8], [3, 2], [7, 1]])
    total = sum(np.exp(network.log_probability(context, np.full(3, w))) for w in range(8))
    assert np.allclose(total, 1, atol=1e-5)
    target, squares = np.array([1, 5, 7]), np.zeros(len(network.flat), np.float32)
    network.learn(context, target, squares)
    for i in range(0, len(squares), 3):
        ends = []
        for step in (1e-2, -1e-2):
            moved = network.flat.copy()
            moved[i] += step
            ends.append(-lm.Network(s, moved).log_probability(context, target).mean())
        assert abs(abs(ends[0] - ends[1]) / 2e-2 - np.sqrt(squares[i])) < 2e-3


def test_neighbours_stay_within_a_text():
    s = lm.Settings(words=6, buckets=2, group=4, side=1)
    got = lm.neighbours(np.array([1, 2, 3, 4]), np.array([0, 0, 1, 1]), s, np.arange(4))
    assert got.tolist() == [[8, 2], [1, 8], [8, 4], [3, 8]]


def test_graph_search_finds_the_nearest():
    random_ = np.random.default_rng(3)
    centroids = random_.standard_normal((500, 8))
    graph = ann.centroid_graph(centroids, ann.Settings())
    queries = random_.standard_normal((200, 8))
    ids, d = ann.graph_search(queries, centroids, graph, 32)
    exact = np.sqrt(((queries[:, None] - centroids) ** 2).sum(2))
    assert (ids[:, 0] == exact.argmin(1)).mean() > 0.97
    assert np.allclose(d, np.take_along_axis(exact, ids, 1)) and (np.diff(d, axis=1) >= 0).all()
    assert all(len(set(row)) == 32 for row in ids.tolist())


def test_probabilities_of_a_batch_are_worked_out_in_kept_space():
    import tracemalloc

    s = lm.Settings()
    network, ids = lm.Network(s), np.random.default_rng(1).integers(0, s.outputs, (1 << 14, 5))
    first = network.log_probability(ids[:, 1:], ids[:, 0])
    tracemalloc.start()
    again = network.log_probability(ids[:, 1:], ids[:, 0])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (again == first).all() and most < 4 << 20  # the logits of classes alone have 4 MB


def test_a_step_of_learning_is_worked_out_in_kept_space():
    import tracemalloc

    s = lm.Settings()
    network, ids = lm.Network(s), np.random.default_rng(1).integers(0, s.outputs, (s.batch, 5))
    squares = np.zeros(len(network.flat), np.float32)
    network.learn(ids[:, 1:], ids[:, 0], squares)
    tracemalloc.start()
    network.learn(ids[:, 1:], ids[:, 0], squares)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 << 20  # the logits of classes and of words have 4 MB


@pytest.mark.parametrize("scale", [0.3, 200])
def test_a_step_follows_the_exact_gradient_also_of_logits_that_overflow(scale):
    s = lm.Settings(words=10, buckets=2, side=1, width=3, hidden=4, group=4)
    random_ = np.random.default_rng(2)
    network = lm.Network(s, random_.standard_normal(len(lm.Network(s).flat)) * 0.3)
    network.klass *= scale / 0.3
    network.word *= scale / 0.3
    context, target = random_.integers(0, s.outputs + 1, (50, 2)), random_.integers(0, s.outputs, 50)
    embed, inner, inner_bias, klass, klass_bias, word, word_bias = (x.astype(np.float64) for x in (network.embed, network.inner, network.inner_bias, network.klass, network.klass_bias, network.word, network.word_bias))
    joined = embed[context].reshape(50, -1)
    hidden = np.tanh(joined @ inner + inner_bias)
    found, want = np.zeros(50), {k: np.zeros_like(x) for k, x in (("klass", klass), ("klass_bias", klass_bias), ("word", word), ("word_bias", word_bias), ("inner", inner), ("embed", embed))}
    for i in range(50):
        c = target[i] // s.group
        own = slice(c * s.group, (c + 1) * s.group)
        back = np.zeros(s.hidden)
        for weights, bias, right, into, into_bias in ((klass, klass_bias, c, want["klass"], want["klass_bias"]), (word[own].T, word_bias[own], target[i] % s.group, want["word"][own].T, want["word_bias"][own])):
            logits = hidden[i] @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            found[i] += logits[right] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
            p[right] -= 1
            into += np.outer(hidden[i], p) / 50
            into_bias += p / 50
            back += weights @ p / 50
        back *= 1 - hidden[i] ** 2
        want["inner"] += np.outer(joined[i], back)
        np.add.at(want["embed"], context[i], (inner @ back).reshape(2, -1))
    assert np.allclose(network.log_probability(context, target), found, rtol=1e-5, atol=5e-6 * (1 + scale))
    network.learn(context, target, np.zeros(len(network.flat), np.float32))
    for k, x in want.items():
        assert np.allclose(getattr(network.gradient, k), x, rtol=1e-4, atol=5e-6 * (1 + scale)), k


def test_hashing_takes_little_room_beside_the_words():
    import tracemalloc

    texts = pa.array(["words of a long text " * 50_000, "ab"])
    hashes, bounds = word_hashes(texts)
    tracemalloc.start()
    word_hashes(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert bounds.tolist() == [0, 250_000, 250_001] and len(set(hashes.tolist())) == 6
    assert most < 14 << 20  # 250,001 words have 2 MB, the terms of all bytes would have 8 MB


def test_frequent_words_with_the_same_first_bits_are_told_apart():
    s = lm.Settings(words=6, buckets=3)
    frequent = np.array([5 << 48, (5 << 48) + 9, 2**64 - 1, 0, (5 << 48) + 7, 2**64 - 2], np.uint64)
    others = np.array([1, (5 << 48) + 8, 2**64 - 3, 6 << 48], np.uint64)
    ids = lm.Vocabulary(frequent, s).ids(np.concatenate([frequent, others]))
    assert ids.tolist() == [0, 1, 2, 3, 4, 5, *(6 + others % np.uint64(3)).tolist()]
    assert (lm.Vocabulary(frequent[:0], s).ids(others) >= 6).all()


def test_ids_of_remembered_words_are_joined_without_a_step_per_word():
    import sys

    made, long, steps = Identifiers(vocabulary_path()), "x" * 70, []
    made.of(["red green"])

    def trace(frame, event, arg):
        steps.append(event)
        return trace

    sys.settrace(trace)
    try:
        (got,) = made.of(["red green " * 5000 + "blue"])
    finally:
        sys.settrace(None)
    red, blue, longest = (Identifiers(vocabulary_path()).of([x])[0] for x in ("red green", "blue", long))
    assert got == red * 5000 + blue and len(steps) < 1000
    assert made.of([f"red green {long} blue", "blue", f"{long}"]) == [red + longest + blue, blue, longest]
