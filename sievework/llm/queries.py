"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import alignment, ann, chat, language, lm, mixing, near_texts, near_vectors, packing, prefix_trie, quality, substrings, tokens
from sievework.llm.tables import given

Query = Callable[[SparkSession, str], DataFrame]


def op1_masked_pseudo_likelihood(spark, sf_dir):
    return lm.score_documents(given(spark, sf_dir, "documents"))


def op2_mix_sources(spark, sf_dir):
    return mixing.mix(given(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return quality.score_quality(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


def op4_nearest(spark, sf_dir):
    vectors = given(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op5_token_counts(spark, sf_dir):
    return tokens.count_tokens(given(spark, sf_dir, "documents"))


def op6_pack(spark, sf_dir):
    return packing.pack(given(spark, sf_dir, "documents"), keep_ids=False).drop("ids")


def op7_language(spark, sf_dir):
    return language.identify(given(spark, sf_dir, "documents"))


def op8_near_texts(spark, sf_dir):
    return near_texts.near_duplicates(given(spark, sf_dir, "documents"), near_texts.Settings(words=3, percent=85))


def op9_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(given(spark, sf_dir, "embeddings"))


def op10_chat(spark, sf_dir):
    return chat.formatted(given(spark, sf_dir, "conversations"))


def op11_align(spark, sf_dir):
    return alignment.align(given(spark, sf_dir, "documents"), keep_groups=False).drop("groups")


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(given(spark, sf_dir, "conversations"), rebuild=True)


def op13_substrings(spark, sf_dir):
    return substrings.remove_repeats(given(spark, sf_dir, "documents"), keep_text=False).drop("kept")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_masked_pseudo_likelihood, op2_mix_sources, op3_quality, op4_nearest, op5_token_counts, op6_pack, op7_language, op8_near_texts, op9_near_vectors, op10_chat, op11_align, op12_prefix_trie, op13_substrings)
}
