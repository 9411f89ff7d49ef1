"""Chat formatting: logged snapshots of one conversation collapse to the longest, which are rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.tables import stored

TURNS_PER_PART = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns_of(log: DataFrame, turns_per_part: int) -> DataFrame:
    """conv_id, turn, range, role, text and a digest of the last two, with defaults for nulls."""
    role, text = F.coalesce("role", F.lit("user")), F.coalesce("text", F.lit(""))
    rows = log.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    span = F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(-1 << 62))
    digest = F.md5(F.concat("role", F.lit("\x1f"), "text").cast("binary"))
    return rows.withColumn("span", span).withColumn("digest", digest)


def maximal_conversations(log: DataFrame, turns_per_part: int = TURNS_PER_PART) -> tuple[DataFrame, DataFrame]:
    """The conversations that no other extends (conv_id, n_turns, copies), and all spans of turns (conv_id, span, part).

    A prefix of a conversation is known by two 64-bit hashes, each the exclusive or of hashes of (place, turn), rolled
    along its turns. Turns are placed in two steps, spans and then turns within a span, so a conversation of any length
    is spread over many groups; only digests are shuffled, no texts.
    """
    slim = turns_of(log, turns_per_part).select("conv_id", "span", "turn", "digest").distinct()
    slim = stored(slim, "turns")
    by_turn = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "digest")
    spans = slim.groupBy("conv_id", "span").agg(F.count("*").alias("turns"))
    by_span = Window.partitionBy("conv_id").orderBy("span")
    spans = spans.withColumn("start", F.sum("turns").over(by_span) - F.col("turns")).withColumn("part", F.row_number().over(by_span) - 1)
    spans = stored(spans, "spans")
    placed = slim.withColumn("within", F.row_number().over(by_turn)).join(spans, ["conv_id", "span"])
    placed = placed.withColumn("place", F.col("start") + F.col("within"))
    for k in (1, 2):
        placed = placed.withColumn(f"h{k}", F.xxhash64(F.lit(k), "place", "digest"))
    placed = stored(placed.select("conv_id", "span", "part", "place", "h1", "h2"), "places")
    sums = placed.groupBy("conv_id", "span").agg(*[F.bit_xor(f"h{k}").alias(f"sum{k}") for k in (1, 2)])
    earlier = by_span.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "span", *[F.coalesce(F.bit_xor(f"sum{k}").over(earlier), F.lit(0)).alias(f"sum{k}") for k in (1, 2)])
    rolling = Window.partitionBy("conv_id", "span").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = placed.select("conv_id", "span", "place", *[F.bit_xor(f"h{k}").over(rolling).alias(f"own{k}") for k in (1, 2)])
    prefixes = prefixes.join(sums, ["conv_id", "span"])
    prefixes = prefixes.select("conv_id", "place", *[F.col(f"own{k}").bitwiseXOR(F.col(f"sum{k}")).alias(f"h{k}") for k in (1, 2)])
    lengths = spans.groupBy("conv_id").agg(F.sum("turns").alias("n_turns"))
    prefixes = stored(prefixes.join(lengths, "conv_id"), "prefixes")
    same = ["place", "h1", "h2"]
    ends = prefixes.filter(F.col("place") == F.col("n_turns"))
    ends = ends.groupBy(*same).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = prefixes.filter(F.col("place") < F.col("n_turns")).select(*same).distinct()
    kept = ends.join(inner, same, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "copies")
    return stored(kept, "kept"), spans.select("conv_id", "span", "part")


def formatted(log: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """Renders each maximal conversation: conv_id, n_turns, copies, part, rendered.

    ``log`` needs conv_id, turn, role and text; other columns are ignored. A conversation goes if its turns are the
    first turns of a longer one; of equal ones the smallest conv_id stays, ``copies`` counts them. A long conversation
    comes in parts: turns whose numbers fall into the same ``turns_per_part``. Parts are numbered from 0; concatenated in
    that order they are the whole.

    Turns go by number, null first, ties by the digest of role and text; a row logged twice counts once. A null role is
    ``user``, a null text is empty, rows without conv_id belong to no conversation and are left out. Markers inside a
    text are broken up so that they can't end its turn. An empty table gives an empty result.
    """
    kept, spans = maximal_conversations(log, turns_per_part)
    body = F.replace(F.replace("text", F.lit(OPEN), F.lit("< |im_start|>")), F.lit(CLOSE), F.lit("< |im_end|>"))
    rows = turns_of(log, turns_per_part).join(kept.select("conv_id"), "conv_id", "left_semi")
    rows = rows.select(
        "conv_id", "span", F.struct(F.col("turn"), F.col("digest"), F.concat(F.lit(OPEN), "role", F.lit("\n"), body, F.lit(CLOSE + "\n")).alias("said")).alias("item")
    )
    parts = rows.groupBy("conv_id", "span").agg(F.array_sort(F.collect_set("item")).alias("items"))
    first = F.filter("items", lambda i: i["turn"].isNull())
    rest = F.filter("items", lambda i: i["turn"].isNotNull())
    text = F.array_join(F.transform(F.concat(first, rest), lambda i: i["said"]), "")
    parts = parts.select("conv_id", "span", text.alias("rendered"))
    return parts.join(spans, ["conv_id", "span"]).join(kept, "conv_id").select("conv_id", "n_turns", "copies", "part", "rendered")
