"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.tables import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 20
_DRAWS = 1 << 60  # draws are 60-bit numbers
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, size: Column, seed: int) -> Column:
    """A document's seeded place in the sampling order of its source."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def weighted_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weights in turn, to sources in code point order, null last.

    Sources are cut into ranges of names and numbered within each; the ranges' counts, one row per partition of the shuffle, say
    where a range starts. So no task sorts all names, however many sources there are.
    """
    by_name = F.col("source").asc_nulls_last()
    ranged = stored(sizes.repartitionByRange(by_name).withColumn("range", F.spark_partition_id()), "ranged-sources")
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    starts = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("start"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(by_name)) - 1
    place = F.col("start") + F.col("within")
    numbered = ranged.withColumn("within", within).join(starts, "range")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    return numbered.select(*sizes.columns, weight.alias("weight"))


def water_filled(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Adds ``target``: shares of ``budget`` by ``weight``, none above ``max_epochs`` times ``source_size``.

    Each round clamps the sources whose share exceeds their cap and shares what is left among the others by weight. Only
    two sums per round come to the driver; rounds end when no further source is clamped, as the water level only rises.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        over = cap < F.lit(level) * F.col("weight") if clamped >= 0 else F.lit(False)
        found = sources.agg(
            F.count_if(over).alias("n"), F.sum(F.when(over, cap)).alias("filled"), F.sum(F.when(~over, F.col("weight"))).alias("open")
        ).first()
        if found["n"] == clamped or not found["open"]:
            break
        clamped, level = found["n"], (budget - (found["filled"] or 0.0)) / found["open"]
    if not found["open"] and found["n"]:
        return sources.withColumn("target", cap)
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    ``docs`` needs doc_id, text and source; other columns are ignored, whatever their names. Returns one row per row:
    doc_id, source, size (words), source_size, target (the source's words in the mix), copies (whole repetitions) and
    taken (words, repeats counted; at most ``max_epochs`` times the size).

    All sources share ``share`` times the words of all documents by weight, as far as ``max_epochs`` allows. A source's
    documents are all taken as often as fits wholly; then, in a seeded order, one time more until the target is met; the
    document at that point is taken in part. So a source's words differ from its target by rounding only.

    Null text or text without words: size and taken 0. Null source: a source of its own, last in order. Documents with
    equal ids and sizes share their place in the order, so repeated rows are treated alike, and those that share the last
    place are taken in part alike. An empty table gives an empty result.

    One pass reads the texts. The point where a source's last repetition ends is found without sorting a source: words
    are summed by ranges of the order, only the range that holds the point is summed by place. A source of n documents has
    about sqrt(n) ranges of about sqrt(n) documents, so neither step gathers many.
    """
    base, ends = _planned(docs, weights, share, max_epochs, seed)
    return _counted(base, ends).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` says, with the columns of ``docs``.

    A document taken in part comes once more if the part is half or more, else not: texts are never cut here. Texts are
    not shuffled: the table of sources decides from a row's own size and place.
    """
    _, ends = _planned(docs, weights, share, max_epochs, seed)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"))
    rows = _counted(rows.withColumn("draw", draw(F.col("doc_id"), F.col("size"), seed)), ends).filter(F.col("copies") > 0)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("time")
    return rows.select("row", times).select("row.*")


def _planned(docs, weights, share, max_epochs, seed) -> tuple[DataFrame, DataFrame]:
    """Sizes and places of all rows; per source its target and the place where its last repetition ends."""
    size = n_words(F.col("text"))
    base = docs.select("doc_id", "source", size.alias("size")).withColumn("draw", draw(F.col("doc_id"), F.col("size"), seed))
    base = stored(base, "sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = stored(weighted_sources(sizes, weights), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = water_filled(sources, share * total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = sources.withColumn("ranges", F.ceil(F.sqrt(F.col("rows"))).cast("double"))
    sources = stored(sources.withColumnRenamed("source", "own_source"), "targets")

    at_range = F.floor(F.col("draw") / F.lit(float(_DRAWS)) * F.col("ranges"))
    placed = base.filter(F.col("size") > 0).join(sources, _same_source()).withColumn("range", at_range)
    by_range = placed.groupBy("own_source", "range", "rest").agg(F.sum("size").alias("words"))
    last_range = _reached(by_range, ["own_source"], "range").select(
        F.col("own_source").alias("last_source"), F.col("range").alias("last_range"), "before"
    )
    in_range = placed.join(last_range, F.col("own_source").eqNullSafe(F.col("last_source")) & (F.col("range") == F.col("last_range")))
    by_place = in_range.groupBy("own_source", "draw", "rest", "before").agg(F.sum("size").alias("words"))
    last = _reached(by_place.withColumn("rest", F.col("rest") - F.col("before")).drop("before"), ["own_source"], "draw").select(
        F.col("own_source").alias("last_source"),
        F.col("draw").alias("last_draw"),
        ((F.col("rest") - F.col("before")) / F.col("words")).alias("part"),
    )
    ends = stored(sources.join(last, F.col("own_source").eqNullSafe(F.col("last_source")), "left").drop("last_source"), "ends")

    return base, ends


def _counted(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds source_size, target, copies and taken to rows with source, size and draw."""
    once_more = F.col("draw") < F.col("last_draw")
    at_end = F.col("draw") == F.col("last_draw")
    copies = F.col("whole") + F.when(once_more | (at_end & (F.col("part") >= 0.5)), 1).otherwise(0)
    extra = F.when(once_more, F.col("size")).when(at_end, F.floor(F.col("part") * F.col("size") + 0.5)).otherwise(0)
    taken = F.col("whole") * F.col("size") + extra
    counts = {"copies": copies.cast("long"), "taken": taken.cast("long")}
    return rows.join(ends, _same_source()).withColumns(counts)


def _same_source() -> Column:
    return F.col("source").eqNullSafe(F.col("own_source"))


def _reached(sums: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key the row in whose ``words`` the running sum passes ``rest``; ``before`` is the sum before it."""
    running = F.sum("words").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    before = sums.withColumn("before", running - F.col("words"))
    return before.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
