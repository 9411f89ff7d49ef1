"""Decoding of JSON replies with strict syntax and Python truthiness, as native expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import errors
from sievework.functions.stages import Stage
from sievework.functions.text import strip

# Longest texts kept from a reply.
MAX_REASONING = 300
MAX_TITLE = 200


def _guarded(text: Column) -> tuple[Column, Column]:
    """The reply in an array closed by its own hash, which it cannot contain, and the hash.

    try_parse_json stops at the end of the first value; so anything but exactly one value before the hash is noticed.
    """
    guard = F.sha2(text, 256)
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), guard, F.lit('"]'))), guard


def _is_whole(reply: Column, guard: Column) -> Column:
    second = F.try_variant_get(reply, "$[1]", "string")
    return F.coalesce((second == guard) & F.try_variant_get(reply, "$[2]", "variant").isNull(), F.lit(False))


def decodable(raw: Column) -> Column:
    """Whether a reply is exactly one JSON object."""
    reply, guard = _guarded(strip(raw))
    kind = F.schema_of_variant(F.try_variant_get(reply, "$[0]", "variant"))
    return _is_whole(reply, guard) & F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def with_decoded(df: DataFrame, stage: Stage, raw: str = "raw_answer") -> DataFrame:
    """Replace ``raw`` by the stage's question columns, texts, score and decoding error.

    The error is '' for a decoded reply and NULL raw text gives NULL everywhere.
    """
    others = [F.col(c) for c in df.columns if c != raw]
    reply, guard = _guarded(strip(F.col(raw)))
    staged = df.select(*others, guard.alias("_guard"), reply.alias("_reply"))
    whole = _is_whole(F.col("_reply"), F.col("_guard"))
    value = F.try_variant_get("_reply", "$[0]", "variant")
    staged = staged.select(
        *others,
        F.when(F.col("_guard").isNull(), F.lit(None).cast("string"))
        .when(~whole, errors.JSON_PARSE_ERROR)
        .when(~F.schema_of_variant(value).startswith("OBJECT"), errors.JSON_NOT_OBJECT)
        .otherwise("")
        .alias("_error"),
        value.alias("_value"),
    )
    ok = F.col("_error") == ""
    # The fields are rendered as JSON text once; truth and text are both read off that.
    fields = {q.column: q.field for q in stage.questions}
    if stage.has_title:
        fields[stage.title_column] = "title"
    fields[stage.reasoning_column] = "reasoning"
    staged = staged.select(
        *others,
        "_error",
        *[F.when(ok, F.try_variant_get("_value", f"$.{f}", "variant")).alias(c) for c, f in fields.items()],
    )

    known = F.col("_error").isNotNull()
    texts = {stage.reasoning_column: MAX_REASONING}
    if stage.has_title:
        texts[stage.title_column] = MAX_TITLE
    decoded = staged.select(
        *others,
        *[F.when(known, truth(F.col(q.column))).alias(q.column) for q in stage.questions],
        *[F.when(known, F.left(as_text(F.col(c)), F.lit(n))).alias(c) for c, n in texts.items()],
        F.col("_error").alias(stage.error_column),
    )
    return decoded.withColumn(stage.score_column, F.when(known_error(stage), stage_score(stage)))


def known_error(stage: Stage) -> Column:
    return F.col(stage.error_column).isNotNull()


def truth(value: Column) -> Column:
    """Python's ``bool`` of a JSON value; a missing one is false."""
    json = F.to_json(value)
    number = json.try_cast("double")
    return (
        F.when(json.isNull() | json.isin("null", "false", '""', "[]", "{}"), False)
        .when(json.substr(1, 1).isin('"', "[", "{", "t"), True)
        .otherwise(F.coalesce(number != 0, F.lit(False)))
    )


def as_text(value: Column) -> Column:
    """Python's ``str`` of a JSON scalar; a missing one is ''. Lists and objects keep their JSON text."""
    json = F.to_json(value)
    return (
        F.when(json.isNull(), "")
        .when(json == "null", "None")
        .when(json == "true", "True")
        .when(json == "false", "False")
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def stage_score(stage: Stage) -> Column:
    """0 unless every gate is true, else the points of all true answers."""
    gates = reduce(and_, [F.coalesce(F.col(q.column), F.lit(False)) for q in stage.gates])
    base = sum(q.points for q in stage.gates)
    extra = [F.when(F.col(q.column), q.points).otherwise(0) for q in stage.extras]
    return F.when(gates, reduce(lambda a, b: a + b, extra, F.lit(base))).otherwise(0).cast("int")


def without_answer(stage: Stage, error: Column) -> dict[str, Column]:
    """The columns of an evaluation that gave nothing but an error."""
    columns: dict[str, Column] = {q.column: F.lit(False) for q in stage.questions}
    if stage.has_title:
        columns[stage.title_column] = F.lit("")
    columns[stage.reasoning_column] = F.lit("")
    columns[stage.score_column] = F.lit(0)
    columns[stage.error_column] = error
    return columns
