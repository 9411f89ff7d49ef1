"""Contact lists from CSV: every field is text, empty fields stay '', ``NA`` stays ``NA``."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import WHITESPACE
from sievework.operators.contacts import add_optional_columns, require_columns
from sievework.sources.records import csv_records

RAW_RECORD = "_corrupt_record"


def normal_name(header: str) -> str:
    return header.removeprefix("\ufeff").strip(WHITESPACE).lower().replace(" ", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip and lowercase column names and put ``_`` for spaces; names must stay distinct."""
    return df.toDF(*_distinct_names(df.columns))


def _distinct_names(headers: list[str]) -> list[str]:
    names = [normal_name(h) for h in headers]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"Several columns are called the same after normalisation: {repeated}")
    return names


def read_contacts(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Contacts, and the raw records that hold more fields than the header.

    A file is read by as many tasks as its size asks for, also where fields contain line breaks. That takes a pass more
    over the files; ``multi_line=False`` saves it where no field has any. In a folder every file must have the same header; one that
    has not fails the read rather than filling the wrong columns.
    """
    reader = spark.read.options(multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE")
    first = reader.option("header", False).csv(path).first()
    if first is None:
        raise ValueError(f"No header line in {path}")
    names = _distinct_names([h or "" for h in first])
    rows = _split_records(spark, path, list(first), names) if multi_line else _lines(reader, path, list(first), names)

    # The record is kept for short rows too, which are legal. Commas outside quotes tell the two apart.
    separators = F.regexp_count(F.regexp_replace(RAW_RECORD, '"[^"]*"', ""), F.lit(","))
    # Spark refuses plans that read nothing but the record (a count), hence the look at the first field.
    readable = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    too_long = F.coalesce(separators > len(names) - 1, F.lit(False)) & readable
    contacts = rows.filter(~too_long).select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])
    quarantined = rows.filter(too_long).select(F.col(RAW_RECORD).alias("record"), *[F.col(f"`{n}`") for n in names])
    return add_optional_columns(require_columns(contacts)), quarantined


def _lines(reader: DataFrameReader, path: str, first: list[str | None], names: list[str]) -> DataFrame:
    """Rows of files whose records are lines."""
    # Spark compares each file's header with the schema, so that has the headers as they are written.
    written = [h if h else f"_c{i}" for i, h in enumerate(first)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*written, RAW_RECORD)])
    # Every field has to be parsed for a record of wrong length to be noticed.
    reader = reader.options(header=True, columnNameOfCorruptRecord=RAW_RECORD, columnPruning=False)
    checked = reader.options(enforceSchema=not all(first))  # a nameless column can't be compared
    return checked.schema(schema).csv(path).toDF(*names, RAW_RECORD)


def _split_records(spark: SparkSession, path: str, first: list[str | None], names: list[str]) -> DataFrame:
    """Rows of files whose records may be many lines."""
    fields = [f"c{i}" for i in range(len(names))]
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": RAW_RECORD}
    schema = ", ".join(f"{c} string" for c in (*fields, RAW_RECORD))
    rows = csv_records(spark, path).withColumn("row", F.from_csv("record", F.lit(schema), options))
    told = F.array(*[F.coalesce(f"row.{c}", F.lit("")) for c in fields])
    told = F.transform(told, lambda h: F.regexp_replace(h, "^\ufeff", ""))
    same = (told == F.array(*[F.lit((h or "").removeprefix("\ufeff")) for h in first])) & F.col(f"row.{RAW_RECORD}").isNull()
    wrong = F.raise_error(F.concat(F.lit("Another header in "), F.col("file"), F.lit(": "), F.col("record"))).cast("boolean")
    rows = rows.filter(F.when(F.col("header"), F.when(same, False).otherwise(wrong)).otherwise(True))
    return rows.select(*[F.col(f"row.{c}").alias(n) for c, n in zip((*fields, RAW_RECORD), (*names, RAW_RECORD), strict=True)])


def land_contacts(spark: SparkSession, path: str, out: str, multi_line: bool = True) -> DataFrame:
    """Read CSV once, number the contacts, store them as Parquet and return the stored table.

    ``contact_id`` is drawn while landing and never again, so later stages, retried tasks and re-runs agree
    on it. Rows with too many fields go to ``<out>_quarantine``.
    """
    contacts, quarantined = read_contacts(spark, path, multi_line)
    contacts.withColumn("contact_id", F.monotonically_increasing_id()).write.mode("overwrite").parquet(out)
    quarantined.write.mode("overwrite").parquet(out.rstrip("/") + "_quarantine")
    return spark.read.parquet(out)
