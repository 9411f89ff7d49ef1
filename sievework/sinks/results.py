"""Result files. Parquet is the main form; CSV holds the same values under quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def csv_values(df: DataFrame) -> DataFrame:
    """Booleans spelled ``True`` and ``False``; other columns as they are."""
    spelled = {
        f.name: F.when(F.col(f.name), "True").when(~F.col(f.name), "False")
        for f in df.schema.fields
        if isinstance(f.dataType, T.BooleanType)
    }
    return df.withColumns(spelled) if spelled else df


def write_results(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_results_csv(df: DataFrame, path: str) -> None:
    """CSV with header, every field quoted, quotes doubled."""
    (
        csv_values(df)
        .write.mode("overwrite")
        .options(header=True, quoteAll=True, quote='"', escape='"', timestampFormat=TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_requests(requests: DataFrame, path: str) -> None:
    """Requests as JSON lines for an external batch service."""
    requests.write.mode("overwrite").json(path)
