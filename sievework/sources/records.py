"""Records of CSV files whose fields may hold line breaks, read by many tasks however large a file is.

Files are read in blocks, as Spark splits text. Whether a line break ends a record depends on all quotes before it, so a
first pass finds, per block, what it makes of either start (outside or inside of quotes); running through the blocks of a
file then gives each block's true start. A second pass cuts blocks into records, and the few records that lie across
blocks are put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_QUOTED = re.compile(r'"(?:[^"]|"")*+"')
_REST = re.compile(r'(?:[^"]|"")*+"')
_WHOLE, _CONTINUES, _BEGINS = 0, 1, 2
_RECORDS_AT_ONCE = 4096


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts outside or inside of a quoted field ends inside of one.

    A quote opens a field only as its first sign; doubled it stands for itself; what follows the closing one belongs to
    the field up to the comma.
    """
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _REST.match(line)
        if not closed:
            return True
        at = line.find(",", closed.end()) + 1
        if not at:
            return False
    while True:
        if line.startswith('"', at):
            closed = _QUOTED.match(line, at)
            if not closed:
                return True
            at = closed.end()
        at = line.find(",", at) + 1
        if not at:
            return False


def _blocks(batches) -> Iterator[tuple[str, int, list[str]]]:
    """Lines as they come: (file, start of the block, lines). A block may come in several parts."""
    for batch in batches:
        values = batch["value"].to_pylist()
        rows = zip(batch["file"].to_pylist(), batch["block"].to_pylist(), values, strict=True)
        for (file, block), own in groupby(rows, key=lambda r: (r[0], r[1])):
            yield file, block, [r[2] for r in own]


def _outcomes(batches) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], tuple[bool, bool]] = {}
    for file, block, lines in _blocks(batches):
        outside, inside = found.get((file, block), (False, True))
        for line in lines:
            if '"' in line:
                same = outside == inside
                outside = ends_inside(line, outside)
                inside = outside if same else ends_inside(line, inside)
        found[file, block] = outside, inside
    columns = [[k[0] for k in found], [k[1] for k in found], [v[0] for v in found.values()], [v[1] for v in found.values()]]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "from_outside", "from_inside"])


def block_starts(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Per block whether it starts inside of quotes: one row a block comes to the driver, some hundred bytes per 128 MB.

    A block that ends alike from either start decides what follows; one that doesn't keeps or swaps the state. The state
    is the last decision, swapped as often as blocks since then swap.
    """
    blocks = lines.mapInArrow(_outcomes, "file string, block long, from_outside boolean, from_inside boolean")
    so_far = Window.partitionBy("file").orderBy("block")
    decides = F.col("from_outside") == F.col("from_inside")
    swaps = F.sum(F.when(~decides & F.col("from_outside"), 1).otherwise(0)).over(so_far) % 2
    decided = F.when(decides, F.col("from_outside").cast("int").bitwiseXOR(F.col("swaps")))
    after = F.coalesce(F.last("decided", True).over(so_far), F.lit(0)).bitwiseXOR(F.col("swaps"))
    states = blocks.withColumn("swaps", swaps.cast("int")).withColumn("decided", decided).withColumn("after", after)
    states = states.select("file", "block", F.coalesce(F.lag("after").over(so_far), F.lit(0)).alias("inside"))
    return {(r["file"], r["block"]): bool(r["inside"]) for r in states.collect()}


class _Cutter:
    """Cuts the lines of one block into records."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.kind = _CONTINUES if inside else _WHOLE
        self.lines: list[str] = []
        self.headless = block == 0  # the header, a file's first record, is still to come

    def add(self, lines: list[str]) -> Iterator[tuple]:
        for line in lines:
            self.lines.append(line)
            self.inside = ends_inside(line, self.inside)
            if not self.inside:
                yield from self._record(self.kind)
                self.kind = _WHOLE

    def rest(self) -> Iterator[tuple]:
        if self.lines:
            yield from self._record(_CONTINUES if self.kind == _CONTINUES else _BEGINS)

    def _record(self, kind: int) -> Iterator[tuple]:
        record = "\n".join(self.lines)
        self.lines = []
        if record.strip("\r") or kind != _WHOLE:
            yield self.file, self.block, kind, self.headless, record
            self.headless = False


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, header (whether it is the file's first record) and record, a row per record that is not empty.

    Within a block records come in order. Line breaks are ``\\n`` or ``\\r\\n``; inside of fields they stay as they are.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    starts = block_starts(lines)

    def cut(batches):
        held: list[tuple] = []
        current = None
        for file, block, own in _blocks(batches):
            if current is None or (current.file, current.block) != (file, block):
                held += current.rest() if current else ()
                current = _Cutter(file, block, starts[file, block])  # a block that the first pass didn't see is an error
            for record in current.add(own):
                held.append(record)
                if len(held) >= _RECORDS_AT_ONCE:
                    yield _records(held)
                    held = []
        held += current.rest() if current else ()
        yield _records(held)

    parts = lines.mapInArrow(cut, "file string, block long, kind int, header boolean, record string")
    whole = parts.filter(F.col("kind") == _WHOLE).select("file", "header", "record")
    # Of records across blocks there is at most one beginning and one end a block.
    so_far = Window.partitionBy("file").orderBy("block", "kind")
    begun = F.last(F.when(F.col("kind") == _BEGINS, F.col("block")), True).over(so_far)
    pieces = parts.filter(F.col("kind") != _WHOLE).withColumn("begun", begun)
    piece = F.struct("block", "kind", "record")
    joined = pieces.groupBy("file", "begun").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("header").alias("header"))
    joined = joined.select("file", "header", F.array_join(F.col("pieces.record"), "\n").alias("record"))
    every = whole.unionByName(joined) if len(starts) > 1 else parts.select("file", "header", "record")
    return every.withColumn("record", F.regexp_replace("record", "\r\\z", ""))


def _records(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ["file", "block", "kind", "header", "record"], [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
