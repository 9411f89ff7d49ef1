"""Packing: documents' token ids into sequences of one length, first fit decreasing in random groups."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.tables import stored
from sievework.llm.tokens import Identifiers, vocabulary_path
from sievework.llm.workers import bounds_of, in_groups, per_worker

CAPACITY = 2048
END_ID = 1
PIECES_PER_GROUP = 8192
SEED = 6
_TEXTS_AT_ONCE = 200


def first_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin and offset of each item, put into the first bin with room for it. Sizes are given in falling order.

    A tournament tree holds the room left in each bin: a node has the greatest room below it, so the first bin that
    fits is found from the root in as many steps as the tree is deep.
    """
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bins.append(at - leaves)
        offsets.append(capacity - room[at])
        room[at] -= size
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return bins, offsets


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool, remembered: int) -> DataFrame:
    """Token ids of each row cut into pieces of ``capacity`` and a rest: piece, doc_id, start, length, ids_crc32, doc_tokens, ids."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        piece = TaskContext.get().partitionId() << 33  # pieces are numbered within the task
        ids_of = per_worker(("ids", path, remembered), lambda: Identifiers(path, remembered)).of
        for whole in batches:
            for low in range(0, whole.num_rows, _TEXTS_AT_ONCE):
                batch = whole.slice(low, _TEXTS_AT_ONCE)
                texts = [t or "" for t in batch["text"].to_pylist()]
                out: list[list] = [[] for _ in range(7)]
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), ids_of(texts), strict=True):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        own = ids[4 * start : 4 * (start + capacity)]
                        values = (piece, doc_id, start, len(own) // 4, zlib.crc32(own), total, own if keep_ids else None)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                        piece += 1
                kinds = [pa.int64()] * 6 + [pa.binary()]
                names = ["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    pieces_per_group: int = PIECES_PER_GROUP,
    seed: int = SEED,
    keep_ids: bool = True,
    remembered: int = 256 << 20,
) -> DataFrame:
    """Packs the token ids of all rows (doc_id, text) into sequences of at most ``capacity`` ids.

    Per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with ``keep_ids``
    its ids as 32-bit numbers (null otherwise, so that only lengths are shuffled). A document's ids end with ``end_id``.
    They are cut into pieces of ``capacity`` and a rest; a full piece is a sequence of its own. Rests are dealt at random
    into groups of about ``pieces_per_group``, and each group is packed first fit decreasing; larger groups waste less
    and take longer in one task. Sequence ids are unique, those of full pieces negative; within a sequence pieces follow without a
    gap.

    A worker remembers the ids of words in about ``remembered`` bytes; fewer make it slower, and change nothing else.

    Null or empty text is the end id alone. Repeated rows are packed each for itself, ties by the pieces' numbers. Other columns are
    ignored; an empty table gives an empty result. The pieces are stored before they are dealt, so a group's members do
    not change if a task runs again.
    """
    cut = stored(pieces(docs, path or vocabulary_path(), capacity, end_id, keep_ids, remembered), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = cut.filter(F.col("length") == capacity)
    alone = full.select(*columns, (-1 - F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
    rests = cut.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // pieces_per_group))
    dealt = rests.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "piece"), F.lit(groups)))

    def packed(table: pa.Table):
        bounds = bounds_of(table, ["group"])
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = table.slice(low, high - low)
            order = np.lexsort((own["piece"].to_numpy(), -own["length"].to_numpy()))
            own = own.take(pa.array(order))
            bins, offsets = first_fit(own["length"].to_pylist(), capacity)
            sequence = np.array(bins, np.int64) + (own["group"][0].as_py() << 32)
            added = own.select(columns).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets, pa.int64()))
            yield from added.append_column("ids", own["ids"]).to_batches()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return in_groups(dealt, ["group"], packed, schema).unionByName(alone)
