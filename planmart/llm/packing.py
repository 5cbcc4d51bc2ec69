"""Packing documents into sequences: bounded-space best fit per partition, leftovers merged.

Each partition keeps at most `open_windows` windows open.  A piece goes into
the fullest window that still has room for it (best fit); when none has, a new
window opens, and if that would be one too many the fullest is emitted first.
What is open at a partition's end is merged with the leftovers of other
partitions, FAN partitions at a time, level by level, by the same rule with
whole windows as the items.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmart.llm.common import arrow_batches, written
from planmart.llm.pieces import texts_of
from planmart.llm.tokens import RUN_CHARS, text_ids

FAN = 64                      # partitions (or groups) whose leftovers meet in one task
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, full boolean"
_MOVES = "window long, into long, shift long, full boolean, part long"


class Windows:
    """At most `most` open windows of `size` tokens; best fit, fullest out."""

    def __init__(self, size: int, most: int, first_id: int, on_full):
        self.size, self.most, self.next_id, self.on_full = size, most, first_id, on_full
        self.open: list[tuple[int, int]] = []         # (room, id), by room

    def place(self, length: int) -> tuple[int, int]:
        """(window id, offset) of an item of `length` <= size."""
        at = bisect_left(self.open, (length, -1))     # least room that is enough
        if at < len(self.open):
            room, window = self.open.pop(at)
        else:
            if len(self.open) >= self.most:
                self.on_full(self.open.pop(0)[1])     # the fullest
            room, window = self.size, self.next_id
            self.next_id += 1
        if room > length:
            insort(self.open, (room - length, window))
        else:
            self.on_full(window)
        return window, self.size - room


def _first_id(level: int, part: int) -> int:
    """Window ids: 6 bits of level, 27 of partition, 30 of running number."""
    return level << 57 | part << 30


def _pieces(docs: DataFrame, path: str, end_id: int, size: int, open_windows: int, run_chars: int) -> DataFrame:
    """The pieces of every document with the window each lies in; full: that window is closed."""
    end = int(end_id).to_bytes(4, "little")
    names = [x.split()[0] for x in _PIECES.split(", ")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        closed: set[int] = set()
        held: dict[int, list[tuple]] = {}             # pieces of the open windows
        ready: list[tuple] = []

        def on_full(window: int) -> None:
            ready.extend((*p, True) for p in held.pop(window, []))
            closed.add(window)

        windows = Windows(size, open_windows, _first_id(0, part), on_full)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.bool_() if n == "full" else pa.int64())
                 for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)

        for batch in batches:
            ids_of = (ids for texts in texts_of(batch.column("text"), run_chars) for ids in text_ids(texts, path, run_chars))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, size):
                    cut = ids[4 * start:4 * (start + size)]
                    window, offset = windows.place(len(cut) // 4)
                    piece = (doc, start, len(cut) // 4, zlib.crc32(cut), total, window, offset)
                    if window in closed:
                        closed.discard(window)
                        ready.append((*piece, True))
                    else:
                        held.setdefault(window, []).append(piece)
                closed.clear()
            if ready:
                yield out(ready)
                ready.clear()
        if held:
            yield out([(*p, False) for pieces in held.values() for p in pieces])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, _PIECES)


def _merge(leftovers: DataFrame, size: int, open_windows: int, level: int) -> DataFrame:
    """Leftover windows (window, filled, part) packed again, FAN parts to a task:
    into which window each goes and how far its pieces shift."""
    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        full: set[int] = set()
        windows = Windows(size, open_windows, _first_id(level, int(key[0])), full.add)
        group = group.sort_values(["filled", "window"], ascending=[False, True])
        rows = [(w, *windows.place(int(n))) for w, n in zip(group["window"], group["filled"], strict=True)]
        return pd.DataFrame([(w, into, shift, into in full, int(key[0])) for w, into, shift in rows],
                            columns=[x.split()[0] for x in _MOVES.split(", ")])

    return (leftovers.groupBy(F.floor(F.col("part") / FAN).alias("group"))
            .applyInPandas(of, _MOVES))


def pack(docs: DataFrame, path: str, end_id: int = 2, size: int = 4096, open_windows: int = 64,
         run_chars: int | None = None) -> DataFrame:
    """A row for each piece of each document of `docs` (doc_id, text): doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and `end_id`, cut every `size` ids; NULL and empty
    texts are the end id alone.  Repeated rows are packed each; NULL doc_ids
    stay; other columns are ignored; an empty table gives no rows.  `run_chars`: about
    so much text is held at a time; less takes more time and changes no row.
    """
    run_chars = run_chars or RUN_CHARS
    with arrow_batches(docs.sparkSession, run_chars):     # a run of texts each, in the worker and in the executor
        pieces = written(_pieces(docs, path, end_id, size, open_windows, run_chars))
    done = pieces.where("full").drop("full").withColumnRenamed("window", "sequence_id")
    loose = written(pieces.where("NOT full").drop("full"))
    part = F.shiftright("window", 30).bitwiseAND(F.lit((1 << 27) - 1))
    leftovers = loose.groupBy("window").agg(F.sum("length").alias("filled")).withColumn("part", part)
    parts = leftovers.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    moves = None                                      # window -> (into, shift) over all levels so far
    level = 0
    while True:
        level += 1
        parts = -(-parts // FAN)
        step = written(_merge(leftovers, size, open_windows, level))
        if moves is None:
            moves = step.select("window", "into", "shift")
        else:
            later = step.select(F.col("window").alias("into"), F.col("into").alias("then"),
                                F.col("shift").alias("more"))
            moves = written(moves.join(later, "into", "left").select(
                "window", F.coalesce("then", "into").alias("into"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")))
        if parts == 1:
            break
        # a window that was closed here stays; the open ones meet those of other groups
        sizes = leftovers.join(step, "window").where("NOT full")
        leftovers = (sizes.groupBy(F.col("into").alias("window")).agg(F.sum("filled").alias("filled"))
                     .withColumn("part", part))
    placed = (loose.join(moves, "window")
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      F.col("into").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset")))
    return done.select(*placed.columns).unionByName(placed)
