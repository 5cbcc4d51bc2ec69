"""SimHash near-duplicates, found with pivot distance tables.

Every text gets a 64-bit fingerprint; fingerprints within `max_bits` differing
bits are linked and linked groups are the components of those links.

How pairs are found, without comparing all with all:

1. Exact copies fold into one row per distinct fingerprint.
2. The bits are cut into `blocks` runs.  Of two fingerprints with at most
   `max_bits` differing bits, `blocks - max_bits` runs agree, so every choice of
   that many runs is a join key and no link is lost.
3. Each fingerprint carries its row of the pivot distance table: its Hamming
   distances to PIVOTS reference fingerprints.  By the triangle inequality the
   distances of two fingerprints to any reference differ by no more than their
   own distance, so a pair under one key is discarded when its largest
   coordinate difference exceeds `max_bits`; survivors are verified bit by bit.
4. Within a key, rows are first compared with the key's smallest fingerprint
   only.  What that connects needs no further comparing with each other: the
   second pass compares rows of different groups, never all pairs of a group.
5. A key that keeps more than CROWD rows outside its largest group isn't paired
   at all.  Its rows get finer keys: the bits that the key leaves open are cut
   into `blocks` runs again, `blocks - max_bits` of which agree for any link, and
   steps 3 and 4 start over.  Under a key that leaves OPEN bits there are at most
   2^OPEN different fingerprints, so refining ends and no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planmart.llm.common import all_of, arrow_batches, without, written
from planmart.llm.components import connected_components
from planmart.llm.pieces import forget, texts_of

SEED = 42
BITS = 64
RUN_BYTES = 2 << 20  # of texts that are Python objects at a time, about
PIVOTS = 16          # reference fingerprints: XXH64 of 0..15
PER_LONG = 8         # distances of 0..64, eight bits each, packed into longs
CROWD = 256          # rows outside a key's largest group, beyond which its rows get finer keys
OPEN = 10            # bits that a key leaves open, from which on it isn't refined


def text_fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text: shingles of `shingle` words, repeats included; a bit
    is set if it is set in over half of their hashes.  No word: zero."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        runs = zip(*(words[i:] for i in range(shingle)), strict=False)
        hashes = [xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs]
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):     # bounded memory for very long texts
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """The fingerprint of a text column, as a signed long."""
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        for column in columns:
            made = [text_fingerprint(t, shingle) for texts in texts_of(column, RUN_BYTES) for t in texts]
            yield pa.array(np.array(made, dtype=np.uint64).view(np.int64))

    return F.arrow_udf(of, T.LongType())(text)


def pivot_table(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """`prints` with its distances to the references, packed into PIVOTS / 8 longs d0, d1, ..."""
    def packed(first: int) -> Column:
        out = F.lit(0).cast("long")
        for i in range(PER_LONG):
            distance = F.bit_count(F.col(fp).bitwiseXOR(F.xxhash64(F.lit(first + i)))).cast("long")
            out = out.bitwiseOR(F.shiftleft(distance, 8 * i))
        return out

    return prints.withColumns({f"d{k}": packed(k * PER_LONG) for k in range(PIVOTS // PER_LONG)})


def _close(a: str, b: str, max_bits: int) -> Column:
    """No coordinate differs by more than `max_bits`; then the bits themselves are compared."""
    near = [F.abs(F.shiftright(F.col(f"{a}.d{i // PER_LONG}"), 8 * (i % PER_LONG)).bitwiseAND(F.lit(127))
                  - F.shiftright(F.col(f"{b}.d{i // PER_LONG}"), 8 * (i % PER_LONG)).bitwiseAND(F.lit(127)))
            <= max_bits for i in range(PIVOTS)]
    return all_of([*near, F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= max_bits])


def finer_masks(mask: int, max_bits: int, blocks: int) -> list[int]:
    """Every choice of bits to agree besides those of `mask`: two fingerprints that agree in `mask` and
    differ in `max_bits` bits at most agree in one of the masks returned."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    edges = [len(free) * i // blocks for i in range(blocks + 1)]
    runs = [sum(1 << b for b in free[lo:hi]) for lo, hi in itertools.pairwise(edges)]
    return [mask | sum(chosen) for chosen in itertools.combinations(runs, blocks - max_bits)]


def _signed(mask: int) -> int:
    return np.uint64(mask).astype(np.int64).item()


def _refined(rows: DataFrame, masks: list[int], max_bits: int, blocks: int) -> tuple[DataFrame, list[int]]:
    """`rows` (mask: one of `masks`, fp, ...) under the finer keys (mask, key) of their masks, and these masks.

    The table of masks has len(masks) rows, whatever the input.
    """
    finer = {m: finer_masks(m, max_bits, blocks) for m in masks}
    if len(masks) == 1:                                # nothing to look up
        table = rows.withColumn("finer", F.array(*[F.lit(_signed(f)) for f in finer[masks[0]]]))
    else:
        steps = rows.sparkSession.createDataFrame(
            [(_signed(m), [_signed(f) for f in fs]) for m, fs in finer.items()], "mask long, finer array<long>")
        table = rows.join(F.broadcast(steps), "mask")
    table = (table.drop("mask", "key").withColumn("mask", F.explode("finer")).drop("finer")
             .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
    return table, sorted({f for fs in finer.values() for f in fs})


def link_components(prints: DataFrame, max_bits: int = 3, blocks: int = 5) -> DataFrame:
    """(fp, component) of the distinct fingerprints `prints` (fp) that have a link."""
    table = pivot_table(prints)
    on = ["mask", "key"]
    rows, masks = _refined(table, [0], max_bits, blocks)
    rows = rows.withColumn("component", F.col("fp"))
    first, links = None, []
    while True:
        # First pass: rows against their key's smallest fingerprint.
        shared = (rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n"),
                                        F.min(F.struct(*table.columns, "component")).alias("l"))
                  .where("n > 1").drop("n"))
        rows = written(rows.join(shared, on))
        star = (rows.alias("r").where((F.col("r.component") != F.col("l.component")) & _close("r", "l", max_bits))
                .select(F.col("r.component").alias("a"), F.col("l.component").alias("b")))
        if first is not None:
            star = written(star.distinct())
            links.append(star)
        groups = connected_components(star)
        first = groups if first is None else first

        # Second pass: under each key, rows outside its most frequent group against rows of other groups.
        rows = (rows.drop("l").join(groups.toDF("component", "group"), "component", "left")
                .withColumn("component", F.coalesce("group", "component")).drop("group"))
        sizes = rows.groupBy(*on, "component").agg(F.count(F.lit(1)).alias("n"))
        main = (sizes.groupBy(*on).agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                       F.count(F.lit(1)).alias("groups"), (F.sum("n") - F.max("n")).alias("rest"))
                .where("groups > 1").drop("groups"))
        mixed = written(rows.join(main, on))
        crowd = F.lit(False)
        if BITS - min(m.bit_count() for m in masks) > OPEN:
            crowd = F.col("rest") > CROWD
        pairs = mixed.where(~crowd)
        links.append(pairs.where("component != main").alias("x").join(pairs.alias("y"), on)
                     .where((F.col("x.component") != F.col("y.component")) & _close("x", "y", max_bits))
                     .select(F.col("x.component").alias("a"), F.col("y.component").alias("b")))
        crowded = mixed.where(crowd).drop("main", "rest")
        if crowded.isEmpty():
            break
        rows, masks = _refined(crowded, masks, max_bits, blocks)

    # Later links are between components of the first pass; a fingerprint without one is its own there.
    merged = connected_components(reduce(DataFrame.unionByName, links)).toDF("component", "top")
    named = first.toDF("fp", "component").unionByName(
        merged.select(F.col("component").alias("fp"), "component")).distinct()
    return (named.join(merged, "component", "left")
            .select("fp", F.coalesce("top", "component").alias("component")))


def near_duplicates(docs: DataFrame, max_bits: int = 3, blocks: int = 5) -> DataFrame:
    """`docs` (doc_id, fp, ...) with component (a fingerprint) and its smallest doc_id, component_id.

    `docs` should be a written table: it is read more than once.  NULL doc_ids
    take part in linking and never are the smallest, unless a component has no
    other.  Repeated rows fall into the same component.
    """
    firsts = written(docs.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = link_components(firsts.select("fp"), max_bits, blocks)
    component = F.coalesce("component", "fp")
    firsts = firsts.join(linked, "fp", "left").withColumn("component", component)
    smallest = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = firsts.join(smallest, "component").select("fp", "component", "component_id")
    return without(docs, "component", "component_id").join(ids, "fp")


def dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, blocks: int = 5) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs` (doc_id, text).

    NULL and blank texts have the fingerprint zero and link like any other.
    Texts are used whole.  Other columns of `docs` are ignored; an empty table
    gives no rows.
    """
    prints = written(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")))
    return near_duplicates(prints, max_bits, blocks).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, blocks: int = 5) -> DataFrame:
    """`docs` with one row of each component: the smallest doc_id, the first row where it repeats.

    All columns of `docs` are returned; NULL doc_ids come after all others.
    """
    names = docs.columns
    with arrow_batches(docs.sparkSession, RUN_BYTES):
        table = written(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                                    F.col("doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                                    fingerprint(F.col("text"), shingle).alias("fp")))
    found = near_duplicates(table.select("doc_id", "row", "fp"), max_bits, blocks)
    keep = (found.groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")).alias("best"))
            .select("best.row"))
    return (table.join(keep, "row", "left_semi")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]))
