"""Exactly one row per message identifier out of at-least-once deliveries.

An identifier made of digits is a producer (its length and leading digits) and a sequence number. Per producer the
numbers already accepted are kept as disjoint ranges; a number outside them is accepted once and the ranges grow.
Any other identifier is looked up by its exact text.

Plan: (1) inside every Arrow batch one candidate per number is kept, so a hot identifier leaves a row per batch;
(2) one shuffle by producer and block of numbers, in which rows already known to be surplus are spread by row id;
(3) each sorted partition is walked once, with the range that is growing as its only state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRODUCER_DIGITS = 4  # leading digits that name the producer
BLOCK_BITS = 16  # numbers of one block are walked by one task

_WALK = "kind string, message_id string, producer string, row_id bigint, lo bigint, hi bigint, n bigint"


def split_identifier(identifier: Column, producer_digits: int = PRODUCER_DIGITS) -> tuple[Column, Column]:
    """(producer, number). Well-formed: digits only, up to 18 after the producer's. Others are their own producer, number 0."""
    well = identifier.rlike(rf"^[0-9]{{{producer_digits + 1},{producer_digits + 18}}}$")
    named = F.concat(F.length(identifier).cast("string"), F.lit(":"), F.substring(identifier, 1, producer_digits))
    number = identifier.substr(F.lit(producer_digits + 1), F.length(identifier))
    return F.when(well, named).otherwise(F.concat(F.lit("="), identifier)), F.when(well, number.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        code = b.column("producer").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        number, at, row = (b.column(c).to_numpy(zero_copy_only=False) for c in ("number", "at", "row_id"))
        order = np.lexsort((row, at, number, code))
        again = np.zeros(len(order), bool)
        again[1:] = (code[order][1:] == code[order][:-1]) & (number[order][1:] == number[order][:-1])
        covered = np.zeros(len(order), bool)
        covered[order] = again
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("message_id", "producer", "number", "at", "row_id")], pa.array(covered)], ["message_id", "producer", "number", "at", "row_id", "covered"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (covered, producer, number, at, row_id). Emits the surplus rows and the ranges."""
    producer, lo, hi, n = None, 0, -1, 0  # the range that grows; its producer is None before the first row

    def out(kind: str, ids: pa.Array, producers: pa.Array, rows: pa.Array, los: pa.Array, his: pa.Array, ns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(rows), pa.string()), ids, producers, rows, los, his, ns], ["kind", "message_id", "producer", "row_id", "lo", "hi", "n"])

    def ranges(ps: list, ls: list, hs: list, ns: list) -> pa.RecordBatch:
        k = len(ps)
        return out("range", pa.nulls(k, pa.string()), pa.array(ps, pa.string()), pa.nulls(k, pa.int64()), pa.array(ls, pa.int64()), pa.array(hs, pa.int64()), pa.array(ns, pa.int64()))

    for b in batches:
        if not b.num_rows:
            continue
        known = b.column("covered").to_numpy(zero_copy_only=False)
        names = b.column("producer")
        number, row = (b.column(c).to_numpy(zero_copy_only=False) for c in ("number", "row_id"))
        fresh = np.flatnonzero(~known)
        covered = known.copy()
        if len(fresh):
            coded = names.take(pa.array(fresh)).dictionary_encode()
            code, words, num = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, number[fresh]
            same = np.zeros(len(fresh), bool)
            same[1:] = code[1:] == code[:-1]
            prior = np.empty(len(fresh), np.int64)
            prior[1:] = num[:-1]
            if producer is not None and words[code[0]].as_py() == producer:
                same[0], prior[0] = True, hi
            dup = same & (num <= prior)
            covered[fresh[dup]] = True
            kept = np.flatnonzero(~dup)
            if len(kept):
                extends = same[kept] & (num[kept] == prior[kept] + 1) & (num[kept] & (2**BLOCK_BITS - 1) != 0)
                starts = kept[~extends]
                edges = np.searchsorted(kept, starts)
                ps, ls, hs, ns = [], [], [], []
                if producer is not None:
                    ps, ls, hs, ns = [producer], [lo], [hi], [n]
                    grown = edges[0] if len(edges) else len(kept)
                    if grown:
                        hs[0], ns[0] = int(num[kept[grown - 1]]), n + int(grown)
                ends = np.append(edges[1:], len(kept)) if len(edges) else edges
                for s, e in zip(edges, ends, strict=True):
                    ps.append(words[code[kept[s]]].as_py())
                    ls.append(int(num[kept[s]]))
                    hs.append(int(num[kept[e - 1]]))
                    ns.append(int(e - s))
                producer, lo, hi, n = ps.pop(), ls.pop(), hs.pop(), ns.pop()
                if ps:
                    yield ranges(ps, ls, hs, ns)
        surplus = pa.array(np.flatnonzero(covered))
        if len(surplus):
            k = len(surplus)
            void = pa.nulls(k, pa.int64())
            yield out("surplus", b.column("message_id").take(surplus), names.take(surplus), pa.array(row[covered]), void, void, void)
    if producer is not None:
        yield ranges([producer], [lo], [hi], [n])


def deliveries(df: DataFrame, identifier: str, received: str, row: str, producer_digits: int = PRODUCER_DIGITS) -> DataFrame:
    """Walks all deliveries; rows of kind ``surplus`` (message_id, row_id) and ``range`` (producer, lo, hi, n).

    The earliest ``received`` of an identifier stays, the smallest ``row`` in a tie; a null ``received`` is later than
    any other. Null identifiers are never surplus and enter no range. ``row`` must be unique. Identifiers are compared
    as exact texts: leading zeros and blanks count. Ranges don't cross blocks of 2**16 numbers.
    """
    producer, number = split_identifier(F.col(identifier), producer_digits)
    at = F.coalesce(F.unix_micros(F.col(received)), F.lit(2**63 - 1).cast("bigint"))
    rows = df.where(F.col(identifier).isNotNull()).select(
        F.col(identifier).alias("message_id"), producer.alias("producer"), number.alias("number"), at.alias("at"), F.col(row).cast("bigint").alias("row_id")
    )
    combined = rows.mapInArrow(_combine, "message_id string, producer string, number bigint, at bigint, row_id bigint, covered boolean")
    place = F.when(F.col("covered"), F.xxhash64("row_id")).otherwise(F.xxhash64("producer", F.shiftright("number", BLOCK_BITS)))
    return (
        combined.withColumn("_place", place)
        .repartition("_place")
        .drop("_place")
        .sortWithinPartitions("covered", "producer", "number", "at", "row_id")
        .mapInArrow(_walk, _WALK)
    )


def surplus_rows(df: DataFrame, identifier: str, received: str, row: str, producer_digits: int = PRODUCER_DIGITS) -> DataFrame:
    """(message_id, row_id) of every row beyond the first of its identifier; see ``deliveries``."""
    return deliveries(df, identifier, received, row, producer_digits).where("kind = 'surplus'").select("message_id", "row_id")


def exactly_once(df: DataFrame, identifier: str, received: str, row: str, producer_digits: int = PRODUCER_DIGITS) -> DataFrame:
    """``df`` without its surplus rows (an anti join by the unique row id, so hot identifiers don't meet in one task)."""
    return df.join(surplus_rows(df, identifier, received, row, producer_digits).select(F.col("row_id").alias(row)), row, "left_anti")


def seen_ranges(df: DataFrame, identifier: str, received: str, row: str, producer_digits: int = PRODUCER_DIGITS) -> DataFrame:
    """Disjoint ranges (producer, lo, hi, n) of well-formed numbers, cut at block borders: the state kept between runs."""
    return deliveries(df, identifier, received, row, producer_digits).where("kind = 'range' and producer not like '=%'").select("producer", "lo", "hi", "n")


def not_seen(df: DataFrame, identifier: str, seen: DataFrame, producer_digits: int = PRODUCER_DIGITS) -> DataFrame:
    """Rows whose number no range of ``seen`` covers. Ranges are cut at blocks, so this is an equality join by
    (producer, block) with the bounds as a condition; rows with malformed or null identifiers pass."""
    producer, number = split_identifier(F.col(identifier), producer_digits)
    names = ("__producer", "__number", "__block")  # unlikely to be the names of columns of df
    rows = df.withColumns(dict(zip(names, (producer, number, F.shiftright(number, BLOCK_BITS)), strict=True)))
    known = seen.select(F.col("producer").alias("__seen_producer"), F.shiftright("lo", BLOCK_BITS).alias("__seen_block"), F.col("lo").alias("__seen_lo"), F.col("hi").alias("__seen_hi"))
    inside = (F.col("__producer") == F.col("__seen_producer")) & (F.col("__block") == F.col("__seen_block")) & F.col("__number").between(F.col("__seen_lo"), F.col("__seen_hi"))
    return rows.join(known, inside, "left_anti").drop(*names)


def merge_seen(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two sets of block-cut ranges as disjoint ranges (producer, lo, hi, n)."""
    from pyspark.sql import Window

    block = F.shiftright("lo", BLOCK_BITS)
    w = Window.partitionBy("producer", block).orderBy("lo", "hi")
    both = a.unionByName(b).withColumn("_before", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    islands = both.withColumn("_island", F.sum(F.when(F.col("_before") >= F.col("lo") - 1, 0).otherwise(1)).over(w))
    return (
        islands.groupBy("producer", block.alias("_block"), "_island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select("producer", "lo", "hi", (F.col("hi") - F.col("lo") + 1).alias("n"))
    )
