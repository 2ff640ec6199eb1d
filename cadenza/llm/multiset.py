"""Records that are equal but for white space, letter case, punctuation or field order.

Each (field name, normalised value) pair is hashed twice; the sums of the hashes over a record's fields are its
fingerprint, whatever their order.

Plan: (1) every Arrow batch finds its own groups by fingerprint and verifies their fields, so a hot group leaves one
head row for each batch, and beside it narrow rows that name their head; (2) heads are shuffled by fingerprint and
grouped by a hash aggregate whose keys include the whole fields, which verifies that they are equal; (3) heads that are
themselves copies hand their group's first id on to their narrow rows by a hash join, in which no head has more rows
than a batch holds. The table is read once and nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.tables import written

LANE = (1 << 56) - 1  # a sum of up to 128 fields fits a signed 64-bit number


def letters_and_digits(value: Column) -> Column:
    """Lower-cased letters (with their accents, as they are) and digits in order; null stays null."""
    return F.lower(F.regexp_replace(value.cast("string"), r"[^\p{L}\p{M}\p{N}]+|[\x{FE00}-\x{FE0F}\x{200B}-\x{200D}]", ""))


def fingerprint(fields: dict[str, Column]) -> tuple[Column, Column]:
    """Two 56-bit sums over the record's (name, value) pairs; a null field adds nothing."""

    def lane(tag: str) -> Column:
        return reduce(Column.__add__, [F.when(v.isNotNull(), F.xxhash64(F.lit(f"{tag}{name}"), v).bitwiseAND(LANE)).otherwise(F.lit(0).cast("bigint")) for name, v in fields.items()])

    return lane("a:"), lane("b:")


def _keyed(df: DataFrame, row: str, fields: Sequence[str]) -> DataFrame:
    values = df.select(F.col(row).cast("bigint").alias("_id"), *[letters_and_digits(F.col(c)).alias(f"_f{i}") for i, c in enumerate(fields)])
    a, b = fingerprint({c: F.col(f"_f{i}") for i, c in enumerate(fields)})
    return values.withColumns({"_a": a, "_b": b})


def local_heads(ids: np.ndarray, mixed: np.ndarray, fields: Sequence[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """(the place of each row's head within the batch, how many rows a head stands for). The head is the group's smallest
    id. A row whose fields differ from those of its fingerprint's head is its own head."""
    code, _ = pd.factorize(mixed)  # by hashing, in order of appearance
    least = np.full(code.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids)
    place = np.zeros(len(least), np.int64)
    smallest = np.flatnonzero(ids == least[code])
    place[code[smallest]] = smallest
    head = place[code]
    other = np.flatnonzero(head != np.arange(len(ids)))
    if len(other):
        same = np.ones(len(other), bool)
        for f in fields:
            mine, its = f.take(pa.array(other)), f.take(pa.array(head[other]))
            equal = pc.fill_null(pc.equal(mine, its), False).to_numpy(zero_copy_only=False)
            same &= equal | (mine.is_null().to_numpy(zero_copy_only=False) & its.is_null().to_numpy(zero_copy_only=False))
        head[other[~same]] = other[~same]
    return head, np.bincount(head, minlength=len(ids))


def _combine(n_fields: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [*[f"_f{i}" for i in range(n_fields)], "_a", "_b", "_id", "_n", "_head"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda c, b=batch: b.column(c).to_numpy(zero_copy_only=False)
            fields = [batch.column(f"_f{i}") for i in range(n_fields)]
            ids = column("_id")
            head, n = local_heads(ids, column("_a").view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + column("_b").view(np.uint64), fields)
            own = head == np.arange(len(ids))
            heads, rest = pa.array(np.flatnonzero(own)), np.flatnonzero(~own)
            void = pa.nulls(len(heads), pa.int64())
            yield pa.RecordBatch.from_arrays([*[f.take(heads) for f in fields], *[batch.column(c).take(heads) for c in ("_a", "_b", "_id")], pa.array(n[own]), void], names)
            if len(rest):
                void = pa.nulls(len(rest), pa.int64())
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(rest), pa.string())] * n_fields, void, void, pa.array(ids[rest]), void, pa.array(ids[head[rest]])], names)

    return run


def _combined(df: DataFrame, row: str, fields: Sequence[str]) -> DataFrame:
    """Heads (fields, fingerprint, _id, _n rows of their batch) and narrow rows (_id, _head)."""
    texts = ", ".join(f"_f{i} string" for i in range(len(fields)))
    return _keyed(df, row, fields).mapInArrow(_combine(len(fields)), f"{texts}, _a bigint, _b bigint, _id bigint, _n bigint, _head bigint")


def _heads(combined: DataFrame) -> DataFrame:
    return combined.where("_head is null").withColumn("_place", F.xxhash64("_a", "_b")).repartition("_place")


def _grouped(heads: DataFrame, n_fields: int) -> DataFrame:
    keys = ["_place", "_a", "_b", *[f"_f{i}" for i in range(n_fields)]]
    return heads.groupBy(*keys).agg(F.min("_id").alias("first_id"), F.sum("_n").alias("copies"), F.count(F.lit(1)).alias("_heads"))


def groups(df: DataFrame, row: str, fields: Sequence[str]) -> DataFrame:
    """One record per group: ``first_id`` and ``copies`` (1 for a record without copies). Null equals null, not ''. An
    empty table has no groups."""
    return _grouped(_heads(_combined(df, row, fields)), len(fields)).select("first_id", "copies")


def copies(df: DataFrame, row: str, fields: Sequence[str]) -> DataFrame:
    """(first_id, copy_id): a row for each record beyond the first of its group; ``row`` must be a unique whole number and
    not null. Null equals null and nothing else; columns other than those named are ignored. The combined batches are
    written once into the shared folder, as heads and narrow rows part ways."""
    combined = written(_combined(df, row, fields), "combined")
    heads = _heads(combined)
    several = _grouped(heads, len(fields)).where("_heads > 1 and copies > 1").hint("shuffle_hash").alias("g")

    def same(c: str) -> Column:
        # Within a place; written so that it isn't taken for a key of the join, by which both sides would be shuffled again.
        h, g = F.col(f"h.{c}"), F.col(f"g.{c}")
        return F.coalesce(h.between(g, g), h.isNull() & g.isNull())

    equal = reduce(Column.__and__, [same(c) for c in ("_a", "_b", *[f"_f{i}" for i in range(len(fields))])])
    known = heads.alias("h").join(several, (F.col("h._place") == F.col("g._place")) & equal)
    handed = known.select(F.col("h._id").alias("_local"), "first_id").where(F.col("_local") > F.col("first_id"))
    narrow = combined.where("_head is not null").select("_head", "_id")
    rest = narrow.join(handed.hint("shuffle_hash"), F.col("_head") == F.col("_local"), "left")
    return handed.select("first_id", F.col("_local").alias("copy_id")).unionByName(rest.select(F.coalesce("first_id", "_head").alias("first_id"), F.col("_id").alias("copy_id")))
