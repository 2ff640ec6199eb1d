"""Changes between consecutive full deliveries of a table.

The deliveries are reduced to one row per (version, key), range-partitioned and sorted by (key, version). One pass
over each sorted range then compares neighbours, as the two pointers of a merge do: a neighbour of the next version is
the same record delivered again, a missing neighbour is an addition or a removal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, version: str, key: str, order: str, compare: Sequence[str]) -> DataFrame:
    """One row per (version, key): the one with the largest ``order`` (a null order is the smallest); of equals, the
    one with the largest values. An aggregate, so copies of a hot key are combined before the shuffle. Rows without
    version or key are left out."""
    return (
        df.where(F.col(version).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(version).alias("_version"), F.col(key).alias("_key"))
        .agg(F.max(F.struct(F.col(order).alias("_order"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(compare)])).alias("_row"))
        .select("_version", "_key", F.struct(*[F.col(f"_row._c{i}").alias(f"_c{i}") for i in range(len(compare))]).alias("_row"))
    )


def snapshot_changes(df: DataFrame, version: str, key: str, order: str, compare: Sequence[str]) -> DataFrame:
    """Rows ``version, key, change_kind, changed_fields``: what was added, removed or changed from version - 1 to version.

    Versions run from the smallest to the largest that occurs; a version without rows removes everything. Null equals
    null and differs from any value. Empty input gives no rows; columns other than those named are ignored.
    """
    rows = latest_per_key(df, version, key, order, compare)
    bounds = df.where(F.col(key).isNotNull()).agg(F.min(version).alias("lo"), F.max(version).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    merge = Window.partitionBy("_key").orderBy("_version")
    v, before, after, old = F.col("_version"), F.col("_before"), F.col("_after"), F.col("_old")

    def emit(at: Column, kind: str, fields: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("change_kind"), fields.alias("changed_fields"))

    none = F.array().cast("array<string>")
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"_row._c{i}").eqNullSafe(F.col(f"_old._c{i}")), F.lit(c)) for i, c in enumerate(compare)])
    )
    present = before.isNotNull() & (before == v - 1)
    emitted = F.array_compact(
        F.array(
            F.when((v > lo) & ~F.coalesce(present, F.lit(False)), emit(v, "added", none)),
            F.when(present & ~F.col("_row").eqNullSafe(old), emit(v, "changed", differing)),
            F.when((v < hi) & (after.isNull() | (after > v + 1)), emit(v + 1, "removed", none)),
        )
    )
    return (
        rows.repartitionByRange("_key")
        .sortWithinPartitions("_key", "_version")
        .select("*", F.lag("_version").over(merge).alias("_before"), F.lag("_row").over(merge).alias("_old"), F.lead("_version").over(merge).alias("_after"))
        .select("_key", F.explode(emitted).alias("_e"))
        .select(F.col("_e.at").cast(df.schema[version].dataType).alias(version), F.col("_key").alias(key), "_e.change_kind", "_e.changed_fields")
    )
